"""Ranked search against scores of every document for every item."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from cases import documents, mixed_rows, words

from tracefold.llm import lexical_search as S
from tracefold.llm.decontamination import words_of


def brute(rows, items, limit=10):
    """(item, rank, score, key) by the definition; rows of one key and score are told apart by nothing."""
    texts = [(k, words_of(t)) for k, t, *_ in rows]
    texts = [(k, w) for k, w in texts if w]
    n, total = len(texts), sum(len(w) for _, w in texts)
    held = Counter(t for _, w in texts for t in set(w))
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * c + 1))) for t, c in held.items()}
    found = []
    for item, text in items:
        scored = []
        for k, w in texts:
            tf, m = Counter(w), 25 + 75 * len(w) * n // total
            score = sum(weight[t] * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in words_of(text) if t in tf)
            if score > 0:
                scored.append((-score, k is None, k or 0))
        found += [(item, r, -s, None if none else k) for r, (s, none, k) in enumerate(sorted(scored)[:limit], 1)]
    return sorted(found, key=str)


def items_of(rng, rows):
    made = [(k, " ".join((rng.choice(rows)[1] or "").split()[:12]) + " " + words(rng, 5)) for k in range(12)]
    return [*made, (50, None), (51, ""), (52, "nothing that occurs"), (53, "w1"), (None, "w2 w2 W3"), (3, "once no id"), (3, "once no id"), (54, "Ünïcödé 漢字 P3")]


@pytest.mark.parametrize("options", [{}, {"shard_postings": 40, "block": 2}, {"block_bytes": 150, "block": 1}, {"shard_postings": 1}])
def test_against_all_scores(spark, options):
    rng = random.Random(1)
    rows = mixed_rows()
    items = items_of(rng, rows)
    found = S.rank(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"), **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(((r.item_id, r.rank, r.score, r.doc_id) for r in found.collect()), key=str) == brute(rows, items)


def test_text_keys_and_empty_tables(spark):
    rows = [("b", "x y"), ("a", "y x"), (None, "x y"), ("c", "z")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    items = spark.createDataFrame([("i", "x", 1)], "item_id string, text string, score int")
    assert [r.doc_id for r in sorted(S.rank(docs, items).collect(), key=lambda r: r["rank"])] == ["a", "b", None]
    assert S.rank(docs.limit(0), items).count() == 0 and S.rank(docs, items.limit(0)).count() == 0


def shard(rng, n=3000, n_terms=120):
    """Documents of a few topics."""
    rows = []
    for _ in range(n):
        topic = rng.integers(0, 12)
        terms = np.unique(np.concatenate([topic * 10 + rng.integers(0, 10, 6), rng.zipf(1.5, 3) % n_terms]))
        rows.append((terms, rng.integers(1, 1000, len(terms))))
    ends = np.cumsum([len(t) for t, _ in rows])
    made = S.Shard(ends, np.concatenate([t for t, _ in rows]).astype(np.int32), np.concatenate([w for _, w in rows]), np.arange(n), n_terms, 16)
    return rows, made


def test_blocks_that_were_not_kept(monkeypatch):
    rng = np.random.default_rng(4)
    _, made = shard(rng, 400)
    asked = [(np.array([0, 3, 12]), np.array([1, 1, 2])), (np.array([1, 2, 50]), np.array([3, 1, 1]))] * 2
    wanted = [made.search(*a, 10) for a in asked]
    monkeypatch.setattr(S, "HELD", 1)
    made.blocks.clear()
    for a, (docs, scores) in zip(asked, wanted):
        again = made.search(*a, 10)
        assert again[0].tolist() == docs.tolist() and again[1].tolist() == scores.tolist() and len(made.blocks) <= 2


def test_bounds_hold_and_blocks_are_skipped():
    rng = np.random.default_rng(3)
    rows, made = shard(rng)
    scored = []
    real = made._rows
    made._rows = lambda docs: scored.append(len(docs)) or real(docs)
    for _ in range(30):
        terms = np.unique(rng.integers(0, 12) * 10 + rng.integers(0, 10, 4))
        times = rng.integers(1, 3, len(terms))
        asked = dict(zip(terms.tolist(), times.tolist()))
        truth = np.array([sum(asked.get(t, 0) * w for t, w in zip(r[0].tolist(), r[1].tolist())) for r in rows])
        for term in terms.tolist():
            docs, ends, *_ = blocks = made.blocks_of(term)
            assert sorted(docs.tolist()) == [d for d, r in enumerate(rows) if term in r[0]]
            bounds = made.bounds(blocks, terms, times)
            assert np.diff(np.append(0, ends)).max() <= 32
            assert all(truth[docs[a:z]].max() <= bound for a, z, bound in zip([0, *ends[:-1]], ends, bounds))
        scored.clear()
        docs, scores = made.search(terms, times, 10)
        wanted = np.lexsort((np.arange(len(truth)), -truth))[:10]
        assert docs.tolist() == wanted.tolist() and scores.tolist() == truth[wanted].tolist()
        # far fewer documents are scored than hold a term
        assert sum(scored) < (truth > 0).sum()
