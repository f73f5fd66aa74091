"""Alignment of two tokenizers against plain loops over their tokens."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from cases import documents, mixed_rows
from test_llm_tokens import odd_texts
from tokenizers import Tokenizer

from tracefold.llm import alignment as A
from tracefold.llm import queries

FILES = [public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")]
ROWS = [*mixed_rows(), *((300 + k, t) for k, t in enumerate(odd_texts(80)))]


def byte_of_letter():
    """The byte-level letters by their definition: printable bytes stand for themselves."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def brute(rows):
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)"""
    tokenizer, model, letters = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[1]), byte_of_letter()
    tokenizer.encode_special_tokens = True
    made = []
    for key, text, *_ in rows:
        a, b = tokenizer.encode(" " + text, add_special_tokens=False) if text else None, model.encode(text) if text else []
        a = list(zip(a.ids, [bytes(letters[c] for c in t) for t in a.tokens])) if text else []
        pieces = [(i, model.id_to_piece(i)) for i in b]
        b = [(i, bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces]
        wanted = (" " + (text or "")).encode()
        if not text or b"".join(t for _, t in a) != wanted or b"".join(t for _, t in b) != wanted:
            a = b = []
        spans = []
        for side in (a, b):
            at, found = 0, []
            for i, t in side:
                found.append((at, at + len(t), i))
                at += len(t)
            spans.append(found)
        links, first = [], 0
        for x, y, i in spans[0]:
            while first < len(spans[1]) and spans[1][first][1] <= x:
                first += 1
            k = first
            while k < len(spans[1]) and spans[1][k][0] < y:
                links.append((i, spans[1][k][2]))
                k += 1
        groups, ends = [], sorted({y for _, y, _ in spans[0]} & {y for _, y, _ in spans[1]})
        for x, y in zip([0, *ends], ends):
            groups.append(tuple([i for p, q, i in side if x <= p and q <= y] for side in spans) if len(wanted) < 5000 else None)
        made.append((key, len(a), len(b), groups, links))
    counts = Counter(pair for *_, links in made for pair in set(links))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    return [(k, n_a, n_b, len(g), len(l), sum(counts[p] == most[p[0]] for p in l), sum(counts[p] for p in l), g) for k, n_a, n_b, g, l in made]


WANTED = brute(ROWS)


@pytest.mark.parametrize("head_size", [0, 30, 1 << 19])
def test_all_documents(spark, head_size):
    found = A.align(documents(spark, ROWS), *FILES, head_size=head_size)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    rows = [(*r[:7], [(list(g.a), list(g.b)) for g in r.groups]) for r in found.collect()]
    known = {i for i, w in enumerate(WANTED) if None not in w[7]}
    assert len(known) > len(WANTED) - 3
    assert sorted((r[:7] for r in rows), key=str) == sorted((w[:7] for w in WANTED), key=str)
    short = sorted((r for r in rows if len(r[7]) < 800), key=str)
    assert short == sorted((w for w in WANTED if len(w[7]) < 800), key=str)


def test_cases():
    by_key = {w[0]: w for w in WANTED if w[0] is not None}
    assert by_key[100][1:7] == by_key[101][1:7] == (0,) * 6
    marked = [w for w, r in zip(WANTED, ROWS) if "▁" in (r[1] or "")]
    assert marked and all(w[1:7] == (0,) * 6 for w in marked)
    assert any(w[1] for w in WANTED if w[0] and w[0] >= 300)


@pytest.mark.parametrize("held", [4, 100_000])
def test_encoder_is_both_libraries(held):
    tokenizer, model = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    tokenizer.encode_special_tokens = True
    texts = [*odd_texts(400), "a\n\n b", "\n", " \n x", "a▁b c", "tab\there", "x \u3000 y"]
    encoder = A.BothEncoder(*FILES, held)
    for k in range(0, len(texts), 50):
        some = [t for t in texts[k:k + 50]]
        a, b = encoder.encode(some)
        assert a.to_pylist() == [tokenizer.encode(" " + t, add_special_tokens=False).ids if t else [] for t in some]
        assert b.to_pylist() == [model.encode(t) for t in some]


def test_empty_tables(spark):
    assert A.align(documents(spark, ROWS).limit(0), *FILES).count() == 0
    assert A.align(documents(spark, [(1, None), (2, "")]), *FILES).select("n_links", "n_groups").collect() == [(0, 0), (0, 0)]


@pytest.mark.parametrize("block_bytes", [1, 60, 1 << 20])
def test_blocks_keep_documents_apart(spark, block_bytes):
    texts = ["some words here", None, "and there", "x" * 40, "a▁b", "é漢 mixed", ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "row long, text string").selectExpr("row", "row as key", "text")
    found = {r.row: r for r in A.align_texts(rows.coalesce(1), *FILES, block_bytes=block_bytes).collect()}
    tokenizer, model = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    for k, text in enumerate(texts):
        r, has = found[k], bool(text) and "▁" not in text
        assert sum((g.a for g in r.groups), []) == (tokenizer.encode(" " + text, add_special_tokens=False).ids if has else [])
        assert sum((g.b for g in r.groups), []) == (model.encode(text) if has else [])
        assert r.n_links == sum(r.times) == r.n_a + r.n_b - r.n_groups and r.n_groups == len(r.groups)
        assert len(set(zip(r.pair_a, r.pair_b))) == len(r.times)


def test_query(spark, tmp_path):
    rows = ROWS[-60:]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_alignment(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    wanted = []
    for *numbers, groups in brute(rows):
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        wanted.append((*numbers, hashlib.sha256(shown.encode()).hexdigest() if groups else ""))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(wanted, key=str)
