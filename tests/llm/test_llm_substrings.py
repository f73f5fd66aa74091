import random

import pytest
from cases import documents, mixed_rows, words
from pyspark.sql import functions as F

from tracefold.llm.substring_dedup import dedup_substrings


def brute(rows, window):
    """Occurrences by window in the order of ids, then texts' hashes; equal rows are one document."""
    unique = {}
    for k, text, version in rows:
        unique[(k is None, k or 0, version % (1 << 64) >> 32)] = text
    seen, kept = {}, {}
    for key in sorted(unique):
        w = (unique[key] or "").encode().split()
        gone = set()
        for s in range(len(w) - window + 1):
            if seen.setdefault(tuple(w[s:s + window]), (key, s)) != (key, s):
                gone |= set(range(s, s + window))
        kept[key] = len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()
    return sorted(((k is None, k or 0), *kept[(k is None, k or 0, v % (1 << 64) >> 32)]) for k, _, v in rows)


@pytest.mark.parametrize("window, vocabulary", [(20, 300), (20, 2), (5, 6), (33, 1)])
def test_repeats(spark, window, vocabulary):
    rng = random.Random(vocabulary)
    rows = mixed_rows()
    passages = [words(rng, n, vocabulary) for n in (19, 20, 21, 70)]
    for k in range(60):
        rows.append((800 + k, " ".join([words(rng, rng.randrange(12), vocabulary), rng.choice(passages), words(rng, rng.randrange(30), vocabulary), rng.choice(passages)]), "en", "s"))
    rows += rows[-2:]
    docs = documents(spark, rows)
    versions = [(r.doc_id, r.text, r.v) for r in docs.select("doc_id", "text", F.xxhash64("text").alias("v")).collect()]
    found = dedup_substrings(docs, window=window).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_words, r.n_removed, r.text) for r in found) == brute(versions, window)


def test_empty_table(spark):
    assert dedup_substrings(documents(spark, mixed_rows()).limit(0)).count() == 0
