import random
import re

import pytest
from cases import documents, mixed_rows, words
from pyspark.sql import functions as F

from tracefold.llm.decontamination import find_contamination


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, window):
    out = []
    for k, text, *_ in rows:
        w = split(text)
        hit, found = set(), set()
        for item, item_text in items:
            iw = split(item_text)
            size = min(window, len(iw))
            own = {tuple(iw[a:a + size]) for a in range(len(iw) - size + 1)} if iw else set()
            for a in range(len(w) - size + 1):
                if size and tuple(w[a:a + size]) in own:
                    hit |= set(range(a, a + size))
                    found |= {str(item)} if item is not None else set()
        out.append(((k is None, k or 0), len(w), len(hit), sorted(found)))
    return sorted(out)


ITEMS = [(1, "The QUICK brown fox; jumps over the lazy dog again, and again and again"), (2, "short-item of five words"), (10, "!!! ..."), (11, None),
         (None, "an item that has no id but has ten words or more"), (3, "p1 p2 p3 p4 p5 p6 p7 p8 p9 p10 p11 p12"), (3, "another row of the same item id with ten words"),
         (4, "a a a a a a a a a a a a"), (4, "a a a a a a a a a a a a"), (5, "ünïcödé ñ 漢字 x")]


def rows_with_items():
    rng = random.Random(9)
    made = []
    for k in range(30):
        text = words(rng, 20)
        for _, item in rng.sample(ITEMS, 2):
            text += " " + (item or "").upper() + " / " + words(rng, 3)
        made.append((500 + k, text, "en", "s"))
    return [*mixed_rows(), *made, made[0], (600, "the quick brown fox jumps over the lazy dog", "en", "s")]


@pytest.mark.parametrize("window, shingle, block_bytes", [(10, 3, 1 << 20), (10, 1, 100), (4, 5, 1 << 20)])
def test_windows(spark, window, shingle, block_bytes):
    rows = rows_with_items()
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("item", F.lit(1))
    found = find_contamination(documents(spark, rows), items, window=window, shingle=shingle, block_bytes=block_bytes).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_words, sum(s.end - s.start for s in r.spans), r.item_ids) for r in found) == brute(rows, ITEMS, window)


def test_empty_tables_and_whole_rows(spark):
    docs, items = documents(spark, rows_with_items()), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert find_contamination(docs.limit(0), items).count() == 0
    clean = find_contamination(docs, items.limit(0), with_row=True)
    assert clean.filter(F.size("spans") > 0).count() == 0
    assert clean.select("doc.*").dtypes == docs.dtypes
    assert sorted(map(str, clean.select("doc.*").collect())) == sorted(map(str, docs.collect()))
