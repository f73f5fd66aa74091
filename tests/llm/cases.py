"""Small tables with the awkward rows: nulls, empty texts, ties, repeated rows, clashing columns."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["row", "key", "fp", "version", "p", "place", "held", "doc", "items", "words", "lines", "score", "level_0", "others", "host",
            "n_words", "token", "part", "ids", "epoch", "value", "body", "spans", "lang_pred"]


def documents(spark, rows):
    """Rows of (doc_id, text, lang, source); every name that operators use inside is a column too."""
    filled = [(*r, *(None,) * (4 - len(r)), len(r[1] or "")) for r in rows]
    return spark.createDataFrame(filled, SCHEMA).withColumns({c: F.lit(7) for c in CLASHING})


def words(rng, n, vocabulary=60):
    return " ".join(f"w{min(int(rng.paretovariate(0.6)), vocabulary)}" for _ in range(n))


def mixed_rows(seed=3, n=40):
    """Random texts with copies, near copies and shared passages, then the awkward ones."""
    rng = random.Random(seed)
    passage = " ".join(f"p{k}" for k in range(45))
    made = []
    for k in range(n):
        text = words(rng, rng.choice([3, 15, 60, 200]), 300)
        if k % 5 == 0:
            text += "\n" + passage + " " + words(rng, 9)
        if k % 7 == 0 and made:
            text = rng.choice(made)[1]
        if k % 9 == 0 and made:
            text = made[-1][1] + " changed"
        made.append((k, text, "en", f"src{k % 3}"))
    long = " ".join(f"x{k % 977}" for k in range(30_000))
    return [*made, (100, None, None, None), (101, "", "en", None), (102, " \n\t ", "de", "src1"), (None, "no id here at all", "en", "src0"),
            (103, "once once once", "en", "src0"), (103, "once once once", "en", "src0"), (103, "another text of the same id", "fr", "src0"),
            (104, "a " * 200, "en", "src0"), (105, long, "en", "src2"), (106, "Ünïcödé ñ 漢字   \x0b\x0c x\x1cy", "es", "src9"),
            (None, passage, "en", "src1")]
