"""Quality rules: base rules within a text, and the frequency of lines across the documents of a host.

Only DataFrame functions are used. Lines are normalised (lower case, runs of white space and of
digits made equal) and hashed together with their host. A line found in more than ``max_documents``
documents of a host is removed from all of them. A document left with fewer than ``min_words`` words,
or with less than ``min_share`` of its words, is rejected, as is one that fails the base rules.

Every row is a document, also if rows are equal; a document counts once for a line that it repeats.
Defined cases: a null or empty text has no words and fails the base rules; a null host is a host of
its own. Two different lines count as one if their 64-bit hashes are equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracefold.llm.common import WORD, written

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def normalised(line: Column) -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D]+", " ")), "[0-9]+", "0")


def _repeats(rows: DataFrame) -> DataFrame:
    """Words in windows found twice or more in a text: the windows are sorted by hash, so equal ones are neighbours.

    Each step is a projection of its own; a later one reads its arrays many times.
    """
    hashes = F.col("hashes")
    window = F.transform(F.slice("hashes", 1, F.greatest(F.col("n_words") - (WINDOW - 1), F.lit(0))),
                         lambda h, i: F.xxhash64(h, *(F.get(hashes, i + k) for k in range(1, WINDOW))))
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))).withColumn("windows", window)
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn("by_hash", F.when(repeated, F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    by_hash = F.col("by_hash")

    def has_equal(x: Column, k: Column) -> Column:
        return F.coalesce(F.get(by_hash, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(by_hash, k + 1)["h"] == x["h"], F.lit(False))

    rows = rows.withColumn("starts", F.array_sort(F.transform(F.filter("by_hash", has_equal), lambda x: x["i"])))
    starts = F.col("starts")
    covered = F.transform("starts", lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - s, F.lit(WINDOW))))
    total = F.aggregate(covered, F.lit(0), lambda a, b: a + b)
    return (rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long"))
            .drop("hashes", "windows", "by_hash", "starts"))


def base_rules(docs: DataFrame, text: str, keep: list[Column]) -> DataFrame:
    """``keep`` and the counts of the base rules for each row; ``lines`` holds the lines that have a word."""
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("body"))
    rows = rows.select("*", F.regexp_extract_all("body", F.lit(WORD), F.lit(0)).alias("words"),
                       F.filter(F.split("body", "\n"), lambda line: line.rlike(WORD)).alias("lines"))
    rows = rows.select(
        "*", F.size("words").cast("long").alias("n_words"), F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("body", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines")).drop("body")
    return _repeats(rows).drop("words")


def rate_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", *, max_documents: int = 50,
                   min_words: int = 10, min_share: float = 0.5, with_text: bool = False) -> DataFrame:
    """For each row the counts of the base rules, base_failed, n_removed (words in removed lines) and kept.

    ``with_text`` adds clean_text, the text without the removed lines.
    """
    body = [F.col(text).alias("text")] if with_text else []
    rated = base_rules(docs, text, [F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(host).alias("host"), *body])
    rated = rated.withColumn("lines", F.transform("lines", lambda line: F.struct(
        F.xxhash64(F.col("host"), normalised(line)).alias("line"), F.regexp_count(line, F.lit(WORD)).alias("words"))))
    rated = written(rated, "quality")
    frequent = (rated.select(F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line"))
                .groupBy("line").agg(F.count("*").alias("documents")).filter(F.col("documents") > max_documents).select("line"))
    gone = (rated.select("row", F.inline("lines")).join(frequent, "line", "left_semi")
            .groupBy("row").agg(F.sum("words").alias("n_removed"), *([F.collect_set("line").alias("gone")] if with_text else [])))
    found = rated.join(gone, "row", "left").withColumn("n_removed", F.coalesce("n_removed", F.lit(0)).cast("long"))
    left = F.col("n_words") - F.col("n_removed")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    found = found.withColumns({"base_failed": failed, "kept": ~failed & (left >= min_words) & (left >= min_share * F.col("n_words"))})
    out = [F.col("key").alias(key), *BASE, "n_removed", "base_failed", "kept"]
    if with_text:
        stays = F.filter(F.split("text", "\n"), lambda line: ~F.coalesce(
            line.rlike(WORD) & F.array_contains("gone", F.xxhash64(F.col("host"), normalised(line))), F.lit(False)))
        out.append(F.array_join(stays, "\n").alias("clean_text"))
    return found.select(*out)
