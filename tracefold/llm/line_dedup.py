"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line without white space at both ends, A-Z lower-cased. Keys of at least
``min_chars`` code points found in at least ``min_documents`` documents lose their lines in all
documents but the one with the largest id.

Documents come in batches of falling ids. A batch's keys are counted, merge-anti-joined with the
sorted runs of the batches before it, and written as a run of their own: a key that no run has gets
its keeper there, the others only add to the count. Two runs of a level are merged into one of the
next. Runs are bucketed by key and sorted within buckets, so joins and merges move no run.

Keys are compared by 128 bits of hash. Every row is a document. Defined cases: a null text is one
empty line and comes back as an empty text; rows with the same id share keeping; rows without an id
keep a line only if no row with an id holds it. Ids are numbers. Runs are tables of the session's catalog while
they are needed, and are dropped before the result is returned.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracefold.cluster import shared_path
from tracefold.llm.common import join_dealt, shuffle_partitions, written

BLANK = b" \t\n\v\f\r"
KEY = ["hi", "lo"]


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The hash of a line's key, or None if the key is short."""
    key = line.strip(BLANK).lower()  # of bytes: A-Z only
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


class LineRuns:
    """Sorted runs by level, each a bucketed table: hi, lo, n (documents), keeper (null if an older run has it)."""

    def __init__(self, spark: SparkSession):
        self.spark, self.levels, self.names = spark, [], []
        self.buckets = shuffle_partitions(spark)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _write(self, df: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        self.names.append(name)
        (df.select(*KEY, "n", "keeper").write.option("path", shared_path(self.spark, name)).format("parquet")
         .bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name))
        return self.spark.table(name)

    def add(self, lines: DataFrame) -> DataFrame:
        """Add a batch of (doc_id, hi, lo), ids below those of the batches before; returns its run."""
        found = lines.groupBy(*KEY).agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
        fresh = F.lit(True)
        for k, run in enumerate(self.runs()):
            found = found.join(run.select(*KEY, F.lit(True).alias(f"held_{k}")), KEY, "left")
            fresh &= F.col(f"held_{k}").isNull()
        run = self._write(found.withColumn("keeper", F.when(fresh, F.col("keeper"))))
        self._put(run, 0)
        return run

    def _put(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == 2:
            pair, self.levels[level] = self.levels[level], []
            self._put(self._write(self.merge(*pair)), level + 1)

    @staticmethod
    def merge(a: DataFrame, b: DataFrame) -> DataFrame:
        a, b = a.alias("a"), b.alias("b")
        both = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in KEY], "full")
        return both.select(
            *(F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in KEY),
            (F.coalesce("a.n", F.lit(0)) + F.coalesce("b.n", F.lit(0))).alias("n"),
            F.coalesce("a.keeper", "b.keeper").alias("keeper"))

    def merged(self) -> DataFrame:
        return reduce(self.merge, self.runs())

    def drop(self) -> None:
        """Take the runs out of the catalog."""
        while self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.names.pop()}")


def hashed_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, version, hi, lo for each distinct key of at least ``min_chars`` code points of each row."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, digests = [], []
            for k, text in enumerate(batch["text"]):
                found = {line_key(line, min_chars) for line in (text.as_py() or "").encode().split(b"\n")} - {None}
                take += [k] * len(found)
                digests += found
            pairs = pa.Array.from_buffers(pa.int64(), 2 * len(digests), [None, pa.py_buffer(b"".join(digests))])
            at = pa.array(take, pa.int64())
            even = pa.array(range(0, 2 * len(digests), 2), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(at), batch["version"].take(at), pairs.take(even), pairs.take(pa.compute.add(even, 1))],
                ["doc_id", "version", *KEY])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(keys, f"doc_id {kind}, version long, hi long, lo long")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", *, min_chars: int = 40, min_documents: int = 5,
                batches: int = 4) -> DataFrame:
    """For each row its key, n_lines, n_dropped and the text that stays."""
    spark = docs.sparkSession
    # a row's outcome follows from its id and text, so these stand for the row
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("version"))
    cuts = docs.select(F.percentile_approx(key, [k / batches for k in range(1, batches)] or 0.5).alias("cuts")).first().cuts if batches > 1 else None
    batch = F.lit(batches - 1) - sum((F.coalesce((F.col("doc_id") > c).cast("int"), F.lit(0)) for c in set(cuts or ())), F.lit(0))
    path = shared_path(spark, "lines")
    hashed_lines(rows, min_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, version long, hi long, lo long, batch int").parquet(path)
    store = LineRuns(spark)
    try:
        for k in range(batches):
            store.add(lines.filter(F.col("batch") == k))
        often = written(store.merged().filter(F.col("n") >= min_documents).select(*KEY, "keeper"), "often-lines")
    finally:
        store.drop()
    # sorted and merged: the common lines grow with the input, and dealing repeats them, so they are not to be broadcast by their file's size
    gone = (join_dealt(lines, often.hint("merge"), KEY, F.col("version")).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy(F.col("doc_id").alias("id"), F.col("version").alias("of")).agg(F.collect_set(F.struct(*KEY)).alias("gone")))
    joined = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("version") == F.col("of")), "left").select("doc_id", "text", "gone")

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, dropped, texts = [], [], []
            for text, gone in zip(batch["text"].to_pylist(), batch["gone"].to_pylist()):
                lines = (text or "").encode().split(b"\n")
                if gone:
                    out = {g["hi"].to_bytes(8, "little", signed=True) + g["lo"].to_bytes(8, "little", signed=True) for g in gone}
                    stay = [line for line in lines if line_key(line, min_chars) not in out]
                else:
                    stay = lines
                counts.append(len(lines))
                dropped.append(len(lines) - len(stay))
                texts.append(b"\n".join(stay).decode())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts, pa.string())],
                ["doc_id", "n_lines", "n_dropped", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(drop, f"doc_id {kind}, n_lines long, n_dropped long, text string").withColumnsRenamed({"doc_id": key, "text": text})
