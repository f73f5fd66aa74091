"""What several operators share: tables, written stages, words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracefold.cluster import shared_path

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the folder that all executors share; what follows starts from those files."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def byte_length(text: Column) -> Column:
    """UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def join_dealt(rows: DataFrame, one_per_key: DataFrame, keys: list[str], by: Column, parts: int = 64) -> DataFrame:
    """Inner join with a table that has a row for each key. The rows of a common key are dealt to ``parts`` places by ``by``."""
    everywhere = one_per_key.withColumn("dealt", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return rows.withColumn("dealt", F.pmod(by, F.lit(parts)).cast("int")).join(everywhere, [*keys, "dealt"]).drop("dealt")


class PartCache:
    """What parts of texts are encoded as; of two generations, so that parts that keep coming are encoded once while rare ones leave.

    Subclasses say how parts are encoded. At most ``held`` parts are kept, apart from those of the current call.
    """

    def __init__(self, held: int):
        self.held, self.encoded = held, 0
        self.young: dict = {}
        self.old: dict = {}

    def encode_parts(self, parts: list[str]) -> Iterable:
        raise NotImplementedError

    def lookup(self, parts: list[str]) -> list:
        """What each part is encoded as."""
        found = list(map(self.young.get, parts))
        gaps = [k for k, known in enumerate(found) if known is None]
        missing = {parts[k] for k in gaps}
        again = missing & self.old.keys()
        self.young.update((part, self.old[part]) for part in again)
        new = list(missing - again)
        self.encoded += len(new)
        self.young.update(zip(new, self.encode_parts(new)))
        for k in gaps:
            found[k] = self.young[parts[k]]
        if len(self.young) > self.held // 2:
            self.young, self.old = {}, self.young
        return found

    def join(self, texts: list[list[str]]) -> list[bytes]:
        """The encoded bytes of each text, given as its parts."""
        found = self.lookup(list(chain.from_iterable(texts)))
        ends = list(accumulate(map(len, texts), initial=0))
        return [b"".join(found[a:z]) for a, z in zip(ends, ends[1:])]


def take_lists(values: np.ndarray, ends: np.ndarray, which: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists (``values`` cut at ``ends``) picked by number and joined: the picks up to each of ``upto`` are one list."""
    starts = np.append(0, ends)[which]
    sizes = ends[which] - starts if len(which) else np.zeros(0, np.int64)
    total = np.append(0, np.cumsum(sizes))
    at = np.arange(total[-1]) + np.repeat(starts - total[:-1], sizes)
    return values[at], total[upto]


def blocks_of(texts: pa.Array, block_bytes: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``block_bytes`` of text, one row at least."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        limit = (upto[start - 1] if start else 0) + block_bytes
        end = max(start + 1, int(np.searchsorted(upto, limit, "right")))
        yield start, end
        start = end
