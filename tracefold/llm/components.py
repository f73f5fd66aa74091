"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracefold.llm.common import written


def _smaller(edges: DataFrame) -> DataFrame:
    return edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def connected(links: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) for each node of the links (u, v) that is not its own root.

    Each round is a few joins on the larger or the smaller end; no neighbours are gathered.
    """
    edges = written(_smaller(links), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("at")).agg(F.least(F.min("v"), F.col("at")).alias("least"))
        large = edges.join(least, F.col("v") == F.col("at")).select("u", F.col("least").alias("v")).filter("u <> v").distinct()
        low = large.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("least"))
        small = (large.join(low, F.col("u") == F.col("at"))
                 .select(F.explode(F.array(F.struct("u", F.col("least").alias("v")), F.struct(F.col("v").alias("u"), F.col("least").alias("v")))).alias("e"))
                 .select("e.*"))
        edges = written(_smaller(small), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
