"""Replay of sessions that begin alike: a tree of event lists, in which shared beginnings are folded once.

The different event lists of a model are read in stretches of 4, 4, 8, 16, ... events. Lists that have read the
same so far stand at one node of the tree. A stretch that several lists of a node go on with is folded once,
from the node's state, and leads to a node of the next level; a list that goes on alone is folded to its end.
Stretches double, so that the levels are few however long the lists are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracefold.cluster import cut_lineage
from tracefold.operators.sessions import union_all

FIRST_STRETCH = 4


def fold_tree(variants: DataFrame, models: DataFrame, opening: Column, fold: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``state`` at the end of each of the distinct lists ``variants`` (model_id, labels).

    ``opening`` is the state a model (a row of ``models``) starts in; ``fold`` advances ``state`` over ``part``.
    """
    variants = cut_lineage(variants.withColumn("id", F.monotonically_increasing_id()))
    at_node = variants.withColumn("node", F.lit(-1).cast("bigint"))
    states = models.select("model_id", F.lit(-1).cast("bigint").alias("node"), opening.alias("state"))
    key, done = ["model_id", "node", "part"], []
    read, stretch = 0, FIRST_STRETCH
    while True:
        ahead = at_node.withColumn("part", F.slice("labels", read + 1, stretch))
        rest = F.slice("labels", F.lit(read + 1), F.greatest(F.lit(0), F.size("labels") - read))
        stretches = ahead.withColumn("rest", rest).groupBy(*key).agg(
            F.count(F.lit(1)).alias("lists"), F.min("id").alias("child"), F.first("rest").alias("rest"))
        alone = F.col("lists") == 1
        todo = stretches.withColumn("stretch", F.col("part")).withColumn("part", F.when(alone, F.col("rest")).otherwise(F.col("part")))
        todo = todo.join(states, ["model_id", "node"]).join(models, "model_id")
        folded = cut_lineage(fold(todo).select("model_id", "node", F.col("stretch").alias("part"), "lists", "child", "state"))
        done.append(folded.where(alone).select(F.col("child").alias("id"), "state"))
        shared = folded.where(~alone)
        # a list that ends with the stretch; the others go on from the child
        moved = cut_lineage(ahead.join(shared.select(*key, "child"), key).select("model_id", "labels", "id", F.col("child").alias("node")))
        read, stretch = read + stretch, max(stretch, read + stretch)
        ends = F.size("labels") <= read
        states = shared.select("model_id", F.col("child").alias("node"), "state")
        done.append(moved.where(ends).join(states, ["model_id", "node"]).select("id", "state"))
        at_node = moved.where(~ends)
        if at_node.isEmpty():
            return variants.join(union_all(done), "id").drop("id")
