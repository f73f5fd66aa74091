"""Mixing sources to target weights by hierarchical budgeting, with DataFrame functions only.

A token budget is handed down a tree of groups (say domain, language, source). Children share their
parent's tokens by weight. A child cannot get more than its documents hold in ``max_epochs`` epochs;
what it leaves goes to its siblings by their weights, and to the parent's siblings only when the whole
family is full, as a family's capacity is the sum of its members'. Members of weight 0 count for nothing there, at any level,
so what they hold is left to the others.

A leaf's tokens are whole epochs and a prefix of one more. Every epoch has its own seeded order of the
leaf's documents. Where the prefix ends is found by two histograms over the leading digits of the
order and a running sum over the documents of one small bin; no group is sorted as a whole. Documents
are then joined with one row per leaf.

Defined cases: null group values are a group of their own. Groups with weight 0 get nothing. Shares
are rounded down. A document without words is never selected. Documents of a leaf with one id stand
at one place of the order; if the prefix ends within them, each gives the same part of its tokens,
rounded down. An empty table or a budget of 0 selects nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracefold.llm.common import WORD, join_dealt, written

DIGITS = 3  # of 16 values: histograms have 4096 bins


def _big(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")


def tagged(group: Column) -> Column:
    """A group's value as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def weight_of(level: str, weights: Mapping[str, int]) -> Column:
    found = F.lit(1)
    for value, weight in weights.items():
        found = F.when(F.col(level) == f"={value}", F.lit(weight)).otherwise(found)
    return found.cast("long")


def share(children: DataFrame, parent: Sequence[str], own: str) -> DataFrame:
    """``tokens`` for each child of (parent, own, weight, cap, given), weights above 0: capped shares of what the parent is given."""
    family = Window.partitionBy(*parent, "given")
    by_need = family.orderBy(F.col("cap") / F.col("weight"), own)
    before = F.coalesce(F.sum("cap").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weights = F.sum("weight").over(by_need.rowsBetween(0, Window.unboundedFollowing))
    ranked = children.withColumns({"before": before, "weights": weights})
    full = _big("cap") * _big("weights") + _big("before") * _big("weight") <= _big("given") * _big("weight")
    ranked = ranked.withColumn("full", full)
    ranked = ranked.withColumns({
        "used": F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(family), F.lit(0)),
        "open": F.sum(F.when(~F.col("full"), F.col("weight"))).over(family)})
    part = F.expr("cast(cast(given - used as decimal(38,0)) * cast(weight as decimal(38,0)) div cast(open as decimal(38,0)) as long)")
    return ranked.select(*parent, own, F.when(F.col("full"), F.col("cap")).otherwise(part).alias("tokens"))


def budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], *, budget_percent: int,
            max_epochs: int) -> DataFrame:
    """Tokens for each leaf of (levels, held): ``budget_percent`` of all tokens, handed down the tree.

    A leaf below a group of weight 0 adds to the budget but not to what its ancestors can hold.
    """
    total = leaves.agg(F.coalesce(F.floor(F.sum("held") * budget_percent / 100), F.lit(0)).cast("long").alias("given"))
    for level in levels:
        leaves = leaves.filter(weight_of(level, weights.get(level, {})) > 0)
    given: DataFrame | None = None
    for k, level in enumerate(levels):
        path = list(levels[:k + 1])
        nodes = leaves.groupBy(*path).agg((F.sum("held") * max_epochs).alias("cap")).withColumn("weight", weight_of(level, weights.get(level, {})))
        if given is None:
            nodes = nodes.join(F.broadcast(total))  # one row
        else:
            nodes = nodes.join(given.withColumnRenamed("tokens", "given"), path[:-1])
        given = share(nodes, path[:-1], level)
    return given


def _running(bins: DataFrame, levels: Sequence[str], order: str) -> DataFrame:
    """The bin of each leaf in which ``rest`` is reached, with what comes before it."""
    upto = F.sum("held").over(Window.partitionBy(*levels).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return (bins.withColumn("upto", upto).filter((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("held") < F.col("rest")))
            .withColumn("rest", F.col("rest") - F.col("upto") + F.col("held")).drop("upto"))


def with_leaf(rows: DataFrame, leaves: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Rows with what their leaf has."""
    return join_dealt(rows, leaves, list(levels), F.xxhash64("id"))


def cuts(rows: DataFrame, leaves: DataFrame, levels: Sequence[str], order: Column) -> DataFrame:
    """For each leaf with a prefix the place in the order where it ends, and what is taken of the unit there."""
    wanted = leaves.filter("rest > 0").select(*levels, "epochs", "rest")
    placed = with_leaf(rows, wanted.drop("rest"), levels).withColumn("place", order).filter("held > 0")
    found = wanted.drop("epochs")
    for k in range(2):
        digits = F.substring("place", 1 + k * DIGITS, DIGITS)
        here = placed if k == 0 else with_leaf(placed, found.select(*levels, "lead"), levels).filter(F.col("place").startswith(F.col("lead")))
        bins = here.groupBy(*levels, digits.alias("bin")).agg(F.sum("held").alias("held")).join(found, list(levels))
        lead = F.col("bin") if k == 0 else F.concat("lead", "bin")
        found = _running(bins, levels, "bin").select(*levels, lead.alias("lead"), "rest")
    here = with_leaf(placed, found, levels).filter(F.col("place").startswith(F.col("lead")))
    units = here.groupBy(*levels, "place", "rest").agg(F.sum("held").alias("held"))
    return _running(units, levels, "place").select(*levels, F.col("place").alias("cut"), F.col("rest").alias("cut_rest"), F.col("held").alias("cut_held"))


def mix(docs: DataFrame, groups: Mapping[str, Column], weights: Mapping[str, Mapping[str, int]], *, key: str = "doc_id",
        text: str = "text", budget_percent: int = 100, max_epochs: int = 4, seed: int = 17) -> DataFrame:
    """A row for each document and epoch selected: ``doc`` (the row), epoch, n_tokens and take_tokens.

    ``groups`` names the levels from the top, with an expression over ``docs`` for each; ``weights``
    gives whole weights by level and value, 1 for values not named.
    """
    levels = [f"level_{k}" for k in range(len(groups))]
    named = dict(zip(levels, (weights.get(g, {}) for g in groups)))
    rows = docs.select(F.struct("*").alias("doc"), F.coalesce(F.col(key).cast("string"), F.lit("-")).alias("id"),
                       F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("held"),
                       *(tagged(c).alias(level) for level, c in zip(levels, groups.values())))
    counted = written(rows.select("id", "held", *levels), "token-lengths")
    held = counted.groupBy(*levels).agg(F.sum("held").alias("held")).filter("held > 0")
    given = budgets(held, levels, named, budget_percent=budget_percent, max_epochs=max_epochs)
    leaves = held.join(given, levels).withColumns({"epochs": F.expr("tokens div held"), "rest": F.expr("tokens % held")}).drop("held", "tokens")
    leaves = written(leaves, "leaves")
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.col("id")))
    ends = written(leaves.join(cuts(counted, leaves, levels, place), levels, "left"), "leaf-cuts")
    chosen = with_leaf(rows.filter("held > 0"), ends, levels).withColumn("place", place)
    last = (F.when(F.col("place") < F.col("cut"), F.col("held"))
            .when(F.col("place") == F.col("cut"), F.expr("cast(cast(cut_rest as decimal(38,0)) * cast(held as decimal(38,0)) div cast(cut_held as decimal(38,0)) as long)"))
            .otherwise(F.lit(0)))
    chosen = chosen.withColumn("last", last)
    epochs = F.col("epochs") + F.when(F.col("last") > 0, 1).otherwise(0)
    chosen = chosen.filter(epochs > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), epochs - 1)))
    taken = F.when(F.col("epoch") < F.col("epochs"), F.col("held")).otherwise(F.col("last"))
    return chosen.select("doc", "epoch", F.col("held").alias("n_tokens"), taken.alias("take_tokens"))
