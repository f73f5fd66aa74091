"""Process models as tables: building, editing and looking up Petri nets.

Every operator works on all models in the tables at once and keeps results in
long form, so neither the number of models nor the size of one model has to fit
a single task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Tables with a row per event name are broadcast up to this size; larger ones are joined by name and deal.
BROADCAST_MODEL_BYTES = 16 << 20
ROW_BYTES = 64
DEALS = 64


@dataclass(frozen=True)
class Nets:
    """Places, transitions and arcs of any number of models."""

    places: DataFrame
    transitions: DataFrame
    arcs: DataFrame


def _next_ord(existing: DataFrame, order: str) -> DataFrame:
    return existing.groupBy("model_id").agg((F.max(order) + 1).alias("base"))


def _append(existing: DataFrame, added: DataFrame, order: str) -> DataFrame:
    """Append rows numbered 0, 1, ... per model after the rows the model already has."""
    numbered = (
        added.join(_next_ord(existing, order), "model_id", "left")
        .withColumn(order, (F.col(order) + F.coalesce("base", F.lit(0))).cast("int"))
    )
    return existing.unionByName(numbered.select(existing.columns))


def add_places(nets: Nets, added: DataFrame) -> Nets:
    """Add places; ``place_ord`` of the new rows counts from 0 within each model."""
    return replace(nets, places=_append(nets.places, added, "place_ord"))


def add_arcs(nets: Nets, added: DataFrame) -> Nets:
    """Add arcs; ``arc_ord`` of the new rows counts from 0 within each model."""
    return replace(nets, arcs=_append(nets.arcs, added, "arc_ord"))


def add_transitions(nets: Nets, added: DataFrame) -> Nets:
    """Add transitions, with their arcs where ``input_places`` and ``output_places`` are given.

    ``added`` holds model_id, trans_ord (from 0 within each model), transition_id, name
    and optionally the two place arrays.
    """
    transitions = _append(nets.transitions, added.select(nets.transitions.columns), "trans_ord")
    listed = [c for c in ("input_places", "output_places") if c in added.columns]
    if not listed:
        return replace(nets, transitions=transitions)
    # arc numbers leave every list of a model the same room, so no rows have to be counted in order
    longest = F.max(F.greatest(F.lit(0), *[F.size(c) for c in listed])).alias("room")
    roomy = added.join(added.groupBy("model_id").agg(longest), "model_id")
    place_lists = F.array(*[F.struct(F.lit(k).alias("list"), F.col(c).alias("places")) for k, c in enumerate(listed)])
    ends = (
        roomy.select("model_id", "trans_ord", "transition_id", "room", F.inline(place_lists))
        .select("*", F.posexplode("places").alias("nth", "place_id"))
    )
    is_input = F.element_at(F.array(*[F.lit(c == "input_places") for c in listed]), F.col("list") + 1)
    arcs = ends.select(
        "model_id", ((F.col("trans_ord") * len(listed) + F.col("list")) * F.col("room") + F.col("nth")).alias("arc_ord"),
        F.when(is_input, F.col("place_id")).otherwise(F.col("transition_id")).alias("source"),
        F.when(is_input, F.col("transition_id")).otherwise(F.col("place_id")).alias("target"),
    )
    return replace(nets, transitions=transitions, arcs=_append(nets.arcs, arcs, "arc_ord"))


def delete_transitions(nets: Nets, deleted: DataFrame) -> Nets:
    """Remove transitions and the arcs touching them; places stay."""
    gone = deleted.select("model_id", "transition_id")
    leaves_transition = F.substring("source", 1, 1) == "t"
    arcs = nets.arcs.withColumn("transition_id", F.when(leaves_transition, F.col("source")).otherwise(F.col("target")))
    key = ["model_id", "transition_id"]
    return replace(
        nets,
        transitions=nets.transitions.join(gone, key, "left_anti"),
        arcs=arcs.join(gone, key, "left_anti").select(nets.arcs.columns),
    )


def directed_arcs(nets: Nets) -> DataFrame:
    """Arcs seen from their transition: (model_id, transition_id, side, place_id, arc_ord).

    The first letter of the source decides the direction: p is an input, t an output,
    anything else is not an arc.
    """
    kind = F.substring("source", 1, 1)
    return nets.arcs.where(kind.isin("p", "t")).select(
        "model_id",
        F.when(kind == "p", F.col("target")).otherwise(F.col("source")).alias("transition_id"),
        F.when(kind == "p", "in").otherwise("out").alias("side"),
        F.when(kind == "p", F.col("source")).otherwise(F.col("target")).alias("place_id"),
        "arc_ord",
    )


def transition_arcs(nets: Nets) -> DataFrame:
    """Directed arcs without repeats: a place counts once per side, at its lowest arc."""
    return (
        directed_arcs(nets)
        .groupBy("model_id", "transition_id", "side", "place_id").agg(F.min("arc_ord").alias("arc_ord"))
    )


def transition_lookup(nets: Nets) -> DataFrame:
    """Transitions by event name, in file order within a name."""
    return nets.transitions.select("model_id", "name", "trans_ord", "transition_id")


def _without(nets: Nets, side: str) -> DataFrame:
    arcs = transition_arcs(nets).where(F.col("side") == side)
    return nets.transitions.join(arcs, ["model_id", "transition_id"], "left_anti").select("model_id", "transition_id")


def input_transitions(nets: Nets) -> DataFrame:
    """Transitions that lead into the model: no input place."""
    return _without(nets, "in")


def output_transitions(nets: Nets) -> DataFrame:
    """Transitions that lead out of the model: no output place."""
    return _without(nets, "out")


def merge_transitions(nets: Nets, merges: DataFrame) -> Nets:
    """Give ``transition_id`` the places of ``other_id`` too, its own first.

    ``merges`` holds (model_id, transition_id, other_id); the other transition stays as it is.
    """
    borrowed = (
        directed_arcs(nets).withColumnRenamed("transition_id", "other_id")
        .join(merges, ["model_id", "other_id"])
        .join(_next_ord(nets.arcs, "arc_ord"), "model_id")
    )
    is_input = F.col("side") == "in"
    rows = borrowed.select(
        "model_id", (F.col("arc_ord") + F.col("base")).cast("int").alias("arc_ord"),
        F.when(is_input, F.col("place_id")).otherwise(F.col("transition_id")).alias("source"),
        F.when(is_input, F.col("transition_id")).otherwise(F.col("place_id")).alias("target"),
    )
    return replace(nets, arcs=nets.arcs.unionByName(rows))


def suffix_ids(nets: Nets, suffix: str) -> Nets:
    """Append ``_suffix`` to every id, so that nets can be combined; no suffix, no change."""
    if not suffix:
        return nets

    def named(*columns: str) -> dict[str, Column]:
        return {c: F.concat_ws("_", F.col(c), F.lit(suffix)) for c in columns}
    return Nets(
        nets.places.withColumns(named("place_id")),
        nets.transitions.withColumns(named("transition_id")),
        nets.arcs.withColumns(named("source", "target")),
    )


def initial_marking(nets: Nets) -> DataFrame:
    """Places that hold tokens before the first event."""
    return nets.places.where(F.col("init_tokens") > 0).select("model_id", "place_id", "init_tokens")


def union_nets(*nets: Nets) -> Nets:
    """All models of several net tables together."""
    first, *rest = nets
    for other in rest:
        first = Nets(first.places.unionByName(other.places), first.transitions.unionByName(other.transitions),
                     first.arcs.unionByName(other.arcs))
    return first


def event_transition_lookup(log: DataFrame, nets: Nets, model_id: str) -> DataFrame:
    """Each event of a log with every transition of its name in the model."""
    lookup = transition_lookup(nets).where(F.col("model_id") == model_id).withColumnRenamed("name", "event")
    return event_join(check_nets(nets, [model_id]))(log, lookup, ["event"])


def missing_ratios(markings: DataFrame, nets: Nets) -> DataFrame:
    """Share of a transition's input places that hold no token.

    ``markings`` holds (model_id, marking_id, event, tokens): the tokens of a marking as
    an array of place ids and the event to be fired. A transition without input places
    misses nothing.
    """
    inputs = transition_arcs(nets).where(F.col("side") == "in")
    needs = (
        nets.transitions.join(inputs, ["model_id", "transition_id"], "left")
        .groupBy("model_id", "transition_id", "trans_ord", F.col("name").alias("event"))
        .agg(F.sort_array(F.collect_list(F.when(F.col("place_id").isNotNull(), F.struct("arc_ord", "place_id"))))
             ["place_id"].alias("ins"))
    )
    absent = F.size(F.filter("ins", lambda place: ~F.array_contains("tokens", place)))
    ratio = F.when(F.size("ins") == 0, F.lit(0.0)).otherwise(absent.cast("double") / F.size("ins"))
    # one row per transition; left to Spark, which sees the size of the tables or splits a common name
    return (
        markings.join(needs, ["model_id", "event"])
        .select("model_id", "marking_id", "event", "transition_id", "trans_ord", ratio.alias("ratio"))
    )


def least_missing_transitions(markings: DataFrame, nets: Nets) -> DataFrame:
    """For each marking and event, all transitions tied for the lowest missing ratio."""
    ratios = missing_ratios(markings, nets)
    event_key = ["model_id", "marking_id", "event"]
    lowest = F.min("ratio").over(Window.partitionBy(*event_key))
    return ratios.withColumn("lowest", lowest).where(F.col("ratio") == F.col("lowest")).drop("lowest")


@dataclass(frozen=True)
class ModelFacts:
    """What replay has to know about one model before it is planned."""

    transitions: int
    arcs: int
    most_per_name: int
    size: int = field(default=0, compare=False)  # bytes, about


def check_nets(nets: Nets, model_ids: list[str]) -> dict[str, ModelFacts]:
    """Measure the named models and refuse broken ones.

    Refused: a transition id used twice, a transition without a name, an arc to or from
    an undeclared transition, a model that is not in the tables.
    """
    wanted = F.col("model_id").isin(model_ids)
    declared = nets.transitions.where(wanted)
    # one row per use of a transition id or of an event name
    uses = (
        declared.select("model_id", F.lit("id").alias("kind"), F.col("transition_id").alias("key"), F.lit(1).alias("declared"))
        .unionByName(declared.select("model_id", F.lit("name").alias("kind"), F.col("name").alias("key"), F.lit(1).alias("declared")))
        .unionByName(directed_arcs(nets).where(wanted).select(
            "model_id", F.lit("id").alias("kind"), F.col("transition_id").alias("key"), F.lit(0).alias("declared")))
    )
    is_id, is_name = F.col("kind") == "id", F.col("kind") == "name"
    rows = (
        uses.groupBy("model_id", "kind", "key").agg(F.sum("declared").alias("declared"), F.count(F.lit(1)).alias("uses"))
        .groupBy("model_id").agg(
            F.sum(F.when(is_id, F.col("declared"))).alias("transitions"),
            F.sum(F.when(is_id, F.col("uses") - F.col("declared"))).alias("arcs"),
            F.sum(F.col("uses") * (F.coalesce(F.octet_length("key"), F.lit(0)) + ROW_BYTES)).alias("size"),
            F.max(F.when(is_name, F.col("declared"))).alias("most_per_name"),
            F.max(F.when(is_id, F.col("declared"))).alias("most_per_id"),
            F.count(F.when(is_id & (F.col("declared") == 0), 1)).alias("dangling"),
            F.count(F.when(is_name & F.col("key").isNull(), 1)).alias("unnamed"))
    )
    # one row per run's model
    facts = {row.model_id: row for row in rows.collect()}
    checked = {}
    for model in model_ids:
        fact = facts.get(model)
        if fact is None or not fact.transitions:
            raise ValueError(f"model {model} has no transitions")
        if fact.most_per_id > 1:
            raise ValueError(f"model {model} uses a transition id twice")
        if fact.unnamed:
            raise ValueError(f"model {model} has a transition without a name")
        if fact.dangling:
            raise ValueError(f"model {model} has an arc to a transition it does not declare")
        checked[model] = ModelFacts(fact.transitions, fact.arcs, fact.most_per_name, fact.size)
    return checked


def event_join(facts: dict[str, ModelFacts], models: Iterable[str] | None = None) -> Callable[..., DataFrame]:
    """How log rows are joined with a table of one row, or a few, per event name of these models.

    The table is broadcast if its measured size allows. If not, rows of a name are dealt to many
    tasks by case and position, and the table has a copy for each deal: a log has few names, so a
    plain shuffle would gather it in as few tasks.
    """
    size = sum(facts[m].size for m in models or facts)

    def join(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
        if size <= BROADCAST_MODEL_BYTES:
            return rows.join(F.broadcast(table), keys, how)
        place = [c for c in ("case_id", "pos", "ts", "marking_id") if c in rows.columns]
        dealt = rows.withColumn("deal", F.pmod(F.xxhash64(*place), F.lit(DEALS)).cast("int"))
        copies = table.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(DEALS - 1))))
        return dealt.join(copies, [*keys, "deal"], how).drop("deal")
    return join
