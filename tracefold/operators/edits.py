"""Edits of process models as an ordered log, folded once for each model.

A model is a row of its places, transitions and arcs, each in order; an edit log has a row for each edit, with a
sequence number. Elements and edits of a model meet in one shuffle, and one native fold applies the edits one
after the other, whatever their number. The row has the size of the model, as the rows replay works on.

| ``op`` | meaning |
| --- | --- |
| ``add_place`` | place ``id`` called ``name`` with ``tokens`` |
| ``add_transition`` | transition ``id`` called ``name``, with arcs from ``inputs`` and to ``outputs`` |
| ``add_arc`` | an arc from ``id`` to ``other`` |
| ``delete_transition`` | transition ``id`` and the arcs touching it go; places stay |
| ``merge`` | transition ``id`` gets the places of ``other`` too, its own first; ``other`` stays |
| ``suffix`` | every id there is by then gets ``_name``; an empty name changes nothing |

Defined cases: a model without edits stays as it is; edits of a model without elements start from an empty one;
edits without a model are ignored; edits with equal numbers apply in the order of their columns; an unknown ``op``
is an error; deleting or merging what is not there changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracefold.operators.models import Nets
from tracefold.operators.replay_fold import bind

OPS = ("add_place", "add_transition", "add_arc", "delete_transition", "merge", "suffix")
MODEL = {
    "places": {"place_ord": "int", "place_id": "string", "name": "string", "init_tokens": "int", "model_file": "string"},
    "transitions": {"trans_ord": "int", "transition_id": "string", "name": "string"},
    "arcs": {"arc_ord": "int", "source": "string", "target": "string"},
}
EDIT = {"seq": "bigint", "op": "string", "id": "string", "other": "string", "name": "string", "tokens": "int",
        "inputs": "array<string>", "outputs": "array<string>"}


def _struct(fields: dict[str, str]) -> str:
    return "struct<" + ",".join(f"{c}:{t}" for c, t in fields.items()) + ">"


ROW = {kind: _struct(fields) for kind, fields in MODEL.items()}
LIST = {kind: f"array<{row}>" for kind, row in ROW.items()}
STATE = _struct(LIST)


def edit(op: str, seq: Column | int, **values: Column) -> Column:
    """An edit as a value, for logs that follow from the model itself."""
    given = {"seq": seq if isinstance(seq, Column) else F.lit(seq), "op": F.lit(op), **values}
    return F.struct(*[given.get(c, F.lit(None)).cast(t).alias(c) for c, t in EDIT.items()])


def model_rows(nets: Nets) -> DataFrame:
    """(model_id, places, transitions, arcs): a row for each model, its elements in order."""
    tables = {"places": nets.places, "transitions": nets.transitions, "arcs": nets.arcs}

    def tagged(kind: str) -> DataFrame:
        return tables[kind].select("model_id", *[(F.struct(*MODEL[c]) if c == kind else F.lit(None)).cast(ROW[c]).alias(c) for c in MODEL])
    rows = tagged("places").unionByName(tagged("transitions")).unionByName(tagged("arcs"))
    return rows.groupBy("model_id").agg(*[F.sort_array(F.collect_list(c)).alias(c) for c in MODEL])


def with_edits(models: DataFrame, edits: DataFrame) -> DataFrame:
    """Models with ``edits``, their part of the log in order. ``edits`` holds model_id, seq, op and what the ops need."""
    known = F.when(F.col("op").isin(*OPS), F.col("op")).otherwise(F.raise_error(F.concat(F.lit("unknown edit "), F.coalesce("op", F.lit("null")))))
    value = lambda c: known if c == "op" else F.col(c) if c in edits.columns else F.lit(None)
    log = (
        edits.where(F.col("model_id").isNotNull())
        .select("model_id", F.struct(*[value(c).cast(t).alias(c) for c, t in EDIT.items()]).alias("edit"))
        .groupBy("model_id").agg(F.sort_array(F.collect_list("edit")).alias("edits"))
    )
    return models.join(log, "model_id", "full").select(
        "model_id", *[F.coalesce(c, F.array().cast(t)).alias(c) for c, t in LIST.items()],
        F.coalesce("edits", F.array().cast(f"array<{_struct(EDIT)}>")).alias("edits"))


def fold_edits(models: DataFrame) -> DataFrame:
    """Models after their ``edits``."""
    folded = F.aggregate("edits", F.struct(*MODEL).cast(STATE), _step)
    return models.select("model_id", folded.alias("m")).select("model_id", "m.*")


def apply_edits(nets: Nets, edits: DataFrame) -> Nets:
    """All models of the tables after an edit log."""
    return nets_of_rows(fold_edits(with_edits(model_rows(nets), edits)))


def nets_of_rows(models: DataFrame) -> Nets:
    """Models as tables again."""
    # the outer form, as Spark puts a test for empty lists before the plain one and would fold twice for it
    inline = lambda c: models.select("model_id", F.inline_outer(c)).where(F.col(next(iter(MODEL[c]))).isNotNull())
    places = inline("places")
    return Nets(places.select("model_id", "model_file", "place_ord", "place_id", "name", "init_tokens"), inline("transitions"), inline("arcs"))


# --- the step of the fold ---------------------------------------------------------


def _next(rows: Column, order: str) -> Column:
    return F.coalesce(F.array_max(F.transform(rows, lambda r: r[order])) + 1, F.lit(0))


def _with_arcs(arcs: Column, ends: Column) -> Column:
    """Arcs and, numbered after them in steps of ``nth``, the (nth, source, target) of ``ends``."""
    return bind(_next(arcs, "arc_ord"), lambda base: F.concat(arcs, F.transform(
        ends, lambda e: F.struct((base + e["nth"]).alias("arc_ord"), e["source"].alias("source"), e["target"].alias("target")).cast(ROW["arcs"]))))


def _end(nth: Column, source: Column, target: Column) -> Column:
    return F.struct(nth.cast("int").alias("nth"), source.alias("source"), target.alias("target"))


def _is_input(arc: Column) -> Column:
    return F.substring(arc["source"], 1, 1) == "p"


def _is_output(arc: Column) -> Column:
    return F.substring(arc["source"], 1, 1) == "t"


def _borrowed(arcs: Column, own: Column, other: Column) -> Column:
    """The arcs of another transition as ends of one's own."""
    of_other = F.filter(arcs, lambda a: (_is_input(a) & (a["target"] == other)) | (_is_output(a) & (a["source"] == other)))
    return F.transform(of_other, lambda a: _end(
        a["arc_ord"], F.when(_is_input(a), a["source"]).otherwise(own), F.when(_is_input(a), own).otherwise(a["target"])))


def _listed(e: Column) -> Column:
    """Ends of a new transition: its inputs, then its outputs."""
    none = F.array().cast("array<string>")
    inputs = F.coalesce(e["inputs"], none)
    return F.concat(
        F.transform(inputs, lambda p, k: _end(k, p, e["id"])),
        F.transform(F.coalesce(e["outputs"], none), lambda p, k: _end(k + F.size(inputs), e["id"], p)))


def _renamed(rows: Column, kind: str, e: Column, *ids: str) -> Column:
    value = lambda r, c: F.concat_ws("_", r[c], e["name"]) if c in ids else r[c]
    return F.when(F.coalesce(e["name"], F.lit("")) == "", rows).otherwise(
        F.transform(rows, lambda r: F.struct(*[value(r, c).alias(c) for c in MODEL[kind]]).cast(ROW[kind])))


def _step(state: Column, e: Column) -> Column:
    places, transitions, arcs = (state[c] for c in MODEL)
    place = F.struct(_next(places, "place_ord"), e["id"], e["name"], F.coalesce(e["tokens"], F.lit(0)), F.get(places, F.lit(0))["model_file"])
    transition = F.struct(_next(transitions, "trans_ord"), e["id"], e["name"])
    touches = lambda a: F.when(_is_output(a), a["source"]).otherwise(a["target"]) == e["id"]
    op = e["op"]
    return F.struct(
        F.when(op == "add_place", F.concat(places, F.array(place.cast(ROW["places"]))))
         .when(op == "suffix", _renamed(places, "places", e, "place_id")).otherwise(places).alias("places"),
        F.when(op == "add_transition", F.concat(transitions, F.array(transition.cast(ROW["transitions"]))))
         .when(op == "delete_transition", F.filter(transitions, lambda t: t["transition_id"] != e["id"]))
         .when(op == "suffix", _renamed(transitions, "transitions", e, "transition_id")).otherwise(transitions).alias("transitions"),
        F.when(op == "add_transition", _with_arcs(arcs, _listed(e)))
         .when(op == "add_arc", _with_arcs(arcs, F.array(_end(F.lit(0), e["id"], e["other"]))))
         .when(op == "merge", _with_arcs(arcs, _borrowed(arcs, e["id"], e["other"])))
         .when(op == "delete_transition", F.filter(arcs, lambda a: ~F.coalesce(touches(a), F.lit(False))))
         .when(op == "suffix", _renamed(arcs, "arcs", e, "source", "target")).otherwise(arcs).alias("arcs"),
    ).cast(STATE)
