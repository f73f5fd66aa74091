"""The edit log against a fold in plain Python, and against the table operators."""

import random

import pytest

from tracefold.local import local_table, nets_from_rows
from tracefold.operators import models as M
from tracefold.operators.edits import apply_edits, edit, fold_edits, model_rows, nets_of_rows
from pyspark.sql import functions as F

EDITS = "model_id string, seq int, op string, id string, other string, name string, tokens int, inputs array<string>, outputs array<string>"
NET_ROWS = {
    "a": [("t1", "x", ["p1"], ["p2", "p3"]), ("t2", "x", ["p2"], []), ("t3", "y", [], ["p1"])],
    "b": [("t1", "x", ["p1"], ["p1"])],
    "c": [("t1", "x", ["p1"], ["p4"]), ("t2", "z", ["p4", "p1"], ["p5"])],
}


def elements(nets):
    """Per model its places, transitions and arcs as sorted rows."""
    found = {}
    for k, (table, columns) in enumerate(((nets.places, ("place_ord", "place_id", "name", "init_tokens", "model_file")),
                                          (nets.transitions, ("trans_ord", "transition_id", "name")), (nets.arcs, ("arc_ord", "source", "target")))):
        for row in table.collect():
            found.setdefault(row.model_id, ([], [], []))[k].append(tuple(row[c] for c in columns))
    return {m: tuple(sorted(rows) for rows in parts) for m, parts in found.items()}


def plainly(models, edits):
    """The same told from the definitions."""
    models = {m: tuple(list(rows) for rows in parts) for m, parts in models.items()}
    after = lambda rows: max((r[0] for r in rows), default=-1) + 1
    for model, _, op, one, other, name, tokens, ins, outs in sorted(edits, key=lambda e: e[1]):
        if model is None:
            continue
        places, transitions, arcs = models.setdefault(model, ([], [], []))
        base = after(arcs)
        if op == "add_place":
            places.append((after(places), one, name, tokens or 0, places[0][4] if places else None))
        elif op == "add_transition":
            transitions.append((after(transitions), one, name))
            ends = [(p, one) for p in ins or ()] + [(one, p) for p in outs or ()]
            arcs += [(base + k, *end) for k, end in enumerate(ends)]
        elif op == "add_arc":
            arcs.append((base, one, other))
        elif op == "delete_transition":
            transitions[:] = [t for t in transitions if t[1] != one]
            arcs[:] = [a for a in arcs if (a[1] if a[1][0] == "t" else a[2]) != one]
        elif op == "merge":
            arcs += [(base + n, one if s == other else s, one if s[0] == "p" else t) for n, s, t in arcs
                     if (s[0] == "p" and t == other) or (s[0] == "t" and s == other)]
        elif name:
            places[:] = [(n, f"{i}_{name}", *rest) for n, i, *rest in places]
            transitions[:] = [(n, f"{i}_{name}", *rest) for n, i, *rest in transitions]
            arcs[:] = [(n, f"{s}_{name}", f"{t}_{name}") for n, s, t in arcs]
    return {m: tuple(sorted(map(tuple, rows)) for rows in parts) for m, parts in models.items() if any(parts)}


def random_edits(rng):
    t, p = (lambda: f"t{rng.randint(1, 5)}"), (lambda: f"p{rng.randint(1, 5)}")
    rows = []
    for seq in range(60):
        op = rng.choice(["add_place", "add_transition", "add_arc", "add_arc", "delete_transition", "merge", "merge", "suffix"])
        model = rng.choice(["a", "b", "c", "new", None])
        one = {"add_place": p, "add_arc": lambda: rng.choice([p(), t(), "x1"])}.get(op, t)()
        other = t() if op == "merge" or one[0] != "t" else p()
        name = rng.choice(["", "", "n", None]) if op == "suffix" else "x"
        lists = [rng.choice([None, [], [p(), p()]]) for _ in range(2)] if op == "add_transition" else [None, None]
        rows.append((model, seq, op, one, other, name, rng.choice([None, 2]), *lists))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_random_logs(spark, seed):
    nets, rows = nets_from_rows(spark, NET_ROWS), random_edits(random.Random(seed))
    # merges copy arcs, so a long log would grow beyond what a test should hold
    found = elements(apply_edits(nets, local_table(spark, rows, EDITS)))
    assert found == plainly(elements(nets), rows)


def test_order_decides(spark):
    nets = nets_from_rows(spark, NET_ROWS)
    rows = [("b", 2, "delete_transition", "t1_n", None, None), ("b", 1, "suffix", None, None, "n"), ("c", 1, "delete_transition", "t1_n", None, None),
            ("c", 2, "suffix", None, None, "n")]
    edited = apply_edits(nets, local_table(spark, rows, "model_id string, seq int, op string, id string, other string, name string"))
    ids = sorted((r.model_id, r.transition_id) for r in edited.transitions.collect())
    assert ids == [("a", "t1"), ("a", "t2"), ("a", "t3"), ("c", "t1_n"), ("c", "t2_n")]


def test_same_as_the_table_operators(spark):
    nets = nets_from_rows(spark, NET_ROWS)
    gone = M.delete_transitions(nets, local_table(spark, [("a", "t1")], "model_id string, transition_id string"))
    merged = M.merge_transitions(gone, local_table(spark, [("c", "t2", "t1")], "model_id string, transition_id string, other_id string"))
    rows = [("a", 1, "delete_transition", "t1", None), ("c", 2, "merge", "t2", "t1")]
    edited = apply_edits(nets, local_table(spark, rows, "model_id string, seq int, op string, id string, other string"))
    assert elements(edited) == elements(merged)


def test_no_edits_and_unknown_edits(spark):
    nets = nets_from_rows(spark, NET_ROWS)
    schema = "model_id string, seq int, op string, id string"
    assert elements(apply_edits(nets, local_table(spark, [], schema))) == elements(nets)
    for op in ("rename", None):
        with pytest.raises(Exception, match="unknown edit"):
            apply_edits(nets, local_table(spark, [("a", 1, op, "t1")], schema)).arcs.collect()


def test_edits_that_follow_from_the_model(spark):
    models = model_rows(nets_from_rows(spark, NET_ROWS))
    drop = F.transform(F.filter("transitions", lambda t: t["name"] == "x"), lambda t: edit("delete_transition", t["trans_ord"], id=t["transition_id"]))
    left = nets_of_rows(fold_edits(models.withColumn("edits", drop)))
    assert sorted((r.model_id, r.transition_id) for r in left.transitions.collect()) == [("a", "t3"), ("c", "t2")]
