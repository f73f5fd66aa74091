import pytest

from fixtures import NETS
from tracefold.local import local_table, nets_from_rows
from tracefold.operators import models as M

PLACE = "model_id string, model_file string, place_ord int, place_id string, name string, init_tokens int"
TRANSITION = "model_id string, trans_ord int, transition_id string, name string"
ARC = "model_id string, arc_ord int, source string, target string"


@pytest.fixture
def nets(spark):
    return nets_from_rows(spark, {
        "a": [("t1", "x", ["p1"], ["p2", "p3"]), ("t2", "x", ["p2"], []), ("t3", "y", [], ["p1"])],
        "b": [("t1", "x", ["p1"], ["p1"])],
    })


def sides(nets, model="a"):
    found = {}
    for r in sorted(M.transition_arcs(nets).where(f"model_id = '{model}'").collect(), key=lambda r: r.arc_ord):
        found.setdefault(r.transition_id, {"in": [], "out": []})[r.side].append(r.place_id)
    return found


def lookup(nets, name, model="a"):
    rows = M.transition_lookup(nets).where(f"model_id = '{model}' AND name = '{name}'").collect()
    return [r.transition_id for r in sorted(rows, key=lambda r: r.trans_ord)]


def test_add_place(spark, nets):
    more = M.add_places(nets, local_table(spark, [("a", "a.pnml", 0, "p9", "Start", 0)], PLACE))
    row = more.places.where("place_id = 'p9'").first()
    assert (row.model_id, row.name, row.place_ord) == ("a", "Start", 3)
    assert more.places.where("model_id = 'b'").count() == 1


def test_add_transition_with_places(spark, nets):
    rows = [("a", 0, "t8", "x", ["p7", "p8"], ["p9"]), ("a", 1, "t9", "z", [], ["p9", "p8"]), ("c", 0, "t1", "x", ["p1"], [])]
    added = local_table(spark, rows, TRANSITION + ", input_places array<string>, output_places array<string>")
    more = M.add_transitions(nets, added)
    assert lookup(more, "x") == ["t1", "t2", "t8"] and lookup(more, "z") == ["t9"] and lookup(more, "x", "c") == ["t1"]
    assert sides(more)["t8"] == {"in": ["p7", "p8"], "out": ["p9"]}
    assert sides(more)["t9"] == {"in": [], "out": ["p9", "p8"]}
    assert sides(more)["t1"] == sides(nets)["t1"]
    numbers = [r.arc_ord for r in more.arcs.where("model_id = 'a'").collect()]
    assert len(numbers) == len(set(numbers))


def test_add_arcs(spark, nets):
    rows = [("a", 0, "p5", "t2"), ("a", 1, "t2", "p6"), ("a", 2, "p5", "t2"), ("a", 3, "x5", "t2")]
    more = M.add_arcs(nets, local_table(spark, rows, ARC))
    assert sides(more)["t2"] == {"in": ["p2", "p5"], "out": ["p6"]}


def test_delete_transition(spark, nets):
    gone = local_table(spark, [("a", "t1")], "model_id string, transition_id string")
    less = M.delete_transitions(nets, gone)
    assert lookup(less, "x") == ["t2"] and "t1" not in sides(less) and lookup(less, "x", "b") == ["t1"]
    assert less.places.count() == nets.places.count()
    assert lookup(M.delete_transitions(less, local_table(spark, [("a", "t2")], "model_id string, transition_id string")), "x") == []


def test_input_and_output_transitions(nets):
    assert [(r.model_id, r.transition_id) for r in M.input_transitions(nets).collect()] == [("a", "t3")]
    assert [(r.model_id, r.transition_id) for r in M.output_transitions(nets).collect()] == [("a", "t2")]


def test_merge_keeps_own_places_first(spark, nets):
    merges = local_table(spark, [("a", "t2", "t1")], "model_id string, transition_id string, other_id string")
    merged = sides(M.merge_transitions(nets, merges))
    assert merged["t2"] == {"in": ["p2", "p1"], "out": ["p2", "p3"]}
    assert merged["t1"] == sides(nets)["t1"]


def test_suffix(nets):
    renamed = M.suffix_ids(nets, "n")
    assert sides(renamed)["t1_n"] == {"in": ["p1_n"], "out": ["p2_n", "p3_n"]}
    assert lookup(renamed, "x") == ["t1_n", "t2_n"]
    assert {r.place_id for r in M.initial_marking(renamed).collect()} == {"p1_n"}
    assert M.suffix_ids(nets, "") is nets
    both = M.union_nets(nets, renamed)
    assert both.transitions.count() == 8


def test_missing_ratio_decides_by_share_of_inputs(spark):
    nets = nets_from_rows(spark, {
        "legal": [("t1", "s", ["p1"], ["p4"]), ("t2", "s", ["p2"], ["p5"]), ("t3", "s", ["p3"], ["p6"])],
        "share": [("t2", "s", ["p1", "p2"], ["p6"]), ("t1", "s", ["p1", "p2", "p3"], ["p5"]), ("t3", "s", ["p4"], ["p7"])],
        "tie": [("t1", "s", ["p1"], []), ("t2", "s", ["p1", "p2"], []), ("t3", "s", ["p3"], [])],
        "none": [("t1", "s", ["p1"], ["p2"])],
        "source": [("t1", "s", [], ["p2"]), ("t2", "s", ["p9"], [])],
    })
    rows = [("legal", "m", "s", ["p1"]), ("share", "m", "s", ["p1", "p3"]), ("tie", "m", "s", ["p1", "p2"]),
            ("none", "m", "s", []), ("source", "m", "s", [])]
    markings = local_table(spark, rows, "model_id string, marking_id string, event string, tokens array<string>")
    chosen = {}
    for r in M.least_missing_transitions(markings, nets).collect():
        chosen.setdefault(r.model_id, []).append((r.transition_id, r.ratio))
    assert sorted(chosen["legal"]) == [("t1", 0.0)]
    assert chosen["share"] == [("t1", 1 / 3)]
    assert sorted(chosen["tie"]) == [("t1", 0.0), ("t2", 0.0)]
    assert chosen["none"] == [("t1", 1.0)]
    assert chosen["source"] == [("t1", 0.0)]


def test_event_lookup(spark, nets):
    log = local_table(spark, [("c", 1, "x"), ("c", 2, "y"), ("c", 3, "q")], "case_id string, ts bigint, event string")
    rows = M.event_transition_lookup(log, nets, "a").collect()
    assert sorted((r.ts, r.transition_id) for r in rows) == [(1, "t1"), (1, "t2"), (2, "t3")]


def test_broken_models_are_refused(spark):
    good = nets_from_rows(spark, NETS)
    assert M.check_nets(good, ["walk", "desk"])["desk"] == M.ModelFacts(4, 7, 2)
    with pytest.raises(ValueError, match="no transitions"):
        M.check_nets(good, ["absent"])
    twice = M.Nets(good.places, good.transitions.unionByName(local_table(spark, [("walk", 9, "t1", "again")], TRANSITION)), good.arcs)
    with pytest.raises(ValueError, match="twice"):
        M.check_nets(twice, ["walk"])
    unnamed = M.Nets(good.places, good.transitions.unionByName(local_table(spark, [("walk", 9, "t9", None)], TRANSITION)), good.arcs)
    with pytest.raises(ValueError, match="without a name"):
        M.check_nets(unnamed, ["walk"])
    loose = M.Nets(good.places, good.transitions, good.arcs.unionByName(local_table(spark, [("walk", 99, "p1", "t77")], ARC)))
    with pytest.raises(ValueError, match="does not declare"):
        M.check_nets(loose, ["walk"])
    M.check_nets(loose, ["desk"])
