import random

import pytest
from pyspark.sql import functions as F

from brute import replay
from fixtures import GOLDEN, NETS
from tracefold.demo import NETS as DEMO
from tracefold.local import local_table, nets_from_rows
from tracefold.operators import replay_fold
from tracefold.operators.sessions import order_events
from tracefold.plans.check import Run, check_logs, unknown_events

SCHEMA = "case_id string, ts bigint, event string"


def sessions_of(spark, logs, hot_rows=None):
    rows = [(case, k, event) for case, log in logs.items() for k, event in enumerate(log)]
    return order_events(local_table(spark, rows, SCHEMA), hot_rows=hot_rows)


def outcomes(results):
    return {
        r.case_id: (r.status, r.error_detail, list(r.missing_tokens), list(r.missing_indices), list(r.unconsumed_tokens))
        for r in results.collect()
    }


@pytest.mark.parametrize("method", ["auto", "fold"])
@pytest.mark.parametrize("model,events,final,status,missing,indices,left", GOLDEN)
def test_golden(spark, method, model, events, final, status, missing, indices, left):
    nets = nets_from_rows(spark, NETS)
    run = Run(model, expected_final=tuple(final))
    row = check_logs(sessions_of(spark, {"x": events}), nets, [run], method=method).first()
    assert (row.status, row.missing_tokens, row.missing_indices, row.unconsumed_tokens) == (status, missing, indices, left)
    assert row.session_length == len(events)
    assert row.error_detail == ("fly" if status == "unknown_event" else None)


def random_net(rng, one_per_name):
    places = [f"p{k}" for k in range(1, rng.randint(3, 6))]
    names = "abcde"[:rng.randint(2, 5)]
    rows = []
    for k in range(len(names) if one_per_name else rng.randint(len(names), 9)):
        ins = rng.sample(places, rng.randint(0 if one_per_name else 1, min(3, len(places))))
        outs = rng.sample(places, rng.randint(0, min(3, len(places))))
        rows.append((f"t{k}", names[k] if one_per_name else rng.choice(names), ins, outs))
    return rows


def random_logs(rng, count, longest):
    logs = {f"c{k}": [rng.choice("abcde") for _ in range(rng.randint(1, longest))] for k in range(count)}
    logs["long"] = [rng.choice("abc") for _ in range(longest * 6)]
    return logs


@pytest.mark.parametrize("seed", range(4))
def test_scan_on_random_nets(spark, seed):
    rng = random.Random(seed)
    net, logs = random_net(rng, True), random_logs(rng, 40, 12)
    final = tuple(rng.choices(["p1", "p2", "p3"], k=3))
    wanted = {case: replay(net, log, final) for case, log in logs.items()}
    nets, run = nets_from_rows(spark, {"m": net}), [Run("m", expected_final=final)]
    assert outcomes(check_logs(sessions_of(spark, logs), nets, run, method="scan")) == wanted
    assert outcomes(check_logs(sessions_of(spark, logs, hot_rows=9), nets, run, method="scan")) == wanted
    assert outcomes(check_logs(sessions_of(spark, logs), nets, run, method="fold")) == wanted


@pytest.mark.parametrize("seed", range(10, 14))
def test_fold_on_random_nets(spark, seed):
    rng = random.Random(seed)
    net, logs = random_net(rng, False), random_logs(rng, 40, 12)
    final = tuple(rng.choices(["p1", "p2", "p3"], k=2))
    wanted = {case: replay(net, log, final) for case, log in logs.items()}
    nets, run = nets_from_rows(spark, {"m": net}), [Run("m", expected_final=final)]
    assert outcomes(check_logs(sessions_of(spark, logs), nets, run, method="fold")) == wanted
    assert outcomes(check_logs(sessions_of(spark, logs), nets, run, method="fold", share_variants=True)) == wanted
    assert outcomes(check_logs(sessions_of(spark, logs, hot_rows=9), nets, run, method="fold", segment=5)) == wanted


def test_explosion_across_segments(spark):
    net = [("t1", "v", ["p1"], ["p1", "p3"]), ("t2", "v", ["p1"], ["p1", "p4"]), ("t3", "v", ["p1"], ["p1", "p5"]),
           ("t4", "w", ["p1"], ["p1"])]
    logs = {"twelve": ["v", "w"] * 12, "thirteen": ["v", "w"] * 13, "late": ["w"] * 30 + ["v"] * 13 + ["nothing"],
            "early": ["v"] * 5 + ["nothing"] + ["v"] * 20}
    wanted = {case: replay(net, log, ["p1"]) for case, log in logs.items()}
    assert {c: w[0] for c, w in wanted.items()} == {
        "twelve": "ok", "thirteen": "path_explosion", "late": "path_explosion", "early": "unknown_event"}
    nets, run = nets_from_rows(spark, {"m": net}), [Run("m", expected_final=("p1",))]
    for segment in (4, 2048):
        assert outcomes(check_logs(sessions_of(spark, logs), nets, run, segment=segment)) == wanted


def test_models_side_by_side(spark):
    nets = nets_from_rows(spark, NETS)
    logs = {"a": ["go left", "stop"], "b": ["go to work", "sit at desk"], "c": ["wake up"]}
    runs = [Run("walk", expected_final=("p5",)), Run("desk", expected_final=()), Run("morning", expected_final=("p11", "p2"))]
    rows = check_logs(sessions_of(spark, logs), nets, runs).collect()
    assert len(rows) == 9
    for row in rows:
        run = next(r for r in runs if r.model_id == row.model_id)
        wanted = replay(NETS[row.model_id], logs[row.case_id], run.expected_final)
        assert (row.status, row.error_detail, row.missing_tokens, row.missing_indices, row.unconsumed_tokens) == wanted


def test_trimmed_runs_of_different_bounds(spark):
    nets = nets_from_rows(spark, NETS)
    logs = {"a": ["stop", "go left", "stop", "go left"], "b": ["stop"]}
    runs = [Run("walk", "x", ("go left",), ("stop",), ("p5",)), Run("desk", "y", ("stop",), ("go left",), ())]
    rows = {(r.model_id, r.case_id): r for r in check_logs(sessions_of(spark, logs), nets, runs).collect()}
    assert set(rows) == {("walk", "a"), ("desk", "a")}
    assert rows["walk", "a"].session_length == 2 and rows["desk", "a"].session_length == 4


def test_scan_refuses_a_choice_of_transitions(spark):
    with pytest.raises(ValueError, match="need the fold"):
        check_logs(sessions_of(spark, {"x": ["go to work"]}), nets_from_rows(spark, NETS), [Run("desk")], method="scan")


def test_equal_markings_are_dropped_and_the_first_stays(spark):
    buffer = "array({0}, {1}, {0})".format(
        "named_struct('tok', array(1,1,0), 'org', 0, 'lost', 0, 'miss', '')",
        "named_struct('tok', array(0,0,1), 'org', 1, 'lost', 1, 'miss', '3,')")
    row = spark.range(1).select(F.expr(buffer).cast(f"array<{replay_fold.MARKING}>").alias("b")).select(
        replay_fold._trim(F.col("b")).alias("b")).first()
    assert [list(m.tok) for m in row.b] == [[1, 1, 0]] and row.b[0].org == 0


def test_least_divergent_markings_stay(spark):
    buffer = "array({}, {}, {})".format(*[
        f"named_struct('tok', array({k}), 'org', {k}, 'lost', {lost}, 'miss', '')" for k, lost in enumerate([2, 1, 3])])
    row = spark.range(1).select(F.expr(buffer).cast(f"array<{replay_fold.MARKING}>").alias("b")).select(
        replay_fold._trim(F.col("b")).alias("b")).first()
    assert [m.org for m in row.b] == [1]


def test_unknown_events(spark):
    log = local_table(spark, [("x", 0, "go left"), ("x", 1, "fly"), ("y", 0, "swim")], SCHEMA)
    rows = unknown_events(log, nets_from_rows(spark, NETS), "walk").collect()
    assert sorted((r.case_id, r.event) for r in rows) == [("x", "fly"), ("y", "swim")]


def test_long_logs_with_short_sessions(spark):
    logs = {"x": ["stop"] * 30 + ["go left", "stop"], "y": ["go left", "turn back", "stop"] + ["fly"] * 20}
    run = [Run("walk", "", ("go left",), ("stop",), ("p5",))]
    found = outcomes(check_logs(sessions_of(spark, logs), nets_from_rows(spark, NETS), run, method="fold", segment=4))
    assert found == {"x": replay(NETS["walk"], ["go left", "stop"], ["p5"]),
                     "y": replay(NETS["walk"], ["go left", "turn back", "stop"], ["p5"])}


def test_segments_of_one_long_session(spark):
    """Stocks that grow, run dry and tie over many segments."""
    net = [("t1", "in", ["p1"], ["p1", "p3", "p5"]), ("t2", "out", ["p3"], []), ("t3", "out", ["p4"], ["p5"]),
           ("t4", "move", ["p3"], ["p4"]), ("t5", "move", ["p5"], ["p4"])]
    rng = random.Random(3)
    logs = {f"c{k}": rng.choices(["in", "out", "move"], weights=[w, 3, 2], k=240) for k, w in enumerate((1, 3, 6))}
    wanted = {case: replay(net, log, ["p3", "p9"]) for case, log in logs.items()}
    run = [Run("m", expected_final=("p3", "p9"))]
    for segment in (10, 60):
        assert outcomes(check_logs(sessions_of(spark, logs, hot_rows=50), nets_from_rows(spark, {"m": net}), run, segment=segment)) == wanted


def test_runs_must_differ_in_their_names(spark):
    with pytest.raises(ValueError, match="run ids"):
        check_logs(sessions_of(spark, {"x": ["stop"]}), nets_from_rows(spark, NETS), [Run("walk"), Run("walk", "again")])


@pytest.mark.parametrize("together", [False, True])
def test_one_bound_trims_one_side(spark, together):
    """All combinations of bounds on one model, alone and side by side; an empty bound keeps nothing."""
    log, nets = ["turn back", "go left", "stop", "go right", "stop", "turn back"], nets_from_rows(spark, NETS)
    bounds = {"none": (None, None), "first": (("go left",), None), "last": (None, ("stop",)), "both": (("go left",), ("stop",)), "empty": ((), None)}
    cut = {"none": log, "first": log[1:], "last": log[:5], "both": log[1:5]}
    runs = [Run("walk", name, first, last, ("p5",), run_id=name) for name, (first, last) in bounds.items()]
    sessions = sessions_of(spark, {"x": log})
    found = check_logs(sessions, nets, runs).collect() if together else [r for run in runs for r in check_logs(sessions, nets, [run]).collect()]
    got = {r.model_id: (r.status, r.error_detail, r.missing_tokens, r.missing_indices, r.unconsumed_tokens) for r in found}
    assert got == {name: replay(NETS["walk"], part, ["p5"]) for name, part in cut.items()}
    assert {r.model_id: r.session_length for r in found} == {name: len(part) for name, part in cut.items()}


def test_large_models_do_not_gather_the_log_by_event(spark, monkeypatch):
    from tracefold.operators import models

    nets, logs = nets_from_rows(spark, NETS), {"a": ["go left", "stop"], "b": ["go to work", "fly"]}
    runs = [Run("walk", expected_final=("p5",)), Run("desk", expected_final=())]
    wanted = sorted(map(str, check_logs(sessions_of(spark, logs), nets, runs).collect()))
    monkeypatch.setattr(models, "BROADCAST_MODEL_BYTES", 0)
    assert sorted(map(str, check_logs(sessions_of(spark, logs), nets, runs).collect())) == wanted


def test_stretches_of_long_sessions(spark, monkeypatch):
    """Sessions go on from stretch to stretch, with guesses and without, and nothing is folded behind an explosion."""
    shop = [(t, event, list(ins), list(outs)) for t, event, ins, outs in DEMO["shop_amb"]]
    rng = random.Random(7)
    logs = {f"c{k}": rng.choices(["signup", "view", "click", "purchase", "error"], k=n) for k, n in enumerate((70, 95))}
    logs |= {"full": ["signup"] * 105 + ["view"] * 105, "cut": ["signup", "view"] * 20 + ["fly"]}
    wanted = {case: replay(shop, log, ["p2"]) for case, log in logs.items()}
    assert wanted["full"][0] == "path_explosion"
    rounds, parts, real = [], [], replay_fold._relay
    monkeypatch.setattr(replay_fold, "_relay", lambda rows, *a: rounds.append(1) or parts.append(real(rows, *a)) or parts[-1])
    monkeypatch.setattr(replay_fold, "FIRST_STRETCH", 20)
    monkeypatch.setattr(replay_fold, "LAST_STRETCH", 40)
    for slots in (1, 8):  # one slot: sessions fill the slots, so no guesses
        monkeypatch.setattr(replay_fold, "task_slots", lambda _, n=slots: n)
        rounds.clear(), parts.clear()
        assert outcomes(check_logs(sessions_of(spark, logs), nets_from_rows(spark, DEMO), [Run("shop_amb")], segment=10)) == wanted
        assert 1 < len(rounds) <= 8
        # at most 40 events a row
        assert all(p.where("size(out) > 4").isEmpty() for p in parts[:2])
