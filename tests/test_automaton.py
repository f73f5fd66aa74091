"""Long sessions on nets that have an automaton, and on those that have none."""

import random
from math import log2

import pytest

from brute import replay
from test_replay import outcomes, sessions_of
from tracefold.demo import NETS as DEMO
from tracefold.local import local_table, nets_from_rows
from tracefold.operators import automaton, replay_fold
from tracefold.plans.check import Run, check_logs


def net_of(name):
    return [(t, event, list(ins), list(outs)) for t, event, ins, outs in DEMO[name]]


@pytest.fixture
def rounds(monkeypatch):
    """Counts the rounds in which segments are folded."""
    calls = []
    real = replay_fold._run
    monkeypatch.setattr(replay_fold, "_run", lambda *a, **k: calls.append(1) or real(*a, **k))
    return calls


@pytest.mark.parametrize("segments", [12, 48])
@pytest.mark.parametrize("model,size", [("switch", 5), ("shop_amb", 60)])
def test_rounds(spark, rounds, model, size, segments):
    rng = random.Random(segments)
    events = ["signup", "view", "click", "purchase", "error"]
    logs = {f"c{k}": [rng.choice(events) for _ in range(size * segments)] for k in range(3)}
    run = [Run(model, expected_final=("p2",))]
    found = outcomes(check_logs(sessions_of(spark, logs), nets_from_rows(spark, DEMO), run, segment=size))
    assert found == {case: replay(net_of(model), log, ["p2"]) for case, log in logs.items()}
    assert len(rounds) <= 1 + log2(segments)
    if model == "switch":
        assert len(rounds) == 1


def models_of(spark, nets):
    expected = local_table(spark, [(m, ["p2"]) for m in nets], "model_id string, expected_final array<string>")
    return replay_fold.event_options(nets_from_rows(spark, nets), expected)


def test_tables(spark):
    numbered, models = models_of(spark, {m: DEMO[m] for m in ("switch", "chat", "shop", "explode")})
    found = automaton.compile_automata(models, replay_fold.fold_segment)
    # places of the shop and of the chat fill up without bound; where choices multiply, the limit of markings is the bound
    assert sorted(found) == ["explode", "switch"]
    assert automaton.EXPLODED in found["explode"].table() and automaton.EXPLODED not in found["switch"].table()
    # two places, one token in either
    assert sorted(found["switch"].states) == [((0, 1),), ((1, 0),)] and found["switch"].states[0] == ((1, 0),)
    assert set(found["switch"].table()) == {0, 1} and len(found["switch"].table()) == 10
    assert automaton.compile_automata(models, replay_fold.fold_segment, limit=1) == {}


def test_explosions_are_a_state(spark):
    """Choices that multiply markings, in sessions of many segments."""
    choices = [(f"t{k}", "v", ["p1"], ["p1", f"p{k}"]) for k in (3, 4, 5)]
    net = [*choices, ("t9", "w", ["p1", "p3", "p4", "p5"], ["p1"])]
    logs = {"a": ["v"] * 30, "b": ["w"] * 30, "c": ["v", "w"] * 30, "d": ["w"] * 9 + ["x"] + ["v"] * 40}
    wanted = {case: replay(net, log, ["p1"]) for case, log in logs.items()}
    assert {w[0] for w in wanted.values()} == {"ok", "path_explosion", "unknown_event"}
    nets = nets_from_rows(spark, {"m": net})
    assert outcomes(check_logs(sessions_of(spark, logs), nets, [Run("m", expected_final=("p1",))], segment=4)) == wanted
    simple = [("t1", "v", ["p1"], ["p1", "p3"]), ("t2", "v", ["p1"], ["p1", "p4"]), ("t3", "v", ["p1"], ["p1", "p5"]), ("t4", "w", ["p1"], ["p1"])]
    logs = {"a": ["v", "w"] * 12, "b": ["v", "w"] * 13, "c": ["w"] * 30 + ["v"] * 12 + ["x"], "d": ["w"] * 30 + ["v"] * 13 + ["x"]}
    found = outcomes(check_logs(sessions_of(spark, logs), nets_from_rows(spark, {"m": simple}), [Run("m", expected_final=("p1",))], segment=4))
    assert found == {case: replay(simple, log, ["p1"]) for case, log in logs.items()}


def bounded_net(rng):
    """From every place a way for every event, for some events two: a token is never missing, but markings multiply."""
    places = ["p1", "p2", "p3"]
    ways = [(name, p) for name in "abc" for p in places] + [(rng.choice("abc"), rng.choice(places)) for _ in range(2)]
    return [(f"t{k}", name, [p], [rng.choice(places)]) for k, (name, p) in enumerate(ways)]


@pytest.mark.parametrize("seed", range(20, 23))
def test_random_nets(spark, monkeypatch, rounds, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(automaton, "FAN", 3)  # several levels of the tree
    nets = {"m": bounded_net(rng), "n": bounded_net(rng)}
    logs = {f"c{k}": [rng.choice("abc") for _ in range(rng.choice([5, 7, 30, 31, 150]))] for k in range(8)} | {"u": ["a"] * 40 + ["?"] + ["b"] * 40}
    wanted = {(m, case): replay(net, log, ["p2"]) for m, net in nets.items() for case, log in logs.items()}
    runs = [Run(m, expected_final=("p2",)) for m in nets]
    found = check_logs(sessions_of(spark, logs), nets_from_rows(spark, nets), runs, method="fold", segment=6).collect()
    assert {(r.model_id, r.case_id): (r.status, r.error_detail, r.missing_tokens, r.missing_indices, r.unconsumed_tokens) for r in found} == wanted
    assert len(rounds) == 1


@pytest.mark.parametrize("fan", [2, 5, 64])
def test_scan_of_functions(spark, monkeypatch, fan):
    monkeypatch.setattr(automaton, "FAN", fan)
    rng = random.Random(fan)
    rows, wanted = [], {}
    for case, n in (("x", 1), ("y", 2), ("z", 70)):
        state = 0
        for at in range(n):
            f = [rng.randrange(-1 if at > 40 else 0, 4) for _ in range(4)]
            rows.append((case, at, f))
            wanted[case, at] = state
            state = f[state] if state >= 0 else state
    functions = local_table(spark, rows, "case_id string, at bigint, f array<int>")
    found = automaton._scan(functions, ["case_id"], 70).collect()
    assert {(r.case_id, r.at): r.start for r in found} == wanted


def test_winners_of_tied_markings(spark):
    """Which marking is the result is decided segments later."""
    net = [("t1", "a", ["p1"], ["p2"]), ("t2", "a", ["p1"], ["p3"]), ("t3", "b", ["p2"], ["p2"]), ("t4", "b", ["p3"], ["p3"]),
           ("t5", "c", ["p3"], ["p1"]), ("t6", "d", ["p2"], ["p1"])]
    logs = {"c": ["a", *["b"] * 20, "c", "a", "d"], "d": ["a", *["b"] * 20, "d"], "e": ["a", *["b"] * 20]}
    run = [Run("m", expected_final=("p1",))]
    found = outcomes(check_logs(sessions_of(spark, logs), nets_from_rows(spark, {"m": net}), run, segment=4))
    assert found == {case: replay(net, log, ["p1"]) for case, log in logs.items()}


def test_starts_left_out_after_an_explosion(spark):
    segments = local_table(spark, [("m", "x", k, [0, 1]) for k in range(4)], "model_id string, case_id string, segment bigint, labels array<int>")
    made = automaton.Automaton(2, [((1,),), ((2,),)], {(0, 0): 1, (0, 1): 0, (1, 0): 0, (1, 1): automaton.EXPLODED})
    rows = automaton.start_states(segments, {"m": made}, ["model_id", "case_id"], 4).orderBy("segment").collect()
    assert [(r.segment, r.toks) for r in rows] == [(0, [[1]])]


def test_sessions_that_explode_need_no_markings(spark, monkeypatch):
    """The automaton says so for sessions of one segment of a large log."""
    logs = {"a": ["view"] * 13 + ["click"], "b": ["view", "click"] * 12, "c": ["signup"] * 3 + ["fly"], "d": ["view"] * 20 + ["fly"]}
    wanted = {case: replay(net_of("explode"), log, ["p1"]) for case, log in logs.items()}
    assert [w[0] for w in wanted.values()] == ["path_explosion", "ok", "unknown_event", "path_explosion"]
    monkeypatch.setattr(replay_fold, "COMPILE_FROM", 0)
    folded, real = [], replay_fold.fold_segment
    monkeypatch.setattr(replay_fold, "fold_segment", lambda rows, *a: folded.append(rows) or real(rows, *a))
    nets = nets_from_rows(spark, DEMO)
    assert outcomes(check_logs(sessions_of(spark, logs), nets, [Run("explode", expected_final=("p1",))])) == wanted
    assert {r.case_id: len(r.labels) for r in folded[-1].select("case_id", "labels").collect()} == {"a": 0, "b": 24, "c": 3, "d": 0}
    chosen = [Run("explode", expected_final=("p1",)), Run("shop_amb")]  # with and without an automaton, equal sessions once
    found = check_logs(sessions_of(spark, logs), nets, chosen, share_variants=True).where("model_id = 'explode'")
    assert outcomes(found) == wanted
