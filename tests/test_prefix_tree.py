"""Replay that shares equal beginnings of sessions."""

import random

import pytest
from pyspark.sql import functions as F

from brute import replay
from test_replay import outcomes, random_net, sessions_of
from tracefold.local import nets_from_rows
from tracefold.operators import replay_fold
from tracefold.plans.check import Run, check_logs


@pytest.fixture
def folded(monkeypatch):
    """Counts the events that are folded."""
    counts = []

    def watched(name, column):
        real = getattr(replay_fold, name)

        def run(rows, *args, **kwargs):
            counts.append(rows.agg(F.sum(F.size(column))).first()[0] or 0)
            return real(rows, *args, **kwargs)
        monkeypatch.setattr(replay_fold, name, run)
    watched("fold_segment", "labels")
    watched("fold_part", "part")
    return counts


def alike_logs(rng):
    """Sessions that part ways at any place, end within others, repeat, or hold an unknown event."""
    trunk = [rng.choice("abc") for _ in range(40)]
    logs = {}
    for k in range(30):
        cut = rng.choice([0, 1, 3, 4, 5, 8, 15, 16, 17, 32, 40])
        logs[f"c{k}"] = (trunk[:cut] + [rng.choice("abcde") for _ in range(rng.choice([0, 1, 6]))]) or ["a"]
    return logs | {"whole": trunk, "again": trunk, "odd": trunk[:20] + ["?"] + trunk[20:], "first": ["?"], "one": ["a"]}


@pytest.mark.parametrize("seed", [30, 31])
def test_results_and_work(spark, folded, seed):
    rng = random.Random(seed)
    nets, logs = {"m": random_net(rng, False), "k": random_net(rng, False)}, alike_logs(rng)
    wanted = {(m, case): replay(net, log, ["p2"]) for m, net in nets.items() for case, log in logs.items()}
    tables, runs = nets_from_rows(spark, nets), [Run(m, expected_final=("p2",)) for m in nets]
    work = {}
    for option in ("share_variants", "share_prefixes"):
        folded.clear()
        rows = check_logs(sessions_of(spark, logs), tables, runs, method="fold", **{option: True}).collect()
        assert {(r.model_id, r.case_id): (r.status, r.error_detail, r.missing_tokens, r.missing_indices, r.unconsumed_tokens) for r in rows} == wanted
        work[option] = sum(folded)
    assert 0 < work["share_prefixes"] < work["share_variants"]


def test_no_sessions(spark):
    nets = nets_from_rows(spark, {"m": [("t1", "a", ["p1"], ["p2"]), ("t2", "a", ["p1"], ["p3"])]})
    sessions = sessions_of(spark, {"x": ["a"]})
    run = [Run("m", "", ("zz",), ("a",))]
    assert outcomes(check_logs(sessions, nets, run, share_prefixes=True)) == {}
