"""The token ledger against the independent model."""

import random
from collections import Counter

import pytest

from brute import replay
from test_replay import random_net, sessions_of
from tracefold.local import nets_from_rows
from tracefold.plans.check import Run
from tracefold.plans.ledger import LEDGER_COLUMNS, token_ledger


def brute(nets, logs, final):
    found = Counter()
    for model, net in nets.items():
        for case, log in logs.items():
            status, _, missing, indices, left = replay(net, log, final)
            if status == "ok":
                found.update((model, case, "missing", at, place) for at, place in zip(indices, missing))
                found.update((model, case, "left", len(log), place) for place in left)
    return {(*key, n) for key, n in found.items()}


@pytest.mark.parametrize("options", [{}, {"method": "fold"}, {"method": "fold", "segment": 7}])
def test_ledger(spark, options):
    rng = random.Random(5)
    nets = {"plain": random_net(rng, True), "any": random_net(rng, False)}
    logs = {f"c{k}": [rng.choice("abcde") for _ in range(rng.choice([1, 3, 12]))] for k in range(20)}
    logs |= {"long": [rng.choice("ab") for _ in range(40)], "cut": ["a"] * 9 + ["?"] + ["b"] * 20}
    runs = [Run(m, expected_final=("p2", "p2", "p1")) for m in nets]
    for hot_rows in (None, 9):
        rows = token_ledger(sessions_of(spark, logs, hot_rows=hot_rows), nets_from_rows(spark, nets), runs, **options)
        assert rows.columns == LEDGER_COLUMNS
        assert {tuple(r) for r in rows.collect()} == brute(nets, logs, ("p2", "p2", "p1"))


def test_no_list_per_session(spark):
    """A hot session on a model of plain events is never gathered."""
    nets = nets_from_rows(spark, {"m": [("t1", "a", ["p1"], ["p2"]), ("t2", "b", ["p2"], ["p1"])]})
    rows = token_ledger(sessions_of(spark, {"x": ["a", "b"] * 30}, hot_rows=9), nets, [Run("m")])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    # lists are made of a model's arcs alone
    assert not any("case_id" in line for line in plan.splitlines() if "collect_list" in line)
    with pytest.raises(ValueError, match="need the fold"):
        twice = nets_from_rows(spark, {"m": [("t1", "a", ["p1"], ["p2"]), ("t2", "a", ["p1"], ["p3"])]})
        token_ledger(sessions_of(spark, {"x": ["a"]}), twice, [Run("m")], method="scan")
