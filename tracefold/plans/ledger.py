"""The token ledger: one row for each token that was missing, and for each place in which tokens were left.

It holds what check results hold, in long form, so that no row grows with the length of a session. Rows of a
split session stay spread over its chunks or segments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracefold.operators.models import Nets, check_nets, event_join
from tracefold.operators.replay_fold import ledger_fold
from tracefold.operators.replay_scan import ledger_scan
from tracefold.operators.sessions import SEGMENT_EVENTS, Sessions, union_all
from tracefold.plans.check import Run, _expected, _only, _pick, assign_runs, nets_of_runs

LEDGER_COLUMNS = ["model_id", "case_id", "kind", "at", "place_id", "tokens"]


def token_ledger(sessions: Sessions, nets: Nets, runs: Sequence[Run], *, method: str = "auto", segment: int = SEGMENT_EVENTS) -> DataFrame:
    """(model_id, case_id, kind, at, place_id, tokens): ``missing`` tokens by the position of the event that needed
    them (the session's length for the final marking), and ``left`` ones by place, at the session's length.

    Sessions whose check failed have no rows. ``method`` is that of ``check_logs``.
    """
    nets = nets_of_runs(nets, runs)
    facts = check_nets(nets, [run.key for run in runs])
    assigned = assign_runs(sessions, runs)
    plain = [m for m, f in facts.items() if f.most_per_name == 1 and method != "fold"]
    if method == "scan" and len(plain) < len(facts):
        raise ValueError("event names with several transitions need the fold")
    rest = [m for m in facts if m not in plain]
    parts = []
    for models, ledger, more in ((plain, ledger_scan, ()), (rest, ledger_fold, (segment,))):
        if models:
            expected = _expected(nets, [r for r in runs if r.key in models])
            parts.append(ledger(_pick(assigned, models, facts), _only(nets, models), expected, event_join(facts, models), *more))
    return union_all(parts).select(
        *LEDGER_COLUMNS[:3], F.col("at").cast("bigint").alias("at"), "place_id", F.col("tokens").cast("bigint").alias("tokens"))
