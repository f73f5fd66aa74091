"""Conformance check of sessions on models: which replay to use, and how runs are combined."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracefold.local import local_table
from tracefold.operators.models import ModelFacts, Nets, check_nets, event_join
from tracefold.operators.replay_fold import replay_fold
from tracefold.operators.replay_scan import replay_scan
from tracefold.operators.sessions import (
    SEGMENT_EVENTS, Sessions, trim_sessions, union_all, with_session_values,
)
from tracefold.schemas import COUNT_COLUMNS, RESULT_COLUMNS


@dataclass(frozen=True)
class Run:
    """One model applied to a log: what starts, ends and completes a session.

    ``first_events`` or ``last_events`` left at None mean that sessions are not trimmed on that side.
    Several runs of one model need a ``run_id`` each, which then stands as ``model_id`` in the results.
    """

    model_id: str
    area: str = ""
    first_events: tuple[str, ...] | None = None
    last_events: tuple[str, ...] | None = None
    expected_final: tuple[str, ...] = ("p2",)
    run_id: str | None = None

    @property
    def key(self) -> str:
        return self.run_id or self.model_id

    @property
    def trims(self) -> bool:
        return self.first_events is not None or self.last_events is not None


def nets_of_runs(nets: Nets, runs: Sequence[Run]) -> Nets:
    """The models of the runs, a copy for each run, named by the run."""
    if len({run.key for run in runs}) < len(runs):
        raise ValueError("runs of one model need run ids that differ")
    if all(run.key == run.model_id for run in runs):
        return nets
    names = F.array(*[F.struct(F.lit(r.model_id).alias("of"), F.lit(r.key).alias("run")) for r in runs])

    def copies(table: DataFrame) -> DataFrame:
        own = F.filter(names, lambda r: r["of"] == F.col("model_id"))
        return table.withColumn("model_id", F.explode(F.transform(own, lambda r: r["run"])))
    return Nets(copies(nets.places), copies(nets.transitions), copies(nets.arcs))


def _expected(nets: Nets, runs: Sequence[Run]) -> DataFrame:
    rows = [(run.key, list(run.expected_final)) for run in runs]
    return local_table(nets.places.sparkSession, rows, "model_id string, expected_final array<string>")


def _only(nets: Nets, model_ids: list[str]) -> Nets:
    wanted = F.col("model_id").isin(model_ids)
    return Nets(nets.places.where(wanted), nets.transitions.where(wanted), nets.arcs.where(wanted))


def assign_runs(sessions: Sessions, runs: Sequence[Run]) -> Sessions:
    """Sessions of each run, trimmed as it asks, with ``model_id`` and length ``n``.

    Several runs share one pass over the log: rows are repeated per run after the events
    were ordered.
    """
    trims = any(run.trims for run in runs)
    if len(runs) == 1:
        run = runs[0]
        # worked out from the row rather than a constant, which would turn joins on it into cross joins
        model = F.when(F.col("pos") >= 0, F.lit(run.key))
        sessions = sessions.map(lambda p: p.with_rows(p.rows.withColumn("model_id", model)))
        if trims:
            return trim_sessions(sessions, run.first_events, run.last_events)
    else:
        names = lambda events: (F.lit(None) if events is None else F.array(*[F.lit(e) for e in events])).cast("array<string>")
        offers = F.array(*[
            F.struct(F.lit(r.key).alias("model_id"), names(r.first_events).alias("first_events"),
                     names(r.last_events).alias("last_events")) for r in runs])
        sessions = sessions.map(lambda p: replace(
            p, rows=p.rows.select("*", F.inline(offers)), keys=("case_id", "model_id")))
        if trims:
            sessions = trim_sessions(sessions, "first_events", "last_events")
            return sessions.map(lambda p: p.with_rows(p.rows.drop("first_events", "last_events")))
    return sessions.map(lambda p: with_session_values(p, n=F.max(F.col("pos") + 1)))


def check_logs(sessions: Sessions, nets: Nets, runs: Sequence[Run], *, method: str = "auto",
               segment: int = SEGMENT_EVENTS, share_variants: bool = False, share_prefixes: bool = False) -> DataFrame:
    """Replay every session of every run; one result row per (model, session).

    ``method`` is "scan" (windows; event names must be unique), "fold" (any model) or
    "auto", which scans wherever it can.
    """
    nets = nets_of_runs(nets, runs)
    facts = check_nets(nets, [run.key for run in runs])
    assigned = assign_runs(sessions, runs)
    return replay_assigned(assigned, nets, runs, facts, method, segment, share_variants, share_prefixes)


def check_counts(sessions: Sessions, nets: Nets, runs: Sequence[Run], **options) -> DataFrame:
    """As ``check_logs``, with the number of missing and unconsumed tokens instead of their lists."""
    nets = nets_of_runs(nets, runs)
    facts = check_nets(nets, [run.key for run in runs])
    return replay_assigned(assign_runs(sessions, runs), nets, runs, facts, counts=True, **options)


def _counted(results: DataFrame) -> DataFrame:
    size = lambda name: F.size(name).cast("bigint")
    return results.select(
        *COUNT_COLUMNS[:4], size("missing_tokens").alias("missing_count"),
        size("unconsumed_tokens").alias("unconsumed_count"), "session_length")


def replay_assigned(assigned: Sessions, nets: Nets, runs: Sequence[Run], facts: dict[str, ModelFacts], method: str = "auto",
                    segment: int = SEGMENT_EVENTS, share_variants: bool = False, share_prefixes: bool = False, counts: bool = False,
                    context: bool = False) -> DataFrame:
    plain = [m for m, f in facts.items() if f.most_per_name == 1 and method != "fold"]
    if method == "scan" and len(plain) < len(facts):
        raise ValueError("event names with several transitions need the fold")
    rest = [m for m in facts if m not in plain]
    results = []
    if plain:
        chosen, picked = _pick(assigned, plain, facts), [r for r in runs if r.key in plain]
        results.append(replay_scan(chosen, _only(nets, plain), _expected(nets, picked), event_join(facts, plain), counts, context))
    if rest:
        chosen, picked = _pick(assigned, rest, facts), [r for r in runs if r.key in rest]
        folded = replay_fold(chosen, _only(nets, rest), _expected(nets, picked), event_join(facts, rest),
                             segment, share_variants, share_prefixes, context)
        results.append(_counted(folded) if counts else folded)
    return union_all(results).select(COUNT_COLUMNS if counts else [*RESULT_COLUMNS, *(["surrounding_events"] if context else [])])


def _pick(assigned: Sessions, models: list[str], facts: dict[str, ModelFacts]) -> Sessions:
    if len(models) == len(facts):
        return assigned
    return assigned.map(lambda p: p.with_rows(p.rows.where(F.col("model_id").isin(models))))


def unknown_events(log: DataFrame, nets: Nets, model_id: str) -> DataFrame:
    """Events of a log that no transition of the model is named after."""
    names = nets.transitions.where(F.col("model_id") == model_id).select(F.col("name").alias("event"))
    return event_join(check_nets(nets, [model_id]))(log, names, ["event"], "left_anti")


def generate_report(sessions: Sessions, nets: Nets, runs: Sequence[Run], **options) -> DataFrame:
    """Check results with ``surrounding_events``: the events around each missing token as a text, in order.

    Sessions of one or two events get a single text in any case. Texts are made where the events are
    ordered and go through the replay, so the log is read once.
    """
    nets = nets_of_runs(nets, runs)
    facts = check_nets(nets, [run.key for run in runs])
    assigned = assign_runs(sessions, runs)
    return replay_assigned(assigned, nets, runs, facts, context=True, **options)
