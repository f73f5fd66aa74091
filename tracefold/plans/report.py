"""The conformance report: nine text columns per session, its lines and its counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tracefold.functions.text import error_text, list_text, previous_midnight
from tracefold.local import local_table
from tracefold.operators.models import Nets
from tracefold.operators.sessions import is_complete_record, measure_cases, order_events
from tracefold.plans.check import Run, check_counts, check_logs, nets_of_runs
from tracefold.schemas import REPORT_COLUMNS, STATUS_OK
from tracefold.sources.delimited import join_line, save_lines


def format_results(results: DataFrame, nets: Nets, runs: Sequence[Run], as_of: Column | None = None) -> DataFrame:
    """Check results as report rows. A failed check shows its error text, and that text's
    length as its count of missing tokens."""
    as_of = F.current_date() if as_of is None else as_of
    spark = results.sparkSession
    areas = local_table(spark, [(r.key, r.area) for r in runs], "model_id string, area string")
    nets = nets_of_runs(nets, runs)
    files = nets.places.select("model_id", "model_file").groupBy("model_id").agg(F.min("model_file").alias("model_file"))
    # one row per run
    labels = F.broadcast(areas.join(files, "model_id", "left"))
    error = error_text()
    as_text = lambda value: value.cast("string")
    return results.join(labels, "model_id").select(
        "case_id", "area", previous_midnight(as_of).alias("report_date"), "model_file",
        F.coalesce(error, list_text("missing_tokens")).alias("missing_tokens"),
        list_text("unconsumed_tokens").alias("unconsumed_tokens"),
        as_text(F.coalesce(F.length(error), F.size("missing_tokens"))).alias("missing_count"),
        as_text(F.size("unconsumed_tokens")).alias("unconsumed_count"),
        as_text(F.col("session_length")).alias("session_length"),
    )


def conformance_report(log: DataFrame, nets: Nets, runs: Sequence[Run], as_of: Column | None = None,
                       hot_rows: int | None = None, **options) -> DataFrame:
    """Order, trim, replay and format a log of (case_id, ts, event)."""
    results = check_logs(order_events(log, hot_rows), nets, runs, **options)
    return format_results(results, nets, runs, as_of)


def report_lines(report: DataFrame) -> DataFrame:
    """Report rows as pipe-delimited lines."""
    return report.select(join_line(REPORT_COLUMNS).alias("line"))


def save_report(report: DataFrame, path: str) -> None:
    """Write report lines as text files; an existing path is an error."""
    save_lines(report_lines(report), path)


class RunCounters:
    """Named counters, filled by the action that computes a result.

    A counter starts at 0 or the given number. It grows by what rows passing a ``watch`` add to it and by
    ``increment``; ``reset`` gives it a new start. Asking for a name that was not registered is an error. As with any metric that
    tasks report, rows of a stage that runs again because an executor was lost count again.
    """

    def __init__(self) -> None:
        self._adds: dict[str, Column] = {}
        self._start: dict[str, int] = {}
        self._seen: dict[str, Observation] = {}

    def register(self, name: str, condition: Column | None = None, value: Column | None = None, start: int = 0) -> None:
        """A counter of the rows for which ``condition`` holds (all rows if None), or of the sum of ``value`` over them."""
        added = F.lit(1) if value is None else value
        self._adds[name] = F.coalesce(F.sum(added if condition is None else F.when(condition, added)), F.lit(0)).cast("bigint")
        self.reset(name, start)

    def reset(self, name: str, value: int = 0) -> None:
        """Start again from ``value``; what was watched before no longer counts."""
        self._known(name)
        self._start[name] = value
        self._seen.pop(name, None)

    def increment(self, name: str, value: int = 1) -> None:
        """Add to a counter on the driver."""
        self._known(name)
        self._start[name] += value

    def watch(self, df: DataFrame, *names: str) -> DataFrame:
        """``df``, whose rows are counted by ``names`` (all counters if none are given) in its next action.

        Counters watched before are left with their start and count the new rows only.
        """
        if not self._adds:
            raise ValueError("no counter was registered")
        names = names or tuple(self._adds)
        for name in names:
            self._known(name)
        seen = Observation()
        self._seen |= dict.fromkeys(names, seen)
        return df.observe(seen, *[self._adds[name].alias(name) for name in names])

    def value(self, name: str) -> int:
        """Where the counter stands; waits for the action that was watched."""
        self._known(name)
        return self._start[name] + (self._seen[name].get[name] if name in self._seen else 0)

    def values(self) -> dict[str, int]:
        return {name: self.value(name) for name in self._adds}

    def _known(self, name: str) -> None:
        if name not in self._adds:
            raise ValueError(f"there is no counter called {name}, only {sorted(self._adds)}")


def watched_counts(log: DataFrame, nets: Nets, runs: Sequence[Run], counters: RunCounters, at_log: Sequence[str], at_results: Sequence[str],
                   hot_rows: int | None = None, **options) -> DataFrame:
    """``check_counts`` of a log, with counters on the raw rows, rejects included, and on the results.

    Both are filled by the action that computes the results; where a hot case is cut into chunks, by the job that does so.
    """
    sizes = measure_cases(log.where(is_complete_record()), hot_rows)
    results = check_counts(order_events(counters.watch(log, *at_log), sizes=sizes), nets, runs, **options)
    return counters.watch(results, *at_results)


def outcome() -> Column:
    """``conformant``, ``deviating`` or the failure of a counted check result."""
    clean = (F.col("missing_count") == 0) & (F.col("unconsumed_count") == 0)
    return F.when(F.col("status") != STATUS_OK, F.col("status")).when(clean, "conformant").otherwise("deviating")


def count_outcomes(counted: DataFrame) -> DataFrame:
    """Sessions per model and outcome."""
    return counted.groupBy("model_id", outcome().alias("outcome")).agg(F.count(F.lit(1)).alias("sessions"))
