"""Sessions: every event of a case in order, trimmed to start and end events.

Sessions stay in long form, one row per event with its position. A session small
enough for one task is ordered by a window over its case. A case that holds too
large a share of the log is cut into chunks that follow each other in time, so
that its events are ordered, trimmed and replayed by many tasks; what a chunk
needs to know about the chunks before it is carried in a small table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracefold.cluster import cut_lineage, task_slots
from tracefold.local import local_table

# A case is split once it holds more rows than a task's fair share, never below this.
SMALLEST_HOT_CASE = 100_000
CHUNKS_PER_SLOT = 4
# Rows a task orders, replays and holds: the partitions of a larger log grow with it.
TASK_ROWS = 100_000
# Events per row wherever sessions are shown or folded as arrays.
SEGMENT_EVENTS = 2048


@dataclass(frozen=True)
class CaseSizes:
    """Row counts that decide how a log is laid out."""

    total: int
    largest: int
    limit: int
    hot: tuple[str, ...]


@dataclass(frozen=True)
class Piece:
    """Session rows that share one layout.

    ``keys`` identify a session. In a split piece a session is spread over the
    consecutive values of ``chunk``; otherwise all its rows meet in one task.
    """

    rows: DataFrame
    keys: tuple[str, ...] = ("case_id",)
    split: bool = False

    @property
    def task_keys(self) -> tuple[str, ...]:
        return self.keys + ("chunk",) if self.split else self.keys

    def with_rows(self, rows: DataFrame) -> Piece:
        return replace(self, rows=rows)


@dataclass(frozen=True)
class Sessions:
    """A log as ordered sessions: rows of (keys, pos, event), ``pos`` counted from 0."""

    pieces: tuple[Piece, ...]
    longest: int
    total: int = 0

    @property
    def keys(self) -> tuple[str, ...]:
        return self.pieces[0].keys

    def map(self, step: Callable[[Piece], Piece]) -> Sessions:
        return replace(self, pieces=tuple(step(piece) for piece in self.pieces))

    def rows(self, *columns: str) -> DataFrame:
        return union_all(p.rows.select(*p.keys, *columns) for p in self.pieces)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def extract_event_log(raw: DataFrame, case_id, ts, event) -> DataFrame:
    """Pick case, timestamp and event name out of a wide table, by column name or position."""
    def pick(ref):
        return F.col(raw.columns[ref]) if isinstance(ref, int) else F.col(ref) if isinstance(ref, str) else ref
    return raw.select(
        pick(case_id).cast("string").alias("case_id"),
        pick(ts).alias("ts"),
        pick(event).cast("string").alias("event"),
    )


def is_complete_record() -> Column:
    """True for rows that can be ordered; the others are rejects, counted but not replayed."""
    return F.col("case_id").isNotNull() & F.col("ts").isNotNull() & F.col("event").isNotNull()


def measure_cases(log: DataFrame, hot_rows: int | None = None) -> CaseSizes:
    """Count rows per case and name the cases too large for one task.

    Only the case column is read, and counts are combined before they are shuffled.
    Fewer than ``total / limit`` cases can exceed the limit, so the list stays short.
    """
    slots = task_slots(log.sparkSession)
    counts = log.groupBy("case_id").agg(F.count(F.lit(1)).alias("n"))
    total, largest = counts.agg(F.sum("n"), F.max("n")).first()
    total, largest = total or 0, largest or 0
    limit = hot_rows or max(SMALLEST_HOT_CASE, total // (CHUNKS_PER_SLOT * slots))
    hot = ()
    if largest > limit:
        hot = tuple(row.case_id for row in counts.where(F.col("n") > limit).select("case_id").collect())
    return CaseSizes(total, largest, limit, hot)


def order_events(log: DataFrame, hot_rows: int | None = None, sizes: CaseSizes | None = None) -> Sessions:
    """Group a log of (case_id, ts, event) into sessions ordered by time, then event name."""
    log = log.where(is_complete_record())
    sizes = sizes or measure_cases(log, hot_rows)
    if not sizes.hot:
        return Sessions((_order_within_task(_spread(log, sizes)),), sizes.largest, sizes.total)
    hot = F.broadcast(local_table(log.sparkSession, [(c,) for c in sizes.hot], "case_id string"))
    whole = _order_within_task(_spread(log.join(hot, "case_id", "left_anti"), sizes))
    split = _order_across_tasks(log.join(hot, "case_id", "left_semi"), sizes)
    return Sessions((whole, split), sizes.largest, sizes.total)


def _spread(log: DataFrame, sizes: CaseSizes) -> DataFrame:
    """A large log dealt by case to as many tasks as its rows ask for.

    Left alone, partitions are merged by the bytes of the bare log, and what a row becomes in a task, once for every run and
    place, is many times that.
    """
    if sizes.total <= TASK_ROWS:
        return log
    return log.repartition(max(task_slots(log.sparkSession), -(-sizes.total // TASK_ROWS)), "case_id")


def neighbours(in_order) -> dict[str, Column]:
    """The two events before and after a row of a window: b2, b1, a1, a2."""
    near = {f"b{d}": F.lag("event", d) for d in (2, 1)} | {f"a{d}": F.lead("event", d) for d in (1, 2)}
    return {name: value.over(in_order) for name, value in near.items()}


def _order_within_task(log: DataFrame) -> Piece:
    """One window gives the position and the neighbours, which cost nothing where they are not used."""
    by_case = Window.partitionBy("case_id").orderBy("ts", "event")
    near = neighbours(by_case)
    rows = log.withColumns({"pos": F.row_number().over(by_case).cast("bigint") - 1, **near})
    return Piece(rows.select("case_id", "pos", "ts", "event", *near))


def _order_across_tasks(log: DataFrame, sizes: CaseSizes) -> Piece:
    """Order the hot cases by range, so that one case fills many consecutive chunks.

    A range partitioner cannot cut through equal keys, so copies of a record are first
    told apart: counted within the task that read them, then numbered. Sorted rows are
    numbered within their partition, which is the chunk. The checkpoint is needed because
    every later use must see the same chunks.
    """
    # a range partitioner sends a sample of each chunk to the driver: no more chunks than fill the slots or hold a task's rows
    enough = max(CHUNKS_PER_SLOT * task_slots(log.sparkSession), -(-sizes.total // SMALLEST_HOT_CASE))
    chunks = max(2, min(-(-sizes.total // sizes.limit), enough))
    numbered = (
        log.withColumn("origin", F.spark_partition_id())
        .groupBy("case_id", "ts", "event", "origin").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    )
    # the id counts rows in its lower 33 bits and partitions above them
    rows = cut_lineage(
        numbered.repartitionByRange(chunks, "case_id", "ts", "event", "origin", "copy")
        .sortWithinPartitions("case_id", "ts", "event")
        .select("case_id", "ts", "event", F.monotonically_increasing_id().alias("id"))
    ).select("case_id", "ts", "event", F.shiftright("id", 33).cast("int").alias("chunk"),
             F.col("id").bitwiseAND(2**33 - 1).alias("nth"))
    before = Window.partitionBy("case_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    # one row per hot case and chunk: from the row number in the chunk to the position in the session
    offsets = (
        rows.groupBy("case_id", "chunk").agg(F.count(F.lit(1)).alias("size"), F.min("nth").alias("first"))
        .select("case_id", "chunk", (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("first")).alias("offset"))
    )
    ordered = rows.join(offsets, ["case_id", "chunk"]).withColumn("pos", F.col("nth") + F.col("offset"))
    return Piece(ordered.select("case_id", "chunk", "pos", "ts", "event"), split=True)


def with_session_values(piece: Piece, **values: Column) -> Piece:
    """Put aggregates of the whole session on each of its rows."""
    if not piece.split:
        whole = Window.partitionBy(*piece.keys)
        return piece.with_rows(piece.rows.withColumns({k: v.over(whole) for k, v in values.items()}))
    # one row per hot session and run: cases above a task's fair share are fewer than the task slots allow
    per_session = piece.rows.groupBy(*piece.keys).agg(*[v.alias(k) for k, v in values.items()])
    return piece.with_rows(piece.rows.join(F.broadcast(per_session), list(piece.keys)))


def _is_any(events) -> Column:
    """Event is one of ``events``: a list of names, or the name of an array column. None, or a null array, is any event."""
    if events is None:
        return F.lit(True)
    if isinstance(events, str):
        return F.coalesce(F.array_contains(F.col(events), F.col("event")), F.lit(True))
    return F.col("event").isin(list(events)) if len(events) else F.lit(False)


def with_bounds(sessions: Sessions, first_events=None, last_events=None) -> Sessions:
    """Add ``start``, the first start event, and ``end``, the last end event, as positions."""
    values = {}
    if first_events is not None:
        values["start"] = F.min(F.when(_is_any(first_events), F.col("pos")))
    if last_events is not None:
        values["end"] = F.max(F.when(_is_any(last_events), F.col("pos")))
    return sessions.map(lambda piece: with_session_values(piece, **values))


def _narrow(sessions: Sessions, keep: Column, shift: bool = False) -> Sessions:
    def step(piece: Piece) -> Piece:
        rows = piece.rows.where(keep)
        if shift:
            rows = rows.withColumn("pos", F.col("pos") - F.col("start"))
        return piece.with_rows(rows.drop("start", "end"))
    return sessions.map(step)


def sessions_with_start(sessions: Sessions, first_events) -> Sessions:
    """Keep sessions that hold any of the start events."""
    return _narrow(with_bounds(sessions, first_events), F.col("start").isNotNull())


def trim_start(sessions: Sessions, first_events) -> Sessions:
    """Drop what comes before the earliest start event, and sessions without one."""
    return _narrow(with_bounds(sessions, first_events), F.col("pos") >= F.col("start"), shift=True)


def complete_sessions(sessions: Sessions, first_events, last_events) -> Sessions:
    """Trim the front, then keep sessions that still hold any of the end events."""
    kept = (F.col("pos") >= F.col("start")) & (F.col("end") >= F.col("start"))
    return _narrow(with_bounds(sessions, first_events, last_events), kept, shift=True)


def trim_end(sessions: Sessions, last_events) -> Sessions:
    """Drop what comes after the last end event, and sessions without one."""
    return _narrow(with_bounds(sessions, last_events=last_events), F.col("pos") <= F.col("end"))


def trim_sessions(sessions: Sessions, first_events, last_events) -> Sessions:
    """Cut each session to start at its first start event and end at its last end event.

    Rows also get ``n``, the length of the trimmed session. A bound of None leaves its side as it is;
    an empty list keeps no session.
    """
    kept = F.col("pos").between(F.col("start"), F.col("end"))
    bounded = sessions.map(lambda piece: with_session_values(
        piece, start=F.min(F.when(_is_any(first_events), F.col("pos"))), end=F.max(F.when(_is_any(last_events), F.col("pos")))))
    bounded = bounded.map(lambda p: p.with_rows(p.rows.withColumn("n", F.col("end") - F.col("start") + 1)))
    return _narrow(bounded, kept, shift=True)


def extract_logs(log: DataFrame, first_events, last_events, hot_rows: int | None = None) -> Sessions:
    """Group, order and trim a log."""
    return trim_sessions(order_events(log, hot_rows), first_events, last_events)


def session_lengths(sessions: Sessions) -> DataFrame:
    """Events per session; partial counts, so a long session is counted by many tasks."""
    return sessions.rows().groupBy(*sessions.keys).agg(F.count(F.lit(1)).alias("session_length"))


def group_sessions(sessions: Sessions, size: int = SEGMENT_EVENTS) -> DataFrame:
    """Sessions as parallel timestamp and event arrays, one row per ``size`` events.

    Sessions of up to ``size`` events are one row; a longer one continues in the next
    segment, so no row grows with the length of a session.
    """
    segment = F.expr(f"pos div {size}").alias("segment")

    def arrays(piece: Piece) -> DataFrame:
        ordered = F.sort_array(F.collect_list(F.struct("pos", "ts", "event")))
        return (
            piece.rows.groupBy(*piece.keys, segment).agg(ordered.alias("e"))
            .select(*piece.keys, "segment", F.col("e.ts").alias("timestamps"), F.col("e.event").alias("events"))
        )
    return union_all(arrays(piece) for piece in sessions.pieces)
