import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brute import order, trim
from tracefold.cluster import task_slots
from tracefold.local import local_table
from tracefold.operators import sessions as S

SCHEMA = "case_id string, ts bigint, event string"


def log_of(spark, rows):
    return local_table(spark, rows, SCHEMA)


def as_logs(frame):
    logs = {}
    for row in sorted(frame.collect(), key=lambda r: (r.case_id, r.pos)):
        logs.setdefault(row.case_id, []).append((row.pos, row.event))
    for case, rows in logs.items():
        assert [p for p, _ in rows] == list(range(len(rows))), case
    return {case: [e for _, e in rows] for case, rows in logs.items()}


@pytest.fixture(scope="module")
def skewed_rows():
    """A case with a third of all rows, many of them copies, among small cases."""
    rng = random.Random(7)
    rows = [("hot", rng.randrange(60), rng.choice("abcd")) for _ in range(400)]
    rows += [("hot", 30, "b")] * 2500
    rows += [(f"c{rng.randrange(300)}", rng.randrange(50), rng.choice("abcd")) for _ in range(3000)]
    rng.shuffle(rows)
    return rows


def test_ties_are_ordered_by_name_and_copies_stay(spark):
    log = log_of(spark, [("x", 1, "b"), ("x", 1, "a"), ("x", 0, "z"), ("x", 1, "a"), ("x", 2, "B")])
    assert as_logs(S.order_events(log).rows("pos", "event")) == {"x": ["z", "a", "a", "b", "B"]}


def test_rows_without_case_time_or_event_are_left_out(spark):
    log = log_of(spark, [("x", 1, "a"), (None, 1, "a"), ("x", None, "b"), ("x", 2, None)])
    assert as_logs(S.order_events(log).rows("pos", "event")) == {"x": ["a"]}
    assert log.where(~S.is_complete_record()).count() == 3


def test_extract_by_position_or_name(spark):
    raw = local_table(spark, [("u", 5, "x", 9)], "who string, at bigint, what string, more bigint")
    by_position = S.extract_event_log(raw, 0, 1, 2)
    assert by_position.columns == ["case_id", "ts", "event"]
    assert by_position.collect() == S.extract_event_log(raw, "who", "at", "what").collect()


@pytest.mark.parametrize("hot_rows", [None, 500])
def test_order_and_trim_agree_with_brute_force(spark, skewed_rows, hot_rows):
    sessions = S.order_events(log_of(spark, skewed_rows), hot_rows=hot_rows)
    assert len(sessions.pieces) == (2 if hot_rows else 1)
    logs = order(skewed_rows)
    assert as_logs(sessions.rows("pos", "event")) == logs
    wanted = {c: t for c, l in logs.items() if (t := trim(l, ["b", "d"], ["c"]))}
    assert as_logs(S.trim_sessions(sessions, ["b", "d"], ["c"]).rows("pos", "event")) == wanted
    lengths = S.session_lengths(S.trim_sessions(sessions, ["b", "d"], ["c"])).collect()
    assert {r.case_id: r.session_length for r in lengths} == {c: len(t) for c, t in wanted.items()}
    front = {c: l[min(k for k, e in enumerate(l) if e == "d"):] for c, l in logs.items() if "d" in l}
    assert as_logs(S.trim_start(sessions, ["d"]).rows("pos", "event")) == front
    back = {c: l[:max(k for k, e in enumerate(l) if e == "d") + 1] for c, l in logs.items() if "d" in l}
    assert as_logs(S.trim_end(sessions, ["d"]).rows("pos", "event")) == back


def test_a_hot_case_is_spread_over_tasks(spark, skewed_rows):
    sessions = S.order_events(log_of(spark, skewed_rows), hot_rows=500)
    split = sessions.pieces[1]
    assert split.split
    sizes = Counter(r.chunk for r in split.rows.select("chunk").collect())
    # 2,500 copies of one record are cut as well
    assert len(sizes) > 2 and max(sizes.values()) < 800


def test_an_end_before_the_start_does_not_count(spark):
    rows = [("x", k, e) for k, e in enumerate(["end", "start", "mid"])] + [("y", 0, "both")]
    sessions = S.order_events(log_of(spark, rows))
    assert as_logs(S.trim_sessions(sessions, ["start"], ["end"]).rows("pos", "event")) == {}
    assert as_logs(S.trim_sessions(sessions, ["both"], ["both"]).rows("pos", "event")) == {"y": ["both"]}
    assert as_logs(S.trim_sessions(sessions, [], ["end"]).rows("pos", "event")) == {}
    assert as_logs(S.sessions_with_start(sessions, []).rows("pos", "event")) == {}
    assert set(as_logs(S.sessions_with_start(sessions, ["start"]).rows("pos", "event"))) == {"x"}
    assert as_logs(S.complete_sessions(sessions, ["end"], ["end"]).rows("pos", "event")) == {"x": ["end", "start", "mid"]}


@pytest.mark.parametrize("hot_rows", [None, 500])
def test_grouped_sessions_come_in_segments(spark, skewed_rows, hot_rows):
    sessions = S.order_events(log_of(spark, skewed_rows), hot_rows=hot_rows)
    rows = S.group_sessions(sessions, size=100).collect()
    assert max(len(r.events) for r in rows) == 100
    joined = {}
    for row in sorted(rows, key=lambda r: (r.case_id, r.segment)):
        assert len(row.events) == len(row.timestamps)
        joined.setdefault(row.case_id, []).extend(row.events)
    assert joined == order(skewed_rows)


def test_hot_cases_are_few(spark, skewed_rows):
    sizes = S.measure_cases(log_of(spark, skewed_rows), hot_rows=500)
    assert sizes.hot == ("hot",) and sizes.total == len(skewed_rows) and sizes.largest == 2900
    assert S.measure_cases(log_of(spark, [])).hot == ()


def test_chunks_do_not_grow_with_small_hot_limits(spark):
    """A range partitioner samples every chunk to the driver."""
    log = spark.range(40_000).select(F.lit("x").alias("case_id"), F.col("id").alias("ts"), (F.col("id") % 3).cast("string").alias("event"))
    hot = S.order_events(log, hot_rows=10).pieces[-1].rows
    chunks = hot.select("chunk").distinct().count()
    assert 2 <= chunks <= S.CHUNKS_PER_SLOT * task_slots(spark)
    assert hot.where("pos != ts").isEmpty() and hot.count() == 40_000


def test_tasks_grow_with_the_log(spark, monkeypatch):
    """Merged by the bytes of the bare log, a task would hold more rows the larger the log is."""
    monkeypatch.setattr(S, "TASK_ROWS", 100)
    log = spark.range(2000).select((F.col("id") % 50).cast("string").alias("case_id"), F.col("id").alias("ts"), F.lit("e").alias("event"))
    rows = S.order_events(log).pieces[0].rows
    assert rows.rdd.getNumPartitions() == 20
    assert rows.groupBy("case_id").agg(F.max("pos").alias("p")).where("p != 39").isEmpty() and rows.count() == 2000
