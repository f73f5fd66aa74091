import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from brute import replay
from fixtures import NETS
from tracefold.cluster import shared_dir, shared_path
from tracefold.local import local_table, nets_from_rows
from tracefold.operators.sessions import order_events
from tracefold.plans.check import Run, check_counts, check_logs, generate_report
from tracefold.plans import report as R
from tracefold.sources.delimited import join_line, read_delimited, split_line

SCHEMA = "case_id string, ts bigint, event string"


def around(log, indices):
    """Context texts, told from the definition."""
    n = len(log)
    if n == 1:
        return [f"(>> {log[0]})"]
    if n == 2:
        return [f"({log[0]} >> {log[1]})"]
    texts = []
    for i in indices:
        cut = 0 if i == 0 else 2 if i == n - 1 else 3 if i == n else 1
        first = {0: 0, 1: i - 1, 2: n - 3, 3: n - 3}[cut]
        events = log[first:first + 3]
        left, right = " > ".join(events[:cut]), " > ".join(events[cut:])
        texts.append("(" + " ".join(part for part in (left, ">>", right) if part) + ")")
    return texts


def log_table(spark, logs):
    return local_table(spark, [(c, k, e) for c, log in logs.items() for k, e in enumerate(log)], SCHEMA)


def test_context_definition():
    log = list("abcd")
    assert around(log, [0, 1, 3, 4]) == ["(>> a > b > c)", "(a >> b > c)", "(b > c >> d)", "(b > c > d >>)"]


CONTEXT_NETS = {
    "m": [("t1", "a", ["p1"], ["p2"]), ("t2", "b", ["p3"], []), ("t3", "c", ["p2", "p3"], ["p1"])],
    "choice": [("t1", "a", ["p1"], ["p2"]), ("t2", "b", ["p3"], []), ("t3", "c", ["p2", "p3"], ["p1"]), ("t4", "a", ["p3"], ["p1"])],
}
CONTEXT_LOGS = {"one": ["a"], "two": ["b", "a"], "three": ["b", "b", "c"], "four": list("bacb"), "fine": list("a"),
                "long": list("bacbbacabc"), "bad": list("abx"), "badtwo": list("xa")}


@pytest.mark.parametrize("hot_rows", [None, 1, 3])
@pytest.mark.parametrize("model, options", [
    ("m", {}), ("m", {"method": "fold"}), ("choice", {}), ("choice", {"segment": 1}), ("m", {"segment": 3, "method": "fold"}), ("choice", {"share_variants": True})])
def test_surrounding_events(spark, hot_rows, model, options):
    nets, run = nets_from_rows(spark, CONTEXT_NETS), [Run(model, expected_final=("p1", "p9"))]
    rows = generate_report(order_events(log_table(spark, CONTEXT_LOGS), hot_rows=hot_rows), nets, run, **options).collect()
    assert len(rows) == len(CONTEXT_LOGS)
    for row in rows:
        log = CONTEXT_LOGS[row.case_id]
        assert list(row.surrounding_events) == around(log, replay(CONTEXT_NETS[model], log, ["p1", "p9"])[3]), row.case_id


@pytest.mark.parametrize("hot_rows", [None, 3])
def test_surrounding_events_of_trimmed_sessions(spark, hot_rows):
    nets, runs = nets_from_rows(spark, CONTEXT_NETS), [Run("m", "", ("c",), ("b",), ("p9",)), Run("choice", "", ("c",), ("b",), ("p9",))]
    logs = {"x": list("bacbbacabca"), "y": list("aacbbb"), "z": list("acba"), "none": list("aaa")}
    rows = generate_report(order_events(log_table(spark, logs), hot_rows=hot_rows), nets, runs).collect()
    trimmed = {"x": list("cbbacab"), "y": list("cbbb"), "z": list("cb")}
    assert {(r.model_id, r.case_id) for r in rows} == {(m, c) for m in CONTEXT_NETS for c in trimmed}
    for row in rows:
        log = trimmed[row.case_id]
        assert list(row.surrounding_events) == around(log, replay(CONTEXT_NETS[row.model_id], log, ["p9"])[3]), row


def test_report_reads_the_log_once(spark):
    path = shared_path(spark, "test-log")
    log_table(spark, CONTEXT_LOGS).write.parquet(path)
    nets, runs = nets_from_rows(spark, CONTEXT_NETS), [Run("m")]
    report = generate_report(order_events(spark.read.parquet(path)), nets, runs)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Scan ExistingRDD" not in plan


def test_report_rows(spark):
    logs = {"good": ["go left", "turn back", "stop"], "bad": ["go left", "stop"], "odd": ["go left", "fly", "stop"]}
    nets, run = nets_from_rows(spark, NETS), [Run("walk", "streets", ("go left",), ("stop",), ("p5",))]
    rows = {r.case_id: tuple(r) for r in R.conformance_report(
        log_table(spark, logs), nets, run, F.to_date(F.lit("2024-03-01"))).collect()}
    head = ("streets", "2024-02-29 00:00:00", "walk.pnml")
    assert rows["good"] == ("good", *head, "[]", "[]", "0", "0", "3")
    assert rows["bad"] == ("bad", *head, "['p4']", "['p3']", "1", "1", "2")
    # the count of a failed check is the length of its text
    assert rows["odd"] == ("odd", *head, "unknown Event: fly", "[]", "18", "0", "3")


def test_report_of_an_explosion(spark):
    net = [(f"t{k}", "v", ["p1"], ["p1", f"p{k}"]) for k in (3, 4, 5)]
    rows = R.conformance_report(log_table(spark, {"x": ["v"] * 13}), nets_from_rows(spark, {"m": net}), [Run("m", "a")])
    row = rows.first()
    assert (row.missing_tokens, row.missing_count) == ("Path Explosion: over 100 paths in buffer", "40")


def test_date_defaults_to_yesterday(spark):
    rows = R.conformance_report(log_table(spark, {"x": ["go left"]}), nets_from_rows(spark, NETS), [Run("walk", "a")])
    wanted = spark.range(1).select(F.date_format(F.date_sub(F.current_date(), 1), "yyyy-MM-dd 00:00:00")).first()[0]
    assert rows.first().report_date == wanted


def test_save_and_read_back(spark):
    logs = {"bad": ["go left", "stop"], "odd": ["fly"]}
    report = R.conformance_report(log_table(spark, logs), nets_from_rows(spark, NETS), [Run("walk", "a|b", expected_final=())])
    path = shared_path(spark, "test-report")
    R.save_report(report, path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert any(line.startswith("bad|a|b|") for line in lines)
    with pytest.raises(AnalysisException):
        R.save_report(report, path)


def test_lines_keep_empty_fields(spark):
    row = spark.createDataFrame([('a||"b|',)], "value string").select(split_line("value").alias("f")).first()
    assert row.f == ["a", "", '"b', ""]
    path = shared_path(spark, "test-lines")
    spark.createDataFrame([("a|b",), ("|x",)], "value string").write.text(path)
    assert sorted(map(tuple, read_delimited(spark, path, ["f", "g", "h"]).collect())) == [("", "x", None), ("a", "b", None)]


def test_null_fields_cannot_be_joined(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    with pytest.raises(Exception, match="column y is null"):
        df.select(join_line(["x", "y"])).collect()


def test_counters(spark):
    counters = R.RunCounters()
    with pytest.raises(ValueError):
        counters.watch(spark.range(1))
    counters.register("deviating", R.outcome() == "deviating")
    counters.register("failed", F.col("status") != "ok")
    counters.register("events", value=F.col("session_length"), start=10)
    counters.register("lost", F.col("missing_count") > 0, F.col("missing_count"))
    for refused in (counters.value, counters.reset, counters.increment, lambda name: counters.watch(spark.range(1), name)):
        with pytest.raises(ValueError, match="no counter called odd"):
            refused("odd")
    assert counters.values() == {"deviating": 0, "failed": 0, "events": 10, "lost": 0}
    logs = {"good": ["go left", "turn back", "stop"], "bad": ["go left", "stop"], "odd": ["fly"]}
    results = check_counts(order_events(log_table(spark, logs)), nets_from_rows(spark, NETS), [Run("walk", expected_final=("p5",))])
    for _ in range(2):  # a new watch counts its own rows
        counters.watch(results).collect()
        assert counters.values() == {"deviating": 1, "failed": 1, "events": 16, "lost": 1}
    counters.increment("failed")
    counters.increment("lost", 5)
    counters.reset("events", 3)
    assert counters.values() == {"deviating": 1, "failed": 2, "events": 3, "lost": 6}
    counters.watch(results.where("status = 'ok'"), "events").collect()
    assert (counters.value("events"), counters.value("deviating")) == (8, 1)
    counters.watch(results.limit(0)).collect()
    assert counters.values() == {"deviating": 0, "failed": 1, "events": 3, "lost": 5}
    assert {(r.outcome, r.sessions) for r in R.count_outcomes(results).collect()} == {
        ("conformant", 1), ("deviating", 1), ("unknown_event", 1)}


@pytest.mark.parametrize("hot_rows", [None, 2])
def test_rejects_and_results_are_counted_by_one_action(spark, hot_rows):
    rows = [("a", 1, "go left"), ("a", 2, "turn back"), ("a", 3, "stop"), ("b", 1, "go left"), ("b", None, "stop"), (None, 1, "stop"), ("a", 4, None)]
    path = shared_path(spark, "test-log")
    local_table(spark, rows, SCHEMA).write.parquet(path)
    counters = R.RunCounters()
    counters.register("rows")
    counters.register("rejects", ~R.is_complete_record())
    counters.register("sessions")
    results = R.watched_counts(spark.read.parquet(path), nets_from_rows(spark, NETS), [Run("walk", expected_final=("p5",))], counters,
                               ("rows", "rejects"), ("sessions",), hot_rows=hot_rows)
    assert results._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    results.write.parquet(shared_path(spark, "test-results"))
    assert counters.values() == {"rows": 7, "rejects": 3, "sessions": 2}


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.sparkContext.getCheckpointDir()
    assert shared_path(spark, "x") != shared_path(spark, "x")


@pytest.mark.parametrize("model,method", [("walk", "scan"), ("walk", "fold"), ("desk", "fold")])
@pytest.mark.parametrize("hot_rows", [None, 3])
def test_counts_agree_with_lists(spark, model, method, hot_rows):
    logs = {"a": ["go left", "stop", "stop", "go left", "stop"], "b": ["go to work", "sit at desk"], "c": ["go left", "fly"],
            "d": ["go to work"] * 7, "e": ["stop"]}
    nets, run = nets_from_rows(spark, NETS), [Run(model, expected_final=("p5", "p5"))]
    sessions = order_events(log_table(spark, logs), hot_rows=hot_rows)
    listed = {r.case_id: (r.status, r.error_detail, len(r.missing_tokens), len(r.unconsumed_tokens), r.session_length)
              for r in check_logs(sessions, nets, run, method=method).collect()}
    counted = {r.case_id: tuple(r)[2:] for r in check_counts(sessions, nets, run, method=method).collect()}
    assert counted == listed
