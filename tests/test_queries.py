"""Every registered query against its SQL on the smallest tables, and what plans must not contain."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from tracefold import oracles, queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = queries.all_queries(), oracles.all_sql()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    cursor = db.execute(SQL[name])
    found = [d[0] for d in cursor.description]
    assert sorted(found) == columns
    order = [found.index(c) for c in columns]
    assert sorted(map(tuple, df.select(columns).collect())) == sorted(tuple(r[k] for k in order) for r in cursor.fetchall())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "case_id" and df.count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["conformance_report", "check_logs", "check_logs_ambiguous", "replay_ambiguous",
                                  "conformance_multi_model", "generate_report", "unknown_events", "event_transition_lookup"])
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("NestedLoop", "CartesianProduct", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert operator not in text


def test_the_log_is_shuffled_once_and_read_narrow(spark):
    text = plan(QUERIES["conformance_report"](spark, SF_DIR))
    assert text.count("hashpartitioning(case_id") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text
