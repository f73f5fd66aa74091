"""The registered queries against their SQL on the smallest tables; native operators without Python."""

from pathlib import Path

import duckdb
import pytest

from tracefold.llm import oracles, queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")
SQL = oracles.all_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", SQL)
def test_query_matches_sql(spark, db, name):
    df = queries.all_queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    cursor = db.execute(SQL[name])
    found = [d[0] for d in cursor.description]
    assert sorted(found) == columns
    order = [found.index(c) for c in columns]
    key = lambda row: tuple((v is None, v) for v in row)
    assert sorted(map(tuple, df.select(columns).collect()), key=key) == sorted((tuple(r[k] for k in order) for r in cursor.fetchall()), key=key)


def test_native_operators_run_no_python(spark):
    for name in ("op3_mixing", "op4_quality_rules"):
        plan = queries.all_queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "InPandas", "InArrow", "CartesianProduct"))
