from datetime import datetime

from tracefold import queries


def test_tasks_grow_with_the_lines(spark, tmp_path, monkeypatch):
    """Merged by the bytes of the lines, a task would hold more models the more lines there are."""
    rows = [(k // 4, k % 7, k % 5, k % 4 + 1, 0.05, 0.0, "R", "O", datetime(2024, 1, 1)) for k in range(400)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    few = queries.order_models(spark, str(tmp_path))
    wanted = sorted(map(str, few.collect()))
    monkeypatch.setattr(queries, "LINES_PER_TASK", 20)
    many = queries.order_models(spark, str(tmp_path))
    assert many.rdd.getNumPartitions() == 20 and len(wanted) == 100
    assert sorted(map(str, many.collect())) == wanted
