"""Shared storage and parallelism, read from the running session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Local runs may leave the setting out and get a temporary folder; on a cluster
    a machine-local folder would not survive a lost executor, so it is refused.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="tracefold-")
    context.setCheckpointDir(configured)
    return configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder, so that lost executors do not restart the whole chain."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def task_slots(spark: SparkSession) -> int:
    """How many tasks one wide stage is meant to have."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(spark.sparkContext.defaultParallelism, partitions)
