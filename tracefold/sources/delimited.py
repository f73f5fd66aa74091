"""Pipe-delimited text: lines to fields and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def split_line(line: Column | str) -> Column:
    """Fields of a line; empty and trailing fields are kept, quotes mean nothing."""
    return F.split(line, r"\|")


def join_line(columns: list[str]) -> Column:
    """String columns as one line. A null field is an error: skipping it would shift the others."""
    def checked(name: str) -> Column:
        message = F.lit(f"column {name} is null and cannot be written to a line")
        return F.when(F.col(name).isNull(), F.raise_error(message).cast("string")).otherwise(F.col(name))
    return F.concat_ws("|", *[checked(name) for name in columns])


def read_delimited(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Text files with one pipe-delimited row per line, as string columns; missing fields are null."""
    fields = spark.read.text(path).select(split_line("value").alias("fields"))
    return fields.select(*[F.get("fields", F.lit(i)).alias(name) for i, name in enumerate(columns)])


def save_lines(lines: DataFrame, path: str) -> None:
    """Write one text line per row; an existing path is an error."""
    lines.write.mode("errorifexists").text(path)
