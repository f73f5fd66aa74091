"""PNML model files as model tables, read by Spark's XML source."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracefold.operators.models import Nets

NAMED = "struct<_id:string,name:struct<text:string>>"
PLACE = "struct<_id:string,name:struct<text:string>,initialMarking:struct<text:string>>"
NET = (
    f"_id string, place array<{PLACE}>, transition array<{NAMED}>, "
    "arc array<struct<_id:string,_source:string,_target:string>>"
)


def read_models(spark: SparkSession, path: str, model_id: Column | None = None) -> Nets:
    """All models below ``path``: a file or a folder, one model per file.

    A model is named after its file unless ``model_id`` derives another name from ``file_path``.

    Only the first net of a file and only its own places, transitions and arcs count. A
    place with an initial marking holds one token, whatever number is written there. Names are
    kept as written, blanks included; a place without a name is an error.
    """
    file_name = F.element_at(F.split("file_path", "/"), -1)
    found = (
        spark.read.format("xml").option("rowTag", "net").option("ignoreSurroundingSpaces", False).schema(NET).load(path)
        .withColumns({"file_path": F.col("_metadata.file_path"), "block": F.col("_metadata.file_block_start"),
                      "nth": F.monotonically_increasing_id()})
    )
    first = Window.partitionBy("file_path").orderBy("block", "nth")
    nets = (
        found.withColumn("rank", F.row_number().over(first)).where("rank = 1")
        .withColumn("model_file", file_name)
        .withColumn("model_id", F.regexp_replace(file_name, r"\.[^.]*$", "") if model_id is None else model_id)
    )
    places = nets.select("model_id", "model_file", F.posexplode("place").alias("place_ord", "p")).select(
        "model_id", "model_file", "place_ord", F.col("p._id").alias("place_id"),
        F.coalesce("p.name.text", F.raise_error(F.lit("a place has no name")).cast("string")).alias("name"),
        F.when(F.col("p.initialMarking").isNotNull(), 1).otherwise(0).alias("init_tokens"))
    transitions = nets.select("model_id", F.posexplode("transition").alias("trans_ord", "t")).select(
        "model_id", "trans_ord", F.col("t._id").alias("transition_id"), F.col("t.name.text").alias("name"))
    arcs = nets.select("model_id", F.posexplode("arc").alias("arc_ord", "a")).select(
        "model_id", "arc_ord", F.col("a._source").alias("source"), F.col("a._target").alias("target"))
    return Nets(places, transitions, arcs)
