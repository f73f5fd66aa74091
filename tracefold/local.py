"""Small driver-side rows as DataFrames, and nets written down in code."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tracefold.operators.models import Nets
from tracefold.schemas import ARCS, PLACES, TRANSITIONS

# (transition id, event name, input places, output places)
TransitionRow = tuple[str, str, Sequence[str], Sequence[str]]


def local_table(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """Rows as a local relation, whose exact size the optimizer knows."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    records = [dict(zip(schema.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(schema)), schema)


def nets_from_rows(spark: SparkSession, models: Mapping[str, Sequence[TransitionRow]],
                   initial: Mapping[str, Sequence[str]] | None = None) -> Nets:
    """Model tables from transition rows; every model starts with a token in p1 unless ``initial`` says otherwise."""
    places, transitions, arcs = [], [], []
    for model, rows in models.items():
        start = (initial or {}).get(model, ("p1",))
        used = dict.fromkeys([*start, *(p for _, _, ins, outs in rows for p in (*ins, *outs))])
        places += [(model, f"{model}.pnml", k, p, p, start.count(p)) for k, p in enumerate(sorted(used))]
        transitions += [(model, k, t, name) for k, (t, name, _, _) in enumerate(rows)]
        ends = [e for t, _, ins, outs in rows for e in [*((p, t) for p in ins), *((t, p) for p in outs)]]
        arcs += [(model, k, source, target) for k, (source, target) in enumerate(ends)]
    return Nets(local_table(spark, places, PLACES), local_table(spark, transitions, TRANSITIONS),
                local_table(spark, arcs, ARCS))
