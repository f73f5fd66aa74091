"""The events around each event of a session, and the texts that show them.

Neighbours come from the window that orders the session. A chunk of a split session gets the two events before
and after it from the chunks next to it, so that no event is sent to another task but four for each chunk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracefold.functions.text import context_text
from tracefold.operators.sessions import Piece, neighbours

TEXTS = ("around", "around_end", "short")


def with_neighbours(piece: Piece) -> Piece:
    """Rows with the two events before and after: b2, b1, a1, a2."""
    if not piece.split:
        return piece  # the window that ordered the session has added them
    by_chunk = Window.partitionBy(*piece.task_keys).orderBy("pos")
    near = piece.rows.withColumns(neighbours(by_chunk))
    rows = near.join(_halo(near, piece), list(piece.task_keys))
    first, last = F.col("b1").isNull(), F.col("a1").isNull()
    filled = {
        "b2": F.coalesce("b2", F.when(first, F.get("before", F.size("before") - 2)).otherwise(F.get("before", F.size("before") - 1))),
        "b1": F.coalesce("b1", F.get("before", F.size("before") - 1)),
        "a1": F.coalesce("a1", F.get("after", F.lit(0))),
        "a2": F.coalesce("a2", F.when(last, F.get("after", F.lit(1))).otherwise(F.get("after", F.lit(0)))),
    }
    return piece.with_rows(rows.withColumns(filled).drop("before", "after"))


def _halo(near: DataFrame, piece: Piece) -> DataFrame:
    """For each chunk the events of the two chunks before and after it that stand at their edges, in order.

    A chunk holds an event at least, so the two chunks next to it hold the two next to it.
    """
    edge = F.when(F.col("b2").isNull() | F.col("a2").isNull(), F.struct("pos", "event"))
    edges = near.groupBy(*piece.task_keys).agg(F.sort_array(F.collect_list(edge))["event"].alias("edges"))
    by_session = Window.partitionBy(*piece.keys).orderBy("chunk")
    of = lambda start, end: F.flatten(F.collect_list("edges").over(by_session.rowsBetween(start, end)))
    return edges.select(*piece.task_keys, of(-2, -1).alias("before"), of(1, 2).alias("after"))


def with_texts(piece: Piece) -> Piece:
    """Rows with ``around``, the text of a token missing at the event; ``around_end``, on the last one, that of a token
    missing at the end; and ``short``, on the first one of a session of one or two events, the text of that session."""
    here = context_text("pos", "n")
    near = with_neighbours(piece)
    return near.with_rows(near.rows.withColumns({
        "around": here,
        "around_end": F.when(F.col("pos") == F.col("n") - 1, context_text("n", "n")),
        "short": F.when((F.col("n") <= 2) & (F.col("pos") == 0), here),
    }))
