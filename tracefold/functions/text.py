"""Text forms of results, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracefold.schemas import STATUS_PATH_EXPLOSION, STATUS_UNKNOWN_EVENT


def context_text(at: str, length: str) -> Column:
    """The events around position ``at``; expects the columns b2, b1, event, a1, a2 of that position.

    ``>>`` marks where the token was missing. At the very end the position is that of the last event.
    """
    i, n = F.col(at), F.col(length)
    return (
        F.when(n == 1, F.format_string("(>> %s)", "event"))
        .when(n == 2, F.format_string("(%s >> %s)", "event", "a1"))
        .when(i == 0, F.format_string("(>> %s > %s > %s)", "event", "a1", "a2"))
        .when(i == n - 1, F.format_string("(%s > %s >> %s)", "b2", "b1", "event"))
        .when(i == n, F.format_string("(%s > %s > %s >>)", "b2", "b1", "event"))
        .otherwise(F.format_string("(%s >> %s > %s)", "b1", "event", "a1"))
    )


def list_text(items: str) -> Column:
    """An array of ids as ``['p4', 'p5']``, empty as ``[]``."""
    quoted = F.transform(items, lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def error_text() -> Column:
    """What a failed check reports in place of its missing tokens; null for a finished one."""
    return (
        F.when(F.col("status") == STATUS_UNKNOWN_EVENT, F.concat(F.lit("unknown Event: "), "error_detail"))
        .when(F.col("status") == STATUS_PATH_EXPLOSION,
              F.concat(F.lit("Path Explosion: over "), "error_detail", F.lit(" paths in buffer")))
    )


def previous_midnight(as_of: Column) -> Column:
    """The day before ``as_of`` at 00:00:00, as text."""
    return F.date_format(F.date_sub(as_of, 1), "yyyy-MM-dd 00:00:00")
