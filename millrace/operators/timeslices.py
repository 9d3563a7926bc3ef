"""Time slices: split the rows of one key over many groups without losing neighbours.

A device or order id may own a third of all rows.  Rows are therefore grouped by
(key, slice of event time); a row that lies within ``reach`` of a slice border is
copied into the neighbouring slice, where it only serves as a neighbour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REACHES_PER_SLICE = 16


def default_width(reach_ms: int) -> int:
    """Narrow enough to spread a busy key, wide enough to copy only 1/16 of the rows per side."""
    return max(REACHES_PER_SLICE * reach_ms, 1)


def slice_of(ts: Column, width_ms: int) -> Column:
    return F.floor(ts / F.lit(width_ms)).cast("bigint")


def with_slices(
    df: DataFrame, ts: str, width_ms: int, reach_back_ms: int = 0, reach_ahead_ms: int = 0
) -> DataFrame:
    """Add ``slice`` and ``own``; copy rows into slices that need them as neighbours.

    A slice sees every row of its key from ``reach_back_ms`` before its start to
    ``reach_ahead_ms`` after its end.  ``own`` is true on exactly one copy of each row.
    """
    own = slice_of(F.col(ts), width_ms)
    first = slice_of(F.col(ts) - reach_ahead_ms, width_ms)
    last = slice_of(F.col(ts) + reach_back_ms, width_ms)
    return df.withColumn("slice", F.explode(F.sequence(first, last))).withColumn(
        "own", F.col("slice") == own
    )
