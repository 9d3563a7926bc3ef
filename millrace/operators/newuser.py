"""New-user flag repair.

Only the first line of a device may claim ``is_new = "1"``; later claims become "0".

A window per device would put a device that owns a third of the log into one task.
Instead the first line of each device is found by an aggregate (combined before the
shuffle) and joined back on (device, order), a key that is unique per line and
therefore spreads evenly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(order_by: Sequence[str]) -> Column:
    return F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)


def first_lines(log: DataFrame, key: str = "mid", order_by: Sequence[str] = ("seq",)) -> DataFrame:
    """``key, first_order``: the position of the first line of every device."""
    met = log.where(F.col(key).isNotNull())
    return met.groupBy(key).agg(F.min(_order(order_by)).alias("first_order"))


def repair_new_flag(
    log: DataFrame,
    key: str = "mid",
    order_by: Sequence[str] = ("seq",),
    flag: str = "is_new",
    seen: DataFrame | None = None,
) -> DataFrame:
    """Repair ``flag`` and add ``flag_repaired``.

    ``order_by`` is the arrival order and must be unique per device (for a topic:
    timestamp, partition, offset).  ``seen`` holds devices met by earlier runs, whose
    lines are all later ones.
    """
    firsts = first_lines(log, key, order_by)
    if seen is not None:
        firsts = firsts.join(seen.select(key), key, "left_anti")
    return apply_first_lines(log, firsts, key, order_by, flag)


def apply_first_lines(
    log: DataFrame,
    firsts: DataFrame,
    key: str = "mid",
    order_by: Sequence[str] = ("seq",),
    flag: str = "is_new",
) -> DataFrame:
    """The join-back half of the repair, for callers that already hold ``firsts``."""
    marks = firsts.select(
        F.col(key).alias("_key"), F.col("first_order").alias("_order"), F.lit(True).alias("_first")
    )
    joined = log.join(
        marks, (log[key] == F.col("_key")) & (_order(order_by) == F.col("_order")), "left"
    )
    changed = (F.col(flag) == "1") & F.col("_first").isNull()
    return (
        joined.withColumn("flag_repaired", F.coalesce(changed, F.lit(False)))
        .withColumn(flag, F.when(F.col("flag_repaired"), "0").otherwise(F.col(flag)))
        .drop("_key", "_order", "_first")
    )
