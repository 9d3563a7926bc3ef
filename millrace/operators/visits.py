"""Daily unique visitors: the first session entry of each device and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.timetext import day_text


def is_entry(last_page: str = "last_page_id") -> Column:
    """A page opened without a previous page starts a session."""
    return F.col(last_page).isNull()


def daily_first_visits(
    pages: DataFrame, key: str = "mid", ts: str = "ts", order_by: Sequence[str] = ("ts", "seq")
) -> DataFrame:
    """First entry row per (device, day); adds ``day``.

    The ``row_number = 1`` filter is planned as a group limit on both sides of the
    shuffle, so at most one row per device, day and input partition is moved, however
    many rows one device owns.
    """
    entries = pages.where(is_entry() & F.col(ts).isNotNull()).withColumn("day", day_text(F.col(ts)))
    rank = F.row_number().over(Window.partitionBy(key, "day").orderBy(*order_by))
    return entries.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
