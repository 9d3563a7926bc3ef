"""Daily unique visitors on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.timetext import day_text, event_time
from millrace.operators.visits import is_entry


def daily_first_visits_stream(
    pages: DataFrame,
    key: str = "mid",
    ts: str = "ts",
    order_by: Sequence[str] = ("ts", "seq"),
    keep_days: int = 1,
    columns: Sequence[str] = ("seq", "value"),
) -> DataFrame:
    """First entry row per (device, day), emitted in the batch that first meets it.

    Run it in ``update`` mode.  The aggregate keeps the time of the batch that created
    a group; a group is emitted only when that is the current batch.  Rows of a busy
    device are combined before the shuffle.  Days are those of the session time zone, as
    in the batch form; the watermark drops the state of a day at least ``keep_days`` after
    its end.

    A row dated in the future moves the watermark no further than the day after its batch,
    so one wrong clock costs no other device its visits.  A day further ahead is
    emitted once for each day on which rows of it arrive.
    """
    # clocks may run ahead across midnight
    tomorrow = F.date_trunc("day", F.current_timestamp()) + F.expr("interval 1 day")
    entries = (
        pages.where(is_entry() & F.col(ts).isNotNull())
        .withColumn("day", day_text(F.col(ts)))
        .withColumn("day_end", F.least(F.date_trunc("day", event_time(F.col(ts))), tomorrow) + F.expr("interval 1 day"))
        # counted from the end of the day that is still going on, or of the next one
        .withWatermark("day_end", f"{keep_days + 2} days")
        .withColumn("batch_time", F.current_timestamp())
    )
    kept = [c for c in columns if c not in (key, ts)]
    first = F.min_by(F.struct(ts, *kept), F.struct(*order_by))
    groups = entries.groupBy(key, "day", "day_end").agg(
        first.alias("first"),
        F.min("batch_time").alias("created"),
        F.max("batch_time").alias("touched"),
    )
    return groups.where("created = touched").select(key, "first.*", "day")
