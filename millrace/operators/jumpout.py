"""Bounced visits (jump-outs), in two definitions.

Both depend only on the neighbouring rows within the bound, so they run on time
slices (see ``timeslices``): one shuffle and one sort per (device, slice).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.timeslices import default_width, slice_of, with_slices
from millrace.operators.visits import is_entry


def jumpouts_by_pattern(
    pages: DataFrame,
    bound_ms: int = 10_000,
    key: str = "mid",
    ts: str = "ts",
    order_by: Sequence[str] = ("ts", "seq"),
    slice_ms: int | None = None,
) -> DataFrame:
    """Entry rows followed by another entry, or by nothing, within ``bound_ms``.

    Adds ``reason``: ``match`` when the next row is an entry closer than the bound,
    ``timeout`` when no row follows closer than the bound.
    """
    rows = neighbour_rows(pages, bound_ms, 0, {key, ts, *order_by}, ts, slice_ms)
    w = Window.partitionBy(key, "slice").orderBy(*order_by)
    close = F.lead(ts).over(w) - F.col(ts) < bound_ms
    rows = rows.withColumn("_close", F.coalesce(close, F.lit(False))).withColumn(
        "_next_entry", F.lead("entry").over(w)
    )
    emitted = rows.where(F.col("own") & F.col("entry") & (~F.col("_close") | F.col("_next_entry")))
    reason = F.when(F.col("_close"), "match").otherwise("timeout")
    return emitted.withColumn("reason", reason).select(*pages.columns, "reason")


def jumpouts_by_session(
    pages: DataFrame,
    gap_ms: int = 10_000,
    emit_single: bool = False,
    key: str = "mid",
    ts: str = "ts",
    order_by: Sequence[str] = ("ts", "seq"),
    slice_ms: int | None = None,
) -> DataFrame:
    """Entry rows that end their session or precede another entry of it.

    A session goes on while gaps are at most ``gap_ms``.  Sessions of one row are left
    out unless ``emit_single``.  Membership of a session is only ever asked about the
    direct neighbours, so sessions are never collected, however long they are.
    """
    rows = neighbour_rows(pages, gap_ms, gap_ms, {key, ts, *order_by}, ts, slice_ms)
    w = Window.partitionBy(key, "slice").orderBy(*order_by)
    rows = rows.withColumns(
        {
            "_next": F.coalesce(F.lead(ts).over(w) - F.col(ts) <= gap_ms, F.lit(False)),
            "_prev": F.coalesce(F.col(ts) - F.lag(ts).over(w) <= gap_ms, F.lit(False)),
            "_next_entry": F.lead("entry").over(w),
        }
    )
    ends = ~F.col("_next") & (F.lit(emit_single) | F.col("_prev"))
    emitted = rows.where(
        F.col("own") & F.col("entry") & (ends | (F.col("_next") & F.col("_next_entry")))
    )
    return emitted.select(*pages.columns)


def neighbour_rows(
    pages: DataFrame,
    ahead_ms: int,
    back_ms: int,
    needed: set[str],
    ts: str = "ts",
    slice_ms: int | None = None,
) -> DataFrame:
    """Page rows on time slices, with ``entry``.

    Only own copies of entry rows can be emitted, so no others carry columns beyond
    the ``needed`` ones through the shuffle.
    """
    width = slice_ms or default_width(max(ahead_ms, back_ms))
    rows = with_slices(pages.withColumn("entry", is_entry()), ts, width, back_ms, ahead_ms)
    emittable = F.col("own") & F.col("entry")
    return rows.withColumns(
        {c: F.when(emittable, F.col(c)) for c in pages.columns if c not in needed}
    )


def page_sessions(
    pages: DataFrame,
    gap_ms: int = 10_000,
    key: str = "mid",
    ts: str = "ts",
    slice_ms: int | None = None,
) -> DataFrame:
    """Event-time sessions per device: ``first_ts, last_ts, n_rows``.

    Rows become sessions inside each (device, slice) first.  Only the sessions that
    touch a slice border, at most two per slice, still have to meet the rest of
    their device; all others stay grouped by slice.
    """
    width = slice_ms or default_width(gap_ms)
    rows = pages.select(key, F.col(ts).alias("ts")).where("ts is not null")
    rows = rows.withColumn("slice", slice_of(F.col("ts"), width))
    local = _islands(
        rows.select("*", F.col("ts").alias("first_ts"), F.col("ts").alias("last_ts"), F.lit(1).alias("n")),
        [key, "slice"],
        gap_ms,
    )
    starts_at_border = F.col("first_ts") - F.col("slice") * width <= gap_ms
    ends_at_border = (F.col("slice") + 1) * width - F.col("last_ts") <= gap_ms
    group = F.when(~(starts_at_border | ends_at_border), F.col("slice"))
    merged = _islands(local.withColumn("_group", group), [key, "_group"], gap_ms)
    return merged.select(key, "first_ts", "last_ts", F.col("n").alias("n_rows"))


def _islands(spans: DataFrame, group: list[str], gap_ms: int) -> DataFrame:
    """Merge spans ``first_ts, last_ts, n`` of a group that lie at most a gap apart."""
    w = Window.partitionBy(*group).orderBy("first_ts")
    far = F.col("first_ts") - F.lag("last_ts").over(w) > gap_ms
    spans = spans.withColumn("_new", F.coalesce(far, F.lit(True)).cast("int"))
    spans = spans.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        spans.groupBy(*group, "_island")
        .agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("n").alias("n"))
        .drop("_island")
    )
