"""Event time, day text, order time text and ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

YEAR_MS = 365 * 24 * 60 * 60 * 1000


def event_time(ts_ms: Column) -> Column:
    return F.timestamp_millis(ts_ms)


def day_text(ts_ms: Column) -> Column:
    """Epoch milliseconds -> ``yyyy-MM-dd`` in the session time zone."""
    return F.date_format(F.timestamp_millis(ts_ms), "yyyy-MM-dd")


def time_text(raw: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` from such text, or from epoch milliseconds as text."""
    # a failing cast raises and catches an error per row, so plain text is sorted out first
    millis = F.when(F.substring(raw, 5, 1) != "-", raw.try_cast("bigint"))
    return F.coalesce(F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd HH:mm:ss"), raw)


def time_millis(text: Column) -> Column:
    """Epoch milliseconds of ``yyyy-MM-dd HH:mm:ss``; anything after the seconds is ignored."""
    seconds = F.when(F.length(text) >= 19, F.substring(text, 1, 19).try_cast("timestamp"))
    return F.unix_millis(seconds)


def date_part(text: Column) -> Column:
    """The text before the space of ``yyyy-MM-dd HH:mm:ss``."""
    return F.get(F.split(text, " "), F.lit(0))


def hour_part(text: Column) -> Column:
    """The hour digits of ``yyyy-MM-dd HH:mm:ss``."""
    return F.get(F.split(F.get(F.split(text, " "), F.lit(1)), ":"), F.lit(0))


def age_years(birthday: Column, as_of: Column) -> Column:
    """Whole 365-day years between a ``yyyy-MM-dd`` birthday and a timestamp."""
    born = F.unix_millis(F.try_to_timestamp(birthday, F.lit("yyyy-MM-dd")))
    lived = F.unix_millis(as_of) - born
    # truncates towards zero, as integer division does
    return F.when(lived >= 0, F.floor(lived / YEAR_MS)).otherwise(F.ceil(lived / YEAR_MS)).cast("int")
