"""Change-record sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.jsontext import encode
from millrace.operators.changefeed import normalise, only_tables
from millrace.sources.text import topic_lines


def topic_changes(
    spark: SparkSession,
    servers: str,
    topic_pattern: str,
    tables: Sequence[str] = (),
    streaming: bool = True,
    startup: str = "latest",
    options: Mapping[str, str] | None = None,
    keep_dirty: bool = True,
) -> DataFrame:
    """Envelope columns + ``seq`` of the change topics, for the given ``db.table`` names.

    ``startup="initial"`` starts from the retained beginning, which holds the snapshot
    rows (type ``read``) followed by the changes.  Records that cannot be read keep their text
    and get a ``dirty_reason``, unless ``keep_dirty`` is off: then they are dropped.
    """
    records = topic_lines(spark, servers, topic_pattern, streaming, startup, options=options, pattern=True)
    return read_records(records, tables, keep_dirty)


def read_records(records: DataFrame, tables: Sequence[str] = (), keep_dirty: bool = True) -> DataFrame:
    """Envelope rows of change records ``topic, value, ..``; see ``topic_changes``."""
    changes = normalise(records, keep_dirty=True)
    if keep_dirty:
        return only_tables(changes, tables, keep="dirty_reason")
    return only_tables(changes.where("dirty_reason is null"), tables).drop("value", "dirty_reason")


def table_snapshot(table: DataFrame, database: str, name: str, order: Column) -> DataFrame:
    """A table as envelope rows of type ``read``: the snapshot half of ``initial``.

    Used where the change topic no longer holds the snapshot; process it as a batch
    before starting the stream of changes.
    """
    return table.select(
        order.alias("seq"),
        F.lit("read").alias("type"),
        encode(F.struct(*table.columns), keep_nulls=True).alias("data"),
        F.lit("{}").alias("before"),
        F.lit(database).alias("database"),
        F.lit(name).alias("tableName"),
    )
