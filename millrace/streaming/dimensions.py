"""Dimension upserts on micro-batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.dimensions import DEFAULT_KEY, current_rows, set_table_location
from millrace.sinks.topics import is_complete
from millrace.streaming.ledger import Ledger

CHANGE_SCHEMA = "sink_table string, sink_columns string, sink_pk string, seq {order}, data map<string,string>"


def dim_ledger(spark: SparkSession, root: str, every: int = 100, order_type: str = "bigint") -> Ledger:
    """Upserts of all dimension tables, a folder each, compacted to one per key and generation.

    ``order_type`` is the type of ``seq``: for topics
    ``struct<timestamp:timestamp,partition:int,offset:bigint>``.
    """
    schema = CHANGE_SCHEMA.format(order=order_type)
    return Ledger(spark, root, schema, compact_upserts, every, partition_by=("sink_table",))


def compact_upserts(changes: DataFrame) -> DataFrame:
    """Fold the upserts of each (table, key) into one that lists all written columns."""
    names = F.split(F.coalesce(F.nullif(F.trim("sink_pk"), F.lit("")), F.lit(DEFAULT_KEY)), ",")
    key = F.transform(names, lambda c: F.try_element_at("data", F.trim(c)))
    cells = changes.select(
        "sink_table",
        "sink_pk",
        key.alias("_key"),
        "batch_id",
        "seq",
        # a key that the rule does not list must survive too
        F.explode(F.array_union(F.split("sink_columns", ","), F.transform(names, F.trim))).alias("_column"),
        "data",
    ).withColumn("_value", F.try_element_at("data", F.col("_column")))
    last = cells.groupBy("sink_table", "sink_pk", "_key", "_column").agg(
        F.max_by("_value", F.struct("batch_id", "seq")).alias("_value"), F.max("seq").alias("seq")
    )
    # at most one entry per column of the table
    entries = F.array_sort(F.collect_list(F.struct("_column", "_value")))
    folded = last.groupBy("sink_table", "sink_pk", "_key").agg(
        entries.alias("_cells"), F.max("seq").alias("seq")
    )
    return folded.select(
        "sink_table",
        F.array_join(F.col("_cells._column"), ",").alias("sink_columns"),
        "sink_pk",
        "seq",
        F.map_from_entries("_cells").alias("data"),
    )


def current_dim(
    ledger: Ledger, batch_id: int, table: str, columns: Sequence[str], key: Sequence[str] = (DEFAULT_KEY,)
) -> DataFrame:
    """Rows of one dimension as batches up to and including ``batch_id`` left it."""
    changes = ledger.upto(batch_id).where(F.col("sink_table") == table)
    return current_rows(changes, columns, key, order=("batch_id", "seq"))


@dataclass(frozen=True)
class DimFeed:
    """The dimension tables a change feed writes, as other jobs look them up.

    Every committed batch of the feed is a version of all tables.  A reader picks one version and sees every
    table as that batch left it, whatever the feed writes meanwhile.  ``tables`` names the columns of
    each table and ``keys`` its key columns (default ``id``).
    """

    ledger: Ledger
    tables: Mapping[str, Sequence[str]]
    keys: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def version(self, max_age: float | None = None) -> int | None:
        """The newest version; an error if it is more than ``max_age`` seconds old."""
        return self.ledger.newest(max_age)

    def at(self, version: int | None) -> dict[str, DataFrame]:
        """Every table as of a version: empty ones before the first.

        A table is an aggregate of its upserts by key, so a lookup that knows its keys aggregates the upserts
        of these keys only.
        """
        return {name: self._table(name, columns, version) for name, columns in self.tables.items()}

    def latest(self, max_age: float | None = None) -> dict[str, DataFrame]:
        return self.at(self.version(max_age))

    def _table(self, name: str, columns: Sequence[str], version: int | None) -> DataFrame:
        if version is None:
            return self.ledger.spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
        return current_dim(self.ledger, version, name, columns, self.keys.get(name, (DEFAULT_KEY,)))


def publish_dim(
    ledger: Ledger,
    batch_id: int,
    database: str,
    table: str,
    columns: Sequence[str],
    key: Sequence[str] = (DEFAULT_KEY,),
) -> None:
    """Point the catalog table of a dimension at its rows as of ``batch_id``.

    The rows are written to a folder of their own, so readers of the older version
    are not disturbed.
    """
    path = f"{ledger.root.rstrip('/')}-published/{table}/upto={batch_id}"
    if not is_complete(ledger.spark, path):
        current_dim(ledger, batch_id, table, columns, key).write.mode("overwrite").parquet(path)
    set_table_location(ledger.spark, database, table, path)
