"""Starting from a snapshot: its rows first, then the changes, with no gap and no repeat.

A snapshot of a table is read while the table goes on changing.  The log position before the read
(``low``) and the one after it (``high``) fence it in: changes up to ``low`` are in the snapshot, those after ``high`` are not, and
between the two nobody knows.  So changes up to ``low`` are dropped, all later ones are kept, and a snapshot
row loses to any change of its key between the fences, which is newer or tells the same.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.dimensions import DEFAULT_KEY

FENCE_COLUMNS = ("database", "tableName", "low", "high")  # one row per table that has a snapshot


def changes_after(changes: DataFrame, fences: DataFrame, order: str = "seq") -> DataFrame:
    """Changes, or a stream of them, that the snapshots do not hold yet; tables without a fence are kept whole.

    There is one fence per table, so they are broadcast.
    """
    low = fences.select(F.col("database").alias("_db"), F.col("tableName").alias("_table"), "low")
    same = F.col("database").eqNullSafe(F.col("_db")) & F.col("tableName").eqNullSafe(F.col("_table"))
    joined = changes.join(F.broadcast(low), same, "left")
    return joined.where(F.col("low").isNull() | (F.col(order) > F.col("low"))).select(*changes.columns)


def image_key(keys: Mapping[str, Sequence[str]]) -> Column:
    """The key of a change as one text, from the image it carries; ``keys`` names the key columns by table.

    Parts are told apart by their lengths.  Null where a part is missing.
    """
    image = F.when(F.length("data") > 2, F.col("data")).otherwise(F.col("before"))

    def text(names: Sequence[str]) -> Column:
        parts = [F.get_json_object(image, f"$['{n}']") for n in names]
        return F.concat(*[x for p in parts for x in (F.length(p).cast("string"), F.lit(":"), p)])

    key = text((DEFAULT_KEY,))
    for table, names in keys.items():
        key = F.when(F.col("tableName") == table, text(names)).otherwise(key)
    return key


def snapshot_rows(
    snapshot: DataFrame,
    changes: DataFrame,
    fences: DataFrame,
    keys: Mapping[str, Sequence[str]],
    order: str = "seq",
) -> DataFrame:
    """The rows of the snapshot that no change between the fences replaces, at the position ``low``.

    ``snapshot`` holds envelope rows of type ``read`` (``sources.changes.table_snapshot``), ``changes`` the log as a batch, at
    least from ``low`` to ``high``; only the keys changed in between are looked up.  A snapshot row without a key
    is kept, and so are rows of tables without a fence.
    """
    fence = fences.select(
        F.col("database").alias("_db"), F.col("tableName").alias("_table"), "low", "high"
    )
    same = F.col("database").eqNullSafe(F.col("_db")) & F.col("tableName").eqNullSafe(F.col("_table"))
    between = (F.col(order) > F.col("low")) & (F.col(order) <= F.col("high"))
    window = changes.join(F.broadcast(fence), same & between)
    # an update that moves a row to another key touches both
    old = F.struct("database", "tableName", "before", F.lit("{}").alias("data"))
    new = F.struct("database", "tableName", "before", "data")
    touched = window.select(F.explode(F.array(old, new)).alias("e")).select("e.*")
    touched = touched.select("database", "tableName", image_key(keys).alias("_key")).where("_key is not null").distinct()
    keyed = snapshot.withColumn("_key", image_key(keys))
    kept = keyed.join(touched, ["database", "tableName", "_key"], "left_anti")
    placed = kept.join(F.broadcast(fence), same, "left")
    return placed.withColumn(order, F.coalesce("low", order)).select(*snapshot.columns)


def initial_changes(
    snapshot: DataFrame,
    changes: DataFrame,
    fences: DataFrame,
    keys: Mapping[str, Sequence[str]],
    order: str = "seq",
) -> DataFrame:
    """Batch: the snapshot's rows and all changes they do not hold yet."""
    columns = [c for c in snapshot.columns if c in changes.columns]
    first = snapshot_rows(snapshot, changes, fences, keys, order).select(*columns)
    return first.unionByName(changes_after(changes, fences, order).select(*columns))
