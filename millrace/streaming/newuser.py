"""New-user flag repair on micro-batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.newuser import apply_first_lines, first_lines
from millrace.streaming.ledger import Ledger

BUCKETS = 256  # folders of a generation's base; fixed for the life of a ledger
RECENT = -1  # the folder of a batch's own devices


def device_ledger(
    spark: SparkSession, root: str, key: str = "mid", order_type: str = "bigint", every: int = 100
) -> Ledger:
    """Devices met so far.

    A batch adds the devices of its lines without asking whether they are known.  The base of a generation
    holds one row per device, in folders by a hash of the device, so that a batch reads the folders it asks about and the
    additions of the generation's batches: what it costs does not grow with the devices ever met.
    """

    def fold(rows: DataFrame) -> DataFrame:
        met = rows.groupBy(key).agg(F.min("first_order").alias("first_order"), F.max("batch_id").alias("batch_id"))
        placed = met.withColumns({"fresh": F.lit(False), "bucket": bucket_of(key)})
        return placed.repartition("bucket").sortWithinPartitions("bucket", key)

    schema = f"{key} string, first_order {order_type}, fresh boolean, bucket int"
    return Ledger(spark, root, schema, fold, every, partition_by=("bucket",))


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def met_before(ledger: Ledger, batch_id: int, devices: DataFrame, key: str = "mid") -> DataFrame:
    """Those of a small cached column of ``devices`` that batches before this one met."""
    asked = [r["bucket"] for r in devices.select(bucket_of(key).alias("bucket")).distinct().collect()]
    known = ledger.before(batch_id).where(F.col("bucket").isin([*asked, RECENT]))
    return known.join(devices, key, "left_semi").select(key).distinct()


def repair_batch(
    batch: DataFrame,
    batch_id: int,
    ledger: Ledger,
    key: str = "mid",
    order_by: Sequence[str] = ("seq",),
    flag: str = "is_new",
) -> DataFrame:
    """The batch operator, with devices of earlier batches taken from the ledger.

    Only a device whose first line here claims to be new can keep its claim, so only such devices are looked up;
    their measured size lets Spark broadcast them to the ledger.  Of a cached ``batch`` only the
    lines that claim to be new are joined to the answer, the others pass as they are.  The answer
    (``fresh``) is written with the batch's devices and read back, so a replay gives the same.
    """
    claims = F.col(flag) == "1"
    firsts = first_lines(batch, key, order_by).persist(StorageLevel.MEMORY_AND_DISK)
    claimed = batch.where(claims & F.col(key).isNotNull()).select(key).distinct()
    asked = firsts.join(claimed, key, "left_semi").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        asked.count()
        met = met_before(ledger, batch_id, asked.select(key), key)
        fresh = asked.join(met, key, "left_anti").select(key, F.lit(True).alias("fresh"))
        rows = firsts.join(fresh, key, "left").select(
            key, "first_order", F.coalesce("fresh", F.lit(False)).alias("fresh"), F.lit(RECENT).alias("bucket")
        )
        written = ledger.append(batch_id, rows)
    finally:
        asked.unpersist()
        firsts.unpersist()
    others = batch.where(~F.coalesce(claims, F.lit(False))).withColumn("flag_repaired", F.lit(False))
    repaired = apply_first_lines(batch.where(claims), written.where("fresh"), key, order_by, flag)
    return repaired.unionByName(others)
