"""What a watermark drops, kept instead of lost.

Spark drops late rows inside a stateful operator and reports only their number.  This job reads the same stream and
finds the same rows before any state: a row is late if its time is not after the watermark that earlier
micro-batches reached, the newest event time they saw less the delay.  Spark lets a row pass that only the micro-batch
just before has made late, so that one does not count.  The job must see the same micro-batches as the one
it watches over: the same source with the same limit of files or offsets per batch.  Where Spark puts an empty
micro-batch in between, as it does while a stream is idle, its operators are one step stricter.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.sinks.topics import Writer, file_writer
from millrace.streaming.ledger import Ledger

LATE_TOPIC = "late_rows"


def watermark_ledger(spark: SparkSession, root: str, every: int = 100) -> Ledger:
    """The newest event time of each micro-batch, in milliseconds."""

    def fold(rows: DataFrame) -> DataFrame:
        return rows.agg(F.max("newest").alias("newest"), F.max("batch_id").alias("batch_id"))

    return Ledger(spark, root, "newest bigint", fold, every)


def split_late(batch: DataFrame, batch_id: int, ledger: Ledger, delay_ms: int, ts: str = "ts") -> DataFrame:
    """The rows of a micro-batch with ``late``, by the watermark that earlier batches reached; notes its own newest time.

    Rows without a time are not late.  One number per batch reaches the driver.
    """
    before = ledger.before(max(batch_id - 1, 0)).agg(F.max("newest")).first()[0]
    ledger.append(batch_id, batch.agg(F.max(ts).cast("bigint").alias("newest")))
    # the watermark never lies before the epoch
    limit = max(before - delay_ms, 0) if before is not None else 0
    is_late = F.lit(False) if limit == 0 else F.coalesce(F.col(ts) <= limit, F.lit(False))
    return batch.withColumns({"late": is_late, "watermark": F.lit(limit)})


def late_rows_job(
    rows: DataFrame,
    out_root: str,
    checkpoint: str,
    delay_ms: int = 1_000,
    ts: str = "ts",
    topic: str = LATE_TOPIC,
    writer: Writer | None = None,
) -> DataStreamWriter:
    """Streaming: the late ones of rows with ``value`` and a time, with the watermark they missed, to an audit topic."""
    ledger = watermark_ledger(rows.sparkSession, f"{out_root.rstrip('/')}-watermarks")

    def process(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            late = split_late(held, batch_id, ledger, delay_ms, ts).where("late")
            kept = [c for c in ("seq",) if c in late.columns]
            (writer or file_writer(out_root))(late.select(F.lit(topic).alias("topic"), "value", "watermark", *kept), batch_id)
        finally:
            held.unpersist()

    return rows.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
