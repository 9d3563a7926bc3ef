"""App log job: raw lines -> start, display and page topics, and quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.operators.applog import DIRTY, LogTopics, log_outputs, parse_log
from millrace.operators.newuser import repair_new_flag
from millrace.sinks.topics import Writer, file_writer
from millrace.streaming.ledger import Ledger
from millrace.streaming.newuser import repair_batch


def accepted_lines(lines: DataFrame) -> DataFrame:
    """Parsed lines in which a dirty line belongs to no device.

    Outputs are encoded from the parsed object, so only dirty lines keep their text;
    otherwise every line would be shuffled and cached twice.
    """
    dirty = F.col("route") == DIRTY
    return parse_log(lines).withColumns(
        {"mid": F.when(~dirty, F.col("mid")), "value": F.when(dirty, F.col("value"))}
    )


def log_tables(
    lines: DataFrame,
    order_by: Sequence[str] = ("seq",),
    topics: LogTopics = LogTopics(),
    pages_with_displays: bool = False,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Batch: every output row as ``topic, value, reason``."""
    repaired = repair_new_flag(accepted_lines(lines), order_by=order_by, seen=seen)
    return log_outputs(repaired, topics, pages_with_displays)


def log_job(
    lines: DataFrame,
    out_root: str,
    ledger: Ledger,
    checkpoint: str,
    order_by: Sequence[str] = ("seq",),
    topics: LogTopics = LogTopics(),
    pages_with_displays: bool = False,
    writer: Writer | None = None,
) -> DataStreamWriter:
    """Streaming: one parse of a micro-batch, all outputs in one write."""

    def process(batch: DataFrame, batch_id: int) -> None:
        parsed = accepted_lines(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            repaired = repair_batch(parsed, batch_id, ledger, order_by=order_by)
            (writer or file_writer(out_root))(log_outputs(repaired, topics, pages_with_displays), batch_id)
        finally:
            parsed.unpersist()

    return lines.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
