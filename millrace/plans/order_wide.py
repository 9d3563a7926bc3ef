"""Order wide job: orders x details by time interval, then six dimensions."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions.jsontext import encode
from millrace.operators.dimensions import unique_dims
from millrace.operators.orders import (
    ORDER_FIELDS,
    WIDE_DIMS,
    dirty_records,
    enrich,
    interval_join,
    parse_details,
    parse_orders,
)
from millrace.sinks.topics import Writer, file_writer
from millrace.streaming.orders import interval_join_stream, unmatched_orders_stream
from millrace.streaming.snapshot import Snapshot

ORDER_WIDE_TOPIC = "dwm_order_wide"  # fixed value
DIRTY_ORDERS_TOPIC = "dirty_orders"
UNMATCHED_ORDERS_TOPIC = "unmatched_orders"


def order_wide(
    order_lines: DataFrame,
    detail_lines: DataFrame,
    dims: Mapping[str, DataFrame],
    bound_ms: int = 5_000,
    as_of: str | None = None,
) -> DataFrame:
    """Batch: enriched wide rows from JSON text."""
    wide = interval_join(parse_orders(order_lines), parse_details(detail_lines), bound_ms)
    return enrich(wide, unique_dims(dims, WIDE_DIMS), as_of)


def order_wide_job(
    order_lines: DataFrame,
    detail_lines: DataFrame,
    dims: Mapping[str, Snapshot] | Callable[[], Mapping[str, DataFrame]],
    out_root: str,
    checkpoint: str,
    bound_ms: int = 5_000,
    delay: str = "0 seconds",
    as_of: str | None = None,
    topic: str = ORDER_WIDE_TOPIC,
    writer: Writer | None = None,
) -> DataStreamWriter:
    """Streaming: stream-stream join, then lookups in snapshots of bounded age.

    ``dims`` holds a snapshot per dimension, or is called once per micro-batch for all of them
    (``DimFeed.latest``), so that the lookups of a batch see one version of every table.
    """
    wide = interval_join_stream(order_lines, detail_lines, bound_ms, delay)

    def process(batch: DataFrame, batch_id: int) -> None:
        pairs = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n_rows = pairs.count()  # its measured size decides whether its keys are broadcast
            tables = dims() if callable(dims) else {name: s.get() for name, s in dims.items()}
            rows = enrich(pairs, tables, as_of, narrow=True, n_rows=n_rows)
            value = encode(F.struct(*rows.columns), keep_nulls=True)
            outputs = rows.select(F.lit(topic).alias("topic"), value.alias("value"))
            (writer or file_writer(out_root))(outputs, batch_id)
        finally:
            pairs.unpersist()

    return wide.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)


def order_rejects_job(
    order_lines: DataFrame,
    detail_lines: DataFrame,
    out_root: str,
    checkpoint: str,
    topic: str = DIRTY_ORDERS_TOPIC,
    writer: Writer | None = None,
) -> DataStreamWriter:
    """Streaming: orders and details that cannot be read or lack a key or a time, with a reason, to an audit topic."""
    parsed = (parse_orders(order_lines, keep_dirty=True), parse_details(detail_lines, keep_dirty=True))
    dirty = [dirty_records(rows).withColumn("kind", F.lit(kind)) for rows, kind in zip(parsed, ("order", "detail"), strict=True)]

    def process(batch: DataFrame, batch_id: int) -> None:
        (writer or file_writer(out_root))(batch.select(F.lit(topic).alias("topic"), "value", "reason", "kind"), batch_id)

    both = dirty[0].unionByName(dirty[1])
    return both.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)


def unmatched_orders_job(
    order_lines: DataFrame,
    detail_lines: DataFrame,
    out_root: str,
    checkpoint: str,
    bound_ms: int = 5_000,
    delay: str = "0 seconds",
    topic: str = UNMATCHED_ORDERS_TOPIC,
    writer: Writer | None = None,
) -> DataStreamWriter:
    """Streaming: orders that no detail met within the bound, each once, to an audit topic."""
    rows = unmatched_orders_stream(order_lines, detail_lines, bound_ms, delay)

    def process(batch: DataFrame, batch_id: int) -> None:
        value = encode(F.struct(*ORDER_FIELDS), keep_nulls=True)
        (writer or file_writer(out_root))(batch.select(F.lit(topic).alias("topic"), value.alias("value")), batch_id)

    return rows.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
