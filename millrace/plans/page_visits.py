"""Visit jobs on page-log lines: daily unique visitors and bounced visits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions.jsontext import encode, parsed_object, with_parsed
from millrace.operators.applog import PAGE, parse_log
from millrace.sinks.topics import Writer, file_writer
from millrace.streaming.jumpout import jumpouts_by_windows, jumpouts_stream
from millrace.streaming.visits import daily_first_visits_stream

# Topic names (fixed values).
UNIQUE_VISIT_TOPIC = "dwm_unique_visit"
JUMP_OUT_TOPIC = "dwm_user_jump_out"


def page_rows(lines: DataFrame) -> DataFrame:
    """Page lines as ``value, mid, page_id, last_page_id, ts, seq``.

    Lines without an arrival position get one from their text, which only decides
    between lines of a device with the same ``ts``.
    """
    pages = parse_log(lines).where(F.col("route") == PAGE)
    if "seq" not in pages.columns:
        pages = pages.withColumn("seq", F.xxhash64("value"))
    return pages.select("value", "mid", "page_id", "last_page_id", "ts", "seq")


def unique_visits_job(
    lines: DataFrame,
    out_root: str,
    checkpoint: str,
    topic: str = UNIQUE_VISIT_TOPIC,
    writer: Writer | None = None,
) -> DataStreamWriter:
    """Streaming: the first entry line of each device and day, nulls kept."""
    visits = daily_first_visits_stream(page_rows(lines))
    return _to_topic(visits, topic, writer or file_writer(out_root), checkpoint).outputMode("update")


def jumpouts_job(
    lines: DataFrame,
    out_root: str,
    checkpoint: str,
    bound_ms: int = 10_000,
    by_session: bool = False,
    topic: str = JUMP_OUT_TOPIC,
    by_windows: bool = False,
    writer: Writer | None = None,
) -> DataStreamWriter:
    """Streaming: page lines that end a visit at once, nulls kept.

    With ``by_windows`` a line is emitted when its window ends, which costs less; otherwise as soon as it is decided.
    """
    find = jumpouts_by_windows if by_windows else jumpouts_stream
    jumps = find(page_rows(lines), bound_ms, by_session)
    return _to_topic(jumps, topic, writer or file_writer(out_root), checkpoint).outputMode("append")


def _to_topic(rows: DataFrame, topic: str, send: Writer, checkpoint: str) -> DataStreamWriter:
    def process(batch: DataFrame, batch_id: int) -> None:
        lines = with_parsed(batch, parsed_object(F.col("value")), "doc")
        value = encode(F.col("doc"), keep_nulls=True)
        send(lines.select(F.lit(topic).alias("topic"), value.alias("value")), batch_id)

    return rows.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
