"""Text sources: topics, directories of text files, rolled log files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROLLED_LOGS = "app.*.log"  # rolled files only; the live app.log is still appended to


def topic_lines(
    spark: SparkSession,
    servers: str,
    topic: str,
    streaming: bool = True,
    startup: str = "latest",
    group_id: str | None = None,
    options: Mapping[str, str] | None = None,
    pattern: bool = False,
) -> DataFrame:
    """``topic, value, seq`` of a Kafka topic; ``seq`` is the arrival order.

    With ``pattern``, ``topic`` is a regular expression over topic names.

    ``startup`` is ``latest`` (new records only) or ``initial`` (everything retained);
    a restarted query goes on from its checkpoint instead.  Needs the Kafka connector
    on the class path.
    """
    settings = {"kafka.bootstrap.servers": servers, **subscription(topic, pattern), **(options or {})}
    if streaming or startup == "initial":
        settings.setdefault("startingOffsets", starting_offsets(startup))
    if group_id:
        settings["kafka.group.id"] = group_id
    reader = spark.readStream if streaming else spark.read
    records = reader.format("kafka").options(**settings).load()
    return records.select(
        "topic",
        F.col("value").cast("string").alias("value"),
        F.struct("timestamp", "partition", "offset").alias("seq"),
    )


def subscription(topic: str, pattern: bool = False) -> dict[str, str]:
    """Exactly one way to subscribe, as the source rejects several."""
    return {"subscribePattern" if pattern else "subscribe": topic}


def starting_offsets(startup: str) -> str:
    return {"latest": "latest", "initial": "earliest"}[startup]


def text_lines(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    glob: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """``value, file``: the lines of a directory of text files."""
    reader = spark.readStream if streaming else spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format("text").load(path).select("value", F.col("_metadata.file_path").alias("file"))


def rolled_log_lines(
    spark: SparkSession, directory: str, streaming: bool = False, max_files: int | None = None
) -> DataFrame:
    """Lines of the daily rolled log files of a log server."""
    return text_lines(spark, directory, streaming, ROLLED_LOGS, max_files)
