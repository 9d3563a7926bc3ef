"""Topic sinks: Kafka, and directories that hold one partition per topic."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions.jsontext import encode

DEFAULT_FACT_TOPIC = "dwd_default_topic"  # fixed value: for records that name no topic


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a write to ``path`` was committed."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def fact_outputs(records: DataFrame, default_topic: str = DEFAULT_FACT_TOPIC) -> DataFrame:
    """``topic, value`` of routed fact records: the record's own topic, nulls kept."""
    topic = F.coalesce(F.nullif(F.col("sinkTable"), F.lit("")), F.lit(default_topic))
    return records.select(topic.alias("topic"), encode(F.col("data"), keep_nulls=True).alias("value"))


def write_topics(outputs: DataFrame, root: str, batch_id: int) -> None:
    """Write ``topic, value, ...`` under ``root/batch_id=N/topic=T``, all of it at once.

    The batch is written aside, in a folder that readers pass over, and then moved to its place in one step: a
    job that reads the topics while they are written meets whole batches only, and never a file of a try that was
    not finished.  A batch that is in its place is left alone, so a replayed batch changes nothing.  Moving a folder is
    one step on a file system; on an object store without renames, use a committer or table format that commits.
    """
    spark, path = outputs.sparkSession, f"{root.rstrip('/')}/batch_id={batch_id}"
    if is_complete(spark, path):
        return
    staged = f"{root.rstrip('/')}/_staging/batch_id={batch_id}"
    outputs.write.mode("overwrite").partitionBy("topic").parquet(staged)
    publish_folder(spark, staged, path)


def publish_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Move a written folder to its place; an unfinished one there, left by a job that did not stage, goes first."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (staged, path))
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(target):
        files.delete(target, True)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"{staged} could not be moved to {path}")


def expire_batches(spark: SparkSession, root: str, before: int) -> list[int]:
    """Delete the committed batches below ``before``: those that every reader of the topics has passed.

    Their numbers are returned.  A job's own last batches must stay, as a replay asks whether they are in place.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/batch_id=*/_SUCCESS")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for found in files.globStatus(pattern) or []:
        folder = found.getPath().getParent()
        number = int(folder.getName().removeprefix("batch_id="))
        if number < before and files.delete(folder, True):
            gone.append(number)
    return sorted(gone)


# How a job hands over the ``topic, value`` rows of a micro-batch and its number.
Writer = Callable[[DataFrame, int], None]


def file_writer(root: str) -> Writer:
    """Topic directories under ``root``."""
    return lambda outputs, batch_id: write_topics(outputs, root, batch_id)


def kafka_writer(servers: str) -> Writer:
    """The topic named in each row; a replayed batch is sent again, as the sink promises at least once."""
    return lambda outputs, batch_id: write_kafka(outputs, servers)


def topic_files(
    spark: SparkSession,
    root: str,
    topic: str,
    streaming: bool = False,
    columns: str = "value string",
) -> DataFrame:
    """``value`` (or more ``columns``) of one topic directory; only its partitions are read."""
    schema = f"{columns}, batch_id long, topic string"
    reader = (spark.readStream if streaming else spark.read).schema(schema)
    return reader.parquet(root).where(F.col("topic") == topic).drop("batch_id", "topic")


def write_quarantine(dirty: DataFrame, root: str, batch_id: int) -> None:
    """Keep rejected text with its reason under ``root/batch_id=N``."""
    path = f"{root.rstrip('/')}/batch_id={batch_id}"
    if not is_complete(dirty.sparkSession, path):
        dirty.select("value", "reason").write.mode("overwrite").parquet(path)


def write_kafka(outputs: DataFrame, servers: str, topic: str | None = None) -> None:
    """Send ``value`` to one topic, or to the topic named in each row."""
    _to_topic(outputs, topic).write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def kafka_stream(
    outputs: DataFrame,
    servers: str,
    checkpoint: str,
    topic: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataStreamWriter:
    writer = _to_topic(outputs, topic).writeStream.format("kafka")
    writer = writer.option("kafka.bootstrap.servers", servers).options(**(options or {}))
    return writer.option("checkpointLocation", checkpoint)


def _to_topic(outputs: DataFrame, topic: str | None) -> DataFrame:
    if topic:
        return outputs.select(F.lit(topic).alias("topic"), "value")
    return outputs.select("topic", "value")


def console_stream(outputs: DataFrame, label: str) -> DataStreamWriter:
    """Print rows with a label, for debugging."""
    return outputs.select(F.lit(label).alias("label"), "*").writeStream.format("console")
