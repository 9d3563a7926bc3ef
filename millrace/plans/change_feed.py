"""Change feed job: changes -> fact topics, dimension upserts, unrouted audit."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions.jsontext import encode
from millrace.operators.changefeed import (
    ENVELOPE,
    decode_envelope,
    encode_envelope,
    nonempty,
    normalise,
    only_tables,
)
from millrace.operators.dimensions import add_missing_columns, create_dim_table, dim_changes, key_columns
from millrace.operators.routing import (
    DIM_SINK_TYPE,
    FACT,
    RULE_COLUMNS,
    UNROUTED,
    bounded_rules,
    route_changes,
    routed_records,
    tag_by_pulled_rules,
)
from millrace.operators.startup import changes_after
from millrace.sinks.topics import Writer, fact_outputs, file_writer, is_complete
from millrace.streaming.ledger import Ledger
from millrace.streaming.snapshot import Snapshot

ODS_TOPIC = "ods_base_db"  # fixed value
UNROUTED_TOPIC = "unrouted_changes"
DIRTY_TOPIC = "dirty_changes"


def ods_job(
    records: DataFrame,
    out_root: str,
    checkpoint: str,
    tables: Sequence[str] = (),
    topic: str = ODS_TOPIC,
    dirty_topic: str = DIRTY_TOPIC,
    first: Callable[[], DataFrame] | None = None,
    fences: DataFrame | None = None,
    writer: Writer | None = None,
) -> DataStreamWriter:
    """Streaming: change records of the given ``db.table`` names -> envelope text in one topic.

    Records that cannot be read go to the dirty topic as they came.  To start from a snapshot, ``first`` gives its rows
    (``operators.startup.snapshot_rows``), which the first micro-batch puts in front, and ``fences`` the positions
    up to which changes are in it.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        changes = normalise(batch, keep_dirty=True)
        if fences is not None:
            changes = changes_after(changes, fences)
        if first is not None and batch_id == 0:
            changes = changes.unionByName(first().select("seq", *ENVELOPE), allowMissingColumns=True)
        changes = only_tables(changes, tables, keep="dirty_reason")
        dirty, text = F.col("dirty_reason").isNotNull(), F.col("value")
        envelopes = encode_envelope(changes.withColumn("_text", text)).select(
            F.when(dirty, dirty_topic).otherwise(topic).alias("topic"),
            F.when(dirty, F.col("_text")).otherwise(F.col("value")).alias("value"),
            *[c for c in ("seq",) if c in changes.columns],
        )
        (writer or file_writer(out_root))(envelopes, batch_id)

    return records.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)


def changes_routed(
    changes: DataFrame,
    rules: DataFrame,
    keep_deletes: bool = False,
    read_as_insert: bool = False,
) -> DataFrame:
    """Batch: envelope rows with an image, matched to their rules."""
    return route_changes(nonempty(changes, keep_deletes, read_as_insert), bounded_rules(rules))


def create_dim_tables(
    rules: DataFrame, database: str, known: DataFrame | None = None, evolve: bool = False
) -> None:
    """Create the table of every dimension rule that is not among the ``known`` ones.

    With ``evolve`` a table that exists gets the columns it lacks.  One rule at a time reaches the driver, and the
    catalog is asked about changed rules only.
    """
    changed = rules.where(F.col("sink_type") == DIM_SINK_TYPE).select(*RULE_COLUMNS)
    if known is not None:
        changed = changed.exceptAll(known.select(*RULE_COLUMNS))
    spark = rules.sparkSession
    for r in changed.toLocalIterator():
        create_dim_table(spark, database, r.sink_table, r.sink_columns, r.sink_pk, r.sink_extend)
        if evolve:
            add_missing_columns(spark, database, r.sink_table, [*key_columns(r.sink_pk), *r.sink_columns.split(",")])


def batch_rules(load_rules: Callable[[], DataFrame], root: str, batch_id: int) -> DataFrame:
    """The rules of a micro-batch, read once and kept, so that a replay routes by the same ones."""
    spark, path = SparkSession.active(), f"{root.rstrip('/')}/batch_id={batch_id}"
    if not is_complete(spark, path):
        texts = [F.col(c).cast("string").alias(c) for c in RULE_COLUMNS]
        load_rules().select(*texts).write.mode("overwrite").parquet(path)
    return _read_rules(spark, path)


def rules_before(root: str, batch_id: int) -> DataFrame | None:
    """The rules of the micro-batch before, where they are kept."""
    spark, path = SparkSession.active(), f"{root.rstrip('/')}/batch_id={batch_id - 1}"
    return _read_rules(spark, path) if batch_id and is_complete(spark, path) else None


def _read_rules(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(", ".join(f"{c} string" for c in RULE_COLUMNS)).parquet(path)


def change_feed_job(
    changes: DataFrame,
    load_rules: Callable[[], DataFrame],
    out_root: str,
    dims: Ledger,
    checkpoint: str,
    dim_database: str | None = None,
    keep_deletes: bool = False,
    read_as_insert: bool = False,
    unrouted_topic: str = UNROUTED_TOPIC,
    dirty_topic: str = DIRTY_TOPIC,
    evolve_dims: bool = False,
    writer: Writer | None = None,
) -> DataStreamWriter:
    """Streaming: rules are read again at the start of every micro-batch.

    ``changes`` holds envelope columns and ``seq``, or ``value`` text and ``seq``; text
    that is not one JSON object goes to the dirty topic.  A rule takes effect with the
    next batch, whose rules are kept under ``out_root`` + ``-rules``; rows no rule matches
    are kept in the audit topic with their whole envelope, to be fed in again once a rule exists.
    With a ``dim_database`` the tables of new dimension rules are created there; with ``evolve_dims`` a rule
    that names more columns than before alters its table, once.
    """
    is_text = "value" in changes.columns and "data" not in changes.columns

    def process(batch: DataFrame, batch_id: int) -> None:
        kept = f"{out_root.rstrip('/')}-rules"
        rules = batch_rules(load_rules, kept, batch_id)
        if dim_database:
            create_dim_tables(rules, dim_database, rules_before(kept, batch_id), evolve_dims)
        parsed = decode_envelope(batch, keep_dirty=True) if is_text else batch
        parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
        routed = changes_routed(parsed, rules, keep_deletes, read_as_insert)
        routed = routed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            audit = routed.where(F.col("route") == UNROUTED)
            audit = encode_envelope(audit.withColumn("data", encode(F.col("data"), keep_nulls=True)))
            outputs = fact_outputs(routed_records(routed, FACT)).unionByName(
                audit.select(F.lit(unrouted_topic).alias("topic"), "value")
            )
            if is_text:
                dirty = parsed.where("dirty_reason is not null")
                outputs = outputs.unionByName(dirty.select(F.lit(dirty_topic).alias("topic"), "value"))
            (writer or file_writer(out_root))(outputs, batch_id)
            dims.append(batch_id, dim_changes(routed))
        finally:
            routed.unpersist()
            parsed.unpersist()

    return changes.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)


def pulled_rules_job(
    changes: DataFrame,
    rules: Snapshot,
    out_root: str,
    checkpoint: str,
    period: str = "20 seconds",
    writer: Writer | None = None,
) -> DataStreamWriter:
    """Streaming: whole images tagged with their sink table, rules pulled periodically."""

    def process(batch: DataFrame, batch_id: int) -> None:
        tagged = tag_by_pulled_rules(nonempty(batch), bounded_rules(rules.get()))
        outputs = tagged.select(
            F.col("sink_table").alias("topic"), encode(F.col("data"), keep_nulls=True).alias("value")
        )
        (writer or file_writer(out_root))(outputs, batch_id)

    job = changes.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return job.trigger(processingTime=period)
