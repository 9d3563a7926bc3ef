"""Exact dedup by a heavy-hitter split, in DataFrame functions only.

A mergeable Misra-Gries summary (Spark's frequent-items sketch) names the digests that may be
frequent; their exact group sizes and winners are then counted and broadcast, so that rows of
frequent texts are settled where they are read.  All other digests take an ordinary shuffle.

Defined results: a null text equals the empty text; a null doc_id is smaller than any other;
rows that repeat doc_id and text are one document, all marked ``kept`` by :func:`report` and
reduced to one by :func:`drop_duplicates`; an empty table gives no rows; other columns of any
name pass through :func:`drop_duplicates` unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import ROW, packed, stored

# The summary finds every digest with more than 3.5 / SLOTS of all rows; what it misses is
# small enough for one task.  At most SLOTS / 4 winners (about 80 bytes each) are broadcast.
SLOTS = 4096
FAN_IN = 64


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _prefix(digest: Column) -> Column:
    """The digest's first 60 bits as a number, which the summary counts."""
    return F.conv(F.substring(F.hex(digest), 1, 15), 16, 10).cast("long")


def _winners(slim: DataFrame, slots: int) -> DataFrame:
    """(digest, keep_id, group_size) of the digests that the summary names, counted exactly."""
    partial = (
        slim.select(F.pmod(F.spark_partition_id(), F.lit(FAN_IN)).alias("part"), _prefix(F.col("digest")).alias("item"))
        .groupBy("part")
        .agg(F.expr(f"approx_top_k_accumulate(item, {slots})").alias("summary"))
    )
    # Grouped by a constant: an ungrouped combine fails on partitions without rows.
    merged = partial.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(summary, {slots})").alias("summary"))
    named = merged.select(F.explode(F.expr(f"approx_top_k_estimate(summary, {slots // 4})")).alias("found")).select(
        F.col("found.item").alias("item")
    )
    hits = slim.withColumn("item", _prefix(F.col("digest"))).join(F.broadcast(named), "item", "left_semi")
    return (
        hits.groupBy("digest")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
        .orderBy(F.desc("group_size"), "digest")
        .limit(slots // 4)
    )


def _slim(docs: DataFrame) -> DataFrame:
    return stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest(F.col("text")).alias("digest")),
        "digests",
    )


def report(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    slim = _slim(docs)
    # Read again for both uses below: the table of winners is bounded by slots.
    winners = stored(_winners(slim, slots), "winners")
    marked = slim.join(F.broadcast(winners), "digest", "left")
    heavy = marked.where(F.col("group_size").isNotNull())
    group = Window.partitionBy("digest")
    light = (
        slim.join(F.broadcast(winners), "digest", "left_anti")
        .withColumn("keep_id", F.max("doc_id").over(group))
        .withColumn("group_size", F.count("*").over(group))
    )
    return heavy.unionByName(light).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``docs`` with one row of each text: that of the largest doc_id.

    Losers of frequent texts go before the shuffle; the rest is ranked with a group limit on
    both sides of it.
    """
    winners = stored(_winners(_slim(docs), slots), "winners").select("digest", F.struct("keep_id").alias("win"))
    rows = packed(docs).select("doc_id", text_digest(F.col("text")).alias("digest"), ROW)
    rows = rows.join(F.broadcast(winners), "digest", "left").where(
        F.col("win").isNull() | F.col("doc_id").eqNullSafe(F.col("win.keep_id"))
    )
    best = Window.partitionBy("digest").orderBy(F.desc_nulls_last("doc_id"))
    return rows.withColumn("place", F.row_number().over(best)).where("place = 1").select(f"{ROW}.*")


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


OP9_SQL = """
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id is not distinct from max(doc_id) over g as kept, sha256(coalesce(text, '')) as text_sha256
from documents
window g as (partition by sha256(coalesce(text, '')))
"""
