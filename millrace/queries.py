"""Registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace import fixtures as fx
from millrace.functions.jsontext import as_text, field
from millrace.functions.timetext import age_years, day_text
from millrace.operators import applog, changefeed, dimensions, jumpout, newuser, orders, routing, ruletime, startup, visits
from millrace.plans.app_log import log_job, log_tables
from millrace.plans.change_feed import (
    ODS_TOPIC,
    change_feed_job,
    changes_routed,
    ods_job,
    pulled_rules_job,
)
from millrace.plans.order_wide import order_rejects_job, order_wide, order_wide_job, unmatched_orders_job
from millrace.plans.page_visits import jumpouts_job, page_rows, unique_visits_job
from millrace.session import state_settings, work_dir
from millrace.sinks.topics import fact_outputs, topic_files, write_quarantine, write_topics
from millrace.sources.text import rolled_log_lines
from millrace.streaming.dimensions import DimFeed, current_dim, dim_ledger
from millrace.streaming.jumpout import jumpouts_by_windows, jumpouts_stream, page_sessions_stream
from millrace.streaming.late import late_rows_job
from millrace.streaming.newuser import device_ledger
from millrace.streaming.orders import interval_join_stream
from millrace.streaming.snapshot import Snapshot
from millrace.streaming.visits import daily_first_visits_stream

HOUR_MS = 3_600_000
BOUND_MS = 6 * HOUR_MS
INTERVAL_MS = 30 * 24 * HOUR_MS
AS_OF = "2024-01-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _log(spark: SparkSession, sf: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return applog.parse_log(fx.log_lines(spark, sf))


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return _log(spark, sf).where(F.col("route") != applog.DIRTY)


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return _log(spark, sf).where(F.col("route") == applog.PAGE)


# --- app log ------------------------------------------------------------------------


@query
def log_valid(spark, sf):
    lines = applog.valid_lines(fx.log_lines(spark, sf))
    mid = F.get_json_object("value", "$.common.mid")
    ts = F.get_json_object("value", "$.ts").cast("bigint")
    return lines.select("seq", mid.alias("mid"), ts.alias("ts"), "value")


@query
def log_dirty(spark, sf):
    return applog.dirty_lines(fx.log_lines(spark, sf))


@query
def log_parse(spark, sf):
    """Validity split with conversion to objects, and access to nested fields."""
    lines = applog.parse_lines(fx.log_lines(spark, sf))
    return lines.select(
        "seq",
        field("doc", "common.vc").alias("vc"),
        field("doc", "page.during_time", "bigint").alias("during_time"),
        F.array_join(F.array_sort(F.map_keys("doc")), ",").alias("fields"),
    )


@query
def log_isnew_repair(spark, sf):
    fixed = newuser.repair_new_flag(_clean(spark, sf))
    return fixed.select("seq", "mid", "is_new", "flag_repaired")


@query
def log_split_counts(spark, sf):
    return _log(spark, sf).groupBy("route").agg(F.count("*").alias("n"))


@query
def log_start(spark, sf):
    return _log(spark, sf).where(F.col("route") == applog.START).select("seq", "mid", "ts")


@query
def log_page(spark, sf):
    return _pages(spark, sf).select("seq", "mid", "page_id", "last_page_id", "ts")


@query
def log_display_explode(spark, sf):
    items = applog.explode_displays(_log(spark, sf))
    return items.select(
        "seq",
        as_text(F.col("item")["item"]).alias("item"),
        as_text(F.col("item")["item_type"]).alias("item_type"),
        as_text(F.col("item")["page_id"]).alias("page_id"),
        field("item", "order", "int").alias("order_no"),
        F.size("item").alias("n_fields"),
    )


@query
def log_outputs(spark, sf):
    """The whole log job in one pass: rows per topic after repair and split."""
    out = log_tables(fx.log_lines(spark, sf))
    flag = F.get_json_object("value", "$.common.is_new")
    return out.groupBy("topic", "reason").agg(
        F.count("*").alias("n"), F.sum(F.when(flag == "1", 1).otherwise(0)).alias("n_new")
    )


@query
def log_rolled(spark, sf):
    """The daily rolled files of a log server, read as a stream; the live file is left alone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    root = work_dir(spark, "rolled")
    fx.write_rolled_logs(spark, sf, root)
    lines = _collected(spark, rolled_log_lines(spark, root, streaming=True, max_files=8), "rolled-lines")
    parsed = applog.parse_log(lines)
    return parsed.groupBy(F.regexp_extract("file", r"app\.(\d+-\d+-\d+)\.", 1).alias("day")).agg(
        F.count("*").alias("n"),
        F.count("dirty_reason").alias("n_dirty"),
        F.sum(F.when(F.col("route") == applog.PAGE, 1).otherwise(0)).alias("n_pages"),
    )


# --- visits -------------------------------------------------------------------------


@query
def uv_daily(spark, sf):
    return visits.daily_first_visits(_pages(spark, sf)).select("mid", "day", "seq", "ts")


@query
def jumpout_pattern(spark, sf):
    return jumpout.jumpouts_by_pattern(_pages(spark, sf), BOUND_MS).select("mid", "seq", "ts", "reason")


@query
def jumpout_session(spark, sf):
    return jumpout.jumpouts_by_session(_pages(spark, sf), BOUND_MS).select("mid", "seq", "ts")


@query
def jumpout_session_single(spark, sf):
    """The session definition in which one-row sessions count as well."""
    jumps = jumpout.jumpouts_by_session(_pages(spark, sf), BOUND_MS, emit_single=True)
    return jumps.select("mid", "seq", "ts")


@query
def session_windows(spark, sf):
    return jumpout.page_sessions(_pages(spark, sf), BOUND_MS)


# --- change feed --------------------------------------------------------------------


def _changes(spark: SparkSession, sf: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return changefeed.normalise(fx.change_records(spark, sf))


def _routed(spark: SparkSession, sf: str) -> DataFrame:
    return changes_routed(_changes(spark, sf), fx.rules(spark))


def _cells(column: str = "data") -> list:
    """The columns of a pruned image as text, in one fixed layout."""
    names = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "c_custkey", "c_name", "n_name")
    cells = [as_text(F.try_element_at(column, F.lit(n))) for n in names]
    cells = [
        (c.cast(fx.MONEY) if n == "o_totalprice" else c).alias(n) for n, c in zip(names, cells, strict=True)
    ]
    return [*cells, F.array_join(F.array_sort(F.map_keys(column)), ",").alias("fields")]


@query
def cdc_normalise(spark, sf):
    c = _changes(spark, sf)
    return c.select(
        "seq",
        "type",
        "database",
        "tableName",
        F.get_json_object("data", "$.o_totalprice").cast(fx.MONEY).alias("total"),
        F.get_json_object("before", "$.o_orderkey").cast("bigint").alias("before_key"),
        (F.col("data") == "{}").alias("no_data"),
        F.col("data").contains('"o_comment":null').alias("null_kept"),
    )


@query
def cdc_nonempty(spark, sf):
    return changefeed.nonempty(_changes(spark, sf)).groupBy("tableName", "type").agg(F.count("*").alias("n"))


@query
def cdc_table_filter(spark, sf):
    kept = changefeed.only_tables(_changes(spark, sf), ["retail.order_info", "retail.base_province"])
    return kept.groupBy("database", "tableName").agg(F.count("*").alias("n"))


@query
def cdc_keep_deletes(spark, sf):
    """Deletes carry the old image, snapshot rows count as inserts."""
    kept = changefeed.nonempty(_changes(spark, sf), keep_deletes=True, read_as_insert=True)
    return kept.where(F.col("tableName") == "order_info").select(
        "seq", "type", F.get_json_object("data", "$.o_orderkey").cast("bigint").alias("o_orderkey")
    )


@query
def cdc_route_fact(spark, sf):
    facts = _routed(spark, sf).where(F.col("route") == routing.FACT)
    return facts.select("seq", "sink_table", *_cells())


@query
def cdc_route_dim(spark, sf):
    dims = _routed(spark, sf).where(F.col("route") == routing.DIM)
    return dims.select("seq", "sink_table", *_cells())


@query
def cdc_unrouted(spark, sf):
    changes = changefeed.nonempty(_changes(spark, sf))
    rules = routing.bounded_rules(fx.rules(spark))
    return routing.unrouted_changes(changes, rules).select("seq", "type", "tableName")


@query
def cdc_route_pulled(spark, sf):
    changes = changefeed.nonempty(_changes(spark, sf))
    tagged = routing.tag_by_pulled_rules(changes, routing.bounded_rules(fx.rules(spark)))
    return tagged.select(
        "seq",
        "tableName",
        as_text(F.col("data")["sinkTable"]).alias("sink_table"),
        F.size("data").alias("n_fields"),
    )


@query
def rules_current(spark, sf):
    """Rules from a change log with rewritten and deleted rules: one per order status."""
    return routing.latest_rules(fx.rule_changes(spark, sf)).select("source_table", "operate_type", "sink_table")


@query
def cdc_initial(spark, sf):
    """A snapshot that was read while the table changed, then the changes, from one call of the streaming job."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    root = work_dir(spark, "initial")
    snapshot, fences = fx.order_snapshot(spark, sf)
    log = changefeed.normalise(fx.order_history(fx.table(spark, sf, "orders")))
    records = fx.order_history(fx.sliced_stream(spark, sf, "orders", "o_orderkey"))
    job = ods_job(
        records,
        f"{root}/ods",
        f"{root}/checkpoint",
        ["retail.order_info"],
        first=lambda: startup.snapshot_rows(snapshot, log, fences, {}),
        fences=fences,
    )
    _finish(job)
    text = topic_files(spark, f"{root}/ods", ODS_TOPIC, columns="value string, seq bigint")
    rows = changefeed.decode_envelope(text)
    image = F.when(F.length("data") > 2, F.col("data")).otherwise(F.col("before"))
    return rows.select(
        "seq",
        "type",
        F.get_json_object(image, "$.id").cast("bigint").alias("id"),
        F.get_json_object("data", "$.status").alias("status"),
    )


@query
def cdc_route_asof(spark, sf):
    """Every change by the rule valid when it arrived, from the logs of changes and of rules."""
    at = F.when(F.col("tableName") == "user_info", F.col("seq") * 10).otherwise(F.col("seq"))
    changes = changefeed.nonempty(_changes(spark, sf)).withColumn("seq", at)
    routed = ruletime.route_changes_asof(changes, ruletime.rule_versions(fx.rule_log(spark, sf)))
    fields = F.array_join(F.array_sort(F.map_keys("data")), ",")
    return routed.select(
        "seq", "tableName", "type", "route", "sink_table", F.when(F.col("route") != routing.UNROUTED, fields).alias("fields")
    )


# --- dimensions ---------------------------------------------------------------------


@query
def dim_upsert_current(spark, sf):
    """Every order upserts its customer; some upserts list fewer columns."""
    return dimensions.current_rows(
        fx.customer_upserts(spark, sf), ["c_custkey", "last_order", "last_status"], ["c_custkey"]
    )


@query
def dim_user_age(spark, sf):
    users = fx.dimensions(spark, sf)["dim_user_info"]
    return users.select(
        F.col("id").cast("bigint").alias("id"), "gender", age_years(F.col("birthday"), F.lit(AS_OF).cast("timestamp")).alias("age")
    )


def _lookup(spark: SparkSession, sf: str, spec: dimensions.DimSpec, source: str, key: str) -> DataFrame:
    left = fx.table(spark, sf, source).select(key).withColumnRenamed(key, spec.left_key)
    joined = dimensions.join_dim(left, dimensions.unique_dims(fx.dimensions(spark, sf), [spec]), spec)
    return joined.groupBy(*dimensions.added_columns(spec)).agg(F.count("*").alias("n"))


@query
def dim_join_user(spark, sf):
    spec = dimensions.DimSpec("dim_user_info", "user_id", {"gender": "user_gender"})
    return _lookup(spark, sf, spec, "orders", "o_custkey")


@query
def dim_join_province(spark, sf):
    return _lookup(spark, sf, orders.PROVINCE, "customer", "c_nationkey")


@query
def dim_join_sku(spark, sf):
    """Sku and, through it, trademark, category and product group."""
    return _lookup(spark, sf, orders.SKU, "lineitem", "l_partkey")


@query
def dim_join_trademark(spark, sf):
    return _flat_lookup(spark, sf, orders.TRADEMARK)


@query
def dim_join_category3(spark, sf):
    return _flat_lookup(spark, sf, orders.CATEGORY3)


@query
def dim_join_spu(spark, sf):
    return _flat_lookup(spark, sf, orders.SPU)


def _flat_lookup(spark: SparkSession, sf: str, spec: dimensions.DimSpec) -> DataFrame:
    dims = fx.dimensions(spark, sf)
    sku = dims["dim_sku_info"].select(F.col("id").cast("bigint").alias("sku_id"), spec.left_key)
    return dimensions.join_dim(sku, dims, spec).select("sku_id", *dimensions.added_columns(spec))


# --- orders -------------------------------------------------------------------------


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return orders.parse_orders(fx.order_texts(spark, sf))


def _details(spark: SparkSession, sf: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return orders.parse_details(fx.detail_texts(spark, sf))


@query
def order_parse(spark, sf):
    return _orders(spark, sf).select(
        "id", "province_id", "order_status", "user_id", "total_amount", "original_total_amount",
        "expire_time", "operate_time", "create_time", "create_date", "create_hour", "create_ts",
    )


@query
def order_detail_parse(spark, sf):
    return _details(spark, sf).select(
        "id", "order_id", "sku_id", "sku_name", "sku_num", "order_price", "split_total_amount",
        "create_time", "create_ts",
    )


@query
def order_dirty(spark, sf):
    """Orders and details that cannot be read, lack a key or a time, from one streaming job; their number by reason."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    root = work_dir(spark, "order-rejects")
    number = F.get_json_object("value", "$.id").cast("bigint")
    lines, details = (fx.faulty(texts, number) for texts in _order_streams(spark, sf))
    _finish(order_rejects_job(lines, details, f"{root}/out", f"{root}/checkpoint"))
    rows = spark.read.schema("topic string, value string, reason string, kind string").parquet(f"{root}/out")
    size = F.sum(F.when(F.col("reason") == "not_json_object", F.length("value")).otherwise(0))
    return rows.groupBy("topic", "kind", "reason").agg(F.count("*").alias("n"), size.alias("n_chars"))


@query
def order_unmatched(spark, sf):
    """Orders that the interval join leaves out."""
    alone = orders.unmatched_orders(_orders(spark, sf), _details(spark, sf), INTERVAL_MS)
    return alone.select("id", "user_id", "create_ts")


WIDE_CORE = (
    "detail_id", "order_id", "sku_id", "order_price", "sku_num", "province_id", "order_status",
    "user_id", "total_amount", "expire_time", "create_date", "create_hour", "split_total_amount",
)


@query
def order_interval_join(spark, sf):
    wide = orders.interval_join(_orders(spark, sf), _details(spark, sf), INTERVAL_MS)
    return wide.select(*WIDE_CORE)


@query
def order_wide_rows(spark, sf):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return order_wide(
        fx.order_texts(spark, sf), fx.detail_texts(spark, sf), fx.dimensions(spark, sf), INTERVAL_MS, AS_OF
    )


@query
def order_wide_merge(spark, sf):
    """Wide rows of one order folded into one: first value that is not null per column."""
    wide = fx.with_gaps(orders.interval_join(_orders(spark, sf), _details(spark, sf), INTERVAL_MS))
    merged = orders.merge_wide_group(wide, ["order_id"], ["detail_id", "sku_id", "order_price", "sku_num"])
    return merged.select("order_id", "order_status", "total_amount", "sku_id", "order_price", "sku_num")


@query
def order_wide_merge_pair(spark, sf):
    """Wide rows filled from the order they belong to."""
    wide = fx.with_gaps(orders.interval_join(_orders(spark, sf), _details(spark, sf), INTERVAL_MS))
    nulls = [F.lit(None).cast(orders.WIDE_FIELDS[c]).alias(c) for c in fx.DETAIL_ONLY]
    from_order = _orders(spark, sf).withColumnRenamed("id", "order_id").select("*", *nulls)
    return orders.merge_wide(wide, from_order, ["order_id"]).select(
        "detail_id", "order_id", "order_status", "total_amount", "sku_id", "order_price", "create_date"
    )


# --- sinks --------------------------------------------------------------------------


@query
def sink_topics(spark, sf):
    """Fact records written to the topic each names, and read back by topic."""
    root = work_dir(spark, "sink-topics")
    write_topics(fact_outputs(routing.routed_records(_routed(spark, sf), routing.FACT)), root, 0)
    names = ("dwd_order_info", "dwd_order_info_u")
    parts = [topic_files(spark, root, t).select(F.lit(t).alias("topic"), "value") for t in names]
    key = F.get_json_object("value", "$.o_orderkey").cast("bigint")
    return parts[0].unionByName(parts[1]).select("topic", key.alias("o_orderkey"))


@query
def sink_quarantine(spark, sf):
    root = work_dir(spark, "quarantine")
    write_quarantine(applog.dirty_lines(fx.log_lines(spark, sf)), root, 0)
    return spark.read.parquet(root).select("value", "reason")


# --- streaming ----------------------------------------------------------------------


def _finish(writer: DataStreamWriter) -> int:
    """Run a streaming job over what is there now; the number of its last micro-batch."""
    with state_settings(SparkSession.active()):
        running = writer.trigger(availableNow=True).start()
        try:
            running.awaitTermination()
            return running.lastProgress["batchId"] if running.lastProgress else 0
        finally:
            running.stop()


def _collected(spark: SparkSession, rows: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a streaming frame to a table in the shared folder and read it back."""
    root = work_dir(spark, name)

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/rows/batch_id={batch_id}")

    writer = rows.writeStream.foreachBatch(save).outputMode(mode)
    _finish(writer.option("checkpointLocation", f"{root}/checkpoint"))
    return spark.read.schema(rows.schema).parquet(f"{root}/rows").select(*rows.columns)


def _line_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The log lines in several micro-batches, in order of time."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return fx.lines_from_events(fx.sliced_stream(spark, sf, "events", "ts"))


@query
def stream_isnew(spark, sf):
    """The streaming log job: repaired lines per topic."""
    root = work_dir(spark, "log-job")
    ledger = device_ledger(spark, f"{root}/devices")
    _finish(log_job(_line_stream(spark, sf), f"{root}/out", ledger, f"{root}/checkpoint"))
    rows = spark.read.schema("topic string, value string").parquet(f"{root}/out")
    flag = F.get_json_object("value", "$.common.is_new")
    return rows.groupBy("topic").agg(
        F.count("*").alias("n"), F.sum(F.when(flag == "1", 1).otherwise(0)).alias("n_new")
    )


@query
def stream_uv_daily(spark, sf):
    rows = daily_first_visits_stream(page_rows(_line_stream(spark, sf)))
    return _collected(spark, rows.select("mid", "day", "seq", "ts"), "uv", "update")


@query
def stream_uv_daily_local(spark, sf):
    """The same with the days of another time zone."""
    pages = page_rows(_line_stream(spark, sf))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        rows = daily_first_visits_stream(pages)
        return _collected(spark, rows.select("mid", "day", "seq", "ts"), "uv-local", "update")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@query
def stream_uv_job(spark, sf):
    """Two chained jobs: raw lines to the page topic, page topic to unique visits."""
    root = work_dir(spark, "uv-job")
    ledger = device_ledger(spark, f"{root}/devices")
    _finish(log_job(_line_stream(spark, sf), f"{root}/dwd", ledger, f"{root}/log-checkpoint"))
    pages = topic_files(
        spark, f"{root}/dwd", "dwd_page_log", streaming=True, columns="value string, seq bigint"
    )
    _finish(unique_visits_job(pages, f"{root}/dwm", f"{root}/uv-checkpoint"))
    ts = F.get_json_object("value", "$.ts").cast("bigint")
    visits_ = topic_files(spark, f"{root}/dwm", "dwm_unique_visit")
    return visits_.select(F.get_json_object("value", "$.common.mid").alias("mid"), day_text(ts).alias("day"))


@query
def stream_late(spark, sf):
    """Page rows that come after the watermark has passed them: the log arrives user by user, in four batches."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    root = work_dir(spark, "late")
    limits = fx.quarters(spark, sf, "events", "user_id")
    pages = page_rows(fx.lines_from_events(fx.sliced_stream(spark, sf, "events", "user_id", limits=limits)))
    _finish(late_rows_job(pages, f"{root}/out", f"{root}/checkpoint"))
    rows = topic_files(spark, f"{root}/out", "late_rows", columns="value string, watermark bigint, seq bigint")
    return rows.select("seq", "watermark", F.get_json_object("value", "$.ts").cast("bigint").alias("ts"))


@query
def stream_jumpout(spark, sf):
    rows = jumpouts_stream(page_rows(_line_stream(spark, sf)), BOUND_MS)
    return _collected(spark, rows.select("mid", "seq", "ts", "reason"), "jumpout")


@query
def stream_jumpout_job(spark, sf):
    root = work_dir(spark, "jumpout-job")
    _finish(jumpouts_job(_line_stream(spark, sf), f"{root}/dwm", f"{root}/checkpoint", BOUND_MS))
    jumps = topic_files(spark, f"{root}/dwm", "dwm_user_jump_out")
    return jumps.select(
        F.get_json_object("value", "$.common.mid").alias("mid"),
        F.get_json_object("value", "$.ts").cast("bigint").alias("ts"),
    )


@query
def stream_session(spark, sf):
    rows = jumpouts_stream(page_rows(_line_stream(spark, sf)), BOUND_MS, by_session=True)
    return _collected(spark, rows.select("mid", "seq", "ts"), "session")


@query
def stream_jumpout_windows(spark, sf):
    """Bounced visits by window aggregates: those of all windows that the watermark has passed."""
    rows = jumpouts_by_windows(page_rows(_line_stream(spark, sf)), BOUND_MS)
    return _collected(spark, rows.select("mid", "seq", "ts", "reason"), "jumpout-windows")


@query
def stream_jumpout_windows_job(spark, sf):
    root = work_dir(spark, "jumpout-windows-job")
    job = jumpouts_job(_line_stream(spark, sf), f"{root}/dwm", f"{root}/checkpoint", BOUND_MS, by_windows=True)
    _finish(job)
    jumps = topic_files(spark, f"{root}/dwm", "dwm_user_jump_out")
    return jumps.select(
        F.get_json_object("value", "$.common.mid").alias("mid"),
        F.get_json_object("value", "$.ts").cast("bigint").alias("ts"),
    )


@query
def stream_session_by_windows(spark, sf):
    rows = jumpouts_by_windows(page_rows(_line_stream(spark, sf)), BOUND_MS, by_session=True)
    return _collected(spark, rows.select("mid", "seq", "ts"), "session-by-windows")


@query
def stream_session_windows(spark, sf):
    return _collected(spark, page_sessions_stream(page_rows(_line_stream(spark, sf)), BOUND_MS), "windows")


def _order_streams(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders and details in several micro-batches each, in order of time."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    rows = fx.with_province(spark, sf, fx.sliced_stream(spark, sf, "orders", "o_orderdate"))
    lines = fx.order_texts_from(rows, F.col("c_nationkey"))
    return lines, fx.detail_texts_from(fx.sliced_stream(spark, sf, "lineitem", "l_shipdate"))


@query
def stream_interval_join(spark, sf):
    wide = interval_join_stream(*_order_streams(spark, sf), INTERVAL_MS)
    return _collected(spark, wide.select(*WIDE_CORE), "interval")


@query
def stream_order_unmatched(spark, sf):
    """The same on streams: orders whose interval the watermark has passed."""
    root = work_dir(spark, "unmatched")
    _finish(unmatched_orders_job(*_order_streams(spark, sf), f"{root}/out", f"{root}/checkpoint", INTERVAL_MS))
    rows = topic_files(spark, f"{root}/out", "unmatched_orders")
    return rows.select(F.get_json_object("value", "$.id").cast("bigint").alias("id"))


def _wide_texts(spark: SparkSession, root: str) -> DataFrame:
    """The enriched part of the wide rows a job wrote."""
    schema = (
        "detail_id bigint, order_id bigint, user_age int, user_gender string, province_name string, "
        "province_area_code string, province_iso_code string, province_3166_2_code string, "
        "spu_id bigint, tm_name string, category3_name string, spu_name string"
    )
    value = F.from_json("value", schema)
    return topic_files(spark, root, "dwm_order_wide").select(value.alias("r")).select("r.*")


@query
def stream_order_wide(spark, sf):
    root = work_dir(spark, "order-wide-job")
    dims = fx.dimensions(spark, sf)
    held = {name: Snapshot(lambda df=df: df, max_staleness=86_400) for name, df in dims.items()}
    job = order_wide_job(
        *_order_streams(spark, sf), held, f"{root}/out", f"{root}/checkpoint", INTERVAL_MS, as_of=AS_OF
    )
    try:
        _finish(job)
    finally:
        for snapshot in held.values():
            snapshot.invalidate()
    return _wide_texts(spark, f"{root}/out")


@query
def stream_order_wide_from_feed(spark, sf):
    """Two chained jobs: the change feed fills the six dimensions, the wide rows look them up there."""
    streams = _order_streams(spark, sf)
    root = work_dir(spark, "wide-from-feed")
    ledger = dim_ledger(spark, f"{root}/dims")
    changes = changefeed.normalise(fx.dimension_records(spark, sf))
    _finish(
        change_feed_job(changes, lambda: fx.dimension_rules(spark), f"{root}/facts", ledger, f"{root}/feed-checkpoint")
    )
    feed = DimFeed(ledger, fx.DIM_COLUMNS)
    _finish(
        order_wide_job(*streams, feed.latest, f"{root}/out", f"{root}/checkpoint", INTERVAL_MS, as_of=AS_OF)
    )
    return _wide_texts(spark, f"{root}/out")


def _change_stream(spark: SparkSession, sf: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return changefeed.normalise(fx.order_changes(fx.sliced_stream(spark, sf, "orders", "o_orderkey")))


@query
def stream_route(spark, sf):
    """Two chained jobs: change records to envelope text, text to facts and unrouted rows."""
    root = work_dir(spark, "change-feed")
    records = fx.order_changes(fx.sliced_stream(spark, sf, "orders", "o_orderkey"))
    _finish(ods_job(records, f"{root}/ods", f"{root}/ods-checkpoint"))
    text = topic_files(spark, f"{root}/ods", ODS_TOPIC, streaming=True, columns="value string, seq bigint")
    job = change_feed_job(
        text,
        lambda: fx.rules(spark),
        f"{root}/facts",
        dim_ledger(spark, f"{root}/dims"),
        f"{root}/checkpoint",
    )
    _finish(job)
    rows = spark.read.schema("topic string, value string").parquet(f"{root}/facts")
    key = F.coalesce(
        F.get_json_object("value", "$.o_orderkey"),
        F.get_json_object(F.get_json_object("value", "$.data"), "$.o_orderkey"),
    )
    return rows.select("topic", key.cast("bigint").alias("o_orderkey"))


@query
def stream_dim_upsert(spark, sf):
    """The streaming change feed job: the customer dimension its upserts left."""
    root = work_dir(spark, "dim-feed")
    dims = dim_ledger(spark, f"{root}/dims")
    records = fx.customer_changes(fx.sliced_stream(spark, sf, "customer", "c_custkey"))
    job = change_feed_job(
        changefeed.normalise(records), lambda: fx.rules(spark), f"{root}/facts", dims, f"{root}/checkpoint"
    )
    last = _finish(job)
    columns = ["c_custkey", "c_name", "c_mktsegment"]
    return current_dim(dims, last, "dim_user_info", columns, ["c_custkey"])


@query
def dim_schema_change(spark, sf):
    """A dimension whose rule gains a column after half of its rows: older rows have no value there."""
    root = work_dir(spark, "dim-schema")
    dims, calls = dim_ledger(spark, f"{root}/dims"), []
    before, after = fx.rules_that_grow(spark)

    def load_rules() -> DataFrame:
        calls.append(1)
        return before if len(calls) <= 2 else after

    records = fx.customer_changes(fx.sliced_stream(spark, sf, "customer", "c_custkey", limits=fx.quarters(spark, sf)))
    _finish(
        change_feed_job(changefeed.normalise(records), load_rules, f"{root}/facts", dims, f"{root}/checkpoint")
    )
    return current_dim(dims, dims.newest(), "dim_user_info", ["c_custkey", "c_name", "c_mktsegment"], ["c_custkey"])


@query
def stream_route_pulled(spark, sf):
    root = work_dir(spark, "pulled-rules")
    rules = Snapshot(lambda: fx.rules(spark), max_staleness=20)
    try:
        _finish(pulled_rules_job(_change_stream(spark, sf), rules, f"{root}/out", f"{root}/checkpoint"))
    finally:
        rules.invalidate()
    rows = spark.read.schema("topic string, value string").parquet(f"{root}/out")
    inside = F.get_json_object("value", "$.sinkTable")
    return rows.groupBy("topic", inside.alias("sink_table")).agg(F.count("*").alias("n"))
