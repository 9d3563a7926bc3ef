"""Job inputs derived from the test tables (FIXTURES.md part B).

Every query starts from JSON text or change records built here by Spark from the
given parquet tables, never from rows made up in the driver (the four routing rules
and the topic names are the only literals).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.orders import MONEY
from millrace.operators.routing import RULE_COLUMNS
from millrace.session import work_dir
from millrace.sources.changes import table_snapshot

TOPIC_PREFIX = "changes.retail"
BIG_TABLES = ("events", "orders", "lineitem")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _spread(df, df, name)


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as a file stream."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    stream = spark.readStream.schema(df.schema).option("pathGlobFilter", f"{name}.parquet")
    return _spread(stream.parquet(sf_dir), df, name)


_SLICED: dict[tuple, str] = {}


def sliced_stream(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    by: str,
    slices: int = 4,
    file_bytes: int = 1 << 20,
    limits: list | None = None,
) -> DataFrame:
    """A test table as a stream of several micro-batches, in order of a column.

    The slices are written once per session.  ``limits`` are the values that begin a slice, by default
    those that make slices of about one size.  A slice is as many files as its size asks for, each one a short task
    of its micro-batch: a micro-batch of few large files would build and parse its records on as few cores.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    given = (spark.sparkContext.applicationId, sf_dir, name, by, slices, file_bytes, str(limits))
    # as many files as the size of a slice asks for, at least one
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    files = max(1, -(-size // (slices * file_bytes)))
    if given not in _SLICED:
        _SLICED[given] = _write_slices(df, work_dir(spark, f"slices-{name}"), by, slices, files, limits)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files)
    return stream.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(_SLICED[given])


def _write_slices(df: DataFrame, root: str, by: str, slices: int, files: int, limits: list | None) -> str:
    if limits is None:
        shares = ",".join(str(k / slices) for k in range(1, slices))
        limits = df.agg(F.expr(f"approx_percentile({by}, array({shares}))")).first()[0]
    # rows without a value of the column come first
    place = F.coalesce(sum((F.col(by) >= F.lit(limit)).cast("int") for limit in limits or []) + F.lit(0), F.lit(0))
    # dealt by what they hold: rows dealt in turn are sorted first, which costs more than writing them
    dealt = F.xxhash64(*[f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))])
    # one after the other, as the source takes files in the order of their times
    for k in range(slices):
        rows = df.where(place == k)
        rows = rows.coalesce(1) if files == 1 else rows.repartition(files, dealt)
        rows.write.parquet(f"{root}/slice={k}")
        _fill_slice(df, f"{root}/slice={k}", files)
    return root


def _fill_slice(df: DataFrame, folder: str, files: int) -> None:
    """Add empty files to a slice of few rows, so that each slice is the files of one micro-batch."""
    spark = df.sparkSession
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    system = path(folder).getFileSystem(conf)
    missing = files - len(system.globStatus(path(f"{folder}/part-*.parquet")))
    if missing <= 0:
        return
    spark.createDataFrame([], df.schema).coalesce(1).write.parquet(f"{folder}-empty")
    empty = system.globStatus(path(f"{folder}-empty/part-*.parquet"))[0].getPath()
    for n in range(missing):
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(system, empty, system, path(f"{folder}/empty-{n}.parquet"), False, conf)
    system.delete(path(f"{folder}-empty"), True)


def _spread(df: DataFrame, sized: DataFrame, name: str) -> DataFrame:
    """Use all cores on a table that is stored as one row group.

    Tables with at least as many scan partitions as cores are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if name in BIG_TABLES and sized.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


# --- app log ------------------------------------------------------------------------


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_from_events(table(spark, sf_dir, "events"))


def lines_from_events(events: DataFrame) -> DataFrame:
    """``seq, value``: one JSON log line per event; one in fifty is cut off."""
    e = F.col("event_id")
    mid = F.concat(F.lit("mid_"), F.col("user_id"))
    common = F.struct(
        mid.alias("mid"),
        F.when(e % 2 == 0, "1").otherwise("0").alias("is_new"),
        F.col("user_id").cast("string").alias("uid"),
        F.concat(F.lit("v"), e % 4).alias("vc"),
    )
    page = F.struct(
        F.col("event_type").alias("page_id"),
        F.when(e % 3 != 0, F.concat(F.lit("p"), e % 7)).alias("last_page_id"),
        (F.col("value") * 100).cast("bigint").alias("during_time"),
    )
    items = F.array(_item(e % 1000, 1), _item(e % 777, 2))
    is_start = F.col("event_type") == "signup"
    line = F.struct(
        common.alias("common"),
        F.when(is_start, F.struct(F.lit("tile").alias("entry"))).alias("start"),
        F.when(~is_start, page).alias("page"),
        F.when(F.col("event_type") == "purchase", items).alias("displays"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
    )
    cut_off = F.concat(F.lit('{"common":{"mid":"'), mid)
    return events.select(
        e.alias("seq"), F.when(e % 50 == 0, cut_off).otherwise(F.to_json(line)).alias("value")
    )


def write_rolled_logs(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The log lines as a log server leaves them: files rolled by day, and a live one that is still written to."""
    events = table(spark, sf_dir, "events")
    lines = lines_from_events(events).join(events.select(F.col("event_id").alias("seq"), "ts"), "seq")
    days = lines.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "value")
    days.repartition("day").write.partitionBy("day").text(f"{root}/_written")
    days.limit(10).select("value").coalesce(1).write.text(f"{root}/_live")
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for n, found in enumerate(files.globStatus(path(f"{root}/_written/day=*/part-*"))):
        day = found.getPath().getParent().getName().removeprefix("day=")
        files.rename(found.getPath(), path(f"{root}/app.{day}.{n}.log"))
    for found in files.globStatus(path(f"{root}/_live/part-*")):
        files.rename(found.getPath(), path(f"{root}/app.log"))


def _item(item: Column, order: int) -> Column:
    return F.struct(
        F.lit("shelf").alias("display_type"),
        item.cast("string").alias("item"),
        F.lit("article").alias("item_type"),
        F.lit(order).alias("order"),
        F.lit(order + 2).alias("pos_id"),
    )


# --- change feed --------------------------------------------------------------------


def change_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``topic, seq, value``: change records of three tables."""
    orders = order_changes(table(spark, sf_dir, "orders"))
    users = customer_changes(table(spark, sf_dir, "customer"))
    provinces = _changes(table(spark, sf_dir, "nation"), "base_province", "n_nationkey")
    return orders.unionByName(users).unionByName(provinces)


def order_changes(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey") % 5
    op = F.when(k == 0, "u").when(k == 1, "d").when(k == 2, "r").otherwise("c")
    row = F.struct(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("o_totalprice").cast(MONEY).alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
        F.lit(None).cast("string").alias("o_comment"),
    )
    return orders.select(
        F.lit(f"{TOPIC_PREFIX}.order_info").alias("topic"),
        F.col("o_orderkey").alias("seq"),
        _record(op, F.when(k.isin(0, 1), row), F.when(k != 1, row)).alias("value"),
    )


def order_history(orders: DataFrame) -> DataFrame:
    """``topic, seq, value``: what happened to each order, at the position of its key.

    Of five orders one is updated and one deleted, both there before the log begins, one never changes, two are created.
    """
    k = F.col("o_orderkey") % 5
    op = F.when(k == 0, "u").when(k == 1, "d").otherwise("c")
    row = order_image(F.lit("new"))
    old = order_image(F.lit("old"))
    return orders.where(k != 2).select(
        F.lit(f"{TOPIC_PREFIX}.order_info").alias("topic"),
        F.col("o_orderkey").alias("seq"),
        _record(op, F.when(k.isin(0, 1), old), F.when(k != 1, row)).alias("value"),
    )


def order_image(status: Column) -> Column:
    return F.struct(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), status.alias("status"))


def order_snapshot(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The order table as it was in the middle of ``order_history``, and the fences around its reading."""
    orders = table(spark, sf_dir, "orders")
    last = orders.agg(F.max("o_orderkey")).first()[0] or 0
    k, at = F.col("o_orderkey") % 5, last // 2
    done = F.col("o_orderkey") <= at
    held = (k.isin(0, 2)) | ((k == 1) & ~done) | (k.isin(3, 4) & done)
    status = F.when((k == 2) | ~done, "old").otherwise("new")
    rows = table_snapshot(
        orders.where(held).select(order_image(status).alias("i")).select("i.*"), "retail", "order_info", F.lit(0).cast("bigint")
    )
    fences = spark.createDataFrame(
        [("retail", "order_info", last * 4 // 10, last * 6 // 10)], "database string, tableName string, low bigint, high bigint"
    )
    return rows, fences


def customer_changes(customer: DataFrame) -> DataFrame:
    return _changes(customer, "user_info", "c_custkey")


def _changes(df: DataFrame, name: str, key: str) -> DataFrame:
    row = F.struct(*df.columns)
    return df.select(
        F.lit(f"{TOPIC_PREFIX}.{name}").alias("topic"),
        F.col(key).cast("bigint").alias("seq"),
        _record(F.lit("c"), F.lit(None).cast("string"), row).alias("value"),
    )


def _record(op: Column, before: Column, after: Column) -> Column:
    record = F.struct(op.alias("op"), before.alias("before"), after.alias("after"))
    return F.to_json(record, {"ignoreNullFields": "false"})


def rules(spark: SparkSession) -> DataFrame:
    rows = [
        ("order_info", "insert", "kafka", "dwd_order_info", "o_orderkey,o_custkey,o_totalprice", None),
        ("order_info", "update", "kafka", "dwd_order_info_u", "o_orderkey,o_orderstatus,o_comment", None),
        ("user_info", "insert", "hbase", "dim_user_info", "c_custkey,c_name,c_mktsegment", "c_custkey"),
        ("base_province", "insert", "hbase", "dim_base_province", "n_nationkey,n_name", "n_nationkey"),
    ]
    columns = ", ".join(f"{c} string" for c in RULE_COLUMNS)
    return spark.createDataFrame([(*r, None) for r in rows], columns)


def rules_that_grow(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """A dimension rule, and the same rule with a column more."""
    columns = ", ".join(f"{c} string" for c in RULE_COLUMNS)
    rule = ("user_info", "insert", "hbase", "dim_user_info")
    before = [(*rule, "c_custkey,c_name", "c_custkey", None)]
    after = [(*rule, "c_custkey,c_name,c_mktsegment", "c_custkey", None)]
    return spark.createDataFrame(before, columns), spark.createDataFrame(after, columns)


def quarters(spark: SparkSession, sf_dir: str, name: str = "customer", by: str = "c_custkey") -> list[int]:
    """The keys that begin the second to fourth quarter of the key range of a table."""
    last = table(spark, sf_dir, name).agg(F.max(by)).first()[0] or 0
    return [last * k // 4 for k in (1, 2, 3)]


def rule_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log of routing rules, one change per order, as envelope columns + ``seq``.

    Orders of a customer rewrite that customer's rule; finished orders delete it.
    """
    orders = table(spark, sf_dir, "orders")
    rule = F.to_json(
        F.struct(
            F.concat(F.lit("t_"), "o_custkey").alias("source_table"),
            F.lit("insert").alias("operate_type"),
            F.lit("kafka").alias("sink_type"),
            F.concat(F.lit("dwd_"), "o_orderkey").alias("sink_table"),
            F.lit("id").alias("sink_columns"),
        )
    )
    gone = F.col("o_orderstatus") == "F"
    return orders.select(
        F.col("o_orderkey").alias("seq"),
        F.when(gone, "delete").otherwise("insert").alias("type"),
        F.when(gone, "{}").otherwise(rule).alias("data"),
        F.when(gone, rule).otherwise("{}").alias("before"),
    )


def rule_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log of routing rules that is spread over the positions of the change feed, one change per supplier.

    The rules of orders and users are edited all the time; some changes delete a rule, some move it to rows of
    type ``read``.
    """
    k = F.col("s_suppkey")
    slot, number = k % 4, k.cast("string")
    is_user = slot == 3
    order_columns = F.when(k % 3 == 0, "o_orderkey").when(k % 3 == 1, "o_orderkey,o_custkey").otherwise("o_orderkey,o_totalprice")

    def rule(operation: Column) -> Column:
        return F.to_json(
            F.struct(
                F.when(is_user, "user_info").otherwise("order_info").alias("source_table"),
                operation.alias("operate_type"),
                F.when(is_user, "hbase").otherwise("kafka").alias("sink_type"),
                F.concat(F.when(is_user, "dim_v").otherwise("dwd_v"), number).alias("sink_table"),
                F.when(is_user, "c_custkey,c_name").otherwise(order_columns).alias("sink_columns"),
                F.when(is_user, "c_custkey").alias("sink_pk"),
            )
        )

    own = rule(F.when(slot == 2, "update").otherwise("insert"))
    gone, moved = k % 11 == 0, (k % 13 == 0) & ~is_user
    return table(spark, sf_dir, "supplier").select(
        (k * 150).cast("bigint").alias("seq"),
        F.when(gone, "delete").when(moved, "update").otherwise("insert").alias("type"),
        F.when(gone, "{}").when(moved, rule(F.lit("read"))).otherwise(own).alias("data"),
        F.when(gone | moved, own).otherwise("{}").alias("before"),
    )


def customer_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One upsert of the customer row per order; orders with an odd key omit the status."""
    k = F.col("o_orderkey")
    names = F.when(k % 2 == 0, "c_custkey,last_order,last_status").otherwise("c_custkey,last_order")
    data = F.create_map(
        F.lit("c_custkey"),
        F.col("o_custkey").cast("string"),
        F.lit("last_order"),
        k.cast("string"),
        F.lit("last_status"),
        F.when(k % 4 == 0, F.col("o_orderstatus")),
    )
    return table(spark, sf_dir, "orders").select(
        F.lit("dim_customer").alias("sink_table"),
        names.alias("sink_columns"),
        F.lit("c_custkey").alias("sink_pk"),
        k.alias("seq"),
        data.alias("data"),
    )


# --- orders -------------------------------------------------------------------------


def order_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value``: order rows as JSON text; the province is the customer's nation."""
    return order_texts_from(with_province(spark, sf_dir, table(spark, sf_dir, "orders")), F.col("c_nationkey"))


def with_province(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """Orders, or a stream of them, with the nation of their customer."""
    users = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return orders.join(users, orders.o_custkey == users.c_custkey, "left")


def order_texts_from(orders: DataFrame, province: Column) -> DataFrame:
    total = F.col("o_totalprice").cast(MONEY)
    return orders.select(
        F.to_json(
            F.struct(
                F.col("o_orderkey").alias("id"),
                province.alias("province_id"),
                F.col("o_orderstatus").alias("order_status"),
                F.col("o_custkey").alias("user_id"),
                total.alias("total_amount"),
                F.lit(0).alias("activity_reduce_amount"),
                F.lit(5).alias("coupon_reduce_amount"),
                (total + 5).alias("original_total_amount"),
                F.lit(10).alias("feight_fee"),
                _text(F.col("o_orderdate") + F.expr("interval 15 minutes")).alias("expire_time"),
                _text(F.col("o_orderdate")).alias("create_time"),
            )
        ).alias("value")
    )


def faulty(lines: DataFrame, number: Column) -> DataFrame:
    """Record texts, some of them damaged by ``number``: cut off, without key, without time."""
    # a column, so that the text is searched for its number once
    lines = lines.withColumn("_number", number)
    value, number = F.col("value"), F.col("_number")
    damaged = (
        F.when(number % 50 == 0, F.substring("value", 1, 9))
        .when(number % 50 == 1, F.regexp_replace(value, r'^\{"id":\d+', '{"id":null'))
        .when(number % 50 == 2, F.regexp_replace(value, r'"create_time":"[^"]*"', '"create_time":"soon"'))
    )
    return lines.withColumn("value", F.coalesce(damaged, value)).drop("_number")


def detail_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detail_texts_from(table(spark, sf_dir, "lineitem"))


def detail_texts_from(lineitem: DataFrame) -> DataFrame:
    """``value``: order detail rows as JSON text."""
    price = F.col("l_extendedprice").cast(MONEY)
    return lineitem.select(
        F.to_json(
            F.struct(
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
                F.col("l_orderkey").alias("order_id"),
                F.col("l_partkey").alias("sku_id"),
                F.concat(F.lit("part "), F.col("l_partkey")).alias("sku_name"),
                price.alias("order_price"),
                F.col("l_quantity").cast("bigint").alias("sku_num"),
                _text(F.col("l_shipdate")).alias("create_time"),
                price.alias("split_total_amount"),
                F.lit(0).alias("split_activity_amount"),
                F.lit(1).alias("split_coupon_amount"),
            )
        ).alias("value")
    )


def _text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def dimensions(spark: SparkSession, sf_dir: str, streaming: bool = False) -> dict[str, DataFrame]:
    """The six dimension tables, every column a string; as streams they may repeat rows."""
    read = table_stream if streaming else table
    part = read(spark, sf_dir, "part")
    nation = read(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    k = F.col("c_custkey")
    brand_id = F.regexp_extract("p_brand", r"(\d+)$", 1)
    type_id = F.conv(F.substring(F.md5(F.col("p_type").cast("binary")), 1, 8), 16, 10)
    raw = {
        "dim_user_info": read(spark, sf_dir, "customer").select(
            k.alias("id"),
            F.when(k % 2 == 0, "F").otherwise("M").alias("gender"),
            F.date_add(F.lit("1960-01-01").cast("date"), (k * 37 % 15000).cast("int")).alias("birthday"),
        ),
        "dim_base_province": nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias("id"),
            F.col("n_name").alias("name"),
            (F.col("n_nationkey") + 1000).alias("area_code"),
            F.concat(F.lit("CN-"), "n_nationkey").alias("iso_code"),
            F.concat(F.substring("r_name", 1, 2), F.lit("-"), F.col("n_nationkey")).alias("iso_3166_2"),
        ),
        "dim_sku_info": part.select(
            F.col("p_partkey").alias("id"),
            brand_id.alias("tm_id"),
            type_id.alias("category3_id"),
            (F.col("p_partkey") % 100).alias("spu_id"),
        ),
        "dim_base_trademark": part.select(brand_id.alias("id"), F.col("p_brand").alias("tm_name")),
        "dim_base_category3": part.select(type_id.alias("id"), F.col("p_type").alias("name")),
        "dim_spu_info": read(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("id"), F.col("s_name").alias("spu_name")
        ),
    }
    texts = {name: df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]) for name, df in raw.items()}
    if not streaming:
        for name in ("dim_base_trademark", "dim_base_category3"):
            texts[name] = texts[name].distinct()
    return texts


# Columns of the dimension tables, as their rules list them.
DIM_COLUMNS = {
    "dim_user_info": ("id", "gender", "birthday"),
    "dim_base_province": ("id", "name", "area_code", "iso_code", "iso_3166_2"),
    "dim_sku_info": ("id", "tm_id", "category3_id", "spu_id"),
    "dim_base_trademark": ("id", "tm_name"),
    "dim_base_category3": ("id", "name"),
    "dim_spu_info": ("id", "spu_name"),
}


def dimension_rules(spark: SparkSession) -> DataFrame:
    """The rules that fill the six dimension tables from their source tables."""
    rows = [
        (name.removeprefix("dim_"), "insert", "hbase", name, ",".join(columns), None, None)
        for name, columns in DIM_COLUMNS.items()
    ]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RULE_COLUMNS))


def dimension_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``topic, seq, value``: a stream of change records of the six source tables."""
    feeds = []
    for name, rows in dimensions(spark, sf_dir, streaming=True).items():
        record = _record(F.lit("c"), F.lit(None).cast("string"), F.struct(*rows.columns))
        topic = F.lit(f"{TOPIC_PREFIX}.{name.removeprefix('dim_')}")
        feeds.append(rows.select(topic.alias("topic"), F.col("id").cast("bigint").alias("seq"), record.alias("value")))
    whole = feeds[0]
    for feed in feeds[1:]:
        whole = whole.unionByName(feed)
    return whole


# Columns of a wide row that come from the detail only, among those a merge fills.
DETAIL_ONLY = ("sku_id", "sku_name", "order_price", "sku_num")


def with_gaps(wide: DataFrame) -> DataFrame:
    """Wide rows with some values missing, so that merging has something to fill."""
    return wide.withColumns(
        {
            "order_status": F.when(F.col("sku_id") % 2 == 0, F.col("order_status")),
            "total_amount": F.when(F.col("sku_id") % 3 == 0, F.col("total_amount")),
            "order_price": F.when(F.col("sku_id") % 2 == 1, F.col("order_price")),
        }
    )
