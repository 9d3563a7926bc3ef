from pyspark.sql import functions as F

from millrace.functions.timetext import age_years
from millrace.operators import dimensions as dm
from millrace.operators import orders as od
from millrace.operators.dimensions import DimSpec


def changes(spark, rows):
    return spark.createDataFrame(rows, "sink_columns string, seq bigint, data map<string,string>")


def test_last_write_wins_per_column(spark):
    df = changes(
        spark,
        [
            ("id,name,city", 1, {"id": "1", "name": "a", "city": "x"}),
            ("id,name", 3, {"id": "1", "name": None}),  # city keeps its value
            ("id,city", 2, {"id": "1", "city": "o'hare"}),
            ("id,name,city", 1, {"id": "2", "name": "z"}),  # listed but absent: null
        ],
    )
    got = {r.id: (r.name, r.city) for r in dm.current_rows(df, ["id", "name", "city"]).collect()}
    assert got == {"1": (None, "o'hare"), "2": ("z", None)}


def test_composite_key(spark):
    df = changes(
        spark,
        [
            ("a,b,v", 1, {"a": "1", "b": "1", "v": "x"}),
            ("a,b,v", 2, {"a": "1", "b": "2", "v": "y"}),
            ("a,b,v", 3, {"a": "1", "b": "1", "v": "z"}),
        ],
    )
    got = {(r.a, r.b): r.v for r in dm.current_rows(df, ["a", "b", "v"], ["a", "b"]).collect()}
    assert got == {("1", "1"): "z", ("1", "2"): "y"}


def test_table_from_rule(spark):
    assert dm.key_columns(None) == ["id"] and dm.key_columns(" ") == ["id"]
    assert dm.key_columns("a,b") == ["a", "b"]
    spark.sql("create database if not exists dims")
    for _ in range(2):
        dm.create_dim_table(spark, "dims", "dim_x", "id,name", None, "SALT_BUCKETS = 'q'")
    assert [(f.name, f.dataType.simpleString()) for f in spark.table("dims.dim_x").schema] == [
        ("id", "string"),
        ("name", "string"),
    ]
    properties = {r.key: r.value for r in spark.sql("show tblproperties dims.dim_x").collect()}
    assert properties["primary_key"] == "id" and properties["sink_extend"] == "SALT_BUCKETS = 'q'"


def test_lookup_misses_keep_the_row(spark):
    sku = spark.createDataFrame([("1", "10"), ("2", "11")], "id string, tm_id string")
    tm = spark.createDataFrame([("10", "ten")], "ID string, TM_NAME string")
    spec = DimSpec("sku", "sku_id", {"tm_id": "tm"}, then=(DimSpec("tm", "tm", {"tm_name": "tm_name"}),))
    left = spark.createDataFrame([(1,), (2,), (3,), (None,)], "sku_id bigint")
    got = {r.sku_id: (r.tm, r.tm_name) for r in dm.join_dim(left, {"sku": sku, "tm": tm}, spec).collect()}
    assert got == {1: ("10", "ten"), 2: ("11", None), 3: (None, None), None: (None, None)}


def test_small_side_reduces_a_large_dimension_without_shuffling_it(spark):
    dim = spark.range(400_000).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("g"), "id").alias("gender"))
    left = spark.createDataFrame([(5,), (5,), (7,), (-1,), (None,)], "user_id bigint").persist()
    left.count()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100KB")
    try:
        spec = DimSpec("u", "user_id", {"gender": "gender"})
        joined = dm.join_dim(left, {"u": dim}, spec, keys=left.select("user_id"))
        got = sorted(((r.user_id, r.gender) for r in joined.collect()), key=str)
        assert got == sorted([(5, "g5"), (5, "g5"), (7, "g7"), (-1, None), (None, None)], key=str)
        text = joined._jdf.queryExecution().executedPlan().toString()
        semi = text.index("LeftSemi")
        assert "BroadcastHashJoin" in text[semi - 80 : semi] and "Exchange" not in text[semi:].split("Range")[0].split(
            "BroadcastExchange"
        )[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        left.unpersist()


def test_age_counts_years_of_365_days(spark):
    df = spark.createDataFrame([("2000-01-01",), ("2023-12-31",), ("bad",), (None,)], "b string")
    as_of = F.lit("2001-01-01 00:00:00").cast("timestamp")
    got = {r.b: r.a for r in df.select("b", age_years(F.col("b"), as_of).alias("a")).collect()}
    assert got == {"2000-01-01": 1, "2023-12-31": -23, "bad": None, None: None}


def test_hot_lookup_key_is_split_at_run_time(spark):
    """A third of the rows share one user; a dimension too big to broadcast is shuffled."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(200_000, numPartitions=8)
        left = rows.select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("user_id"), "id")
        users = spark.range(5000).select(
            F.col("id").cast("string").alias("id"), F.concat(F.lit("g"), "id").alias("gender")
        )
        joined = dm.join_dim(left, {"u": users}, DimSpec("u", "user_id", {"gender": "gender"}))
        assert joined.where("gender is not null").count() == 200_000
        joined.write.format("noop").mode("overwrite").save()
        text = _final_plan(joined)
        assert "skew=true" in text
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_rows_are_shuffled_at_most_three_times(spark):
    """Sku follow-up lookups are joined between dimensions, not to the wide rows."""
    assert [s.dim for s in od.WIDE_DIMS] == ["dim_user_info", "dim_base_province", "dim_sku_info"]
    assert [s.dim for s in od.SKU.then] == ["dim_base_trademark", "dim_base_category3", "dim_spu_info"]
