"""Dimensions from the change feed to the wide rows: versions, keys, schema changes, hot lookups."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import dimensions as dm
from millrace.operators import routing
from millrace.operators.dimensions import DimSpec
from millrace.operators.orders import WIDE_DIMS
from millrace.plans import change_feed
from millrace.plans.change_feed import change_feed_job
from millrace.plans.order_wide import order_wide, order_wide_job
from millrace.session import work_dir
from millrace.sinks.topics import topic_files
from millrace.streaming.dimensions import DimFeed, dim_ledger
from millrace.streaming.ledger import StaleLedger
from tests.test_streaming import ENVELOPE, Feed, change, detail, finish, order, rule_frame

USERS = ("user_info", "insert", "hbase", "dim_user_info", "id,gender,birthday", None, None)
COLUMNS = {"dim_user_info": ["id", "gender", "birthday"], "dim_base_province": ["id", "name", "area_code", "iso_code", "iso_3166_2"]}


def test_versions_are_read_as_a_batch_left_them(spark, tmp_path):
    feed, root = Feed(str(tmp_path / "in"), ENVELOPE), work_dir(spark, "versions")
    ledger = dim_ledger(spark, f"{root}/dims", every=2)
    dims = DimFeed(ledger, COLUMNS)
    assert dims.version() is None and all(t.count() == 0 for t in dims.latest().values())
    for n in range(5):
        feed.add([change(n, "insert", "user_info", id=n % 3, gender=f"g{n}", birthday=None)])
        feed_job = change_feed_job(
            feed.stream(spark), lambda: rule_frame(spark, USERS), f"{root}/out", ledger, f"{root}/ck"
        )
        finish(feed_job)
        assert dims.version() == n
    want = [{"0": "g0"}, {"0": "g0", "1": "g1"}, {"0": "g0", "1": "g1", "2": "g2"}, {"0": "g3", "1": "g1", "2": "g2"}, {"0": "g3", "1": "g4", "2": "g2"}]
    for n, rows in enumerate(want):
        assert {r.id: r.gender for r in dims.at(n)["dim_user_info"].collect()} == rows
    # an increment that is not committed is no version
    uncommitted = ledger.root + "/gen=2/batch_id=5/sink_table=dim_user_info"
    ledger.spark.range(1).write.parquet(uncommitted + "/part")
    assert dims.version() == 4
    dims.version(max_age=3600)
    with pytest.raises(StaleLedger):
        dims.ledger.newest(10, clock=lambda: 4e9)


def test_one_dimension_reads_only_its_own_folders(spark):
    ledger = dim_ledger(spark, work_dir(spark, "folders"))
    rows = [(t, "id", None, 1, {"id": "1"}) for t in ("dim_a", "dim_b")]
    ledger.append(0, spark.createDataFrame(rows, "sink_table string, sink_columns string, sink_pk string, seq bigint, data map<string,string>"))
    view = DimFeed(ledger, {"dim_a": ["id"]}).latest()["dim_a"]
    assert view.collect() == [("1",)]
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "sink_table" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_lookup_aggregates_only_the_upserts_of_its_keys(spark):
    ledger = dim_ledger(spark, work_dir(spark, "pushed"))
    upserts = spark.range(5000).select(
        F.lit("dim_user_info").alias("sink_table"), F.lit("id,gender").alias("sink_columns"), F.lit(None).cast("string").alias("sink_pk"),
        F.col("id").alias("seq"), F.create_map(F.lit("id"), (F.col("id") % 1000).cast("string"), F.lit("gender"), F.concat(F.lit("g"), "id")).alias("data"),
    )
    ledger.append(0, upserts)
    left = spark.createDataFrame([(5,), (7,), (-1,)], "user_id bigint").persist()
    left.count()
    spec = DimSpec("dim_user_info", "user_id", {"gender": "gender"})
    dims = DimFeed(ledger, {"dim_user_info": ["id", "gender"]}).latest()
    joined = dm.join_dim(left, dims, spec, keys=left.select("user_id"))
    assert {r.user_id: r.gender for r in joined.collect()} == {5: "g4005", 7: "g4007", -1: None}
    lines = joined._jdf.queryExecution().optimizedPlan().toString().splitlines()
    semi = next(n for n, text in enumerate(lines) if "LeftSemi" in text)
    # the aggregate of the upserts stands above the reduction to the keys
    assert any("Aggregate" in text and "max_by" in text for text in lines[:semi])
    left.unpersist()


def test_the_wide_job_looks_up_what_the_feed_wrote(spark, tmp_path):
    root = work_dir(spark, "from-feed")
    feed, o, d = Feed(str(tmp_path / "in"), ENVELOPE), Feed(str(tmp_path / "o"), "value string"), Feed(str(tmp_path / "d"), "value string")
    others = {s.dim: ["id", *s.columns] for spec in WIDE_DIMS[2:] for s in (spec, *spec.then)}
    ledger = dim_ledger(spark, f"{root}/dims")
    dims = DimFeed(ledger, {**COLUMNS, **others})
    provinces = ("base_province", "insert", "hbase", "dim_base_province", "id,name,area_code,iso_code,iso_3166_2", None, None)
    base = 1_600_000_000_000

    def run(n, gender):
        feed.add([change(n, "insert", "user_info", id=n, gender=gender, birthday="2000-01-01"), change(n, "insert", "base_province", id=1, name="north")])
        finish(change_feed_job(feed.stream(spark), lambda: rule_frame(spark, USERS, provinces), f"{root}/out", ledger, f"{root}/ck"))
        o.add([{"value": json.dumps({"id": n, "user_id": n, "province_id": 1, "create_time": str(base + 60_000 * n)})}])
        d.add([detail(n, n, base + 60_000 * n)])
        finish(order_wide_job(o.stream(spark), d.stream(spark), dims.latest, f"{root}/wide", f"{root}/wide-ck", as_of="2020-01-01 00:00:00"))

    run(1, "F")
    run(2, "M")
    rows = [json.loads(r.value) for r in topic_files(spark, f"{root}/wide", "dwm_order_wide").collect()]
    assert {(r["order_id"], r["user_gender"], r["province_name"]) for r in rows} == {(1, "F", "north"), (2, "M", "north")}


def test_a_dimension_row_without_its_key_goes_to_the_audit(spark, tmp_path):
    feed, root = Feed(str(tmp_path / "in"), ENVELOPE), work_dir(spark, "keyless")
    feed.add([change(1, "insert", "user_info", id=None, gender="F"), change(2, "insert", "user_info", gender="M"), change(3, "insert", "user_info", id=0, gender="M")])
    ledger = dim_ledger(spark, f"{root}/dims")
    finish(change_feed_job(feed.stream(spark), lambda: rule_frame(spark, USERS), f"{root}/out", ledger, f"{root}/ck"))
    assert [r.id for r in DimFeed(ledger, COLUMNS).latest()["dim_user_info"].collect()] == ["0"]
    audit = [json.loads(r.value) for r in topic_files(spark, f"{root}/out", "unrouted_changes").collect()]
    images = [json.loads(r["data"]) for r in audit]
    assert sorted(images, key=lambda i: i["gender"]) == [{"gender": "F", "id": None}, {"gender": "M"}]


def test_a_rule_that_gains_a_column_alters_its_table_once(spark, tmp_path, monkeypatch):
    spark.sql("create database if not exists growing")
    feed, root = Feed(str(tmp_path / "in"), ENVELOPE), work_dir(spark, "growing")
    ledger, statements = dim_ledger(spark, f"{root}/dims"), []
    for name in ("create_dim_table", "add_missing_columns"):
        plain = getattr(change_feed, name)
        monkeypatch.setattr(change_feed, name, lambda *a, n=name, f=plain: statements.append((n, f(*a))))
    rules = [("user_info", "insert", "hbase", "dim_grows", "name", "id", None)]

    def run(n, **row):
        feed.add([change(n, "insert", "user_info", **row)])
        job = change_feed_job(
            feed.stream(spark), lambda: rule_frame(spark, *rules), f"{root}/out", ledger, f"{root}/ck", "growing", evolve_dims=True
        )
        finish(job)

    run(1, id=1, name="a", city="x")
    run(2, id=2, name="b", city="x")
    assert set(spark.table("growing.dim_grows").columns) == {"id", "name"} and len(statements) == 2
    rules[0] = ("user_info", "insert", "hbase", "dim_grows", "name,city", "id", None)
    run(3, id=3, name="c", city="z")
    run(4, id=1, name="d", city=None)
    assert set(spark.table("growing.dim_grows").columns) == {"id", "name", "city"}
    assert [s for s in statements if s[1]] == [("add_missing_columns", ["id"]), ("add_missing_columns", ["city"])] and len(statements) == 4
    rows = DimFeed(ledger, {"dim_grows": ["id", "name", "city"]}).latest()["dim_grows"]
    assert {tuple(r) for r in rows.collect()} == {("1", "d", None), ("2", "b", None), ("3", "c", "z")}


def test_a_repeated_dimension_key_does_not_double_rows(spark):
    dim = spark.createDataFrame([("1", "b"), ("1", "a"), ("2", "c"), (None, "n")], "id string, gender string")
    left = spark.createDataFrame([(1,), (2,), (3,)], "user_id bigint").persist()
    spec = DimSpec("u", "user_id", {"gender": "gender"})
    want = {(1, "a"), (2, "c"), (3, None)}
    for got in (
        dm.join_dim(left, dm.unique_dims({"u": dim}, [spec]), spec),
        dm.join_dim(left, {"u": dim}, spec, keys=left.select("user_id")),
    ):
        rows = [tuple(r) for r in got.collect()]
        assert len(rows) == 3 and set(rows) == want
    once = dim.where("gender <> 'b'")
    assert dm.one_row_per_key(once) is once
    o = spark.createDataFrame([(order(1, 1_600_000_000_000)["value"],)], "value string")
    d = spark.createDataFrame([(detail(1, 1, 1_600_000_000_000)["value"],)], "value string")
    dims = {s.dim: spark.createDataFrame([], ", ".join(f"{c} string" for c in ["id", *s.columns])) for spec in WIDE_DIMS for s in (spec, *spec.then)}
    dims["dim_user_info"] = spark.createDataFrame([("1", "F", "2000-01-01"), ("1", "M", "2000-01-01")], "id string, gender string, birthday string")
    assert [r.user_gender for r in order_wide(o, d, dims, as_of="2020-01-01 00:00:00").collect()] == ["F"]


def test_hot_lookup_keys_are_split_inside_a_micro_batch(spark):
    """A third of the pairs are one user's; adaptive execution is off, as in a streaming job."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        pairs = spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("user_id"), "id").persist()
        users = spark.range(5000).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("g"), "id").alias("gender"))
        spec = DimSpec("u", "user_id", {"gender": "gender"})
        hot = dm.hot_keys(pairs, "user_id", pairs.count(), many=2_000)
        assert hot.keys == ("0",) and hot.salts == 11
        sizes = {}
        for name, keys in (("plain", dm.HotKeys()), ("split", hot)):
            joined = dm.join_dim(pairs, {"u": users}, spec, pairs.select("user_id"), keys)
            assert joined.where(F.col("gender") == F.concat(F.lit("g"), "user_id")).count() == n
            sizes[name] = max(r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("gender").alias("n")).collect())
        assert sizes["plain"] > n / 3 and sizes["split"] < n / 4
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "_salt" in plan and joined.columns == ["user_id", "id", "gender"]
        assert dm.hot_keys(pairs, "user_id", n) == dm.HotKeys()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_unrouted_rows_of_a_dimension_keep_their_whole_image(spark):
    changes = spark.createDataFrame([(1, "insert", "user_info", '{"gender":"F","x":1}')], "seq bigint, type string, tableName string, data string")
    routed = routing.route_changes(changes, rule_frame(spark, USERS)).collect()
    assert [(r["route"], sorted(r["data"])) for r in routed] == [(routing.UNROUTED, ["gender", "x"])]
