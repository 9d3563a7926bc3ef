"""Streaming forms over several files must give what the batch forms give."""

import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from millrace import fixtures as fx
from millrace.operators.applog import LogTopics
from millrace.operators.jumpout import jumpouts_by_pattern, jumpouts_by_session, page_sessions
from millrace.operators.orders import interval_join, parse_details, parse_orders
from millrace.operators.routing import RULE_COLUMNS
from millrace.operators.visits import daily_first_visits
from millrace.plans.app_log import log_job, log_tables
from millrace.plans.change_feed import change_feed_job, pulled_rules_job
from millrace.plans.order_wide import order_wide_job
from millrace.plans.page_visits import jumpouts_job, page_rows, unique_visits_job
from millrace.session import work_dir
from millrace.sinks.topics import topic_files, write_topics
from millrace.streaming.dimensions import current_dim, dim_ledger, publish_dim
from millrace.streaming.jumpout import jumpouts_by_windows, jumpouts_stream, page_sessions_stream
from millrace.streaming.ledger import Ledger
from millrace.streaming.newuser import device_ledger
from millrace.streaming.orders import interval_join_stream
from millrace.streaming.snapshot import Snapshot
from millrace.streaming.visits import daily_first_visits_stream

LINE = "seq bigint, value string"
DAY = 86_400_000


class Feed:
    """A directory that receives one file of rows at a time."""

    def __init__(self, path, schema=LINE):
        self.path, self.schema, self.n = path, schema, 0
        os.makedirs(path, exist_ok=True)

    def add(self, rows):
        name = f"{self.path}/part-{self.n:05d}.json"
        with open(name, "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows)
        os.utime(name, (1_700_000_000 + self.n, 1_700_000_000 + self.n))
        self.n += 1

    def stream(self, spark):
        return spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).json(self.path)

    def batch(self, spark):
        return spark.read.schema(self.schema).json(self.path)


def finish(writer):
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def collect(spark, rows, mode="append", root=None):
    root = root or work_dir(spark, "collect")

    def save(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{root}/rows/batch_id={batch_id}")

    writer = rows.writeStream.foreachBatch(save).outputMode(mode)
    finish(writer.option("checkpointLocation", f"{root}/ck"))
    return spark.read.schema(rows.schema).parquet(f"{root}/rows").select(*rows.columns)


def bag(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def line(mid, ts, last=None, is_new="1"):
    page = {"page_id": "p", **({"last_page_id": last} if last else {})}
    return json.dumps({"common": {"mid": mid, "is_new": is_new}, "page": page, "ts": ts})


def visits(seed=5, n=240, step=3_000):
    """Lines in time order; one device holds a third of them."""
    rng = random.Random(seed)
    rows, ts = [], 1_000_000
    for i in range(n):
        ts += rng.randrange(0, 2 * step)
        mid = "hot" if rng.random() < 0.34 else f"m{rng.randrange(12)}"
        rows.append({"seq": i, "value": line(mid, ts, rng.choice([None, "x"]))})
    return rows, ts


@pytest.fixture()
def visit_feed(tmp_path):
    rows, last = visits()
    feed = Feed(str(tmp_path / "in"))
    for i in range(0, len(rows), 60):
        feed.add(rows[i : i + 60])
    # a far later row of another device moves the watermark past everything
    feed.add([{"seq": 10_000, "value": line("sentinel", last + 10 * DAY, "x")}])
    return feed


def real(df):
    return df.where("mid <> 'sentinel'")


@pytest.mark.parametrize("by_session", [False, True])
def test_jumpouts(spark, visit_feed, by_session):
    pages = real(page_rows(visit_feed.batch(spark)))
    want = jumpouts_by_session(pages, 10_000) if by_session else jumpouts_by_pattern(pages, 10_000)
    # slices of 40 s: many borders
    got = jumpouts_stream(page_rows(visit_feed.stream(spark)), 10_000, by_session, slice_ms=40_000)
    assert bag(collect(spark, got).select("mid", "seq", "ts")) == bag(want.select("mid", "seq", "ts"))


@pytest.mark.parametrize("by_session", [False, True])
def test_jumpouts_by_windows(spark, visit_feed, by_session):
    pages = real(page_rows(visit_feed.batch(spark)))
    want = jumpouts_by_session(pages, 10_000) if by_session else jumpouts_by_pattern(pages, 10_000)
    got = jumpouts_by_windows(page_rows(visit_feed.stream(spark)), 10_000, by_session, slice_ms=40_000)
    held = collect(spark, got)
    columns = ["mid", "seq", "ts", *([] if by_session else ["reason"])]
    assert bag(held.select(*columns)) == bag(want.select(*columns))
    assert {json.loads(r.value)["ts"] for r in held.collect()} == {r.ts for r in want.collect()}
    batch = jumpouts_by_windows(pages, 10_000, by_session)
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert bag(batch.select(*columns)) == bag(want.select(*columns))


def test_jumpouts_do_not_depend_on_arrow_batches(spark, visit_feed):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        pages = real(page_rows(visit_feed.batch(spark)))
        got = jumpouts_stream(page_rows(visit_feed.stream(spark)), 10_000)
        want = jumpouts_by_pattern(pages, 10_000)
        columns = ["mid", "seq", "ts", "reason"]
        assert bag(collect(spark, got).select(*columns)) == bag(want.select(*columns))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_sessions(spark, visit_feed):
    want = page_sessions(real(page_rows(visit_feed.batch(spark))), 10_000)
    got = collect(spark, page_sessions_stream(page_rows(visit_feed.stream(spark)), 10_000))
    assert bag(got) == bag(want)


def test_unique_visits_over_days_and_restarts(spark, tmp_path):
    rng = random.Random(2)
    rows = [
        {"seq": i, "value": line(f"m{rng.randrange(8)}", i * DAY // 40, rng.choice([None, "x"]))}
        for i in range(200)
    ]
    feed, root = Feed(str(tmp_path / "in")), work_dir(spark, "uv")
    for i in range(0, 200, 50):
        feed.add(rows[i : i + 50])
        if i % 100:  # stop after every second file, then go on from the checkpoint
            got = collect(spark, daily_first_visits_stream(page_rows(feed.stream(spark))), "update", root)
    want = daily_first_visits(page_rows(feed.batch(spark)))
    assert bag(got.select("mid", "day", "seq", "ts")) == bag(want.select("mid", "day", "seq", "ts"))


def test_unique_visits_use_the_days_of_the_session_zone(spark, tmp_path):
    hour = DAY // 24
    times = [("m", 2 * hour), ("m", 20 * hour), ("n", 17 * hour), ("n", DAY + 3 * hour)]
    feed = Feed(str(tmp_path / "in"))
    for i, (mid, ts) in enumerate(times):
        feed.add([{"seq": i, "value": line(mid, ts)}])
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        got = bag(collect(spark, daily_first_visits_stream(page_rows(feed.stream(spark))), "update").select("mid", "day", "seq"))
        want = bag(daily_first_visits(page_rows(feed.batch(spark))).select("mid", "day", "seq"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == want == [("m", "1970-01-01", "0"), ("m", "1970-01-02", "1"), ("n", "1970-01-02", "2")]


def test_one_wrong_clock_costs_no_other_device_its_visit(spark, tmp_path):
    now = int(time.time() * 1000)
    feed = Feed(str(tmp_path / "in"))
    for i, (mid, ts) in enumerate([("a", now), ("wrong", 4_070_908_800_000), ("b", now), ("c", now), ("a", now + 1)]):
        feed.add([{"seq": i, "value": line(mid, ts)}])
    got = collect(spark, daily_first_visits_stream(page_rows(feed.stream(spark))), "update")
    assert bag(got.select("mid", "seq")) == [("a", "0"), ("b", "2"), ("c", "3"), ("wrong", "1")]


def test_dimension_ledger_with_topic_positions_and_an_unlisted_key(spark, tmp_path):
    feed, root = Feed(str(tmp_path / "in"), ENVELOPE), work_dir(spark, "feed")
    position = "struct<timestamp:timestamp,partition:int,offset:bigint>"
    dims = dim_ledger(spark, f"{root}/dims", every=2, order_type=position)
    rules = rule_frame(spark, ("user_info", "insert", "hbase", "dim_user_info", "name", "id", None))
    seq = F.struct(F.timestamp_millis("seq").alias("timestamp"), F.lit(0).alias("partition"), F.col("seq").alias("offset"))
    for n, (id_, name) in enumerate([(1, "a"), (2, "b"), (1, "c"), (2, "d"), (3, "e")]):
        feed.add([change(n, "insert", "user_info", id=id_, name=name)])
    changes = feed.stream(spark).withColumn("seq", seq)
    finish(change_feed_job(changes, lambda: rules, f"{root}/out", dims, f"{root}/ck"))
    rows = current_dim(dims, 4, "dim_user_info", ["id", "name"]).collect()
    assert {tuple(r) for r in rows} == {("1", "c"), ("2", "d"), ("3", "e")}
    plain = dim_ledger(spark, f"{root}/plain")
    with pytest.raises(ValueError, match="seq"):
        plain.append(0, dims.upto(4).drop("batch_id"))


def test_log_job_restart_and_replay(spark, tmp_path):
    rng = random.Random(4)
    rows = [{"seq": i, "value": line(f"m{rng.randrange(9)}", i, None, rng.choice("01"))} for i in range(120)]
    rows[10]["value"] = "broken"
    feed, root = Feed(str(tmp_path / "in")), work_dir(spark, "log")
    ledger = device_ledger(spark, f"{root}/devices", every=2)
    for i in range(0, 120, 20):
        feed.add(rows[i : i + 20])
        if i % 40:
            finish(log_job(feed.stream(spark), f"{root}/out", ledger, f"{root}/ck"))
    out = spark.read.schema("topic string, value string, reason string").parquet(f"{root}/out")
    assert bag(out.select("topic", "value", "reason")) == bag(
        log_tables(feed.batch(spark)).drop("seq")
    )
    # replaying a committed batch changes nothing
    before = bag(out)
    from millrace.plans.app_log import accepted_lines
    from millrace.streaming.newuser import repair_batch

    batch = spark.createDataFrame([(r["seq"], r["value"]) for r in rows[40:60]], LINE)
    again = repair_batch(accepted_lines(batch), 2, ledger)
    flags = {r.seq: r.is_new for r in again.collect()}
    whole = {json.loads(r.value)["common"]["mid"] for r in out.where("topic = 'dwd_page_log'").collect()}
    assert len(flags) == 20 and len(whole) == 9
    write_topics(again.selectExpr("'x' as topic", "value"), f"{root}/out", 2)
    assert bag(spark.read.schema(out.schema).parquet(f"{root}/out")) == before


def test_chained_jobs_read_topic_directories(spark, visit_feed):
    root = work_dir(spark, "chain")
    ledger = device_ledger(spark, f"{root}/devices")
    finish(log_job(visit_feed.stream(spark), f"{root}/dwd", ledger, f"{root}/ck1"))
    pages = topic_files(spark, f"{root}/dwd", LogTopics().page, streaming=True)
    finish(unique_visits_job(pages, f"{root}/uv", f"{root}/ck2"))
    finish(jumpouts_job(pages, f"{root}/jump", f"{root}/ck3"))
    uv = topic_files(spark, f"{root}/uv", "dwm_unique_visit")
    mids = [r.m for r in uv.select(F.get_json_object("value", "$.common.mid").alias("m")).collect()]
    batch = page_rows(visit_feed.batch(spark))
    assert sorted(mids) == sorted(r.mid for r in daily_first_visits(batch).collect())
    jumps = topic_files(spark, f"{root}/jump", "dwm_user_jump_out")
    assert jumps.count() == jumpouts_by_pattern(real(batch)).count()


def order(i, ts):
    return {"value": json.dumps({"id": i, "user_id": i % 3, "create_time": str(ts)})}


def detail(i, order_id, ts):
    return {"value": json.dumps({"id": i, "order_id": order_id, "sku_id": i % 4, "create_time": str(ts)})}


@pytest.fixture()
def order_feeds(tmp_path):
    rng = random.Random(9)
    orders, details = Feed(str(tmp_path / "o"), "value string"), Feed(str(tmp_path / "d"), "value string")
    for part in range(3):
        base = 1_600_000_000_000 + part * 60_000
        orders.add([order(part * 20 + i, base + i * 1000) for i in range(20)])
        # half of the details belong to one order
        details.add(
            [
                detail(part * 100 + i, part * 20 + (0 if i % 2 else rng.randrange(20)), base + rng.randrange(-6, 26) * 1000)
                for i in range(80)
            ]
        )
    return orders, details


def test_interval_join(spark, order_feeds):
    o, d = order_feeds
    want = interval_join(parse_orders(o.batch(spark)), parse_details(d.batch(spark)))
    assert want.count() > 30
    got = interval_join_stream(o.stream(spark), d.stream(spark), delay="60 seconds")
    assert bag(collect(spark, got)) == bag(want)


def test_order_wide_job(spark, order_feeds):
    o, d = order_feeds
    frames = {
        "dim_user_info": "id string, gender string, birthday string",
        "dim_base_province": "id string, name string, area_code string, iso_code string, iso_3166_2 string",
        "dim_sku_info": "id string, tm_id string, category3_id string, spu_id string",
        "dim_base_trademark": "id string, tm_name string",
        "dim_base_category3": "id string, name string",
        "dim_spu_info": "id string, spu_name string",
    }
    rows = {
        "dim_user_info": [("0", "F", "1990-01-01")],
        "dim_sku_info": [("1", "5", "6", "7")],
        "dim_base_trademark": [("5", "tm")],
    }
    dims = {n: Snapshot(lambda n=n, s=s: spark.createDataFrame(rows.get(n, []), s)) for n, s in frames.items()}
    root = work_dir(spark, "wide")
    finish(
        order_wide_job(
            o.stream(spark), d.stream(spark), dims, f"{root}/out", f"{root}/ck", delay="60 seconds",
            as_of="2020-01-01 00:00:00",
        )
    )
    got = [json.loads(r.value) for r in topic_files(spark, f"{root}/out", "dwm_order_wide").collect()]
    want = interval_join(parse_orders(o.batch(spark)), parse_details(d.batch(spark)))
    assert len(got) == want.count()
    assert all(len(g) == 35 for g in got)
    assert {(g["user_id"], g["user_age"]) for g in got} == {(0, 30), (1, None), (2, None)}
    assert {(g["sku_id"], g["tm_id"], g["tm_name"]) for g in got} == {
        (0, None, None), (1, 5, "tm"), (2, None, None), (3, None, None),
    }


ENVELOPE = "seq bigint, type string, data string, before string, database string, tableName string"


def change(seq, op, table, **row):
    return {"seq": seq, "type": op, "data": json.dumps(row), "before": "{}", "database": "shop", "tableName": table}


def rule_frame(spark, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in RULE_COLUMNS))


def test_change_feed_job_with_rules_added_later(spark, tmp_path):
    feed, root = Feed(str(tmp_path / "in"), ENVELOPE), work_dir(spark, "feed")
    dims = dim_ledger(spark, f"{root}/dims", every=2)
    user = ("user_info", "insert", "hbase", "dim_user_info", "id,name", None, None)
    rename = ("user_info", "update", "hbase", "dim_user_info", "id,name,city", "id", None)
    fact = ("order_info", "insert", "kafka", "dwd_order_info", "id,total", None, None)
    current = [user]

    def run():
        finish(
            change_feed_job(
                feed.stream(spark), lambda: rule_frame(spark, *current), f"{root}/out", dims, f"{root}/ck", "feed_dims"
            )
        )

    spark.sql("create database if not exists feed_dims")
    feed.add([change(1, "insert", "user_info", id=1, name="a"), change(2, "insert", "order_info", id=9, total=1)])
    run()
    current.extend([rename, fact])
    feed.add([change(3, "insert", "order_info", id=10, total=None, x=1), change(4, "insert", "user_info", id=2, name="b")])
    feed.add([change(5, "update", "user_info", id=1, name="c", city="x"), change(6, "update", "user_info", id=1, name=None, city="y")])
    feed.add([change(7, "insert", "user_info", id=1, name="d")])
    feed.add([change(8, "delete", "user_info")])
    run()
    out = spark.read.schema("topic string, value string").parquet(f"{root}/out")
    unrouted = next(r.value for r in out.collect() if r.topic == "unrouted_changes")
    kept = json.loads(unrouted)
    assert (kept["type"], kept["tableName"], kept["data"]) == ("insert", "order_info", '{"id":9,"total":1}')
    assert {(r.topic, r.value) for r in out.collect()} == {
        ("unrouted_changes", unrouted),
        ("dwd_order_info", '{"id":10,"total":null}'),
    }
    columns = ["id", "name", "city"]
    states = [
        {r.id: (r.name, r.city) for r in current_dim(dims, n, "dim_user_info", columns).collect()} for n in range(5)
    ]
    assert states == [
        {"1": ("a", None)},
        {"1": ("a", None), "2": ("b", None)},
        {"1": (None, "y"), "2": ("b", None)},
        {"1": ("d", "y"), "2": ("b", None)},
        {"1": ("d", "y"), "2": ("b", None)},
    ]
    assert spark.table("feed_dims.dim_user_info").columns == ["id", "name"]
    for batch_id, rows in ((1, {("1", "a"), ("2", "b")}), (3, {("1", "d"), ("2", "b")})):
        publish_dim(dims, batch_id, "feed_dims", "dim_user_info", ["id", "name"])
        assert {tuple(r) for r in spark.table("feed_dims.dim_user_info").collect()} == rows


def test_pulled_rules_job(spark, tmp_path):
    feed, root = Feed(str(tmp_path / "in"), ENVELOPE), work_dir(spark, "pulled")
    feed.add([change(1, "insert", "a", id=1), change(2, "insert", "b", id=2)])
    rules = Snapshot(lambda: rule_frame(spark, ("a", "insert", "kafka", "t_a", "id", None, None)), 20)
    finish(pulled_rules_job(feed.stream(spark), rules, f"{root}/out", f"{root}/ck"))
    rows = topic_files(spark, f"{root}/out", "t_a").collect()
    assert [json.loads(r.value) for r in rows] == [{"id": 1, "sinkTable": "t_a"}]


def test_ledger_generations(spark):
    ledger = Ledger(spark, work_dir(spark, "ledger"), "k bigint", lambda df: df.select("k", "batch_id").distinct(), 3)
    for n in range(8):
        assert sorted(r.k for r in ledger.before(n).collect()) == list(range(n))
        written = ledger.append(n, spark.createDataFrame([(n,)], "k bigint"))
        assert [r.k for r in written.collect()] == [n]
    assert sorted(r.k for r in ledger.upto(7).collect()) == list(range(8))
    assert sorted(r.k for r in ledger.before(4).collect()) == list(range(4))
    # an increment that was committed is not replaced by a replay
    ledger.append(7, spark.createDataFrame([(99,)], "k bigint"))
    assert 99 not in {r.k for r in ledger.upto(7).collect()}


def test_snapshot_staleness(spark):
    now, loads = [0.0], []

    def load():
        loads.append(now[0])
        return spark.range(1)

    held = Snapshot(load, max_staleness=10, clock=lambda: now[0])
    for now[0] in (0.0, 9.9, 10.0, 15.0):
        held.get()
    assert loads == [0.0, 10.0]
    held.invalidate()
    held.get()
    assert loads == [0.0, 10.0, 15.0]
    fresh = Snapshot(load)
    fresh.get(), fresh.get()
    assert len(loads) == 5


def test_change_feed_from_text_keeps_dirty_lines(spark, tmp_path):
    feed, root = Feed(str(tmp_path / "in")), work_dir(spark, "text-feed")
    envelope = {k: v for k, v in change(0, "insert", "order_info", id=1).items() if k != "seq"}
    feed.add([{"seq": 1, "value": json.dumps(envelope)}, {"seq": 2, "value": "junk"}])
    rules = rule_frame(spark, ("order_info", "insert", "kafka", "t", "id", None, None))
    dims = dim_ledger(spark, f"{root}/dims")
    finish(change_feed_job(feed.stream(spark), lambda: rules, f"{root}/out", dims, f"{root}/ck"))
    out = spark.read.schema("topic string, value string").parquet(f"{root}/out")
    assert {(r.topic, r.value) for r in out.collect()} == {("t", '{"id":1}'), ("dirty_changes", "junk")}


def test_arrival_order_of_several_fields(spark, visit_feed):
    """Topics carry (timestamp, partition, offset) as the arrival position."""

    def positioned(lines):
        seq = F.struct(
            F.timestamp_millis(F.col("seq")).alias("timestamp"),
            (F.col("seq") % 3).cast("int").alias("partition"),
            F.col("seq").alias("offset"),
        )
        return page_rows(lines.withColumn("seq", seq))

    want = jumpouts_by_pattern(real(positioned(visit_feed.batch(spark))), 10_000)
    got = collect(spark, jumpouts_stream(positioned(visit_feed.stream(spark)), 10_000))
    columns = ["mid", "ts", "seq.offset", "reason"]
    assert bag(got.select(*columns)) == bag(want.select(*columns))


def test_join_state_is_evicted(spark, order_feeds):
    o, d = order_feeds
    for part in range(3, 6):  # later files move the watermark on
        base = 1_600_000_000_000 + part * 600_000
        o.add([order(1000 + part, base)])
        d.add([detail(1000 + part, 1000 + part, base)])
    rows = interval_join_stream(o.stream(spark), d.stream(spark), delay="60 seconds")
    q = finish(
        rows.writeStream.foreachBatch(lambda b, i: b.count()).option("checkpointLocation", work_dir(spark, "evict"))
    )
    assert q.lastProgress.stateOperators[0].numRowsTotal < 10


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    feed = Feed(str(tmp_path / "in"))
    feed.add([{"seq": 1, "value": line("a", 1_000_000)}])
    feed.add([{"seq": 2, "value": line("b", 9_000_000, "x")}])
    feed.add([{"seq": 3, "value": line("b", 9_100_000, "x")}])  # lateness follows one batch behind
    feed.add([{"seq": 4, "value": line("a", 1_001_000)}, {"seq": 5, "value": line("c", 9_100_000, "x")}])
    rows = jumpouts_stream(page_rows(feed.stream(spark)), 10_000)
    root, got = work_dir(spark, "late"), []
    q = finish(
        rows.writeStream.foreachBatch(lambda b, i: got.extend(r.seq for r in b.collect())).option(
            "checkpointLocation", root
        )
    )
    assert got == [1]
    assert sum(p.stateOperators[0].numRowsDroppedByWatermark for p in q.recentProgress) == 1


def test_sliced_stream_keeps_null_rows_and_splits_large_slices(spark, tmp_path):
    rows = [(n, None if n % 10 == 0 else n) for n in range(400)]
    spark.createDataFrame(rows, "id long, at long").coalesce(1).write.parquet(str(tmp_path / "sliced.parquet"))
    for file_bytes in (128 << 20, 100):
        stream = fx.sliced_stream(spark, str(tmp_path), "sliced", "at", file_bytes=file_bytes).withColumn("file", F.input_file_name())
        batches = []
        query = (
            stream.writeStream.trigger(availableNow=True)
            .option("checkpointLocation", str(tmp_path / f"checkpoint-{file_bytes}"))
            .foreachBatch(lambda df, _: batches.append(([r["id"] for r in df.collect()], df.select("file").distinct().count())))
            .start()
        )
        query.awaitTermination(60)
        assert sorted(i for ids, _ in batches for i in ids) == list(range(400))
        assert len(batches) == 4 and {n == 1 for _, n in batches} == {file_bytes > 100}


def test_slices_are_one_micro_batch_each_and_spread_over_files(spark, tmp_path):
    # of the first slice only two rows, fewer than its files
    rows = [(n, 0 if n < 2 else n, "x" * 20 + str(n * 7919)) for n in range(200_000)]
    spark.createDataFrame(rows, "id long, at long, t string").coalesce(1).write.parquet(str(tmp_path / "spread.parquet"))
    size = sum(f.stat().st_size for f in (tmp_path / "spread.parquet").glob("*.parquet"))
    for given in ({}, {"file_bytes": size // 12 + 1}):
        stream = fx.sliced_stream(spark, str(tmp_path), "spread", "at", limits=[2, 70_000, 130_000], **given)
        batches = []
        query = (
            stream.writeStream.trigger(availableNow=True)
            .option("checkpointLocation", str(tmp_path / f"checkpoint-spread-{len(given)}"))
            .foreachBatch(lambda df, _: batches.append((df.count(), df.agg(F.min("id")).first()[0], df.rdd.getNumPartitions())))
            .start()
        )
        query.awaitTermination(60)
        assert [(n, first) for n, first, _ in batches] == [(2, 0), (69_998, 2), (60_000, 70_000), (70_000, 130_000)]
    assert all(parts >= 3 for *_, parts in batches)


def test_default_slices_of_a_table_of_some_megabytes_use_several_cores(spark, tmp_path):
    wide = spark.range(150_000).select(F.col("id").alias("at"), F.concat(F.sha2(F.col("id").cast("string"), 256)).alias("t"))
    wide.coalesce(1).write.parquet(str(tmp_path / "megabytes.parquet"))
    parts = []
    query = (
        fx.sliced_stream(spark, str(tmp_path), "megabytes", "at").writeStream.trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "checkpoint-megabytes"))
        .foreachBatch(lambda df, _: parts.append(df.rdd.getNumPartitions()))
        .start()
    )
    query.awaitTermination(60)
    assert len(parts) == 4 and min(parts) > 1


def test_devices_of_a_bucket_share_their_state(spark, tmp_path):
    feed, start = Feed(str(tmp_path / "in")), 1_000_000
    lines = [line(f"m{n}", start + n % 50) for n in range(600)] + [line("z", start + 60, "x")]
    feed.add([{"seq": n, "value": text} for n, text in enumerate(lines)])
    feed.add([{"seq": 1000, "value": line("m7", start + 5_000)}, {"seq": 1001, "value": line("m8", start + 6_000, "x")}])
    feed.add([{"seq": 1002, "value": line("z", start + 100_000, "x")}])
    root, got = work_dir(spark, "buckets"), []
    rows = jumpouts_stream(page_rows(feed.stream(spark)), 10_000, buckets=4)
    q = finish(
        rows.writeStream.foreachBatch(lambda b, i: got.extend(tuple(r) for r in b.select("mid", "seq", "reason").collect())).option(
            "checkpointLocation", root
        )
    )
    want = jumpouts_by_pattern(page_rows(feed.batch(spark)), 10_000).select("mid", "seq", "reason").collect()
    assert sorted(got) == sorted(tuple(r) for r in want) and len(got) == 600
    timers = [p.stateOperators[0].customMetrics["numRegisteredTimers"] for p in q.recentProgress]
    # a timer for each bucket, slice and look at it, not for each device
    assert 0 < max(timers) <= 8
