"""Batches appear whole or not at all, readers never meet them twice, and jobs hand over to any writer."""

import json
import os

import pytest
from pyspark.sql import functions as F

from millrace.plans.app_log import log_job
from millrace.plans.change_feed import change_feed_job, ods_job, pulled_rules_job
from millrace.plans.order_wide import order_rejects_job, order_wide_job, unmatched_orders_job
from millrace.plans.page_visits import jumpouts_job, page_rows, unique_visits_job
from millrace.session import work_dir
from millrace.sinks import topics
from millrace.sinks.topics import expire_batches, topic_files, write_topics
from millrace.streaming.dimensions import dim_ledger
from millrace.streaming.late import late_rows_job
from millrace.streaming.ledger import Ledger
from millrace.streaming.newuser import device_ledger
from millrace.streaming.snapshot import Snapshot
from tests.test_streaming import ENVELOPE, Feed, change, detail, finish, line, order, rule_frame

ROWS = "topic string, value string, seq bigint"


class Crash(Exception):
    pass


def test_a_chained_job_never_meets_an_unfinished_batch(spark, tmp_path, monkeypatch):
    feed, root = Feed(str(tmp_path / "in")), work_dir(spark, "crash")
    ledger, plain = device_ledger(spark, f"{root}/devices"), topics.publish_folder

    def first(**how):
        finish(log_job(feed.stream(spark), f"{root}/dwd", ledger, f"{root}/ck1", **how))

    def second():
        pages = topic_files(spark, f"{root}/dwd", "dwd_page_log", streaming=True, columns="value string, seq bigint")
        finish(unique_visits_job(pages, f"{root}/uv", f"{root}/ck2"))
        rows = topic_files(spark, f"{root}/uv", "dwm_unique_visit").collect()
        return sorted(json.loads(r.value)["common"]["mid"] for r in rows)

    feed.add([{"seq": n, "value": line(f"a{n}", 1_000_000 + n)} for n in range(5)])
    first()
    assert second() == [f"a{n}" for n in range(5)]
    feed.add([{"seq": 10 + n, "value": line(f"b{n}", 1_100_000 + n)} for n in range(5)])

    def crash(spark, staged, path):
        raise Crash(path)

    # the first job dies with its files written, before they are in place
    monkeypatch.setattr(topics, "publish_folder", crash)
    with pytest.raises(Exception, match="Crash"):
        first()
    assert os.path.exists(f"{root}/dwd/_staging/batch_id=1/_SUCCESS") and not os.path.exists(f"{root}/dwd/batch_id=1")
    monkeypatch.setattr(topics, "publish_folder", plain)
    assert second() == [f"a{n}" for n in range(5)]
    # it starts again and replays the batch: the reader gets each line once
    first()
    first()
    assert second() == sorted([f"a{n}" for n in range(5)] + [f"b{n}" for n in range(5)])


def test_a_batch_in_its_place_is_left_alone(spark):
    root = work_dir(spark, "placed")
    rows = lambda v: spark.createDataFrame([("t", v, 1), ("u", v, 2)], ROWS)
    write_topics(rows("first"), root, 0)
    write_topics(rows("again"), root, 0)
    assert {r.value for r in topic_files(spark, root, "t").collect()} == {"first"}
    # what a job that did not stage left unfinished is replaced
    spark.range(3).write.parquet(f"{root}/batch_id=1/topic=t")
    os.remove(f"{root}/batch_id=1/topic=t/_SUCCESS")
    write_topics(rows("second"), root, 1)
    write_topics(spark.createDataFrame([], ROWS), root, 2)
    assert sorted(r.value for r in topic_files(spark, root, "t").collect()) == ["first", "second"]
    assert expire_batches(spark, root, 1) == [0] and expire_batches(spark, root, 1) == []
    assert [r.value for r in topic_files(spark, root, "u").collect()] == ["second"]


def test_generations_that_are_folded_can_go(spark):
    ledger = Ledger(spark, work_dir(spark, "expire"), "k bigint", every=2)
    for n in range(5):
        ledger.append(n, spark.createDataFrame([(n,)], "k bigint"))
    assert sorted(ledger.expire(4)) == ["gen=0", "gen=1"] and ledger.expire(4) == []
    assert sorted(r.k for r in ledger.upto(4).collect()) == [0, 1, 2, 3, 4]


def test_every_job_takes_a_writer(spark, tmp_path):
    root, got = work_dir(spark, "writers"), {}

    def recording(name):
        got[name] = []
        return lambda outputs, batch_id: got[name].extend((batch_id, r.topic) for r in outputs.select("topic").collect())

    lines, changes, records = Feed(str(tmp_path / "l")), Feed(str(tmp_path / "c"), ENVELOPE), Feed(str(tmp_path / "r"), ROWS)
    o, d = Feed(str(tmp_path / "o"), "value string"), Feed(str(tmp_path / "d"), "value string")
    base = 1_600_000_000_000
    for n in range(3):
        lines.add([{"seq": n, "value": line("a", base - n * 86_400_000 * 30)}, {"seq": 10 + n, "value": line("z", base + n * 86_400_000)}])
    changes.add([change(1, "insert", "a", id=1)])
    records.add([{"topic": "s.db.t", "seq": 1, "value": json.dumps({"op": "c", "after": {"id": 1}})}])
    o.add([order(1, base), {"value": "x"}])
    d.add([detail(1, 1, base)])
    for k in (1, 2):
        o.add([order(90 + k, base + k * 10_000_000)])
        d.add([detail(90 + k, 0, base + k * 10_000_000)])
    rules = rule_frame(spark, ("a", "insert", "kafka", "t_a", "id", None, None))
    dims = {
        name: Snapshot(lambda c=columns: spark.createDataFrame([], ", ".join(f"{x} string" for x in c)), 0)
        for name, columns in {
            "dim_user_info": ["id", "gender", "birthday"], "dim_base_province": ["id", "name", "area_code", "iso_code", "iso_3166_2"],
            "dim_sku_info": ["id", "tm_id", "category3_id", "spu_id"], "dim_base_trademark": ["id", "tm_name"],
            "dim_base_category3": ["id", "name"], "dim_spu_info": ["id", "spu_name"],
        }.items()
    }
    at = lambda name: (f"{root}/{name}", f"{root}/{name}-ck")
    jobs = {
        "log": lambda w: log_job(lines.stream(spark), at("log")[0], device_ledger(spark, f"{root}/dev"), at("log")[1], writer=w),
        "ods": lambda w: ods_job(records.stream(spark), *at("ods"), writer=w),
        "feed": lambda w: change_feed_job(changes.stream(spark), lambda: rules, at("feed")[0], dim_ledger(spark, f"{root}/dims"), at("feed")[1], writer=w),
        "pulled": lambda w: pulled_rules_job(changes.stream(spark), Snapshot(lambda: rules, 20), *at("pulled"), writer=w),
        "uv": lambda w: unique_visits_job(lines.stream(spark), *at("uv"), writer=w),
        "jump": lambda w: jumpouts_job(lines.stream(spark), *at("jump"), by_windows=True, writer=w),
        "wide": lambda w: order_wide_job(o.stream(spark), d.stream(spark), dims, *at("wide"), writer=w),
        "rejects": lambda w: order_rejects_job(o.stream(spark), d.stream(spark), *at("rejects"), writer=w),
        "unmatched": lambda w: unmatched_orders_job(o.stream(spark), d.stream(spark), *at("unmatched"), writer=w),
        "late": lambda w: late_rows_job(page_rows(lines.stream(spark)), *at("late"), writer=w),
    }
    for name, job in jobs.items():
        finish(job(recording(name)))
        assert not os.path.exists(f"{root}/{name}"), name
    names = {name: {topic for _, topic in rows} for name, rows in got.items()}
    assert names == {
        "log": {"dwd_page_log"}, "ods": {"ods_base_db"}, "feed": {"t_a"}, "pulled": {"t_a"}, "uv": {"dwm_unique_visit"},
        "jump": {"dwm_user_jump_out"}, "wide": {"dwm_order_wide"}, "rejects": {"dirty_orders"}, "unmatched": {"unmatched_orders"},
        "late": {"late_rows"},
    }


def test_kafka_writer_sends_the_topic_of_each_row(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(topics, "write_kafka", lambda outputs, servers: sent.append((servers, outputs.columns)))
    topics.kafka_writer("host:1")(spark.createDataFrame([("t", "v")], "topic string, value string").withColumn("x", F.lit(1)), 3)
    assert sent == [("host:1", ["topic", "value", "x"])]
