"""Nothing is lost without a trace: dirty records, unmatched orders, late rows."""

import json
import random

from pyspark.sql import functions as F

from millrace.operators.orders import dirty_records, parse_details, parse_orders, unmatched_orders
from millrace.plans.order_wide import order_rejects_job, unmatched_orders_job
from millrace.plans.page_visits import page_rows
from millrace.session import work_dir
from millrace.sinks.topics import topic_files
from millrace.streaming.jumpout import jumpouts_stream
from millrace.streaming.late import late_rows_job
from tests.test_streaming import Feed, detail, finish, line, order

TEXT = "value string"
BAD = {
    '{"id":1,"crea': "not_json_object",
    "": "not_json_object",
    "[1]": "not_json_object",
    '{"user_id":1,"create_time":"2020-01-01 00:00:00"}': "no_key",
    '{"id":7,"order_id":1}': "no_time",
    '{"id":8,"order_id":1,"create_time":"soon"}': "no_time",
}


def test_dirty_records_keep_their_text(spark):
    good = order(1, 1_600_000_000_000)["value"]
    rows = spark.createDataFrame([(t, n) for n, t in enumerate([*BAD, None, good])], "value string, seq bigint")
    parsed = parse_orders(rows, keep_dirty=True)
    assert {r["value"]: r["reason"] for r in dirty_records(parsed).collect()} == {**BAD, None: "not_json_object"}
    clean = parsed.where("dirty_reason is null").collect()
    assert [(r["id"], r["value"]) for r in clean] == [(1, None)]
    # without the side output what is no object is dropped, the rest passes with nulls
    assert sorted(r["seq"] for r in parse_orders(rows).collect()) == [3, 4, 5, 7]
    lacking = spark.createDataFrame([('{"id":1,"create_time":"2020-01-01 00:00:00"}',)], TEXT)
    assert dirty_records(parse_details(lacking, keep_dirty=True)).first()["reason"] == "no_key"


def test_rejects_of_both_inputs_reach_one_topic(spark, tmp_path):
    o, d, root = Feed(str(tmp_path / "o"), TEXT), Feed(str(tmp_path / "d"), TEXT), work_dir(spark, "rejects")
    o.add([order(1, 1_600_000_000_000), {"value": "x"}])
    d.add([{"value": "{}"}, detail(1, 1, 1_600_000_000_000)])
    for _ in range(2):  # a second run finds nothing new
        finish(order_rejects_job(o.stream(spark), d.stream(spark), f"{root}/out", f"{root}/ck"))
    rows = topic_files(spark, f"{root}/out", "dirty_orders", columns="value string, reason string, kind string").collect()
    assert sorted(tuple(r) for r in rows) == [("x", "not_json_object", "order"), ("{}", "no_key", "detail")]


def feeds(tmp_path, seed=2):
    rng, base = random.Random(seed), 1_600_000_000_000
    o, d, orders, details = Feed(str(tmp_path / "o"), TEXT), Feed(str(tmp_path / "d"), TEXT), [], []
    for part in range(3):
        some = [(part * 40 + k, base + part * 100_000 + k * 1000) for k in range(40)]
        # a third of the details are one order's; others lie on, within and beyond the bound
        lines = [(i, some[0][0] if i % 3 == 0 else rng.choice(some)[0], base + part * 100_000 + rng.randrange(45) * 1000) for i in range(60)]
        o.add([order(*x) for x in some])
        d.add([detail(*x) for x in lines])
        orders += some
        details += lines
    near = {n for n, at in orders if any(k == n and abs(t - at) <= 5000 for _, k, t in details)}
    return o, d, orders, {n for n, _ in orders} - near


def test_unmatched_orders_come_out_once(spark, tmp_path):
    o, d, orders, want = feeds(tmp_path)
    batch = unmatched_orders(parse_orders(o.batch(spark)), parse_details(d.batch(spark)))
    assert sorted(r["id"] for r in batch.collect()) == sorted(want) and 0 < len(want) < len(orders)
    root, late = work_dir(spark, "unmatched"), max(at for _, at in orders) + 10_000_000
    o.add([order(9999, late)])
    d.add([detail(9999, 9999, late)])
    job = unmatched_orders_job(o.stream(spark), d.stream(spark), f"{root}/out", f"{root}/ck", delay="60 seconds")
    finish(job)
    got = [json.loads(r.value)["id"] for r in topic_files(spark, f"{root}/out", "unmatched_orders").collect()]
    assert sorted(got) == sorted(want)


def test_late_rows_are_those_that_the_operator_drops(spark, tmp_path):
    rng, feed, tops, want = random.Random(6), Feed(str(tmp_path / "in")), [], []
    for part in range(4):
        some = []
        for n in range(30):
            # in the middle of the slices of 160 s, so that the operator holds one copy of each
            ts = (100 * part + rng.randrange(-150, 100)) * 160_000 + 50_000_000_000 - 50_000_000_000 % 160_000 + 80_000
            seq = part * 100 + n
            some.append((seq, ts))
            if part > 1 and ts <= max(tops[: part - 1]) - 1000:
                want.append(seq)
        feed.add([{"seq": s, "value": line("hot" if s % 3 == 0 else f"m{s}", t)} for s, t in some])
        tops.append(max(t for _, t in some))
    root = work_dir(spark, "late")
    finish(late_rows_job(page_rows(feed.stream(spark)), f"{root}/out", f"{root}/ck"))
    late = topic_files(spark, f"{root}/out", "late_rows", columns="value string, watermark bigint, seq bigint")
    assert sorted(r["seq"] for r in late.collect()) == sorted(want) and want
    assert late.where(F.get_json_object("value", "$.ts").cast("bigint") > F.col("watermark")).count() == 0
    jumps = jumpouts_stream(page_rows(feed.stream(spark)), 10_000)
    q = finish(jumps.writeStream.foreachBatch(lambda b, _: b.count()).option("checkpointLocation", f"{root}/ck2"))
    assert sum(p.stateOperators[0].numRowsDroppedByWatermark for p in q.recentProgress if p.stateOperators) == len(want)
