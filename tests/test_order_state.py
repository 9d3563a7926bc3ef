"""The keyed state of the order streams: what Spark's stream-stream join gives, in an entry per group of rows."""

import json
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_streaming import Feed, bag, collect, detail, finish, order

from millrace.operators.orders import interval_join, parse_details, parse_orders, unmatched_orders
from millrace.session import state_settings, work_dir
from millrace.streaming import orders as so

BASE = 1_600_000_000_000


@pytest.fixture()
def feeds(tmp_path):
    """Four files a side: repeated orders, a busy order, late rows, rows without key or time."""
    rng = random.Random(4)
    o, d = Feed(str(tmp_path / "o"), "value string"), Feed(str(tmp_path / "d"), "value string")
    for part in range(4):
        start = BASE + part * 100_000
        ids = [part * 30 + i for i in range(30)] + [part * 30] * 2
        rows = [order(i, start + rng.randrange(40) * 1000) for i in ids]
        lines = [
            detail(part * 100 + i, part * 30 + (0 if i % 3 else rng.randrange(30)), start + rng.randrange(-6, 46) * 1000)
            for i in range(90)
        ]
        if part > 1:  # later than the watermark of the batch before
            rows += [order(9000 + part, BASE + 1000), order(1, BASE + 20_000)]
            lines += [detail(9000 + part, 1, BASE + 20_000), detail(9100 + part, 9000 + part, BASE + 1000)]
        odd = {"id": None, "order_id": None, "create_time": str(start)}
        o.add([*rows, {"value": json.dumps(odd)}, {"value": json.dumps({"id": 7})}])
        d.add([*lines, {"value": json.dumps(odd)}, {"value": json.dumps({"id": 8, "order_id": 7})}])
    return o, d


def test_rows_are_those_of_the_stream_stream_join(spark, feeds):
    o, d = feeds
    parsed = [so.watermarked(parse(f.stream(spark))) for parse, f in ((parse_orders, o), (parse_details, d))]
    pairs = so.interval_join_stream(o.stream(spark), d.stream(spark), buckets=4)
    alone = so.unmatched_orders_stream(o.stream(spark), d.stream(spark), buckets=4)
    with state_settings(spark, partitions=1):
        want = bag(collect(spark, interval_join(*parsed)))
        assert bag(collect(spark, pairs)) == want and len(want) > 100
        want = bag(collect(spark, unmatched_orders(*parsed).select(*alone.columns)))
        assert bag(collect(spark, alone)) == want and len(want) > 0


def test_orders_of_a_bucket_share_their_state(spark, tmp_path):
    o, d = Feed(str(tmp_path / "o"), "value string"), Feed(str(tmp_path / "d"), "value string")
    o.add([order(i, BASE) for i in range(300)])
    d.add([detail(i, i % 300, BASE + 1000) for i in range(900)])
    for form in (so.interval_join_stream, so.unmatched_orders_stream):
        rows = form(o.stream(spark), d.stream(spark), buckets=4)
        counted = []
        writer = rows.writeStream.foreachBatch(lambda b, _, counted=counted: counted.append(b.count()))
        q = finish(writer.option("checkpointLocation", work_dir(spark, "share")))
        held = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
        # an entry per bucket and slice, not per row
        assert 0 < max(held) <= 8
        assert sum(counted) == (900 if form is so.interval_join_stream else 0)


def test_rows_far_from_today_are_matched(spark, tmp_path):
    o, d = Feed(str(tmp_path / "o"), "value string"), Feed(str(tmp_path / "d"), "value string")
    far = "9999-12-31 00:00:00"
    o.add([{"value": json.dumps({"id": 1, "create_time": far})}, order(2, BASE)])
    d.add([{"value": json.dumps({"id": 5, "order_id": 1, "create_time": far})}, detail(6, 2, BASE)])
    got = collect(spark, so.interval_join_stream(o.stream(spark), d.stream(spark)))
    assert sorted((r.order_id, r.create_time[:4]) for r in got.collect()) == [(1, "9999"), (2, "2020")]


def test_packed_rows_come_back_as_they_were(spark):
    odd = [None, "", "\\", "\\N", "\\s", "\\b", "a\x1fb", "\\\x1f\\b\\N", "\x1f", "é\n"]
    rows = spark.createDataFrame([(i, t, odd[-i]) for i, t in enumerate(odd)], "id bigint, a string, b string").select(
        "*",
        F.when(F.col("id") != 3, F.expr("cast(id * 1.01 as decimal(16,2))")).alias("c"),
        F.struct("id", F.timestamp_micros(F.col("id") * 1_234_567 + 1).alias("at")).alias("seq"),
    )
    fields = dict(rows.dtypes)
    packed = rows.select(so._packed(fields).alias("t"))
    assert bag(packed.select(so._unpacked("t", fields).alias("r")).select("r.*")) == bag(rows)


class Held:
    """Stands in for the state of a group."""

    def __init__(self):
        self.get, self.exists, self.hasTimedOut, self.watermark = None, False, False, 0

    def update(self, value):
        self.get, self.exists = value, True

    def remove(self):
        self.get, self.exists = None, False

    def getCurrentWatermarkMs(self):  # noqa: N802
        return self.watermark

    def setTimeoutTimestamp(self, at):  # noqa: N802
        assert at >= self.watermark


def test_a_busy_order_is_matched_in_pieces(monkeypatch):
    monkeypatch.setattr(so, "PAIRS_AT_ONCE", 100)
    rng, state, bound = random.Random(2), Held(), 50
    seen, got, sizes, alone_state, alone = [], [], [], Held(), []
    for batch in range(3):
        rows = [
            (rng.random() < 0.4, rng.choice([0, 0, rng.randrange(6)]), 1000 + batch * 60 + rng.randrange(100), f"{batch}-{i}")
            for i in range(120)
        ]
        chunk = pd.DataFrame(rows, columns=["is_order", "id", "ts", "text"])
        chunk["is_order"] = chunk["is_order"].to_numpy(np.bool_)
        seen += rows
        for pairs in so.PairsOfGroup(bound)((0,), iter([chunk[:50], chunk[50:]]), state):
            sizes.append(len(pairs))
            got += list(zip(pairs["o"], pairs["d"], strict=True))
        for some in so.AloneInGroup(bound)((0,), iter([chunk]), alone_state):
            alone += list(some["o"])
    want = [(a[3], b[3]) for a in seen for b in seen if a[0] and not b[0] and a[1] == b[1] and abs(a[2] - b[2]) <= bound]
    assert sorted(got) == sorted(want) and max(sizes) <= 100 < len(want)
    alone_state.hasTimedOut, alone_state.watermark = True, 10_000
    for some in so.AloneInGroup(bound)((0,), iter([chunk[:0]]), alone_state):
        alone += list(some["o"])
    met = {a for a, _ in want}
    assert sorted(alone) == sorted(t for is_order, _, _, t in seen if is_order and t not in met)
    assert not alone_state.exists
