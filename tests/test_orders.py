import json
import random
from decimal import Decimal

from pyspark.sql import functions as F

from millrace.operators import orders as od


def texts(spark, *objects):
    return spark.createDataFrame([(json.dumps(o),) for o in objects], "value string")


def test_order_times_from_text_and_from_millis(spark):
    df = texts(
        spark,
        {"id": 1, "create_time": "2021-06-25 07:08:09", "total_amount": 1.50},
        {"id": 2, "create_time": 1624604889000},
        {"id": 3, "create_time": "junk"},
        {"id": 4},
        {"id": 5, "create_time": "2021-06-25 07:08:09.123"},
        {"id": 6, "create_time": "2021-06-25"},
    )
    got = {r.id: r for r in od.parse_orders(df).collect()}
    for i in (1, 2):
        r = got[i]
        assert (r.create_time, r.create_date, r.create_hour, r.create_ts) == (
            "2021-06-25 07:08:09", "2021-06-25", "07", 1624604889000,
        )
    assert got[1].total_amount == Decimal("1.50")
    assert [got[i].create_ts for i in (3, 4, 5, 6)] == [None, None, 1624604889000, None]


def frames(spark, orders, details):
    o = spark.createDataFrame(orders, "id bigint, create_ts bigint")
    d = spark.createDataFrame(details, "id bigint, order_id bigint, create_ts bigint")
    fill = lambda df, fields: df.select(
        "*", *[F.lit(None).cast(t).alias(n) for n, t in fields.items() if n not in df.columns]
    )
    o = fill(o, od.ORDER_FIELDS).withColumns({"create_date": F.lit(None), "create_hour": F.lit(None)})
    return o, fill(d, od.DETAIL_FIELDS)


def test_interval_ends_are_inclusive(spark):
    o, d = frames(
        spark,
        [(1, 100_000), (2, 100_000)],
        [(10, 1, 95_000), (11, 1, 105_000), (12, 1, 94_999), (13, 1, 105_001), (14, 3, 100_000)],
    )
    assert sorted(r.detail_id for r in od.interval_join(o, d).collect()) == [10, 11]


def test_interval_join_against_brute_force(spark):
    rng = random.Random(3)
    orders = [(rng.choice([0, 0, rng.randrange(20)]), rng.randrange(-500, 500)) for _ in range(150)]
    details = [(i, rng.choice([0, rng.randrange(20)]), rng.randrange(-500, 500)) for i in range(300)]
    want = sorted((o[0], d[0]) for o in orders for d in details if o[0] == d[1] and abs(o[1] - d[2]) <= 25)
    o, d = frames(spark, orders, details)
    for width in (None, 10, 25, 60):
        got = od.interval_join(o, d, 25, slice_ms=width)
        assert sorted((r.order_id, r.detail_id) for r in got.collect()) == want


def test_wide_columns_in_order(spark):
    o, d = frames(spark, [(1, 0)], [(1, 1, 0)])
    dims = {
        s.dim: spark.createDataFrame([], ", ".join(f"{c} string" for c in ["id", *s.columns]))
        for s in [*od.WIDE_DIMS, *od.SKU.then]
    }
    wide = od.enrich(od.interval_join(o, d), dims, "2024-01-01 00:00:00")
    assert wide.dtypes == list(od.WIDE_FIELDS.items()) and len(wide.columns) == 35
    assert wide.count() == 1


def test_merge_fills_only_missing_values(spark):
    schema = ", ".join(f"{n} {t}" for n, t in od.WIDE_FIELDS.items())
    row = dict.fromkeys(od.WIDE_FIELDS)
    a = spark.createDataFrame([tuple({**row, "order_id": 1, "order_status": "A"}.values())], schema)
    other = {**row, "order_id": 1, "order_status": "B", "user_id": 5, "split_total_amount": Decimal("1.00")}
    b = spark.createDataFrame([tuple(other.values())], schema)
    got = od.merge_wide(a, b, ["order_id"]).collect()[0]
    assert (got.order_status, got.user_id, got.split_total_amount) == ("A", 5, None)
