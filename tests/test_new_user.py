import random

import pytest

from millrace.operators.newuser import first_lines, repair_new_flag
from millrace.session import work_dir
from millrace.streaming import newuser
from millrace.streaming.newuser import RECENT, bucket_of, device_ledger, met_before, repair_batch


@pytest.fixture(autouse=True)
def few_folders(monkeypatch):
    monkeypatch.setattr(newuser, "BUCKETS", 32)


def log(spark, rows):
    return spark.createDataFrame(rows, "mid string, seq bigint, is_new string")


def flags(df):
    return {(r.mid, r.seq): r.is_new for r in df.collect()}


def test_only_the_first_line_may_be_new(spark):
    rows = [("a", 1, "1"), ("a", 2, "1"), ("a", 3, "0"), ("b", 5, "0"), ("b", 9, "1"), ("c", 4, None)]
    got = flags(repair_new_flag(log(spark, rows)))
    assert got == {
        ("a", 1): "1",
        ("a", 2): "0",
        ("a", 3): "0",
        ("b", 5): "0",
        ("b", 9): "0",
        ("c", 4): None,
    }


def test_devices_seen_before_are_never_new(spark):
    seen = spark.createDataFrame([("a",)], "mid string")
    got = flags(repair_new_flag(log(spark, [("a", 1, "1"), ("b", 1, "1")]), seen=seen))
    assert got == {("a", 1): "0", ("b", 1): "1"}


def test_order_of_several_columns(spark):
    df = spark.createDataFrame(
        [("a", 5, 1, "1"), ("a", 5, 0, "1"), ("a", 4, 9, "1")], "mid string, ts bigint, seq bigint, is_new string"
    )
    got = {(r.ts, r.seq): r.is_new for r in repair_new_flag(df, order_by=("ts", "seq")).collect()}
    assert got == {(5, 1): "0", (5, 0): "0", (4, 9): "1"}


def test_row_order_does_not_matter_and_a_hot_device_is_combined_first(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 == 0 else f"m{i % 50}", i, rng.choice("01")) for i in range(3000)]
    firsts = {}
    for mid, seq, _ in rows:
        firsts.setdefault(mid, seq)
    want = {(m, s): "0" if f == "1" and firsts[m] != s else f for m, s, f in rows}
    rng.shuffle(rows)
    df = log(spark, rows)
    assert flags(repair_new_flag(df)) == want
    plan = first_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "SortAggregate" not in plan
    assert "Window" not in repair_new_flag(df)._jdf.queryExecution().executedPlan().toString()


def test_micro_batches_equal_one_batch(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 3 == 0 else rng.choice([None, *(f"m{k}" for k in range(30))]), i, rng.choice(["0", "1", None])) for i in range(600)]
    ledger, got = device_ledger(spark, work_dir(spark, "devices"), every=3), {}
    for n in range(8):
        part = log(spark, rows[n * 75 : (n + 1) * 75])
        got |= flags(repair_batch(part, n, ledger))
        # a replay finds what the first try wrote
        assert flags(repair_batch(part, n, ledger)) == flags(repair_batch(part, n, ledger))
    assert got == flags(repair_new_flag(log(spark, rows)))


def test_a_batch_reads_only_the_folders_of_devices_that_claim_to_be_new(spark):
    ledger = device_ledger(spark, work_dir(spark, "folders"), every=2)
    for n in range(4):
        repair_batch(log(spark, [(f"d{n}-{k}", k, "0") for k in range(500)]), n, ledger)
    asked = spark.createDataFrame([("d1-7",), ("new",)], "mid string").persist()
    met = met_before(ledger, 4, asked)
    assert [r.mid for r in met.collect()] == ["d1-7"]
    folders = {r["bucket"] for r in asked.select(bucket_of("mid").alias("bucket")).collect()} | {RECENT}
    known = ledger.before(4)
    read = known.where(known.bucket.isin(list(folders)))
    # a base row per device, spread over the folders; two of them are read
    assert known.count() == 2000 and read.count() < 250
    assert "bucket" in met._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_cost_of_a_batch_does_not_grow_with_the_batches(spark):
    """Rows read by the lookup: additions of the generation and two folders, after few batches as after many."""
    ledger, read = device_ledger(spark, work_dir(spark, "flat"), every=5), []
    for n in range(16):
        batch = log(spark, [(f"m{n * 40 + k}", k, "1" if k == 0 else "0") for k in range(40)])
        repair_batch(batch, n, ledger)
        folder = batch.where("seq = 0").select(bucket_of("mid")).first()[0]
        read.append(ledger.before(n + 1).where(f"bucket in ({RECENT}, {folder})").count())
    assert max(read[11:]) <= max(read[:8]) + 40 and ledger.before(16).count() == 640
