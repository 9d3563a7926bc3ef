"""Snapshot and changes: whatever the moment of reading, the state after all is the state of the whole log."""

import json
import random

import pytest

from millrace.operators.changefeed import ENVELOPE
from millrace.operators.startup import changes_after, initial_changes, snapshot_rows
from millrace.plans.change_feed import ods_job
from millrace.session import work_dir
from millrace.sinks.topics import topic_files
from millrace.sources.changes import read_records
from tests.test_streaming import Feed, finish

SCHEMA = "seq bigint, type string, data string, before string, database string, tableName string"
FENCE = "database string, tableName string, low bigint, high bigint"


def row(seq, op, new, old=None, table="t"):
    return (seq, op, json.dumps(new) if new else "{}", json.dumps(old) if old else "{}", "db", table)


def history(seed, n):
    """A log over keys (a, b), one of them hot, and the table after every position."""
    rng, table, log, states = random.Random(seed), {}, [], [{}]
    for seq in range(1, n + 1):
        key = (0, "hot") if rng.random() < 0.3 else (rng.randrange(9), rng.choice("xy"))
        image = {"a": key[0], "b": key[1], "v": seq}
        old = table.get(key)
        if old is None:
            log.append(row(seq, "insert", image))
            table[key] = image
        elif rng.random() < 0.3:
            log.append(row(seq, "delete", None, old))
            del table[key]
        elif rng.random() < 0.2 and (99, key[1]) not in table:
            moved = {**image, "a": 99}
            log.append(row(seq, "update", moved, old))
            del table[key]
            table[99, key[1]] = moved
        else:
            log.append(row(seq, "update", image, old))
            table[key] = image
        states.append(dict(table))
    return log, states


def fold(rows):
    """The table the rows leave, applied in order; a repeat or a gap would show as a wrong value."""
    table = {}
    for _, op, data, before, *_ in sorted(rows, key=lambda r: (r[0], r[1] != "read")):
        new, old = json.loads(data), json.loads(before)
        if old:
            table.pop((old["a"], old["b"]), None)
        if new:
            assert op != "insert" or (new["a"], new["b"]) not in table
            table[new["a"], new["b"]] = new
    return table


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_state_after_all_is_that_of_the_whole_log(spark, seed):
    log, states = history(seed, 90)
    low, high = 30, 60
    rng = random.Random(seed)
    # every row is read at a moment of its own between the fences
    seen = {}
    for key in sorted({k for s in states for k in s}):
        image = states[rng.randint(low, high)].get(key)
        if image:
            seen[key] = image
    snapshot = spark.createDataFrame([row(0, "read", image) for image in seen.values()], SCHEMA)
    changes = spark.createDataFrame([*log, row(5, "insert", {"a": 1, "b": "x"}, table="other")], SCHEMA)
    fences = spark.createDataFrame([("db", "t", low, high)], FENCE)
    got = initial_changes(snapshot, changes, fences, {"t": ("a", "b")})
    rows = [tuple(r) for r in got.select(*SCHEMA_COLUMNS).collect()]
    assert [r for r in rows if r[5] == "other"] == [(5, "insert", '{"a": 1, "b": "x"}', "{}", "db", "other")]
    assert fold([r for r in rows if r[5] == "t"]) == states[-1]
    assert all(r[0] > low for r in rows if r[5] == "t" and r[1] != "read")
    assert snapshot_rows(snapshot.where("false"), changes, fences, {}).count() == 0
    assert changes_after(changes, fences.where("false")).count() == len(log) + 1


SCHEMA_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def test_the_job_starts_from_a_snapshot_and_goes_on(spark, tmp_path):
    feed, root = Feed(str(tmp_path / "in"), "topic string, seq bigint, value string"), work_dir(spark, "initial")
    record = lambda seq, k, v: {"topic": "s.db.t", "seq": seq, "value": json.dumps({"op": "u", "after": {"id": k, "v": v}})}
    feed.add([record(1, 1, "a"), record(5, 2, "b")])
    snapshot = spark.createDataFrame([row(0, "read", {"id": k, "v": "s"}) for k in (1, 2, 3)], SCHEMA)
    log = spark.createDataFrame([row(5, "update", {"id": 2, "v": "b"})], SCHEMA)
    fences = spark.createDataFrame([("db", "t", 2, 6)], FENCE)

    def run():
        finish(
            ods_job(
                feed.stream(spark), f"{root}/ods", f"{root}/ck", ["db.t"],
                first=lambda: snapshot_rows(snapshot, log, fences, {}), fences=fences,
            )
        )

    run()
    feed.add([record(8, 1, "c"), {"topic": "s.db.t", "seq": 9, "value": "junk"}])
    run()
    rows = [json.loads(r.value) for r in topic_files(spark, f"{root}/ods", "ods_base_db").collect()]
    assert sorted((r["type"], r["data"]) for r in rows) == [
        ("read", '{"id": 1, "v": "s"}'), ("read", '{"id": 3, "v": "s"}'), ("update", '{"id":1,"v":"c"}'), ("update", '{"id":2,"v":"b"}'),
    ]
    assert [r.value for r in topic_files(spark, f"{root}/ods", "dirty_changes").collect()] == ["junk"]


def test_records_that_cannot_be_read_are_kept_by_the_source(spark):
    good = json.dumps({"op": "c", "after": {"id": 1}})
    rows = [("s.db.t", 1, good), ("s.db.t", 2, "junk"), ("s.db.u", 3, good), (None, 4, "{}")]
    records = spark.createDataFrame(rows, "topic string, seq bigint, value string")
    kept = read_records(records, ["db.t"])
    assert sorted((r["seq"], r["dirty_reason"], r["value"]) for r in kept.collect() if r["dirty_reason"]) == [
        (2, "not_json", "junk"), (4, "no_operation", "{}"),
    ]
    assert sorted(r["seq"] for r in kept.collect()) == [1, 2, 4]
    plain = read_records(records, ["db.t"], keep_dirty=False)
    assert plain.columns == ["seq", *ENVELOPE] and [r["seq"] for r in plain.collect()] == [1]
