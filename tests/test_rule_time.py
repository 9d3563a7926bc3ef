"""Routing by the rule valid at arrival, against a plain replay of both logs."""

import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import routing
from millrace.operators.ruletime import match_asof, route_changes_asof, rule_versions

LOG = "seq bigint, type string, data string, before string"
CHANGE = "seq bigint, tableName string, type string, data string, note string"


def rule(table, op, sink, columns="id", kind="kafka"):
    return {"source_table": table, "operate_type": op, "sink_type": kind, "sink_table": sink, "sink_columns": columns}


def logs(seed, n_rules, n_changes):
    """One table owns a third of the changes; rules are written, deleted and moved all the time."""
    rng = random.Random(seed)
    tables = ["hot", "a", "b", "c"]
    rule_log, span = [], 10 * n_changes
    for n, seq in enumerate(sorted(rng.sample(range(0, span, 2), n_rules))):
        table, op = rng.choice(tables), rng.choice(["insert", "update"])
        one, kind = rule(table, op, f"s{n}"), rng.random()
        if kind < 0.6:
            rule_log.append((seq, "insert", one, None))
        elif kind < 0.75:
            rule_log.append((seq, "delete", None, one))
        else:
            rule_log.append((seq, "update", rule(rng.choice(tables), rng.choice(["insert", "update"]), f"s{n}"), one))
    changes = []
    for _ in range(n_changes):
        table = "hot" if rng.random() < 0.34 else rng.choice([*tables, "none", None])
        changes.append((rng.choice([rng.randrange(span), rng.randrange(span), None]), table, rng.choice(["insert", "update", "delete"])))
    changes += [(r[0], "hot", "insert") for r in rule_log[:20]]
    return rule_log, changes


def replay(rule_log, changes):
    """Both logs in order of arrival; at one position the change comes first."""
    events = [(seq, 1, n) for n, (seq, *_) in enumerate(rule_log)]
    events += [(seq, 0, n) for n, (seq, *_) in enumerate(changes) if seq is not None]
    live, out = {}, [(*c, None) for c in changes]
    for _, kind, n in sorted(events):
        if kind == 0:
            _, table, op = changes[n]
            out[n] = (*changes[n], live.get((table, op)))
            continue
        _, type_, after, before = rule_log[n]
        if type_ in ("delete", "update") and before:
            live.pop((before["source_table"], before["operate_type"]), None)
        if after:
            live[after["source_table"], after["operate_type"]] = after["sink_table"]
    return sorted(out, key=str)


def frames(spark, rule_log, changes):
    texts = [(seq, t, *(json.dumps(x) if x else "{}" for x in (after, before))) for seq, t, after, before in rule_log]
    rows = [(seq, table, op, '{"id":1,"x":2}', "kept") for seq, table, op in changes]
    return spark.createDataFrame(texts, LOG), spark.createDataFrame(rows, CHANGE).repartition(3)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("way", [{}, {"limit": 0, "slices": 7}, {"limit": 0, "slices": 1}])
def test_each_change_meets_the_rule_of_its_time(spark, seed, way):
    rule_log, changes = logs(seed, 120, 400)
    log, feed = frames(spark, rule_log, changes)
    got = match_asof(feed, rule_versions(log), **way)
    assert set(feed.columns) < set(got.columns) and "valid_from" not in got.columns
    rows = sorted(((r["seq"], r["tableName"], r["type"], r["sink_table"]) for r in got.collect()), key=str)
    assert rows == replay(rule_log, changes)
    assert {r[3] is None for r in rows} == {True, False}


def test_versions_end_where_the_next_write_is(spark):
    rule_log = [
        (10, "insert", rule("a", "insert", "s1"), None),
        (20, "insert", rule("a", "insert", "s2"), None),
        (30, "update", rule("b", "insert", "s3"), rule("a", "insert", "s2")),
        (30, "insert", rule("a", "insert", "s4"), None),
        (40, "delete", None, rule("a", "insert", "s4")),
    ]
    log, _ = frames(spark, rule_log, [])
    got = {(r["sink_table"], r["valid_from"], r["valid_to"]) for r in rule_versions(log).collect()}
    assert got == {("s1", 10, 20), ("s2", 20, 30), ("s3", 30, None), ("s4", 30, 40)}


def test_empty_logs(spark):
    log, feed = frames(spark, [], [(1, "a", "insert")])
    for way in ({}, {"limit": 0}):
        assert [r["sink_table"] for r in match_asof(feed, rule_versions(log), **way).collect()] == [None]
        assert match_asof(feed.where("false"), rule_versions(log), **way).count() == 0


def test_routes_prune_by_the_rule_of_the_time(spark):
    rule_log = [
        (10, "insert", rule("a", "insert", "s1", "id"), None),
        (20, "insert", rule("a", "insert", "d1", "x", "hbase"), None),
        (30, "delete", None, rule("a", "insert", "d1")),
    ]
    log, feed = frames(spark, rule_log, [(n, "a", "insert") for n in (5, 10, 11, 20, 21, 31)])
    got = route_changes_asof(feed, rule_versions(log)).orderBy("seq")
    rows = [(r["seq"], r["route"], r["sink_table"], r["fields"]) for r in got.withColumn("fields", F.map_keys("data")).collect()]
    assert [r[1] for r in rows] == [routing.UNROUTED, routing.UNROUTED, routing.FACT, routing.FACT, routing.DIM, routing.UNROUTED]
    assert rows[2][3] == ["id"] and sorted(rows[4][3]) == ["id", "x"]


def test_a_hot_table_is_spread_over_the_slices(spark):
    rule_log, changes = logs(5, 60, 600)
    log, feed = frames(spark, rule_log, [(n, "hot", "insert") for n in range(3000)])
    matched = match_asof(feed, rule_versions(log), limit=0, slices=16)
    plan = matched._jdf.queryExecution().executedPlan().toString()
    assert "_slice" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert matched.count() == 3000
