import json

from pyspark.sql import functions as F

from millrace.operators import changefeed as cf
from millrace.operators import routing
from millrace.plans.change_feed import changes_routed

RULES = [
    ("order_info", "insert", "kafka", "dwd_order_info", "id,amount", None, None),
    ("user_info", "insert", "hbase", "dim_user_info", "id,name", None, None),
    ("user_info", "update", "hbase", "dim_user_info", "id, name", None, None),
]
RULE_SCHEMA = ", ".join(f"{c} string" for c in routing.RULE_COLUMNS)


def rules(spark, rows=RULES):
    return spark.createDataFrame(rows, RULE_SCHEMA)


def records(spark, *items):
    rows = [(i, f"server.shop.{t}", json.dumps(v)) for i, (t, v) in enumerate(items)]
    return spark.createDataFrame(rows, "seq bigint, topic string, value string")


def test_normalise_operations_and_images(spark):
    row = {"id": 1, "amount": 1.5, "note": None}
    df = records(
        spark,
        ("order_info", {"op": "c", "before": None, "after": row}),
        ("order_info", {"op": "u", "before": row, "after": {**row, "id": 2}}),
        ("order_info", {"op": "d", "before": row, "after": None}),
        ("order_info", {"op": "r", "after": row}),
        ("order_info", {"op": "CREATE", "after": row}),
        ("order_info", {"payload": {"op": "c", "before": None, "after": row}}),
    )
    got = {r.seq: r for r in cf.normalise(df).collect()}
    assert [got[i].type for i in range(6)] == ["insert", "update", "delete", "read", "insert", "insert"]
    assert json.loads(got[0].data) == row and got[0].before == "{}"
    assert json.loads(got[1].before) == row and json.loads(got[1].data)["id"] == 2
    assert got[2].data == "{}" and json.loads(got[5].data) == row
    assert (got[0].database, got[0].tableName) == ("shop", "order_info")
    again = cf.decode_envelope(cf.encode_envelope(cf.normalise(df)).select("seq", "value"))
    assert {r.seq: r.data for r in again.collect()} == {i: r.data for i, r in got.items()}


def test_dirty_envelope_text(spark):
    df = spark.createDataFrame([(1, '{"type":"insert","data":"{}"}'), (2, "junk"), (3, None)], "seq bigint, value string")
    assert [r.seq for r in cf.decode_envelope(df).collect()] == [1]
    kept = {r.seq: (r.type, r.value, r.dirty_reason) for r in cf.decode_envelope(df, keep_dirty=True).collect()}
    assert kept == {
        1: ("insert", None, None),
        2: (None, "junk", "not_json_object"),
        3: (None, None, "not_json_object"),
    }


def test_empty_images_and_options(spark):
    row = {"id": 1}
    df = cf.normalise(
        records(
            spark,
            ("t", {"op": "c", "after": row}),
            ("t", {"op": "d", "before": row, "after": None}),
            ("t", {"op": "r", "after": row}),
        )
    )
    assert {r.seq for r in cf.nonempty(df).collect()} == {0, 2}
    kept = {r.seq: (r.type, r.data) for r in cf.nonempty(df, True, True).collect()}
    assert kept == {0: ("insert", '{"id":1}'), 1: ("delete", '{"id":1}'), 2: ("insert", '{"id":1}')}
    null_image = df.withColumn("data", F.lit(None).cast("string"))
    assert cf.nonempty(null_image).count() == 0


def test_table_filter(spark):
    df = cf.normalise(records(spark, ("a", {"op": "c", "after": {}}), ("b", {"op": "c", "after": {}})))
    assert [r.tableName for r in cf.only_tables(df, ["shop.b"]).collect()] == ["b"]
    assert cf.only_tables(df).count() == 2


def test_routing_prunes_and_keeps_types_and_nulls(spark):
    df = cf.normalise(
        records(
            spark,
            ("order_info", {"op": "c", "after": {"id": 1, "amount": None, "x": 2}}),
            ("user_info", {"op": "c", "after": {"id": 7, "name": "o'b", "age": 3}}),
            ("user_info", {"op": "u", "after": {"id": 7, "name": "new"}}),
            ("other", {"op": "c", "after": {"id": 9}}),
        )
    )
    routed = changes_routed(df, rules(spark))
    got = {r.seq: (r.route, json.loads(r.j)) for r in routed.select("seq", "route", F.to_json("data").alias("j")).collect()}
    assert got == {
        0: ("fact", {"id": 1, "amount": None}),
        1: ("dim", {"id": 7, "name": "o'b"}),
        2: ("dim", {"id": 7}),  # "id, name" names the column " name"
        3: ("unrouted", {"id": 9}),
    }
    facts = routing.routed_records(routed, routing.FACT).collect()
    assert [(r.sinkTable, r.sinkColumns) for r in facts] == [("dwd_order_info", "id,amount")]
    lost = routing.unrouted_changes(cf.nonempty(df), rules(spark)).collect()
    assert [r.seq for r in lost] == [3]
    assert "BroadcastHashJoin" in routed._jdf.queryExecution().executedPlan().toString()


def test_underscores_in_keys_do_not_mix(spark):
    df = cf.normalise(records(spark, ("a_b", {"op": "c", "after": {"id": 1}})))
    other = rules(spark, [("a", "b_insert", "kafka", "t", "id", None, None)])
    assert [r.route for r in changes_routed(df, other).collect()] == ["unrouted"]


def test_pulled_rules_tag_whole_images(spark):
    df = cf.normalise(records(spark, ("order_info", {"op": "c", "after": {"id": 1, "x": [1]}}), ("z", {"op": "c", "after": {"id": 1}})))
    got = routing.tag_by_pulled_rules(df, rules(spark)).select(F.to_json("data").alias("j")).collect()
    assert [json.loads(r.j) for r in got] == [{"id": 1, "x": [1], "sinkTable": "dwd_order_info"}]


def test_rule_log_last_wins_and_deletes_count(spark):
    def rule(table, sink, op="insert"):
        return json.dumps({"source_table": table, "operate_type": op, "sink_table": sink})

    rows = [
        (0, "read", rule("a", "old"), "{}"),
        (1, "update", rule("a", "new"), rule("a", "old")),
        (2, "insert", rule("b", "gone"), "{}"),
        (3, "delete", "{}", rule("b", "gone")),
        (4, "insert", rule("c", "moved"), "{}"),
        (5, "update", rule("d", "moved"), rule("c", "moved")),
        (6, "insert", rule("e", "back"), "{}"),
        (7, "delete", "{}", rule("e", "back")),
        (8, "insert", rule("e", "again"), "{}"),
    ]
    df = spark.createDataFrame(rows, "seq bigint, type string, data string, before string")
    got = {r.source_table: r.sink_table for r in routing.latest_rules(df).collect()}
    assert got == {"a": "new", "d": "moved", "e": "again"}


def test_many_rules_are_not_broadcast_blindly(spark):
    many = spark.range(20).select(
        F.concat(F.lit("t"), "id").alias("source_table"), F.lit("insert").alias("operate_type")
    )
    assert "rightHint" not in routing.bounded_rules(many, limit=10)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in routing.bounded_rules(many, limit=20)._jdf.queryExecution().analyzed().toString()


def test_unreadable_records_keep_their_text(spark):
    good = '{"op":"c","before":null,"after":{"id":1}}'
    bad = ['{"op":"c","after":{"id":2', '{"after":{"id":3}}', "null", ""]
    rows = [(n, "x.retail.t", value) for n, value in enumerate([good, *bad])]
    got = cf.normalise(spark.createDataFrame(rows, "seq int, topic string, value string"), keep_dirty=True)
    assert {r.seq: (r.dirty_reason, r.value) for r in got.collect()} == {
        0: (None, None),
        1: ("not_json", bad[0]),
        2: ("no_operation", bad[1]),
        3: ("no_operation", "null"),
        4: ("not_json", ""),
    }
