import json

from pyspark.sql import functions as F

from millrace.operators import applog
from millrace.plans.app_log import log_tables

PAGE = {"common": {"mid": "m1", "is_new": "1"}, "page": {"page_id": "home"}, "ts": 1000}


def lines(spark, *objects):
    rows = [(i, o if o is None or isinstance(o, str) else json.dumps(o)) for i, o in enumerate(objects)]
    return spark.createDataFrame(rows, "seq bigint, value string")


def test_validity_of_odd_texts(spark):
    texts = ["{}", "[1]", "3", "null", "", None, "{bad", '{"a":1}x', '{"a":1},{"b":2}', ' {"a":1} ']
    df = lines(spark, *texts)
    assert {r.seq for r in applog.valid_lines(df).collect()} == {0, 9}
    dirty = applog.dirty_lines(df).collect()
    assert {r.seq for r in dirty} == set(range(1, 9))
    assert {r.value for r in dirty} == set(texts[1:9])


def test_parse_keeps_or_drops_dirty(spark):
    df = lines(spark, {"a": 1}, "x")
    assert applog.parse_lines(df).count() == 1
    assert applog.parse_lines(df, keep_dirty=True).count() == 2


def test_routes_and_reasons(spark):
    both = {**PAGE, "start": {"entry": "icon"}}
    df = lines(
        spark,
        both,
        {**PAGE, "displays": []},
        {k: v for k, v in PAGE.items() if k != "page"},
        {**PAGE, "common": {"is_new": "1"}},
        PAGE,
        {**PAGE, "displays": [1]},
        {**PAGE, "start": None},
        "oops",
    )
    got = {r.seq: (r.route, r.dirty_reason) for r in applog.parse_log(df).collect()}
    assert got == {
        0: ("start", None),
        1: ("display", None),
        2: ("dirty", "no_page"),
        3: ("dirty", "no_mid"),
        4: ("page", None),
        5: ("dirty", "bad_displays"),
        6: ("page", None),
        7: ("dirty", "not_json_object"),
    }


def test_display_items_get_the_page_and_nothing_else(spark):
    shown = {**PAGE, "displays": [{"item": "1", "page_id": "old"}, {"item": "2", "pos_id": 3}]}
    df = lines(spark, shown, {**PAGE, "displays": []})
    out = log_tables(df).where("topic = 'dwd_display_log'")
    items = sorted((json.loads(r.value) for r in out.collect()), key=lambda d: d["item"])
    assert items == [{"item": "1", "page_id": "home"}, {"item": "2", "pos_id": 3, "page_id": "home"}]


def test_pages_with_displays_option(spark):
    df = lines(spark, {**PAGE, "displays": [{"item": "1"}]})
    topics = [r.topic for r in log_tables(df).collect()]
    assert topics == ["dwd_display_log"]
    topics = sorted(r.topic for r in log_tables(df, pages_with_displays=True).collect())
    assert topics == ["dwd_display_log", "dwd_page_log"]


def test_repair_reaches_the_text_and_keeps_unknown_fields(spark):
    extra = {**PAGE, "err": {"code": 7}, "actions": [{"id": "a"}], "gone": None}
    out = log_tables(lines(spark, extra, extra, "broken")).collect()
    objects = [json.loads(r.value) for r in out if r.topic == "dwd_page_log"]
    assert sorted(o["common"]["is_new"] for o in objects) == ["0", "1"]
    for o in objects:
        assert o["err"] == {"code": 7} and o["actions"] == [{"id": "a"}] and "gone" not in o
    assert [(r.value, r.reason) for r in out if r.topic == "dirty_log"] == [("broken", "not_json_object")]


def test_each_line_is_parsed_once(spark):
    plan = applog.parse_log(lines(spark, PAGE)).where(F.col("route") == "page").select("mid", "ts")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 1


def test_null_fields_vanish_at_every_level(spark):
    cases = {
        '{"a":null,"b":{"c":null,"d":1,"e":null},"f":[null,{"g":null}]}': {"b": {"d": 1}, "f": [None, {}]},
        '{"x":{"y":{"z":null}},"s":"q\\":null,","t":null}': {"x": {"y": {}}, "s": 'q":null,'},
        '{"k,":"b,",":nullx":1,"m":"{","n":{":null":null,"o":"a\\\\"}}': {"k,": "b,", ":nullx": 1, "m": "{", "n": {"o": "a\\"}},
        '{"a":null}': {},
        '{"a":"null","b":":null"}': {"a": "null", "b": ":null"},
    }
    rows = spark.createDataFrame([(n, text) for n, text in enumerate(cases)], "seq bigint, value string")
    got = {r.seq: json.loads(r.value) for r in applog.valid_lines(rows).collect()}
    assert [got[n] for n in range(len(cases))] == list(cases.values())
    item = {"item": "1", "extra": {"x": None, "y": 2}}
    line = {**PAGE, "displays": [item]}
    line["common"] = {**line["common"], "ch": None}
    out = applog.log_outputs(applog.parse_log(spark.createDataFrame([(1, json.dumps(line)), (2, json.dumps({**PAGE, "page": {**PAGE["page"], "item": None}}))], "seq bigint, value string")))
    values = [json.loads(r.value) for r in out.collect()]
    assert {"x": None, "y": 2} not in [v.get("extra") for v in values] and any(v.get("extra") == {"y": 2} for v in values)
    assert all("item" not in v.get("page", {}) for v in values)
