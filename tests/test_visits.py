import random
from datetime import datetime, timezone

from millrace.operators.jumpout import jumpouts_by_pattern, jumpouts_by_session, page_sessions
from millrace.operators.visits import daily_first_visits

SCHEMA = "mid string, ts bigint, seq bigint, last_page_id string"


def pages(spark, rows):
    return spark.createDataFrame([(m, t, s, l) for m, t, s, l in rows], SCHEMA)


def ms(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1000)


def test_first_entry_of_each_day(spark):
    rows = [
        ("a", ms("2021-06-01 08:00:00"), 0, "home"),  # not an entry
        ("a", ms("2021-06-01 09:00:00"), 1, None),
        ("a", ms("2021-06-01 23:59:59.999"), 2, None),
        ("a", ms("2021-06-02 00:00:00"), 3, None),
        ("a", ms("2021-06-01 08:30:00"), 4, None),  # arrives late, is the earliest
        ("b", ms("2021-06-01 10:00:00"), 6, None),
        ("b", ms("2021-06-01 10:00:00"), 5, None),  # tie on time
        ("c", None, 7, None),
    ]
    got = {(r.mid, r.day, r.seq) for r in daily_first_visits(pages(spark, rows)).collect()}
    assert got == {("a", "2021-06-01", 4), ("a", "2021-06-02", 3), ("b", "2021-06-01", 5)}


def test_first_visits_are_reduced_before_the_shuffle(spark):
    plan = daily_first_visits(pages(spark, [("a", 1, 1, None)]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    exchange = text.index("Exchange")
    assert "Partial" in text[exchange:] and "Final" in text[:exchange]


def test_pattern_bounds(spark):
    rows = [
        ("near", 0, 0, None), ("near", 9_999, 1, None), ("near", 100_000, 2, "x"),
        ("edge", 0, 0, None), ("edge", 10_000, 1, "x"),
        ("left", 0, 0, None), ("left", 9_999, 1, "x"),
        ("chain", 0, 0, None), ("chain", 1, 1, None), ("chain", 2, 2, None),
        ("tie", 5, 1, "x"), ("tie", 5, 0, None),
        ("one", 7, 0, None),
    ]
    got = {(r.mid, r.seq): r.reason for r in jumpouts_by_pattern(pages(spark, rows)).collect()}
    assert got == {
        ("near", 0): "match",
        ("near", 1): "timeout",
        ("edge", 0): "timeout",
        ("chain", 0): "match",
        ("chain", 1): "match",
        ("chain", 2): "timeout",
        ("one", 0): "timeout",
    }


def test_session_bounds(spark):
    rows = [
        ("edge", 0, 0, None), ("edge", 10_000, 1, None),
        ("far", 0, 0, None), ("far", 10_001, 1, None),
        ("mixed", 0, 0, None), ("mixed", 5, 1, "x"), ("mixed", 6, 2, None),
    ]
    df = pages(spark, rows)
    got = {(r.mid, r.seq) for r in jumpouts_by_session(df).collect()}
    assert got == {("edge", 0), ("edge", 1), ("mixed", 2)}
    got = {(r.mid, r.seq) for r in jumpouts_by_session(df, emit_single=True).collect()}
    assert got == {("edge", 0), ("edge", 1), ("mixed", 2), ("far", 0), ("far", 1)}


def random_rows(seed, n=1500, span=4_000):
    rng = random.Random(seed)
    rows = [
        ("hot" if rng.random() < 0.4 else f"m{rng.randrange(30)}", rng.randrange(-span, span), i,
         rng.choice([None, "x"]))
        for i in range(n)
    ]
    rng.shuffle(rows)
    return rows


def by_device(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault(r[0], []).append(r)
    return groups


def test_against_brute_force_over_many_slice_borders(spark):
    bound = 20
    rows = random_rows(7)
    pattern, session, spans = set(), set(), set()
    for mid, group in by_device(rows).items():
        runs = []
        for i, (_, ts, seq, last) in enumerate(group):
            if runs and ts - runs[-1][-1][1] <= bound:
                runs[-1].append(group[i])
            else:
                runs.append([group[i]])
            if last is None:
                after = group[i + 1] if i + 1 < len(group) else None
                if after is None or after[1] - ts >= bound:
                    pattern.add((mid, seq, "timeout"))
                elif after[3] is None:
                    pattern.add((mid, seq, "match"))
        for run in runs:
            spans.add((mid, run[0][1], run[-1][1], len(run)))
            for i, r in enumerate(run):
                last_of_many = i + 1 == len(run) and len(run) > 1
                if r[3] is None and (last_of_many or (i + 1 < len(run) and run[i + 1][3] is None)):
                    session.add((mid, r[2]))
    df = pages(spark, rows)
    for width in (None, 20, 33, 7):
        got = jumpouts_by_pattern(df, bound, slice_ms=width).collect()
        assert len(got) == len(pattern) and {(r.mid, r.seq, r.reason) for r in got} == pattern
        got = jumpouts_by_session(df, bound, slice_ms=width).collect()
        assert len(got) == len(session) and {(r.mid, r.seq) for r in got} == session
    for width in (None, 21, 50):
        got = page_sessions(df, bound, slice_ms=width).collect()
        assert len(got) == len(spans)
        assert {(r.mid, r.first_ts, r.last_ts, r.n_rows) for r in got} == spans


def test_a_busy_device_is_spread_over_slices(spark):
    plan = jumpouts_by_pattern(pages(spark, [("a", 1, 1, None)]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(mid") == 1 and "slice" in text.split("Exchange", 1)[1][:60]
