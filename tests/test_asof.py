"""As-of windows against brute force and the hand-worked histories."""

import datetime as dt
import random

from civicspark.operators import asof
from civicspark.operators.asof import Ask, Events, Span, last_before, range_agg, range_agg_many
from civicspark.plans import features
from civicspark.settings import LateRate
from helpers import UTC, day, requests, thresholds

START = dt.datetime(2024, 1, 1, tzinfo=UTC)


def events(n, seed):
    rng = random.Random(seed)
    return [
        (
            i,
            None if i % 40 == 0 else ("hot" if rng.random() < 0.7 else "cold"),
            START + dt.timedelta(minutes=rng.randrange(0, 60 * 24 * 40)),
            float(rng.randrange(5)),
        )
        for i in range(n)
    ]


def brute(rows, i, days, closed):
    _, k, t, _ = rows[i]
    lo = t - dt.timedelta(days=days)
    if closed == "left":
        return [r for r in rows if r[1] == k and lo <= r[2] < t]
    return [r for r in rows if r[1] == k and lo < r[2] <= t]


def test_windows_equal_brute_force_with_hot_and_null_keys(spark):
    rows = events(600, 7)
    df = spark.createDataFrame(rows, "id long, k string, t timestamp, v double")
    for closed in ("left", "right"):
        out = range_agg(
            df, df, keys=["k"], row_time="t", event_time="t", value="v",
            spans=[Span("a", 1), Span("b", 10)], closed=closed,
        ).collect()
        assert len(out) == len(rows)
        for r in out:
            for name, days in (("a", 1), ("b", 10)):
                want = brute(rows, r["id"], days, closed)
                assert r[f"{name}_n"] == len(want)
                assert r[f"{name}_sum"] == sum(x[3] for x in want)


def test_a_burst_is_cut_further(spark, monkeypatch):
    """Nine tenths of all events in one hour of one key: parts of a slice give the same answers."""
    rng = random.Random(9)
    rows = [
        (i, "hot" if i % 10 else "cold", START + dt.timedelta(microseconds=rng.randrange(3_600_000_000) if i % 10 else 10**11 + i), 1.0)
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "id long, k string, t timestamp, v double")
    ask = dict(keys=["k"], row_time="t", event_time="t", value="v", spans=[Span("a", 1), Span("b", 30)])
    plain = sorted(tuple(r) for r in range_agg(df, df, **ask).collect())
    monkeypatch.setattr(asof, "SLICE_ROWS", 8)
    sliced = asof._sliced(df.selectExpr("k AS _k", "unix_micros(t) AS _at"), ["_k"], "_at", f"{asof.MICROS_SLICE}L")
    assert sliced.groupBy("_k", "_cut").count().agg({"count": "max"}).first()[0] <= 8
    assert sorted(tuple(r) for r in range_agg(df, df, **ask).collect()) == plain


def test_many_questions_equal_one_at_a_time(spark):
    rows = events(300, 8)
    df = spark.createDataFrame(rows, "id long, k string, t timestamp, v double").selectExpr("*", "CAST(v AS string) AS j")
    source = Events(df, "t", "v")
    both = range_agg_many(df, "t", [Ask(source, ("k",), (Span("a", 5),)), Ask(source, ("k", "j"), (Span("b", 20),))])
    one = range_agg(df, df, keys=["k"], row_time="t", event_time="t", value="v", spans=[Span("a", 5)])
    two = range_agg(df, df, keys=["k", "j"], row_time="t", event_time="t", value="v", spans=[Span("b", 20)])
    pick = lambda d, *c: sorted(tuple(r) for r in d.select("id", *c).collect())
    assert pick(both, "a_n", "a_sum") == pick(one, "a_n", "a_sum")
    assert pick(both, "b_n", "b_sum") == pick(two, "b_n", "b_sum")


def test_last_before_takes_the_newest_at_or_before(spark):
    left = spark.createDataFrame(
        [(1, day("2026-09-20")), (2, day("2026-09-23")), (3, day("2026-09-30")), (4, day("2026-10-05"))],
        "id long, created timestamp",
    )
    right = spark.createDataFrame(
        [(day("2026-09-23"), 2_911_486), (day("2026-10-01"), 2_921_625)], "taken timestamp, rows long"
    )
    out = last_before(left, right, keys=[], row_time="created", event_time="taken", value="rows", name="rows")
    assert {r["id"]: r["rows"] for r in out.collect()} == {1: None, 2: 2_911_486, 3: 2_911_486, 4: 2_921_625}


HISTORY = [
    (1, "2025-01-01", "2025-01-06", "A"),
    (2, "2025-01-02", "2025-01-25", "A"),
    (3, "2025-01-03", None, "A"),
    (4, "2025-01-20", None, "A"),
]


def history(spark, rows):
    comms = spark.createDataFrame([("X1", "X", "WEST", "S")], "comm_code string, name string, sector string, srg string")
    return features.build_history(requests(spark, rows), thresholds(spark, A=10), comms)


def rate_at(spark, rows, when, min_n=1):
    query = requests(spark, [(9, when, None, "A")])
    out = features.add_late_rates(query, history(spark, rows), [LateRate("r", ("service_name",), 90, min_n)])
    return out.first()["r"]


def test_only_decided_outcomes_count(spark):
    assert rate_at(spark, HISTORY, "2025-01-11") is None  # a deadline at that very moment is not before it
    assert rate_at(spark, HISTORY, "2025-01-13") == 0.5
    assert rate_at(spark, HISTORY, "2025-02-15") == 0.75
    assert rate_at(spark, HISTORY, "2025-02-15", min_n=5) is None


def test_no_lookahead(spark):
    later = [*HISTORY[:3], (4, "2025-01-20", "2025-01-21", "A")]
    assert rate_at(spark, HISTORY, "2025-01-25") == rate_at(spark, later, "2025-01-25")


def test_backlog_ratio_of_a_steady_year_is_one(spark):
    first = dt.date(2024, 1, 1)
    rows = [(i, str(first + dt.timedelta(days=i)), None, "A") for i in range(366)]
    query = requests(spark, [(999, "2025-01-01", None, "A")])
    steady = features.add_backlog_ratio(query, history(spark, rows)).first()["cat_backlog_ratio"]
    assert abs(steady - 1.0) < 0.05


def test_rolling_counts_are_strictly_before(spark):
    rows = requests(
        spark,
        [(1, "2024-06-01", None, "P"), (2, "2024-06-06", None, "P"), (3, "2024-06-11", None, "P"),
         (4, "2024-06-11", None, "P"), (5, "2024-08-30", None, "P"), (6, "2024-06-02", None, "T")],
    )
    got = {r["service_request_id"]: r["cat_open_30d"] for r in features.add_backlog_features(rows).collect()}
    assert got == {"1": 0, "2": 1, "3": 2, "4": 2, "5": 0, "6": 0}


def test_the_last_value_in_a_burst(spark, monkeypatch):
    """The newest event at or before each row, a day's burst cut by its count."""
    rng = random.Random(11)
    events = [(rng.choice(["hot"] * 9 + ["cold"]), START + dt.timedelta(microseconds=rng.randrange(3_600_000_000)), float(i)) for i in range(300)]
    asked = [(i, rng.choice(["hot", "cold", "none"]), START + dt.timedelta(microseconds=rng.randrange(-10**9, 2 * 3_600_000_000))) for i in range(120)]
    e, q = spark.createDataFrame(events, "k string, t timestamp, v double"), spark.createDataFrame(asked, "id long, k string, t timestamp")
    ask = dict(keys=["k"], row_time="t", event_time="t", value="v", name="last")
    want = {}
    for i, k, t in asked:
        before = [(u, v) for j, u, v in events if j == k and u <= t]
        want[i] = max(before)[1] if before else None
    for rows in (asof.SLICE_ROWS, 8):
        monkeypatch.setattr(asof, "SLICE_ROWS", rows)
        assert {r["id"]: r["last"] for r in asof.last_before(q, e, **ask).collect()} == want


def test_sides_that_grow_with_the_rows_are_not_broadcast(spark):
    df = spark.createDataFrame(events(30, 3), "id long, k string, t timestamp, v double")
    spans = (Span("w", 7),)
    many = range_agg_many(df, "t", [Ask(Events(df, "t", "v"), ("k",), spans), Ask(Events(df, "t"), ("k",), spans)])
    last = last_before(df, df, keys=["k"], row_time="t", event_time="t", value="v", name="newest")
    for out in (many, last):
        plan = out._jdf.queryExecution().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert out.count() == df.count()
