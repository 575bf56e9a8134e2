"""Labels, purges, thresholds and the exact split of open requests."""

import datetime as dt

import pytest

from civicspark.plans import labels, purge, scoring
from civicspark.settings import GateSettings, LabelSettings
from helpers import micros, requests, thresholds


def spread(n, category, age, start=dt.date(2021, 1, 1), step=3, first=0):
    return [
        (f"{category}-{first + i}", str(start + dt.timedelta(days=step * i)),
         str(start + dt.timedelta(days=step * i + age(i))), category)
        for i in range(n)
    ]


def test_threshold_is_the_interpolated_quantile_with_a_global_row(spark):
    rows = [(i, "2024-01-01", f"2024-01-{2 + i:02d}", "A") for i in range(4)]
    got = {r[0]: r[1] for r in labels.category_thresholds(requests(spark, rows)).collect()}
    assert got == {"A": 3.25, "__global__": 3.25}


def test_breach_is_strict_and_unseen_categories_use_the_global_threshold(spark):
    rows = requests(
        spark,
        [(1, "2024-01-01", "2024-01-06", "A"), (2, "2024-01-01", "2024-01-07", "A"), (3, "2024-01-01", "2024-01-13", "B")],
    )
    out = labels.apply_labels(rows, thresholds(spark, A=5, GLOBAL=10)).collect()
    assert {r["service_request_id"]: r["breach"] for r in out} == {"1": 0, "2": 1, "3": 1}


PURGED = [
    (f"p{i}", str(dt.date(2024, 6, 1) - dt.timedelta(days=900 + i)), "2024-06-01", "Tree") for i in range(40)
]


def test_purge_needs_age_and_company(spark):
    normal = spread(100, "Tree", lambda i: 5 + i % 10)
    policy = [(f"q{i}", str(dt.date(2024, 5, 1) - dt.timedelta(days=95)), "2024-05-01", "Tree") for i in range(40)]
    lonely = [(f"r{i}", str(dt.date(2024, 4, 1) - dt.timedelta(days=900 + i)), "2024-04-01", "Tree") for i in range(10)]
    out = purge.mark_purged(requests(spark, normal + PURGED + policy + lonely))
    flagged = {r["service_request_id"] for r in out.where("purge_closed").collect()}
    assert flagged == {r[0] for r in PURGED}
    event = purge.purge_events(requests(spark, normal + PURGED)).collect()
    assert [(e["closed_day"], e["tickets"], e["communities"]) for e in event] == [("2024-06-01", 40, 1)]


@pytest.mark.parametrize(("how", "kept"), [("flag", 40), ("keep", 40), ("exclude", 0)])
def test_purge_handling(spark, how, kept):
    rows = requests(spark, spread(600, "Tree", lambda i: 5 + i % 10) + PURGED)
    done = labels.build_training_labels(rows, LabelSettings(purge_handling=how))
    assert done.rows.where("purge_closed").count() == kept
    clean = done.thresholds.where("service_name = 'Tree'").first()["threshold_days"]
    assert (clean > 12) == (how == "keep")


def test_one_boundary_and_leak_free_thresholds(spark):
    rows = requests(spark, spread(600, "A", lambda i: 4 if i < 400 else 40) + [("o", "2025-11-01", None, "A")])
    done = labels.build_training_labels(rows)
    assert done.thresholds.where("service_name = 'A'").first()["threshold_days"] < 40
    assert done.train.where(f"unix_micros(requested_date) >= {done.boundary}").count() == 0
    assert done.test.where(f"unix_micros(requested_date) < {done.boundary}").count() == 0


def test_scored_and_overdue_split_the_open_rows(spark):
    now = dt.date(2026, 9, 24)

    def ago(i, days, category, closed=None):
        return (i, str(now - dt.timedelta(days=days)), closed, category)

    rows = requests(
        spark,
        [ago("s1", 2, "P"), ago("o1", 9, "P"), ago("n", 2, "P", "2026-09-23"), ago("s2", 30, "T"),
         ago("s3", 3, "U"), ago("o2", 12, "U"), ago("edge", 5, "P")],
    )
    norms = thresholds(spark, P=5, T=60, GLOBAL=10)
    asof = micros("2026-09-24")
    scored = scoring.scoring_rows(rows, norms, asof).collect()
    late = {r["service_request_id"] for r in labels.overdue_open(rows, norms, asof).collect()}
    assert {r["service_request_id"] for r in scored} == {"s1", "s2", "s3", "edge"}
    assert late == {"o1", "o2"}
    assert {r["service_request_id"]: r["category_seen"] for r in scored}["s3"] is False


def test_thresholds_without_a_global_row_fall_back_to_their_median(spark):
    rows = requests(spark, [(1, "2024-01-01", "2024-01-09", "C")])
    out = labels.apply_labels(rows, thresholds(spark, A=5, B=9)).first()
    assert out["threshold_days"] == 7.0


def test_leakage_guard():
    labels.assert_no_leakage(["service_name", "cat_open_30d"])
    with pytest.raises(labels.LeakageError, match="closed_date"):
        labels.assert_no_leakage(["service_name", "closed_date"])


def test_unknown_purge_handling_is_refused():
    with pytest.raises(ValueError, match="purge_handling"):
        LabelSettings(purge_handling="drop")
    assert GateSettings().stale_close_min_rows == 30
