"""Detectors, fairness, grading, scorecard, jobs, drift and maps on hand-worked rows."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from civicspark.functions.numbers import band, cost_usd, ratio_band
from civicspark.functions.text import department, job_kind
from civicspark.operators import detect
from civicspark.plans import champion, drift, fairness, grading, jobs, maps, metrics, scorecard
from civicspark.settings import FairnessSettings, ScorecardSettings
from helpers import day, micros, requests


def months(n, first=dt.date(2020, 1, 1)):
    return [dt.date(first.year + (first.month - 1 + i) // 12, (first.month - 1 + i) % 12 + 1, 1) for i in range(n)]


def test_ratio_flags_by_hand(spark):
    rows = [(1, "a", 100.0), (2, "a", 110.0), (3, "a", 95.0), (4, "a", 250.0), (5, "b", 30.0), (6, "b", 31.0), (7, "b", 90.0), (8, "c", 1.0), (9, "c", 99.0)]
    df = spark.createDataFrame(rows, "id long, kind string, v double")
    got = {r["id"] for r in detect.ratio_flags(df, "kind", "v").where("flag").collect()}
    assert got == {4, 7}


@pytest.mark.parametrize("n", [3, 4, 5, 8, 9, 30])
def test_ratio_flags_equal_leave_one_out(spark, n):
    rng = random.Random(n)
    rows = [(i, "k", float(rng.choice([1, 2, 2, 3, 5, 9]))) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, kind string, v double")
    got = {r["id"]: r["flag"] for r in detect.ratio_flags(df, "kind", "v", factor=1.2).collect()}
    for i, _, v in rows:
        assert got[i] == (v > 1.2 * statistics.median([r[2] for r in rows if r[0] != i]))


def test_seasonal_residuals_use_earlier_years_only(spark):
    rows = [("s", m, float(1 + 2 * (m.year - 2020))) for m in months(36)]
    out = detect.seasonal_residuals(spark.createDataFrame(rows, "key string, month date, value double"), ["key"])
    got = {r["month"].year: r["residual"] for r in out.collect()}
    assert got == {2020: None, 2021: 2.0, 2022: 3.0}


def ewma_loop(values, w=0.3, limit=3.0, first=10):
    xs = [v for v in values if v is not None]
    mu, sigma = statistics.mean(xs[:first]), statistics.stdev(xs[:first])
    z, t, out = mu, 0, []
    for v in values:
        if v is None:
            out.append(False)
            continue
        t += 1
        z = w * v + (1 - w) * z
        out.append(abs(z - mu) > limit * sigma * (w / (2 - w) * (1 - (1 - w) ** (2 * t))) ** 0.5)
    return out


def test_ewma_and_sustained_equal_a_plain_loop(spark):
    rng = random.Random(0)
    values = [rng.gauss(0, 1) for _ in range(40)] + [rng.gauss(4, 1) for _ in range(10)]
    values[5] = values[20] = None
    rows = [("s", m, v) for m, v in zip(months(50), values, strict=True)]
    df = spark.createDataFrame(rows, "key string, month date, residual double")
    flagged = detect.sustained(detect.ewma_flags(df, ["key"]), ["key"], "ewma_flag").orderBy("month").collect()
    assert [r["ewma_flag"] for r in flagged] == ewma_loop(values)
    assert sum(r["sustained"] for r in flagged[40:]) >= 7
    short = detect.ewma_flags(df.where("month < '2020-09-01'"), ["key"])
    assert short.where("ewma_flag").count() == 0


def test_sustained_keeps_only_long_runs(spark):
    flags = [True, False, True, True, False, True, True, True, True]
    df = spark.createDataFrame([("s", m, f) for m, f in zip(months(9), flags, strict=True)], "key string, month date, f boolean")
    out = detect.sustained(df, ["key"], "f").orderBy("month").collect()
    assert [r["sustained"] for r in out] == [False] * 5 + [True] * 4


SECTORS = ("NORTH", "SOUTH", "EAST", "WEST")


def predictions(spark, blind=None, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(8):
        sector = SECTORS[i // 2]
        for _ in range(1500):
            y = int(rng.random() < 0.25)
            rows.append((f"C{i}", y, rng.gauss(0, 0.7) + (0 if sector == blind else y)))
    comms = [(f"C{i}", f"N{i}", SECTORS[i // 2], "ESTABLISHED" if i % 2 else "DEVELOPING") for i in range(8)]
    return (
        spark.createDataFrame(rows, "comm_code string, breach int, pred double"),
        spark.createDataFrame(comms, "comm_code string, name string, sector string, srg string"),
    )


def test_a_blind_sector_fails_and_is_named(spark):
    good = fairness.fairness_report(*predictions(spark))
    assert good.overall.first()["passed"]
    bad = fairness.fairness_report(*predictions(spark, blind="EAST"))
    sector = bad.dimensions.where("dimension = 'sector'").first()
    assert not sector["passed"] and sector["lowest_recall_group"] == "EAST" and "EAST" in sector["problems"]
    assert not bad.overall.first()["passed"]


def test_too_few_groups_fail(spark):
    report = fairness.fairness_report(*predictions(spark), FairnessSettings(min_group_rows=10**6))
    assert not report.overall.first()["passed"] and report.overall.first()["recall_ratio"] is None


def test_top_decile_by_hand(spark):
    rows = [(i, int(i < 10 or 50 <= i < 60), 1.0 - i / 100) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, breach int, pred double")
    got = metrics.top_decile(df).first()
    assert (got["base_rate"], got["top_decile_rate"], got["top_decile_lift"], got["top_decile_recall"]) == (0.2, 1.0, 5.0, 0.5)


def test_auc_and_average_precision_with_ties(spark):
    rng = random.Random(5)
    rows = [(int(rng.random() < 0.3), rng.randrange(6) / 6) for _ in range(400)]
    df = spark.createDataFrame(rows, "breach int, pred double")
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap, seen = 0.0, 0.0
    for cut in sorted({p for _, p in rows}, reverse=True):
        above = [y for y, p in rows if p >= cut]
        ap += (sum(above) / len(pos) - seen) * sum(above) / len(above)
        seen = sum(above) / len(pos)
    assert metrics.roc_auc(df).first()[0] == pytest.approx(auc)
    assert metrics.average_precision(df).first()[0] == pytest.approx(ap)


def outcome_rows(spark):
    rows, i = [], 0

    def add(n, sector, outcome, flagged, deadline="2026-09-25"):
        nonlocal i
        for _ in range(n):
            i += 1
            rows.append(("u", "2026-09-24", f"r{i}", "A", sector, "S", i / 1000, flagged, day(deadline), 5.0, True, outcome, day("2026-10-16")))

    add(30, "EAST", "late", True), add(10, "EAST", "late", False)
    add(10, "EAST", "on_time", True), add(50, "EAST", "on_time", False)
    add(20, "WEST", "late", True), add(20, "WEST", "late", False), add(60, "WEST", "on_time", False)
    add(1, "WEST", "undecided", False, "2026-12-01")
    shape = (
        "usage string, scored_asof string, service_request_id string, service_name string, sector string, srg string, "
        "score double, flagged boolean, deadline timestamp, threshold_days double, category_seen boolean, outcome string, "
        "outcome_snapshot timestamp"
    )
    return spark.createDataFrame(rows, shape)


def test_grade_by_hand(spark):
    report = grading.grade(outcome_rows(spark))
    cover = report.coverage.first()
    assert (cover["rows_scored"], cover["rows_graded"]) == (201, 200)
    seen = report.rates.where("quota = 'job' AND cohort = 'seen'").first()
    assert (seen["late_rate"], seen["late_rate_flagged"], seen["recall"]) == (0.4, round(50 / 60, 4), round(50 / 80, 4))
    sector = report.dimensions.where("quota = 'job' AND dimension = 'sector'").first()
    assert (sector["recall_ratio"], sector["lowest_recall_group"]) == (round(0.5 / 0.75, 4), "WEST")


def test_an_undecided_row_past_its_deadline_is_an_error(spark):
    bad = outcome_rows(spark).withColumn("deadline", F.lit("2026-01-01").cast("timestamp"))
    with pytest.raises(Exception, match="still undecided"):
        grading.deadline_passed(bad).collect()


def test_reflag_is_per_run_and_cell(spark):
    rows = [(run, f"{run}{i}", cell, i / 100 + shift) for run, cell, shift in (("1", "a", 0.0), ("1", None, 5.0), ("2", "a", 9.0)) for i in range(10)]
    df = spark.createDataFrame(rows, "scored_asof string, service_request_id string, sector string, score double")
    out = grading.reflag(df, ("sector",), "f").where("f").collect()
    assert len(out) == 3 and {r["score"] for r in out} == {0.09, 5.09, 9.09}


def cube(spark, rows):
    data = [(m, s, sec, dow, n, late) for m, s, sec, dow, n, late in rows]
    return spark.createDataFrame(data, "month date, service_name string, sector string, dow int, n long, late long")


def test_fixed_mix_does_not_move_with_the_mix(spark):
    a, b = months(2)
    c = cube(spark, [(a, "X", "E", 0, 90, 9), (a, "Y", "E", 0, 10, 5), (b, "X", "E", 0, 10, 1), (b, "Y", "E", 0, 90, 45)])
    got = [r["value"] for r in scorecard.city_late_mix_fixed(c).collect()]
    assert got[0] == pytest.approx(got[1]) == pytest.approx(0.3)


def test_weekend_ratio_needs_both_sides(spark):
    a, b = months(2)
    c = cube(spark, [(a, "X", "E", 4, 10, 4), (a, "X", "E", 1, 10, 2), (b, "X", "E", 5, 10, 3)])
    got = scorecard.weekend_ratio(c).collect()
    assert [r["month"] for r in got] == [a] and got[0]["value"] == pytest.approx(2.0) and got[0]["n"] == 10


def test_slowest_share_by_hand(spark):
    rows = [(i, "2024-01-15", "2024-04-24" if i < 5 else "2024-01-16", "A") for i in range(100)]
    out = scorecard.slowest_share(requests(spark, rows), micros("2025-02-01")).collect()
    assert {r["month"] for r in out} == {dt.date(2024, 12, 1)}
    assert out[0]["value"] == pytest.approx(500 / 595)


def test_provisional_months_are_never_judged(spark):
    rows = [(m, "s", "", 1.0 + (9 if i > 40 else 0), 10, i >= 45) for i, m in enumerate(months(50))]
    card = spark.createDataFrame(rows, "month date, series string, key string, value double, n long, provisional boolean")
    out = scorecard.add_flags(card)
    assert out.count() == 50 and out.where("provisional AND (flag OR residual IS NOT NULL)").count() == 0
    assert scorecard.latest(out).first()["month"] == months(45)[-1]
    assert ScorecardSettings().provisional_share == 0.06


def job_rows(spark, seconds, kind="train"):
    rows = [(f"j{i}", kind, "Completed", day(f"2026-09-{24 + i}"), s, "ml.t3.xlarge") for i, s in enumerate(seconds)]
    rows.append(("bad", "score", "Failed", day("2026-09-30"), None, "ml.t3.xlarge"))
    shape = "name string, kind string, status string, created timestamp, billed_seconds double, instance_type string"
    snaps = spark.createDataFrame([(day("2026-09-23"), 2_900_000)], "taken timestamp, rows long")
    return spark.createDataFrame(rows, shape), snaps


def test_slow_and_failed_jobs_are_flagged(spark):
    out = jobs.assess(*job_rows(spark, [249.0, 249.0, 219.0, 600.0]))
    assert {r["name"]: r["reason"] for r in out.where("flag").collect()} == {"j3": "> 2x its kind's median", "bad": "failed"}
    lines = [r["line"] for r in jobs.alert_lines(out).orderBy("ord", "line").collect()]
    assert lines[0] == "2 job(s) flagged" and "no billed time" in lines[1]
    assert jobs.alert_lines(out.where("NOT flag")).count() == 0


def test_the_same_pace_on_more_data_is_not_slow(spark):
    table, _ = job_rows(spark, [100.0, 100.0, 100.0, 250.0])
    snaps = spark.createDataFrame([(day("2026-09-23"), 1_000_000), (day("2026-09-27"), 2_500_000)], "taken timestamp, rows long")
    assert jobs.assess(table.where("kind = 'train'"), snaps).where("flag").count() == 0


def test_text_and_bands(spark):
    names = ["Roads - Pothole", "Zoo - Lions", None, "Law"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(department("n")).collect()] == ["Roads", "Other", "Other", "Law"]
    kinds = ["p-train-20260928-101112", "pipelines-x-Train-9", "pipelines-x", "other-job", "p-20260928-101112"]
    df = spark.createDataFrame([(k,) for k in kinds], "n string")
    assert [r[0] for r in df.select(job_kind("n", "p")).collect()] == ["train", "pipeline-train", "pipeline", None, "20260928-101112"]
    df = spark.createDataFrame([(v,) for v in (0.70, 0.90, 1.00, 1.05, 1.10, 1.30)], "v double")
    assert [r[0] for r in df.select(ratio_band("v")).collect()] == [0, 1, 2, 2, 3, 4]
    assert [r[0] for r in df.select(band("v", (0.8, 1.0))).collect()] == [0, 1, 1, 2, 2, 2]
    cost = spark.range(1).select(cost_usd(F.lit("ml.t3.xlarge"), F.lit(3600.0), spot=True), cost_usd(F.lit("?"), F.lit(1.0)))
    assert tuple(cost.first()) == (0.066, 0.0)


def test_map_helpers(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 11)], "v double")
    assert tuple(maps.quantile_breaks(df, "v", 5).first()) == (2.0, 4.0, 6.0, 8.0)
    with pytest.raises(Exception, match="need at least"):
        maps.quantile_breaks(df.limit(3), "v", 5).collect()
    shapes = [
        '{"type":"Polygon","coordinates":[[[0,0],[0,1],[1,0],[0,0]],[[9,9],[9,8],[8,9],[9,9]]]}',
        '{"type":"MultiPolygon","coordinates":[[[[0,0],[0,1],[0,0]]],[[[5,5],[5,6],[5,5]]]]}',
        '{"type":"Point","coordinates":[0,0]}',
    ]
    df = spark.createDataFrame([(s,) for s in shapes], "geometry string")
    rings = [r["rings"] for r in maps.exterior_rings(df).collect()]
    assert [len(r) for r in rings] == [1, 2, 0] and rings[0][0][1] == [0.0, 1.0]


def test_injection_keeps_the_size_and_hits_the_share(spark):
    rows = [(i, "2024-01-01", None, "Roads - Pothole" if i % 10 == 0 else "Tree") for i in range(100)]
    out = drift.inject(requests(spark, rows), "pothole", 0.3)
    assert out.count() == 100 and out.where("service_name LIKE '%Pothole'").count() == 30
    rest = out.where("service_name = 'Tree'")
    assert rest.select("service_request_id").distinct().count() == 70
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, drift.inject(requests(spark, rows), "pothole", 0.3).collect()))
    with pytest.raises(ValueError, match="no rows match"):
        drift.inject(requests(spark, rows), "snow", 0.3)


def test_intake_window_is_open_closed(spark):
    rows = requests(spark, [(1, "2026-09-23", None, "A"), (2, "2026-09-14", None, "A"), (3, "2026-08-26", None, "A"), (4, "2026-08-24", None, "A")])
    got = drift.intake_rows(rows, micros("2026-09-24")).collect()
    assert {r["service_request_id"] for r in got} == {"1", "2", "3"}


def registry(spark, rows):
    return spark.createDataFrame(
        [("g", v, s, day(c), u, r) for v, s, c, u, r in rows],
        "model_group string, version int, status string, created timestamp, usage string, run string",
    )


def test_registry_rules(spark):
    table = registry(
        spark,
        [(1, "Approved", "2026-01-01", "shadow-not-for-use", "a"), (2, "Rejected", "2026-02-01", "shadow-not-for-use", "b"),
         (3, "Rejected", "2026-01-15", None, None)],
    )
    assert champion.latest_approved(table).first()["version"] == 1
    assert champion.pick_version(table, "g")["version"] == 2
    for version, why in ((1, "approved"), (3, "not marked"), (9, "no version")):
        with pytest.raises(champion.RegistryError, match=why):
            champion.pick_version(table, "g", version)
    runs = spark.createDataFrame([("a",), ("z",)], "run string")
    assert [r[0] for r in champion.unregistered_runs(runs, table).collect()] == ["z"]


def test_margin_and_gate(spark):
    def pr(v):
        return spark.createDataFrame([(v,)], "pr_auc double")

    alone = champion.champion_margin(pr(0.3), None).first()
    assert (alone["champion_exists"], alone["margin"]) == (0, 0.0)
    row = champion.champion_margin(pr(0.374), pr(0.36)).first()
    assert (row["champion_exists"], row["margin"]) == (1, 0.014)
    shape = "pr_auc double, recall_ratio double, min_group_lift double, champion_exists int, margin double"
    cases = [(0.3, 0.8, 1.5, 0, 0.0), (0.3, 0.8, 1.5, 1, 0.004), (0.3, 0.79, 1.5, 0, 0.0), (0.3, None, 1.5, 0, 0.0), (0.3, 0.9, 2.0, 1, 0.005)]
    got = champion.promotion_gate(spark.createDataFrame(cases, shape)).collect()
    assert [r["promoted"] for r in got] == [True, False, False, False, True]
