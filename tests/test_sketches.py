"""Merged month profiles against exact ones: counts equal, quantiles and distances within the stated errors."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicspark.plans import drift, sketches


def table(spark, n, seed, months=6, shift=0.0):
    draw = random.Random(seed)
    rows = [
        (f"2024-0{1 + draw.randrange(months)}-10", None if draw.random() < 0.1 else draw.gauss(10, 3) + shift, draw.choice(["a", "b", "b", None]), None, float(i))
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "day string, x double, s string, gone double, i double")
    return df.withColumn("day", F.col("day").cast("timestamp"))


NUMERIC, LEVELS = ("x", "gone", "i"), ("s",)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    df = table(spark, 20_000, 1)
    out = sketches.Store(spark, str(tmp_path_factory.mktemp("profiles")))
    out.add(df, "day", NUMERIC, LEVELS)
    return df, out


def same_counts(got, exact):
    for name, want in exact.items():
        row = got[name]
        assert (row["rows"], row["missing"], row["kind"]) == (want["rows"], want["missing"], want["kind"])
        for c in ("min", "max", "mean", "std", "completeness"):
            assert row[c] == (want[c] if want[c] is None else pytest.approx(want[c], rel=1e-9))
        assert abs(row["distinct_values"] - want["distinct_values"]) <= sketches.DISTINCT_ERROR * want["distinct_values"] + 0.5


def by_column(df):
    return {r["column"]: r.asDict() for r in df.collect()}


def test_a_merged_profile_is_the_exact_one(spark, store):
    df, kept = store
    got, exact = by_column(sketches.profile(kept.read("sketches"))), by_column(drift.profile(df, NUMERIC, LEVELS))
    same_counts(got, exact)
    for name in ("x", "i"):
        values = np.array([r[0] for r in df.select(name).collect() if r[0] is not None])
        for p, q in sketches.QUANTILES.items():
            assert (values < got[name][p]).mean() - sketches.RANK_ERROR <= q <= (values <= got[name][p]).mean() + sketches.RANK_ERROR
    assert got["gone"]["p50"] is None and got["gone"]["mean"] is None


def test_any_order_and_grouping_of_months_merges_alike(store):
    df, kept = store
    rows = kept.read("sketches")
    exact = by_column(drift.profile(df, NUMERIC, LEVELS))
    for order in (F.col("month").asc(), F.col("month").desc()):
        same_counts(by_column(sketches.profile(rows.orderBy(order))), exact)
    halves = [sketches.merged(rows.where(F.month("month") % 2 == k)) for k in (0, 1)]
    for two in (halves, halves[::-1]):
        same_counts(by_column(sketches.profile(two[0].unionByName(two[1]))), exact)


def test_a_baseline_is_extended_by_its_new_months(spark, tmp_path):
    df = table(spark, 6_000, 3)
    whole, grown = sketches.Store(spark, str(tmp_path / "a")), sketches.Store(spark, str(tmp_path / "b"))
    whole.add(df, "day", NUMERIC, LEVELS)
    grown.add(df.where(F.month("day") <= 4), "day", NUMERIC, LEVELS)
    before = {f for f in grown.read("sketches").inputFiles()}
    grown.add(df.where(F.month("day") > 4), "day", NUMERIC, LEVELS)
    assert before < set(grown.read("sketches").inputFiles())
    same_counts(by_column(sketches.profile(grown.read("sketches"))), by_column(drift.profile(df, NUMERIC, LEVELS)))
    grown.add(df.where(F.month("day") == 2), "day", NUMERIC, LEVELS)  # once more: it replaces itself
    counts = ["month", "column", "rows", "present", "n", "min", "max"]
    assert sorted(map(str, grown.read("sketches").select(counts).collect())) == sorted(map(str, whole.read("sketches").select(counts).collect()))
    assert sorted(map(str, grown.read("levels").collect())) == sorted(map(str, whole.read("levels").collect()))


def test_months_without_rows(spark, store):
    _, kept = store
    assert sketches.profile(kept.read("sketches", since="2030-01-01")).collect() == []
    empty = sketches.month_profiles(table(spark, 10, 1).limit(0), "day", NUMERIC, LEVELS)
    assert sketches.merged(empty[0]).collect() == [] and empty[1].collect() == []
    both = kept.read("sketches").unionByName(empty[0].select(*kept.read("sketches").columns))
    assert by_column(sketches.profile(both))["x"]["rows"] == 20_000


@pytest.mark.parametrize("shift", [0.0, 0.25, 1.5])
def test_distances_are_within_their_error(spark, tmp_path, shift):
    a, b = table(spark, 8_000, 5), table(spark, 5_000, 6, shift=shift).withColumn("s", F.when(F.col("i") % 50 == 0, "new").otherwise(F.col("s")))
    sides = []
    for n, df in enumerate((a, b)):
        kept = sketches.Store(spark, str(tmp_path / str(n)))
        kept.add(df, "day", NUMERIC, LEVELS)
        sides.append((kept.read("sketches"), kept.read("levels")))
    got = {(r["column"], r["check_type"]): r["observed"] for r in sketches.violations(*sides, threshold=-1.0).collect()}
    want = {(r["column"], r["check_type"]): r["observed"] for r in drift.violations(a, b, NUMERIC, LEVELS, threshold=-1.0).collect()}
    assert got.keys() == want.keys()
    for key, value in want.items():
        exact = key[0] in LEVELS or key[1] != "baseline_drift_check"
        assert got[key] == pytest.approx(value, abs=1e-9 if exact else sketches.GAP_ERROR)
