"""The EWMA as a scan: equal to the recursion on short and very long series."""

import random

import pytest
from pyspark.sql import functions as F

from civicspark.operators import detect
from civicspark.settings import ControlSettings


def walked(values, w, mu):
    out, z = [], mu
    for v in values:
        z = w * v + (1 - w) * z
        out.append(z)
    return out


def series(spark, data):
    rows = [(k, i, v) for k, values in data.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, i long, v double")


@pytest.mark.parametrize("block", [2, 7, 4096])
@pytest.mark.parametrize("decay", [0.0, 1e-5, 0.3, 0.7, 0.999, 1.0])
def test_sums_equal_the_recursion(spark, monkeypatch, block, decay):
    monkeypatch.setattr(detect, "BLOCK", block)
    draw = random.Random(1)
    data = {k: [draw.gauss(0, 10) for _ in range(n)] for k, n in (("a", 1), ("b", 10), ("c", 95))}
    got = {(r["k"], r["i"]): r["sum"] for r in detect.decaying_sum(series(spark, data), ["k"], "i", "v", decay, 95).collect()}
    for k, values in data.items():
        s = 0.0
        for i, v in enumerate(values):
            s = decay * s + v
            assert got[k, i] == pytest.approx(s, rel=1e-9, abs=1e-9)


def brute(values, s):
    """The flags of one series, point by point."""
    points = [(i, v) for i, v in enumerate(values) if v is not None]
    flags = [False] * len(values)
    first = [v for _, v in points[: s.min_points]]
    if len(points) < s.min_points:
        return flags
    mu = sum(first) / len(first)
    sigma = (sum((v - mu) ** 2 for v in first) / (len(first) - 1)) ** 0.5
    if sigma == 0:
        return flags
    for n, ((i, _), z) in enumerate(zip(points, walked([v for _, v in points], s.weight, mu), strict=True), 1):
        flags[i] = abs(z - mu) > s.limit * sigma * (s.weight / (2 - s.weight) * (1 - (1 - s.weight) ** (2 * n))) ** 0.5
    return flags


@pytest.mark.parametrize("short", [detect.SHORT, 5])
def test_flags_equal_the_recursion(spark, monkeypatch, short):
    monkeypatch.setattr(detect, "SHORT", short)
    draw = random.Random(2)
    data = {
        "ten": [draw.gauss(0, 1) for _ in range(10)],
        "gaps": [None if i % 4 == 1 else draw.gauss(0, 1) + (4 if i > 60 else 0) for i in range(90)],
        "few": [1.0, None, 2.0],
        "flat": [3.0] * 40,
    }
    rows = [(k, i, v) for k, values in data.items() for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k string, i int, residual double").withColumn("month", F.expr("add_months(DATE'2000-01-01', i)"))
    got = {(r["k"], r["i"]): r["ewma_flag"] for r in detect.ewma_flags(df, ["k"]).collect()}
    assert got == {(k, i): f for k, values in data.items() for i, f in enumerate(brute(values, ControlSettings()))}


def test_a_million_points(spark):
    """Minutes of two years: many blocks, the same flags as a plain loop."""
    n = 1_000_000
    df = spark.range(n).select(
        F.lit("k").alias("k"), F.timestamp_seconds(F.col("id") * 60).alias("month"), "id",
        ((F.pmod(F.xxhash64("id"), F.lit(2_000_001)) - 1_000_000) / 1e6 + F.when(F.col("id") % 200_000 > 199_900, 2.0).otherwise(0.0)).alias("residual"),
    )
    out = detect.ewma_flags(df, ["k"]).select("id", "residual", "ewma_flag").toPandas().sort_values("id")
    want = brute(out["residual"].tolist(), ControlSettings())
    assert out["ewma_flag"].tolist() == want and sum(want) > 300
