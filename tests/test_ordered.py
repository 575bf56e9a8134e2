"""The order operators against brute force, with hot keys, ties, nulls and odd ranges."""

import hashlib
import random

import numpy as np
import pytest

from civicspark.operators.ordered import (
    DAYS_WIDTH,
    SCORE_WIDTH,
    distribution,
    order_statistics,
    quantiles,
    rank_rows,
    running_before,
    sample_exactly,
)


def skewed(n, seed):
    rng = random.Random(seed)
    return [
        (i, "hot" if rng.random() < 0.6 else f"k{rng.randrange(5)}", round(rng.gauss(0, 300), rng.choice([0, 2, 6])))
        for i in range(n)
    ]


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.75, 0.9, 1.0])
def test_quantiles_equal_numpy(spark, q):
    rows = skewed(3000, 1)
    df = spark.createDataFrame(rows, "id long, k string, v double")
    got = {r["k"]: r["p"] for r in quantiles(distribution(df, ["k"], "v"), ["k"], {"p": q}, width=DAYS_WIDTH).collect()}
    for k in {r[1] for r in rows}:
        want = np.quantile([r[2] for r in rows if r[1] == k], q)
        assert got[k] == pytest.approx(want, abs=1e-9)


def test_order_statistics_with_wide_and_narrow_slices(spark):
    rows = skewed(500, 2)
    df = spark.createDataFrame(rows, "id long, k string, v double")
    values = sorted(r[2] for r in rows)
    for width in (1e-6, 1.0, 1e9):
        got = order_statistics(
            distribution(df, [], "v"), [], {"a": "0", "b": "250", "c": "rows - 1"}, width=width
        ).first()
        assert (got["a"], got["b"], got["c"]) == (values[0], values[250], values[-1])


def test_running_before_is_strict(spark):
    df = spark.createDataFrame([("a", float(v), v) for v in (1, 2, 3, 10, 11)], "k string, v double, n long")
    got = {r["v"]: r["before_n"] for r in running_before(df, ["k"], "v", ["n"], width=2.0).collect()}
    assert got == {1.0: 0, 2.0: 1, 3.0: 3, 10.0: 6, 11.0: 16}


def test_rank_rows_splits_ties_by_digest(spark):
    rng = random.Random(3)
    rows = [(str(i), None if i % 50 == 0 else ("hot" if i % 3 else "cold"), float(rng.randrange(4)) / 4) for i in range(2000)]
    df = spark.createDataFrame(rows, "id string, k string, s double")
    got = {r["id"]: r["rank"] for r in rank_rows(df, ["k"], "s", "id", width=SCORE_WIDTH).collect()}
    assert len(got) == len(rows)
    for key in ("hot", "cold", None):
        group = [r for r in rows if r[1] == key]
        group.sort(key=lambda r: (-r[2], hashlib.md5(r[0].encode()).hexdigest(), r[0]))
        assert [got[r[0]] for r in group] == list(range(1, len(group) + 1))


def test_sample_is_exact_and_repeats(spark):
    df = spark.range(5000).selectExpr("CAST(id AS string) AS id")
    one = {r["id"] for r in sample_exactly(df, 700, "id", 42).collect()}
    two = {r["id"] for r in sample_exactly(df.repartition(7), 700, "id", 42).collect()}
    assert len(one) == 700 and one == two
    assert sample_exactly(df, 9000, "id", 42).count() == 5000


@pytest.mark.parametrize("spread", [1e-12, 1.0, 1e15])
def test_digits_need_no_width(spark, spread):
    """Any range, with most values in one far corner of it and a hot value."""
    rng = random.Random(7)
    rows = [("k", 5 * spread if i % 3 == 0 else rng.random() * spread * (1e-7 if i % 2 else 1.0)) for i in range(4000)]
    rows += [("one", -3.5), ("empty", None), (None, 2.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    ranks = {"a": "0", "b": "rows div 3", "c": "rows div 2", "d": "rows - 1"}
    got = {r["k"]: r for r in order_statistics(distribution(df, ["k"], "v"), ["k"], ranks).collect()}
    assert set(got) == {"k", "one", None}
    for key in got:
        values = sorted(v for k, v in rows if k == key and v is not None)
        n = len(values)
        assert [got[key][c] for c in "abcd"] == [values[i] for i in (0, n // 3, n // 2, n - 1)] and got[key]["rows"] == n


def test_no_window_is_without_a_key_but_over_cells(spark):
    """The plan of an unkeyed selection orders cells, and values of one cell, never all values."""
    df = spark.range(100_000).selectExpr("CAST(id AS double) AS v")
    plan = order_statistics(distribution(df, [], "v"), [], {"m": "rows div 2"})._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window " in line]
    assert len(windows) >= 3 and all("_cut" in w or "_what" in w or "_m" in w for w in windows)


def test_a_sample_has_its_size_with_repeated_ids(spark):
    rows = [("a", i // 4) for i in range(40)] + [("b", None)] * 30 + [(None, 1)] * 5
    df = spark.createDataFrame(rows, "id string, v int")
    for n in (0, 1, 5, 33, 70, 74, 75, 200):
        one = sample_exactly(df, n, "id", 3).collect()
        two = sample_exactly(df.repartition(5), n, "id", 3).collect()
        assert len(one) == min(n, 75) and sorted(map(str, one)) == sorted(map(str, two))
    assert sample_exactly(df.limit(0), 5, "id", 3).count() == 0


def test_many_parts_number_a_tie_alike(spark):
    df = spark.range(500).selectExpr("CAST(id AS string) AS id", "0D AS z")
    ranks = [{r["id"]: r["rank"] for r in rank_rows(df, [], "z", "id", parts=p).collect()} for p in (1, 3, 5)]
    assert ranks[0] == ranks[1] == ranks[2] and sorted(ranks[0].values()) == list(range(1, 501))
