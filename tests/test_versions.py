"""Stored model versions: registry entries, scoring side by side, many levels, missing values."""

import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from civicspark.plans import champion, features, metrics, model, registry
from civicspark.schemas import CATEGORICAL, FEATURE_SETS
from civicspark.testbed import adapter
from civicspark.testbed import queries as Q

from helpers import day

TREES = {"maxIter": 5, "maxDepth": 4}


def entries(spark, rows):
    """``rows``: (version, status, day recorded[, path])."""
    data = [("g", v, s, day(f"2025-01-0{v}"), "u", str(v), p[0] if p else f"models/{v}", day(d)) for v, s, d, *p in rows]
    return spark.createDataFrame(data, registry.ENTRY)


def test_later_entries_change_a_status(spark, tmp_path):
    path = str(tmp_path / "registry")
    registry.record(entries(spark, [(1, "Approved", "2025-01-01"), (2, "PendingManualApproval", "2025-01-02")]), path)
    assert registry.champion(registry.read_registry(spark, path), "g")["version"] == 1
    registry.record(entries(spark, [(2, "Approved", "2025-02-01")]), path)
    assert registry.champion(registry.read_registry(spark, path), "g")["path"] == "models/2"
    registry.record(entries(spark, [(2, "Rejected", "2025-02-02")]), path)
    table = registry.read_registry(spark, path)
    assert registry.champion(table, "g")["version"] == 1 and table.count() == 2
    assert registry.champion(table, "other") is None


def test_an_unreadable_registry_or_version_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        registry.read_registry(spark, str(tmp_path / "nowhere"))
    path = str(tmp_path / "registry")
    registry.record(entries(spark, [(1, "Approved", "2025-01-01", None)]), path)
    with pytest.raises(champion.RegistryError, match="nothing is stored"):
        registry.champion(registry.read_registry(spark, path), "g")


def average_precision(rows):
    """By hand: precision at each distinct score, weighted by the recall it adds."""
    late, seen, hits, total = sum(b for _, b in rows), 0, 0, 0.0
    for score in sorted({s for s, _ in rows}, reverse=True):
        here = [b for s, b in rows if s == score]
        seen, hits = seen + len(here), hits + sum(here)
        total += sum(here) * hits / seen
    return total / late


@pytest.fixture(scope="module")
def two(spark, sf):
    """Two versions with other feature sets and other thresholds."""
    done, train_x, _, _ = Q.fitted(spark, sf)
    other = done.thresholds.withColumn("threshold_days", F.col("threshold_days") * 1.5)
    first = model.train(train_x.select(Q.ID, *FEATURE_SETS["baseline"], "breach"), done.thresholds, "baseline", **TREES)
    second = model.train(train_x, other, **TREES)
    return done, first, second


def test_versions_score_as_they_would_alone(spark, sf, two):
    done, first, second = two
    raw, comms, hol = adapter.requests(spark, sf), adapter.communities(spark, sf), adapter.holidays(spark, sf)
    third = Q.fitted(spark, sf)[3]
    models = {"a": first, "b": second, "c": third}
    got = {r[Q.ID]: r for r in registry.score_versions(models, done.test, raw, comms, hol, carry=("breach",)).collect()}
    for name, m in models.items():
        x = features.featurize(done.test, raw, m.thresholds, comms, hol, m.feature_set)
        alone = {r[Q.ID]: r["pred"] for r in m.predict(x).collect()}
        assert alone.keys() == got.keys()
        assert all(got[i][f"pred_{name}"] == pytest.approx(p, abs=1e-12) for i, p in alone.items())


def test_the_margin_is_that_of_the_stored_champion(spark, sf, two, tmp_path):
    done, first, second = two
    path = str(tmp_path / "versions")
    model.save(first, f"{path}/1", {"rows": 1.0})
    registry.record(entries(spark, [(1, "Approved", "2025-01-01", f"{path}/1")]), f"{path}/registry")
    table = registry.read_registry(spark, f"{path}/registry")
    args = second, done.test, adapter.requests(spark, sf), adapter.communities(spark, sf), adapter.holidays(spark, sf)
    scores, margin = registry.compare(table, "g", *args)
    rows, row = scores.collect(), margin.first()
    want = {n: round(average_precision([(r[f"pred_{n}"], r["breach"]) for r in rows]), 4) for n in ("challenger", "champion")}
    assert (row["champion_exists"], row["champion_version"]) == (1, 1)
    assert row["pr_auc"] == pytest.approx(want["challenger"], abs=1e-4) and row["champion_pr_auc"] == pytest.approx(want["champion"], abs=1e-4)
    assert row["margin"] == pytest.approx(want["challenger"] - want["champion"], abs=2e-4)
    scores, margin = registry.compare(table.where("version > 1"), "g", *args)
    row = margin.first()
    assert (row["champion_exists"], row["champion_pr_auc"], row["margin"]) == (0, None, 0.0) and "pred_champion" not in scores.columns


def rows_with_levels(spark, n, levels, seed):
    """A late rate that depends on the level alone, and a number that is missing for late rows."""
    draw = random.Random(seed)
    data = []
    for i in range(n):
        level = draw.randrange(levels)
        late = int(draw.random() < (0.9 if level % 2 else 0.1))
        data.append((str(i), f"L{level}", "a", "c", "s", None if draw.random() < (0.7 if late else 0.1) else draw.random() * 50, late))
    base = spark.createDataFrame(data, f"{Q.ID} string, service_name string, agency_responsible string, comm_name string, source string, cat_late_90d double, breach int")
    rest = [c for c in FEATURE_SETS["challenger"] if c not in (*CATEGORICAL, "cat_late_90d")]
    return base.withColumns({c: F.lit(1.0) for c in rest})


def test_more_levels_than_bins_can_be_fitted(spark, tmp_path):
    train, test = rows_with_levels(spark, 40_000, 5_000, 1), rows_with_levels(spark, 4_000, 5_000, 2)
    m = model.train(train.drop("cat_late_90d").withColumn("cat_late_90d", F.lit(1.0)), spark.createDataFrame([("x", 1.0)], "service_name string, threshold_days double"), **TREES)
    assert m.grouped == ("service_name",) and len(m.schema()["levels"]["service_name"]) <= model.GROUPS
    found = metrics.evaluate(m.predict(test.withColumn("cat_late_90d", F.lit(1.0))))
    assert found["roc_auc"] > 0.75  # eight rows a level: the best possible is about 0.87
    odd = test.limit(3).withColumn("service_name", F.lit("never seen"))
    assert m.predict(odd).select("pred").distinct().count() == 1
    model.save(m, str(tmp_path / "m"), {"rows": 1.0})
    again, _ = model.load(spark, str(tmp_path / "m"))
    assert {tuple(r) for r in again.predict(test).select(Q.ID, "pred").collect()} == {tuple(r) for r in m.predict(test).select(Q.ID, "pred").collect()}


def test_level_groups_see_training_rows_only(spark):
    rows = rows_with_levels(spark, 4_000, 300, 3)
    got = {r["level"]: r["label"] for r in model.level_groups(rows, "service_name", 10).collect()}
    count, late = {}, {}
    for r in rows.collect():
        count[r["service_name"]] = count.get(r["service_name"], 0) + 1
        late[r["service_name"]] = late.get(r["service_name"], 0) + r["breach"]
    prior = sum(late.values()) / sum(count.values())
    rate = {k: (late[k] + prior * model.SMOOTH) / (count[k] + model.SMOOTH) for k in count}
    want = {k: f"g{int(sum(count[j] for j in count if rate[j] < rate[k] - 1e-12) * 10 / 4000):05d}" for k in count}
    assert got == want


def test_missing_values_go_where_the_gain_is(spark):
    train, test = rows_with_levels(spark, 6_000, 3, 4), rows_with_levels(spark, 2_000, 3, 5)
    m = model.train(train, spark.createDataFrame([("x", 1.0)], "service_name string, threshold_days double"), **TREES)
    assert m.missing == ("cat_late_90d",) and not m.grouped
    scored = m.predict(test).groupBy("service_name", F.col("cat_late_90d").isNull().alias("gone")).agg(F.avg("pred").alias("p"))
    by = {(r["service_name"], r["gone"]): r["p"] for r in scored.collect()}
    assert all(by[(k, True)] > by[(k, False)] + 0.1 for k in ("L0", "L1", "L2"))
    assert dict(m.importance())["cat_late_90d"] > 0.1
