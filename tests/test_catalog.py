"""The scored table in the catalog, its views, and what they read."""

import datetime as dt
import re

import pytest

from civicspark.plans import grading
from civicspark.schemas import SCORES
from civicspark.sources import catalog
from civicspark.testbed import adapter, queries


def run(spark, n, score=0.5):
    when = dt.datetime(2026, 9, 24)
    rows = [("u", str(i), "A", "X", "C", "E", "S", when, when, 5.0, True, score, i, i % 2 == 0, "m", "a", "s") for i in range(n)]
    return spark.createDataFrame(rows, SCORES)


@pytest.fixture
def table(spark, tmp_path):
    catalog.create_scores_table(spark, "scored_test", str(tmp_path / "scores"))
    yield "scored_test"
    spark.sql("DROP TABLE scored_test")


def test_a_rerun_replaces_its_own_partition_only(spark, table):
    for asof, n in (("2026-09-24", 3), ("2026-10-01", 4)):
        catalog.insert_run(run(spark, n), table, asof)
    def files():
        return set(spark.sql(f"SELECT DISTINCT input_file_name() AS f FROM {table} WHERE `asof` = '2026-10-01'").toPandas()["f"])

    other = files()
    catalog.insert_run(run(spark, 2, 0.75), table, "2026-09-24")
    got = {r["asof"]: (r["n"], r["s"]) for r in spark.sql(f"SELECT `asof`, count(*) AS n, max(score) AS s FROM {table} GROUP BY 1").collect()}
    assert got == {"2026-09-24": (2, 0.75), "2026-10-01": (4, 0.5)} and files() == other
    with pytest.raises(ValueError):
        catalog.insert_run(run(spark, 1), table, "2026-09-24') --")


def test_a_filter_on_the_run_opens_one_partition(spark, sf):
    views = queries.catalogued(spark, sf)
    plan = spark.table(views["top"]).where("`asof` = '2000-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(asof" in plan
    files = spark.table(views["top"]).where("`asof` = '2000-01-01'").inputFiles()
    through = spark.table(views["outcomes"]).where("scored_asof = '2000-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert files and all("asof=2000-01-01" in f for f in files)
    assert any("2000-01-01" in f for f in re.findall(r"PartitionFilters: \[([^\]]*)", through))


def test_the_views_equal_the_operators(spark, sf):
    views = queries.catalogued(spark, sf)
    outcomes = adapter.outcomes(spark, sf)
    columns = sorted(set(grading.GRADE_COLUMNS))
    assert {tuple(r) for r in spark.table(views["outcomes"]).select(columns).collect()} == {tuple(r) for r in outcomes.select(columns).collect()}
    names = ["usage", "flagged", "requests", "late", "late_rate"]
    assert sorted(map(tuple, spark.table(views["grade"]).select(names).collect())) == sorted(map(tuple, grading.shadow_grade(outcomes).select(names).collect()))
