"""The gate: break one thing, and the named check fails."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from civicspark.plans import quality
from civicspark.settings import GateSettings
from helpers import micros

GATE = GateSettings(min_rows=100, group_min_rows=20, bulk_close_min_rows=10)
ASOF = micros("2025-05-21")
SHAPE = ", ".join(
    f"{c} string"
    for c in (
        "service_request_id", "requested_date", "closed_date", "service_name", "agency_responsible",
        "comm_code", "comm_name", "source", "longitude", "latitude",
    )
)


def clean_rows():
    rng = random.Random(42)
    rows = []
    for i in range(400):
        filed = dt.date(2021, 1, 1) + dt.timedelta(days=4 * i)
        tree = i % 2 == 0
        age = int(rng.gammavariate(4, 12) if tree else rng.gammavariate(2, 1.5))
        closed = None if i % 20 == 0 else str(filed + dt.timedelta(days=age)) + "T00:00:00.000"
        rows.append(
            (f"SR-{i:05d}", str(filed) + "T08:15:00.123+00:00" if i % 3 else str(filed),
             closed if closed is None or i % 3 == 0 else str(filed + dt.timedelta(days=age + 1)),
             "Tree Concern" if tree else "Pothole Repair", "Parks" if tree else "Roads", "X",
             ("BELTLINE", "BOWNESS", "HILLHURST")[i % 3], "Phone", "-114.0", "51.0")
        )
    return rows


@pytest.fixture(scope="module")
def clean(spark):
    return spark.createDataFrame(clean_rows(), SHAPE).cache()


def failing(df, **kw):
    return {r["name"] for r in quality.validate(df, ASOF, GATE, **kw).where("NOT passed").collect()}


def test_a_clean_table_passes(clean):
    assert failing(clean) == set()


def test_a_missing_column_stops_the_rest(clean):
    checks = quality.validate(clean.drop("source"), ASOF, GATE).collect()
    assert [(c["name"], c["passed"]) for c in checks] == [("schema", False)]
    assert json.loads(checks[0]["observed"]) == {"missing": "source", "rows": 400}


def test_each_structural_break_is_named(clean, spark):
    assert failing(clean.limit(50)) >= {"row_count"}
    assert failing(clean, baseline_rows=1000) == {"row_count"}
    assert failing(clean.unionByName(clean.limit(20))) >= {"unique_ids"}
    holes = F.when(F.col("service_request_id") > "SR-00010", F.col("service_name"))
    assert "null_rates" in failing(clean.withColumn("service_name", holes))
    late = quality.check_dates(clean, micros("2025-07-20"), GATE).first()
    assert not late["passed"] and "days before as-of" in late["detail"]
    early = quality.check_dates(clean, micros("2025-01-01"), GATE).first()
    assert not early["passed"] and "dated after as-of" in early["detail"]
    junk = clean.withColumn("requested_date", F.when(F.col("service_request_id") == "SR-00003", "junk").otherwise(F.col("requested_date")))
    assert "unparseable" in quality.check_dates(junk, ASOF, GATE).first()["detail"]


def backfill():
    return [
        (f"BF-{i}", str(dt.date(2025, 3, 1) - dt.timedelta(days=150 + 2 * i)), "2025-03-01", "Pothole Repair", "Roads", "M",
         "MONTGOMERY", "Phone", "-114.0", "51.0")
        for i in range(60)
    ]


def test_a_backfilled_community_warns_three_ways(clean, spark):
    df = clean.unionByName(spark.createDataFrame(backfill(), SHAPE))
    checks = quality.validate(df, ASOF, GATE)
    bad = checks.where("NOT passed").collect()
    assert {c["name"] for c in bad} == {"bulk_close", "stale_bulk_close", "group_outliers"}
    assert {c["severity"] for c in bad} == {"warn"} and all("MONTGOMERY" in c["detail"] or "Pothole" in c["detail"] for c in bad)
    assert quality.gate(checks).first()["passed"]
    assert not quality.gate(checks, strict=True).first()["passed"]


def test_slow_but_genuine_is_no_warning(clean):
    closed = F.to_date("closed_date")
    slower = F.date_add(closed, F.datediff(closed, F.to_date("requested_date")) * 6).cast("string")
    df = clean.withColumn("closed_date", F.when(F.col("comm_name") == "BOWNESS", slower).otherwise(F.col("closed_date")))
    assert failing(df) == set()


def test_the_report_is_written_before_the_gate_raises(clean, spark, tmp_path):
    out = str(tmp_path / "validation")
    with pytest.raises(quality.DataValidationError, match="row_count"):
        quality.run_gate(clean.limit(50), ASOF, path=out, settings=GATE)
    saved = spark.read.json(f"{out}/checks")
    assert saved.where("name = 'row_count' AND NOT passed").count() == 1
    verdict = spark.read.json(f"{out}/report").first()
    assert not verdict["passed"] and "row_count" in verdict["failed"].split(",") and verdict["rows"] == 50
    assert quality.previous_rows(spark, f"{out}/report") == 50


def test_every_finding_is_listed(clean, spark):
    """Eight backfilled communities: the check names five and counts the rest, the table has all."""
    rows = [
        (f"{r[0]}-{k}", *r[1:6], f"BACKFILLED {k}", *r[7:]) for k in range(8) for r in backfill()
    ]
    checks, found = quality.examine(clean.unionByName(spark.createDataFrame(rows, SHAPE)), ASOF, GATE)
    named = {r["comm_name"] for r in found.where("name = 'bulk_close'").collect()}
    assert {f"BACKFILLED {k}" for k in range(8)} <= named
    bulk = checks.where("name = 'bulk_close'").first()
    seen = json.loads(bulk["observed"])
    assert seen["found"] == len(named) and f"and {len(named) - 5} more" in bulk["detail"]
    assert seen["tickets"] == found.where("name = 'bulk_close'").agg(F.sum("tickets")).first()[0]
