"""Ingest round trips and the scored table."""

import datetime as dt

from pyspark.sql import functions as F

from civicspark.sources import requests as raw_zone
from civicspark.sources import snapshots, tables


def land(spark, base, asof, n):
    rows = [
        (str(i), f"{2023 + i % 2}-0{1 + i % 3}-05T00:00:00.000", None if i % 4 else "2025-01-01", "A", "secret")
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "service_request_id string, requested_date string, closed_date string, service_name string, address string")
    return raw_zone.pull_snapshot(df, base, asof, resource="requests", pulled_at=f"{asof}T06:00:00+00:00")


def test_a_rebuild_replaces_and_replay_goes_back(spark, tmp_path):
    base, out = str(tmp_path / "raw"), str(tmp_path / "processed")
    assert land(spark, base, "2026-09-23", 30).first()["row_count"] == 30
    land(spark, base, "2026-10-01", 36)
    for _ in range(2):
        assert snapshots.replay(spark, base, out, "2026-09-23") == "2026-09-23"
        assert raw_zone.load_requests(spark, out).count() == 30
    assert snapshots.latest_asof(spark, base).first()["asof"] == "2026-10-01"
    assert snapshots.replay(spark, base, out) == "2026-10-01"
    rows = raw_zone.load_requests(spark, out)
    assert rows.count() == 36 and "address" not in rows.columns and "year" not in rows.columns
    assert raw_zone.load_requests(spark, out, since="2024-02-01").count() == rows.where("requested_date >= '2024-02-01'").count()


def test_unparseable_values_become_null(spark):
    df = spark.createDataFrame(
        [("1", "2024-01-01T00:00:00+00:00", "junk", "x"), ("2", "nope", None, "1.5"), ("3", "2024-01-01T08:15:00.315697+00:00", None, None)],
        "service_request_id string, requested_date string, closed_date string, longitude string",
    )
    got = raw_zone.derive_partitions(raw_zone.cast_intake(df)).orderBy("service_request_id").collect()
    assert [r["service_request_id"] for r in got] == ["1", "3"]
    assert got[0]["closed_date"] is None and got[0]["longitude"] is None and got[1]["requested_date"].microsecond == 315697


def test_dedupe_keeps_the_newest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", 1, "q"), (None, 1, "n")], "service_request_id string, updated_date int, v string")
    got = {r["service_request_id"]: r["v"] for r in raw_zone.dedupe(df).collect()}
    assert got == {"a": "z", "b": "q", None: "n"}


def test_pages_walk_the_keys_in_order(spark):
    df = spark.range(25).selectExpr("lpad(CAST(id AS string), 3, '0') AS id")
    last, seen = None, []
    while page := [r["id"] for r in raw_zone.keyset_page(df, "id", last, 10).collect()]:
        seen += page
        last = page[-1]
    assert seen == [f"{i:03d}" for i in range(25)]
    assert raw_zone.new_rows(df, "id", "019").count() == 5


def test_a_run_replaces_only_itself(spark, tmp_path):
    path = str(tmp_path / "scores")
    when = dt.datetime(2026, 9, 24, 1, 2, 3, 456789)

    def run(n):
        rows = [("u", str(i), "A", "X", "C", "E", "S", when, when, 5.0, True, 0.5, i, False, "m", "a", "s") for i in range(n)]
        from civicspark.schemas import SCORES

        return spark.createDataFrame(rows, SCORES)

    for asof, n in (("2026-09-24", 3), ("2026-10-01", 4), ("2026-09-24", 2)):
        tables.write_scores(run(n), path, asof)
    out = tables.read_scores(spark, path)
    assert {r["asof"]: r["count"] for r in out.groupBy("asof").count().collect()} == {"2026-09-24": 2, "2026-10-01": 4}
    assert out.select(F.date_format("deadline", "SSSSSS")).first()[0] == "456000"


def test_side_tables(spark, tmp_path):
    path = tmp_path / "metrics.csv"
    path.write_text("comm_code,value,n\nAAA,0.5,10\n,0.1,3\nBBB,,4\nCCC,1.5,7.0\n")
    got = [tuple(r) for r in tables.load_metrics(spark, str(path)).collect()]
    assert got == [("AAA", 0.5, 10), ("CCC", 1.5, 7)]
    path = tmp_path / "communities.json"
    path.write_text('[{"comm_code": "X1", "name": "N", "sector": "EAST", "srg": "S", "class": "R"},\n {"comm_code": "X2"}]')
    assert tables.load_communities(spark, str(path)).count() == 2
    path = tmp_path / "predictions.csv"
    path.write_text("comm_code,breach,pred\n007,1,0.5\n")
    assert tables.load_predictions(spark, str(path)).first()["comm_code"] == "007"
    left = spark.createDataFrame([("a",), ("b",)], "key string")
    assert [r[0] for r in snapshots.stale_keys(left, left.where("key = 'a'")).collect()] == ["b"]
