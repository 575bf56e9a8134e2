"""Publishing without a gap: only differing months are written, readers never miss a table."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from civicspark.sources import published, requests as raw_zone


def rows(spark, data):
    """``data``: (id, requested, value)."""
    df = spark.createDataFrame([(str(i), d, v) for i, d, v in data], "service_request_id string, requested_date string, v string")
    return raw_zone.derive_partitions(df.withColumn("requested_date", F.col("requested_date").cast("timestamp")))


BASE = [(i, f"2024-0{1 + i % 3}-05", "x" if i % 2 else None) for i in range(30)]


def seen(spark, path, **since):
    return sorted((r["service_request_id"], str(r["requested_date"])[:10], r["v"]) for r in published.read_published(spark, path, **since).collect())


def want(data):
    return sorted((str(i), d, v) for i, d, v in data)


def states(report):
    return {(r["year"], r["month"]): r["state"] for r in report.collect()}


def test_one_changed_row_rewrites_one_month(spark, tmp_path):
    path = str(tmp_path / "t")
    assert set(states(published.publish(rows(spark, BASE), path)).values()) == {"new"}
    folders = {r["month"]: r["folder"] for r in published.manifest(spark, path).collect()}
    changed = [(i, d, "y" if i == 4 else v) for i, d, v in BASE]
    assert states(published.publish(rows(spark, changed), path)) == {(2024, 1): "kept", (2024, 2): "changed", (2024, 3): "kept"}
    after = {r["month"]: r["folder"] for r in published.manifest(spark, path).collect()}
    assert after[1] == folders[1] and after[3] == folders[3] and after[2] != folders[2]
    assert seen(spark, path) == want(changed)


def test_another_order_rewrites_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    published.publish(rows(spark, BASE), path)
    before = [n for n, _ in published._pointers(published.Folder(spark, path))]
    assert set(states(published.publish(rows(spark, BASE[::-1]).repartition(7), path)).values()) == {"kept"}
    assert [n for n, _ in published._pointers(published.Folder(spark, path))] == before


def test_digests_tell_repeats_and_moved_nulls(spark):
    def digest(data):
        df = spark.createDataFrame(data, "a string, b string").withColumns({"year": F.lit(2024), "month": F.lit(1)})
        return published.month_digests(df).first()["digest"]

    one = digest([("x", None), ("y", "z")])
    assert one == digest([("y", "z"), ("x", None)])
    assert len({one, digest([(None, "x"), ("y", "z")]), digest([("x", None), ("y", "z"), ("y", "z")]), digest([("x", None)] * 2), digest([("y", "z")] * 2)}) == 5


def test_months_that_are_gone_are_stale_and_old_builds_go(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(4):
        data = [(i, d, f"v{n}") if d.startswith("2024-01") else (i, d, v) for i, d, v in BASE if not (n == 3 and d.startswith("2024-03"))]
        report = published.publish(rows(spark, data), path)
    assert states(report) == {(2024, 1): "changed", (2024, 2): "kept", (2024, 3): "stale"}
    assert seen(spark, path) == want(data)
    kept = {str(p.relative_to(path)) for p in Path(path).glob("data/*/*/*") if p.is_dir()}
    assert len(kept) == 4  # two Januaries, February, and the March of the build before
    assert len(list(Path(path, "manifests").iterdir())) == 2 and len([p for p in Path(path, "current").iterdir() if p.name.isdigit()]) == 2


def test_a_build_that_fails_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    published.publish(rows(spark, BASE), path)
    reader = published.read_published(spark, path)
    bad = rows(spark, [(i, d, "new") for i, d, _ in BASE])
    # the rows can be counted, but not written
    broken = bad.withColumn("v", F.when(F.col("service_request_id") == "7", F.raise_error(F.lit("half-way")).cast("string")).otherwise(F.col("v")))
    real, published.month_digests = published.month_digests, lambda df: real(bad)
    try:
        with pytest.raises(Exception, match="half-way"):
            published.publish(broken, path)
    finally:
        published.month_digests = real
    assert seen(spark, path) == want(BASE) and reader.count() == 30
    published.publish(bad, path)
    assert seen(spark, path) == want([(i, d, "new") for i, d, _ in BASE]) and reader.count() == 30
    left = Path(path, "data/build=cut-off/year=2024/month=1")
    left.mkdir(parents=True)
    assert "data/build=cut-off" in published.remove_unpublished(spark, path)
    assert not left.exists() and reader.count() == 30


def test_two_builds_at_once_one_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    published.publish(rows(spark, BASE), path)
    folder = published.Folder(spark, path)
    folder.create("current/000000000002", "")  # another writer is about to say what it built
    assert seen(spark, path) == want(BASE)
    with pytest.raises(Exception, match="exists"):
        published.publish(rows(spark, BASE[:-1]), path)
    assert seen(spark, path) == want(BASE)


def test_since_opens_later_months_only(spark, tmp_path):
    path = str(tmp_path / "t")
    published.publish(rows(spark, BASE), path)
    part = published.read_published(spark, path, since="2024-02-20")
    assert {f.rsplit("/year=")[1].split("/")[1] for f in part.inputFiles()} == {"month=2", "month=3"}
    assert published.read_published(spark, path, since="2030-01-01").count() == 0
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, str(tmp_path / "nothing"))


def test_an_empty_table_can_be_published(spark, tmp_path):
    path = str(tmp_path / "t")
    published.publish(rows(spark, BASE[:0]), path)
    assert seen(spark, path) == [] and published.read_published(spark, path).columns == ["service_request_id", "requested_date", "v", "year", "month"]
