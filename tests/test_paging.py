"""Pulling a feed: repeated keys at page ends, interrupted pulls, audits."""

import sys
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from civicspark.sources import paging

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def feed_of(tmp_path, keys):
    """Keys may repeat; the second column tells rows of a key apart."""
    path = tmp_path / "feed.parquet"
    pq.write_table(pa.table({"k": pa.array(keys), "n": pa.array(range(len(keys)), pa.int64())}), path)
    return paging.FolderFeed(str(path), "k", ("k", "n")), str(path)


KEYS = ["a"] * 25 + ["b"] + ["c"] * 3 + [f"d{i:02d}" for i in range(40)] + ["e"] * 61


def pulled(spark, base):
    return sorted((r["k"], r["n"]) for r in paging.read_pull(spark, base).collect())


@pytest.mark.parametrize(("size", "rows"), [(1, 40), (7, 10), (10, 1000), (1000, 25)])
def test_no_row_is_lost_or_taken_twice(spark, tmp_path, size, rows):
    feed, path = feed_of(tmp_path, KEYS)
    keys, base = spark.read.parquet(path), str(tmp_path / "pull")
    log = paging.pull(spark, feed, keys.select("k"), "k", keys.schema, base, rows_per_range=rows, page_size=size, ranges_per_wave=3)
    assert pulled(spark, base) == sorted(zip(KEYS, range(len(KEYS)), strict=True))
    assert log.agg(F.sum("rows")).first()[0] == len(KEYS)
    assert paging.audit(spark, base, keys).first()["complete"]


def test_an_interrupted_pull_goes_on(spark, tmp_path):
    feed, path = feed_of(tmp_path, KEYS)
    keys, base = spark.read.parquet(path), str(tmp_path / "pull")
    args = (keys.select("k"), "k", keys.schema, base)
    first = paging.pull(spark, feed, *args, rows_per_range=20, page_size=6, ranges_per_wave=2, waves=1).collect()
    assert len(first) == 1 and 0 < first[0]["rows"] < len(KEYS)
    assert not paging.audit(spark, base, keys).first()["complete"]
    with pytest.raises(Exception, match="gone away"):
        paging.pull(spark, Broken(feed.path, feed.key, feed.columns, first[0]["high"]), *args, rows_per_range=20, page_size=6, ranges_per_wave=2)
    assert [r["wave"] for r in paging._log(spark, base)] == [0]
    log = paging.pull(spark, feed, *args, rows_per_range=20, page_size=6, ranges_per_wave=2).collect()
    assert [r["wave"] for r in log] == list(range(len(log))) and len(log) > 1 and log[-1]["taken"] == len(KEYS)
    assert pulled(spark, base) == sorted(zip(KEYS, range(len(KEYS)), strict=True))


def test_later_rows_are_pulled_by_the_next_call(spark, tmp_path):
    base = str(tmp_path / "pull")
    for keys in ([1, 2, 2, 3], [1, 2, 2, 3, 4, 4, 9]):
        feed, path = feed_of(tmp_path, keys)
        table = spark.read.parquet(path)
        log = paging.pull(spark, feed, table.select("k"), "k", table.schema, base, rows_per_range=2, page_size=1, ranges_per_wave=9)
    assert pulled(spark, base) == [(1, 0), (2, 1), (2, 2), (3, 3), (4, 4), (4, 5), (9, 6)]
    assert [r["high"] for r in log.collect()] == ["3", "9"]
    again = paging.pull(spark, feed, table.select("k"), "k", table.schema, base)
    assert again.count() == 2


@dataclass
class Broken(paging.FolderFeed):
    fine_until: str

    def page(self, after, skip, upto, size):
        if after is not None and after > self.fine_until:
            raise ConnectionError("the service has gone away")
        return paging.FolderFeed.page(self, after, skip, upto, size)


@dataclass
class Short(paging.FolderFeed):
    def page(self, after, skip, upto, size):
        page = paging.FolderFeed.page(self, after, skip, upto, size)
        return page.filter(pc.not_equal(page["k"], "d17"))


def test_pages_that_do_not_add_up_are_refused(spark, tmp_path):
    feed, path = feed_of(tmp_path, KEYS)
    keys, base = spark.read.parquet(path), str(tmp_path / "pull")
    with pytest.raises(paging.AuditError, match="wave 0"):
        paging.pull(spark, Short(feed.path, feed.key, feed.columns), keys.select("k"), "k", keys.schema, base, page_size=8)
    with pytest.raises(FileNotFoundError):
        paging.read_pull(spark, base)
