"""Pulling a keyed feed to its end: key ranges read side by side, page by page, in waves that are
audited and remembered, so an interrupted pull goes on where it stopped."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, StructField, StructType

# the reader travels to the workers by value: they need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LOG = "wave int, ranges int, pages long, rows long, high string, taken long"
RANGE, PAGE = "_range", "_page"


class Feed(Protocol):
    """What is pulled from: an HTTP service in a deployment. It travels to the workers, so it has to
    pickle, and asks again on its own when a request fails."""

    def page(self, after: Any, skip: int, upto: Any, size: int) -> pa.Table:
        """At most ``size`` rows in key order: those with a key in ``[after, upto]``, the first ``skip``
        of them at ``after`` left out. ``after`` is None at the feed's beginning."""


@dataclass
class FolderFeed:
    """A folder or file of Parquet as a feed. A range is sorted once, on its first page."""

    path: str
    key: str
    columns: tuple

    def page(self, after: Any, skip: int, upto: Any, size: int) -> pa.Table:
        held = getattr(self, "_held", None)
        if held is None or held[0] != upto or (held[1] is not None and (after is None or after < held[1])):
            low = pc.field(self.key) <= upto
            low = low if after is None else low & (pc.field(self.key) >= after)
            # few batches read ahead, so that a worker holds little beside the rows of its range
            rows = ds.dataset(self.path, format="parquet").to_table(
                columns=list(self.columns), filter=low, batch_size=1 << 16, batch_readahead=2, fragment_readahead=1
            )
            held = self._held = (upto, after, rows.sort_by([(c, "ascending") for c in (self.key, *(c for c in self.columns if c != self.key))]))
        rows = held[2]
        start = 0 if after is None else pc.sum(pc.less(rows[self.key], after)).as_py() or 0
        return rows.slice(start + skip, size)


@dataclass
class KeyRange(InputPartition):
    """Keys after ``low`` (from the beginning if None) up to and with ``high``."""

    number: int
    low: Any
    high: Any

    def __init__(self, number: int, low: Any, high: Any):
        self.number, self.low, self.high = number, low, high


def _pages(feed: Feed, key: str, span: KeyRange, size: int) -> Iterator[pa.Table]:
    """The pages of one range. The cursor is a key and how many of its rows have come, so a key that
    goes on over a page's end is neither lost nor taken twice."""
    after, skip = span.low, 0
    if after is not None:  # all rows of the lower bound belong to the range before
        while rows := feed.page(after, skip, after, size).num_rows:
            skip += rows
    while (page := feed.page(after, skip, span.high, size)).num_rows:
        yield page
        last = page[key][-1].as_py()
        there = pc.sum(pc.equal(page[key], last)).as_py()
        skip = skip + there if last == after else there
        after = last


def paged_source(feed: Feed, key: str, schema: StructType, ranges: list[KeyRange], size: int) -> type[DataSource]:
    """A batch data source over ``feed``: a partition per key range, the range's and page's number
    beside every row."""
    name = f"paged_{uuid.uuid4().hex}"
    shape = StructType([*schema.fields, StructField(RANGE, IntegerType()), StructField(PAGE, IntegerType())])

    class Reader(DataSourceReader):
        def partitions(self):
            return ranges

        def read(self, partition):
            kinds = pa.schema([pa.field(f.name, page_types[f.name]) for f in schema.fields])
            for number, page in enumerate(_pages(feed, key, partition, size)):
                rows = page.select(kinds.names).cast(kinds).combine_chunks()
                rows = rows.append_column(RANGE, pa.array([partition.number] * len(rows), pa.int32()))
                yield from rows.append_column(PAGE, pa.array([number] * len(rows), pa.int32())).to_batches()

    class Paged(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return shape

        def reader(self, schema):
            return Reader()

    page_types = {f.name: to_arrow_type(f.dataType) for f in schema.fields}
    return Paged


def plan_ranges(keys: DataFrame, key: str, rows: int, after: Any = None) -> list[tuple[Any, Any, int]]:
    """``(low, high, rows)`` of ranges of about ``rows`` rows each, in key order, for all keys after
    ``after``. Equal keys are counted before they are dealt out, so a key is never in two ranges; one
    that has more rows than a range is a range of its own."""
    rest = keys if after is None else keys.where(F.col(key) > F.lit(after))
    counts = rest.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    n = max(1, -(-rest.count() // rows))
    dealt = counts.repartitionByRange(n, "_key").groupBy(F.spark_partition_id().alias("_p"))
    found = dealt.agg(F.max("_key").alias("high"), F.sum("_n").alias("rows")).orderBy("high").collect()
    lows = [after, *[r["high"] for r in found]]
    return [(low, r["high"], r["rows"]) for low, r in zip(lows, found, strict=False)]


class AuditError(RuntimeError):
    """The pages of a pull don't add up to what the feed holds."""


def _log(spark: SparkSession, base: str) -> list:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/log")
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(LOG).json(f"{base}/log").orderBy("wave").collect() if there else []


def pull(
    spark: SparkSession, feed: Feed, keys: DataFrame, key: str, schema: StructType, base: str, *,
    rows_per_range: int = 500_000, page_size: int = 50_000, ranges_per_wave: int = 64, waves: int | None = None,
) -> DataFrame:
    """Pull every row of ``feed`` after the highest key already stored under ``base``, and return the log.

    ``keys`` is the feed's key column (its counts by key are what a service answers in one grouped
    request). A wave reads its ranges side by side, is stored, and counted again from what was stored; only
    if each range holds as many rows as the feed said is the wave recorded, with its highest key. A
    wave that was cut off left no record and is overwritten by the next try. ``waves`` ends a
    pull early; the next call goes on after the last recorded key.
    """
    done = _log(spark, base)
    kind = keys.schema[key].dataType
    high = spark.createDataFrame([(done[-1]["high"] if done else None,)], "h string").select(F.col("h").cast(kind)).first()[0]
    plan = plan_ranges(keys, key, rows_per_range, high)
    for number, at in enumerate(range(0, len(plan), ranges_per_wave)):
        if waves is not None and number >= waves:
            break
        spans = plan[at : at + ranges_per_wave]
        source = paged_source(feed, key, schema, [KeyRange(i, low, top) for i, (low, top, _) in enumerate(spans)], page_size)
        spark.dataSource.register(source)
        wave = len(done) + number
        target = f"{base}/data/wave={wave}"
        spark.read.format(source.name()).load().write.mode("overwrite").parquet(target)
        stored = spark.read.parquet(target).groupBy(RANGE).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(PAGE).alias("pages"))
        found = {r[RANGE]: r for r in stored.collect()}
        off = [f"{low}..{top}: {found[i]['n'] if i in found else 0} of {n}" for i, (low, top, n) in enumerate(spans) if i not in found or found[i]["n"] != n]
        if off:
            raise AuditError(f"wave {wave}: {'; '.join(off[:5])}")
        rows = sum(n for *_, n in spans)
        taken = (done[-1]["taken"] if done and number == 0 else 0 if number == 0 else taken) + rows
        entry = (wave, len(spans), sum(r["pages"] for r in found.values()), rows, str(spans[-1][1]), taken)
        spark.createDataFrame([entry], LOG).coalesce(1).write.mode("append").json(f"{base}/log")
    return spark.createDataFrame(_log(spark, base), LOG)


def read_pull(spark: SparkSession, base: str) -> DataFrame:
    """The rows of all recorded waves."""
    done = _log(spark, base)
    if not done:
        raise FileNotFoundError(f"no recorded pull under {base}")
    return spark.read.parquet(*[f"{base}/data/wave={r['wave']}" for r in done]).drop(RANGE, PAGE)


def audit(spark: SparkSession, base: str, keys: DataFrame) -> DataFrame:
    """One row: what the log counted, what is stored, what the feed holds now, and whether all agree."""
    held = read_pull(spark, base).agg(F.count(F.lit(1)).alias("stored"))
    logged = spark.createDataFrame(_log(spark, base), LOG).agg(F.sum("rows").alias("logged"), F.count(F.lit(1)).alias("waves"))
    there = keys.agg(F.count(F.lit(1)).alias("there"))
    return held.crossJoin(logged).crossJoin(there).withColumn("complete", (F.col("stored") == F.col("logged")) & (F.col("stored") == F.col("there")))
