"""Raw requests to the processed table: read, cast, dedupe, rebuild, page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.schemas import ALLOWED_COLUMNS, COORDINATE_COLUMNS, DATE_COLUMNS, RAW_REQUESTS
from civicspark.session import materialize
from civicspark.sources.published import PARTITIONS, is_published, publish, read_published


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """One raw snapshot: (gzipped) JSON lines, every value as text."""
    return spark.read.schema(RAW_REQUESTS).json(path)


def cast_intake(raw: DataFrame) -> DataFrame:
    """ISO text to timestamps, coordinates to doubles; what does not parse becomes null."""
    present = set(raw.columns)
    casts = {c: F.try_to_timestamp(F.col(c)) for c in DATE_COLUMNS if c in present}
    casts |= {c: F.expr(f"try_cast({c} AS double)") for c in COORDINATE_COLUMNS if c in present}
    return raw.withColumns(casts)


def derive_partitions(df: DataFrame) -> DataFrame:
    """Rows with a filing time, and the ``year`` and ``month`` they are stored under."""
    return df.where(F.col("requested_date").isNotNull()).withColumns(
        {
            "year": F.year("requested_date").cast("smallint"),
            "month": F.month("requested_date").cast("tinyint"),
        }
    )


def dedupe(df: DataFrame, key: str = "service_request_id", newest: str = "updated_date") -> DataFrame:
    """One row per ``key``: the newest, then the largest by its other columns.

    A struct maximum combines map-side, so any number of copies of a key costs one row per
    input partition.
    """
    rest = [c for c in df.columns if c not in (key, newest)]
    top = F.max(F.struct(newest, *rest)).alias("_t")
    return df.groupBy(key).agg(top).select(key, "_t.*").select(*df.columns)


def privacy_projection(df: DataFrame) -> DataFrame:
    """Only the allowed columns; a street address never gets further."""
    return df.select(*[c for c in ALLOWED_COLUMNS if c in df.columns])


def write_processed(df: DataFrame, path: str, rows_per_file: int = 5_000_000) -> None:
    """Replace the processed table whole, partitioned by year and month.

    The rebalance hint lets adaptive execution split a month that is far larger than the
    others and merge small ones.
    """
    (
        df.hint("rebalance", *PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def rebuild_processed(spark: SparkSession, raw_path: str, path: str, *, unique: bool = False) -> DataFrame:
    """The processed table from one raw snapshot, published whole: readers see the older build until the
    new one is there, and only months that differ are written. Returns the state of each month."""
    typed = derive_partitions(cast_intake(privacy_projection(read_raw(spark, raw_path))))
    return publish(dedupe(typed) if unique else typed, path)


def load_requests(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """The processed table without its storage columns; ``since`` prunes whole months first."""
    df = read_published(spark, path, since) if is_published(spark, path) else spark.read.parquet(path)
    if since is not None:
        day = F.lit(since).cast("date")
        ym = F.col("year") * 100 + F.col("month")
        df = df.where(
            (ym >= F.year(day) * 100 + F.month(day)) & (F.col("requested_date") >= day.cast("timestamp"))
        )
    return df.drop(*PARTITIONS)


def keyset_page(df: DataFrame, key: str, last, size: int) -> DataFrame:
    """The next page after ``last`` in key order: what a cursor read returns."""
    after = df if last is None else df.where(F.col(key) > F.lit(last))
    return after.orderBy(key).limit(size)


def new_rows(df: DataFrame, key: str, last) -> DataFrame:
    """Everything after the cursor at once: the distributed form of paging to the end."""
    return df if last is None else df.where(F.col(key) > F.lit(last))


def write_raw(df: DataFrame, path: str, rows_per_file: int = 500_000) -> None:
    """A raw snapshot: gzipped JSON lines, bounded rows per file."""
    df.write.mode("overwrite").option("compression", "gzip").option(
        "maxRecordsPerFile", rows_per_file
    ).json(path)


def snapshot_manifest(
    raw: DataFrame, *, resource: str, asof: str, pulled_at: str, window: str = "", page_size: int = 50_000
) -> DataFrame:
    """The one-row manifest written beside a snapshot; ``pulled_at`` is the moment of the pull."""
    return raw.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(resource).alias("resource"),
        F.lit(asof).alias("asof"),
        F.lit(window).alias("window_where"),
        "row_count",
        F.lit(pulled_at).alias("pulled_at"),
        F.lit(page_size).cast("long").alias("page_size"),
    )


def pull_snapshot(
    df: DataFrame, base: str, asof: str, *, resource: str, pulled_at: str, window: str = ""
) -> DataFrame:
    """Land ``df`` as ``asof=<date>`` with its manifest; returns the manifest."""
    path = f"{base}/asof={asof}"
    text = privacy_projection(df)
    write_raw(text.select(*[F.col(c).cast("string").alias(c) for c in text.columns]), path)
    manifest = materialize(
        snapshot_manifest(
            read_raw(df.sparkSession, path), resource=resource, asof=asof, pulled_at=pulled_at, window=window
        ),
        "manifest",
    )
    manifest.coalesce(1).write.mode("overwrite").json(f"{base}/_manifests/asof={asof}")
    return manifest
