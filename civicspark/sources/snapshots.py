"""Snapshot labels, replay and mirroring over ``asof=`` folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.sources.requests import rebuild_processed


def snapshot_files(spark: SparkSession, base: str) -> DataFrame:
    """``(path, asof)`` of every data file under ``base``; a listing, no file is opened."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.json*")
        .load(base)
        .select("path", F.date_format(F.col("asof").cast("date"), "yyyy-MM-dd").alias("asof"))
    )


def latest_asof(spark: SparkSession, base: str) -> DataFrame:
    """The newest snapshot label, one row."""
    return snapshot_files(spark, base).agg(F.max("asof").alias("asof"))


def replay(spark: SparkSession, base: str, processed: str, asof: str | None = None, *, unique: bool = False) -> str:
    """Rebuild the processed table from a chosen (by default the newest) raw snapshot; months that are
    the same in both are left as they are."""
    label = asof or latest_asof(spark, base).first()["asof"]
    if label is None:
        raise FileNotFoundError(f"no snapshots under {base}")
    rebuild_processed(spark, f"{base}/asof={label}", processed, unique=unique)
    return label


def stale_keys(present: DataFrame, written: DataFrame, key: str = "key") -> DataFrame:
    """Keys under a mirrored prefix that the last build did not write."""
    return present.select(key).distinct().join(written.select(key), key, "left_anti")
