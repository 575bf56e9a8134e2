"""Joins against dimensions, with the fallbacks every caller shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.settings import GLOBAL_CATEGORY, UNKNOWN


def attach_groups(df: DataFrame, communities: DataFrame, dims=("sector", "srg")) -> DataFrame:
    """Each row's community attributes; no match or a null becomes ``UNKNOWN``.

    A code listed twice keeps one row (the smallest attributes), so nothing fans out.
    Catalyst broadcasts the lookup while its measured size allows.
    """
    lookup = communities.groupBy("comm_code").agg(
        F.min(F.struct(*[F.col(d).cast("string").alias(d) for d in dims])).alias("_g")
    )
    joined = df.drop(*dims).join(lookup, "comm_code", "left")
    return joined.withColumns(
        {d: F.coalesce(F.col(f"_g.{d}"), F.lit(UNKNOWN)) for d in dims}
    ).drop("_g")


def attach_sector(df: DataFrame, communities: DataFrame) -> DataFrame:
    return attach_groups(df, communities, ("sector",))


def global_threshold(thresholds: DataFrame) -> float | None:
    """The fallback row, or the median of the category thresholds when there is none."""
    row = thresholds.agg(
        F.max(F.when(F.col("service_name") == GLOBAL_CATEGORY, F.col("threshold_days"))).alias("g"),
        F.median("threshold_days").alias("m"),
    ).first()
    return row["g"] if row["g"] is not None else row["m"]


def with_threshold(df: DataFrame, thresholds: DataFrame, fallback: float | None = None) -> DataFrame:
    """Add ``threshold_days``: the category's own, or the global one if it is unseen."""
    fallback = global_threshold(thresholds) if fallback is None else fallback
    own = thresholds.select("service_name", F.col("threshold_days").alias("_own"))
    return (
        df.drop("threshold_days")
        .join(own, "service_name", "left")
        .withColumn("threshold_days", F.coalesce("_own", F.lit(fallback).cast("double")))
        .drop("_own")
    )


def seen_categories(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Add ``category_seen``: the category has a threshold of its own."""
    known = thresholds.where(F.col("service_name") != GLOBAL_CATEGORY).select(
        "service_name", F.lit(True).alias("_seen")
    )
    return (
        df.join(known, "service_name", "left")
        .withColumn("category_seen", F.coalesce("_seen", F.lit(False)))
        .drop("_seen")
    )
