"""Stale bulk closes: one day on which many long-open tickets of a category were closed.

Both lookups the mask needs, the age limit per category and the qualifying (category, day)
events, are aggregates written once, so marking the full table needs no shuffle of its rows
while those lookups are small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.functions.dates import days_between
from civicspark.operators.ordered import DAYS_WIDTH, distribution, quantiles
from civicspark.session import materialize
from civicspark.settings import GateSettings


def _aged(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "_age": days_between("requested_date", "closed_date"),
            "_day": F.to_date(F.date_trunc("day", "closed_date")),
        }
    )


def age_limits(df: DataFrame, settings: GateSettings | None = None) -> DataFrame:
    """Per category, the age from which a closure counts as stale."""
    s = settings or GateSettings()
    closed = _aged(df).where((F.col("_age") >= 0) & F.col("service_name").isNotNull())
    medians = quantiles(
        distribution(closed, ["service_name"], "_age"), ["service_name"], {"_median": 0.5},
        width=DAYS_WIDTH,
    )
    limit = F.greatest(
        F.col("_median") * s.stale_close_age_ratio, F.lit(s.stale_close_min_age_days)
    )
    return medians.select("service_name", limit.alias("_limit"))


def stale_rows(df: DataFrame, limits: DataFrame) -> DataFrame:
    """The closures past their category's limit, with ``_age`` and ``_day``."""
    return _aged(df).join(limits, "service_name").where(F.col("_age") >= F.col("_limit"))


def purge_lookups(df: DataFrame, settings: GateSettings | None = None):
    """``(limits, events)``: age limits per category, and the days that qualify as purges."""
    s = settings or GateSettings()
    limits = materialize(age_limits(df, s), "age-limits")
    events = (
        stale_rows(df, limits)
        .groupBy("service_name", "_day")
        .agg(F.count(F.lit(1)).alias("_tickets"))
        .where(F.col("_tickets") >= s.stale_close_min_rows)
    )
    return limits, materialize(events, "purge-days")


def mark_purged(df: DataFrame, settings: GateSettings | None = None, lookups=None) -> DataFrame:
    """Add ``purge_closed``; ``lookups`` are :func:`purge_lookups` if already at hand."""
    limits, events = lookups or purge_lookups(df, settings)
    hit = (F.col("_age") >= F.col("_limit")) & F.col("_tickets").isNotNull()
    return (
        _aged(df)
        .join(limits, "service_name", "left")
        .join(events, ["service_name", "_day"], "left")
        .withColumn("purge_closed", F.coalesce(hit, F.lit(False)))
        .select(*df.columns, "purge_closed")
    )


def purge_events(df: DataFrame, settings: GateSettings | None = None) -> DataFrame:
    """One row per purge: tickets, communities touched and median age."""
    s = settings or GateSettings()
    limits, events = purge_lookups(df, s)
    hits = stale_rows(df, limits).join(events, ["service_name", "_day"])
    keys = ["service_name", "_day"]
    # two map-side combined steps instead of a distinct count per event
    communities = (
        hits.where(F.col("comm_name").isNotNull())
        .groupBy(*keys, "comm_name")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("communities"))
    )
    ages = quantiles(distribution(hits, keys, "_age"), keys, {"_m": 0.5}, width=DAYS_WIDTH)
    return (
        ages.join(communities, keys, "left")
        .select(
            "service_name",
            F.date_format("_day", "yyyy-MM-dd").alias("closed_day"),
            F.col("rows").alias("tickets"),
            F.coalesce("communities", F.lit(0)).cast("long").alias("communities"),
            F.round("_m", 1).alias("median_age_days"),
        )
    )
