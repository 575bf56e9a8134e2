"""Time arithmetic in microseconds, so fractional days stay exact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000
DAY_SECONDS = 86_400


def days_between(start, end) -> Column:
    """Fractional days from ``start`` to ``end``; null when either is null."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(float(DAY_MICROS))


def plus_days(start: str, days: str) -> Column:
    """``start`` plus a fractional number of days, to the microsecond."""
    return F.timestamp_micros(
        F.unix_micros(start) + F.round(F.col(days) * float(DAY_MICROS)).cast("long")
    )


def at(micros: int) -> Column:
    """A timestamp literal Catalyst folds, so it reaches the Parquet filter."""
    return F.timestamp_micros(F.lit(int(micros)).cast("long"))


def month_of(ts) -> Column:
    """First day of the month, as a date."""
    return F.trunc(ts, "month")


def week_of(ts) -> Column:
    """The Monday that starts the week, as a date."""
    return F.date_trunc("week", ts).cast("date")


def day_text(ts) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


@dataclass(frozen=True)
class Bounds:
    """Moments measured from the newest row, in microseconds."""

    newest: int | None
    taken: int | None  # midnight after the newest row: when the snapshot was taken
    years: dict  # calendar years back -> moment


def bounds(df: DataFrame, *years: int, ts: str = "requested_date") -> Bounds:
    """One pass, one small row: the cut-offs built from it are literals, so they prune.

    Calendar arithmetic clips: a year before 29 February is the 28th.
    """
    top = F.max(ts)
    row = df.agg(
        F.unix_micros(top).alias("newest"),
        F.unix_micros(F.date_trunc("day", top) + F.expr("INTERVAL 1 DAY")).alias("taken"),
        *[F.unix_micros(top - F.expr(f"INTERVAL {y} YEARS")).alias(f"y{y}") for y in years],
    ).first()
    return Bounds(row["newest"], row["taken"], {y: row[f"y{y}"] for y in years})


def years_before_newest(df: DataFrame, years: int, ts: str = "requested_date") -> int | None:
    return bounds(df, years, ts=ts).years[years]


def snapshot_micros(df: DataFrame, ts: str = "requested_date") -> int | None:
    return bounds(df, ts=ts).taken
