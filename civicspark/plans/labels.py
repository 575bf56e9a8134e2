"""Late or on time: each request judged against its own category's usual resolution time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.functions import dates
from civicspark.operators.lookup import global_threshold, with_threshold
from civicspark.operators.ordered import distribution, quantiles
from civicspark.plans.purge import mark_purged
from civicspark.schemas import LEAKY_COLUMNS
from civicspark.session import materialize
from civicspark.settings import GLOBAL_CATEGORY, GateSettings, LabelSettings


class LeakageError(AssertionError):
    """An outcome-derived column reached the feature matrix."""


def add_days_to_close(df: DataFrame) -> DataFrame:
    return df.withColumn("days_to_close", dates.days_between("requested_date", "closed_date"))


def labelled_subset(
    df: DataFrame, settings: LabelSettings | None = None, start: int | None = None
) -> DataFrame:
    """Closed rows with a non-negative duration, filed in the last ``window_years``.

    ``start`` is that cut-off if it is already known.
    """
    s = settings or LabelSettings()
    start = dates.years_before_newest(df, s.window_years) if start is None else start
    if start is None:
        return add_days_to_close(df).limit(0)
    return add_days_to_close(df.where(F.col("requested_date") >= dates.at(start))).where(
        F.col("days_to_close") >= 0
    )


def holdout_boundary(df: DataFrame, settings: LabelSettings | None = None) -> int | None:
    return dates.years_before_newest(df, (settings or LabelSettings()).holdout_years)


def add_split(df: DataFrame, boundary: int) -> DataFrame:
    """``split``: train before the boundary, test from it on."""
    return df.where(F.col("requested_date").isNotNull()).withColumn(
        "split", F.when(F.col("requested_date") < dates.at(boundary), "train").otherwise("test")
    )


def time_split(df: DataFrame, settings: LabelSettings | None = None, boundary: int | None = None):
    """``(train, test)`` around the boundary, by default one holdout before the newest row."""
    edge = dates.at(holdout_boundary(df, settings) if boundary is None else boundary)
    return df.where(F.col("requested_date") < edge), df.where(F.col("requested_date") >= edge)


def recent(df: DataFrame, years: int) -> DataFrame:
    """The last ``years`` of the rows; 0 keeps them all."""
    if not years:
        return df
    start = dates.years_before_newest(df, years)
    return df.where(F.col("requested_date") >= dates.at(start)) if start is not None else df


def category_thresholds(
    train: DataFrame, percentile: float = 0.75, *, ignore_purged: bool = False
) -> DataFrame:
    """``(service_name, threshold_days)`` per category plus the ``__global__`` row, exact.

    Durations are counted per category and value first; the global row reuses those counts.
    """
    df = train if "days_to_close" in train.columns else add_days_to_close(train)
    if ignore_purged and "purge_closed" in df.columns:
        df = df.where(~F.col("purge_closed"))
    counts = distribution(df, ["service_name"], "days_to_close")
    everything = counts.select(F.lit(GLOBAL_CATEGORY).alias("service_name"), "value", "n")
    both = (
        counts.where(F.col("service_name").isNotNull())
        .unionByName(everything)
        .groupBy("service_name", "value")
        .agg(F.sum("n").alias("n"))
    )
    return quantiles(both, ["service_name"], {"threshold_days": percentile}).select(
        "service_name", "threshold_days"
    )


def apply_labels(df: DataFrame, thresholds: DataFrame, fallback: float | None = None) -> DataFrame:
    """``breach`` = strictly slower than the threshold."""
    out = df if "days_to_close" in df.columns else add_days_to_close(df)
    late = F.coalesce(F.col("days_to_close") > F.col("threshold_days"), F.lit(False))
    return with_threshold(out, thresholds, fallback).withColumn("breach", late.cast("int"))


def overdue_open(
    df: DataFrame, thresholds: DataFrame, asof: int, settings: LabelSettings | None = None,
    start: int | None = None, fallback: float | None = None,
) -> DataFrame:
    """Open requests already older than their threshold: certain breaches."""
    s = settings or LabelSettings()
    start = dates.years_before_newest(df, s.window_years) if start is None else start
    if start is None:
        return apply_labels(df.limit(0), thresholds).withColumn("censored", F.lit(True))
    still_open = df.where(
        F.col("closed_date").isNull() & (F.col("requested_date") >= dates.at(start))
    )
    # the same deadline as in scoring, so overdue and scored rows split the open ones exactly
    return (
        with_threshold(still_open, thresholds, fallback)
        .where(dates.plus_days("requested_date", "threshold_days") < dates.at(asof))
        .withColumns(
            {
                "days_to_close": F.lit(None).cast("double"),
                "breach": F.lit(1),
                "censored": F.lit(True),
            }
        )
    )


@dataclass(frozen=True)
class Labels:
    """Labelled rows with their ``split``, and the thresholds that judged them."""

    rows: DataFrame
    thresholds: DataFrame
    boundary: int
    asof: int

    @property
    def train(self) -> DataFrame:
        return self.rows.where(F.col("split") == "train")

    @property
    def test(self) -> DataFrame:
        return self.rows.where(F.col("split") == "test")


def build_training_labels(
    df: DataFrame, settings: LabelSettings | None = None, *, include_overdue_open: bool = True,
    asof: int | None = None, gate: GateSettings | None = None,
    purges=None,
) -> Labels:
    """Purges marked on the full pull, thresholds from training rows only, both parts labelled.

    The thresholds are written once: every later join reads that small table instead of
    recomputing the quantiles.
    """
    s = settings or LabelSettings()
    known = dates.bounds(df, s.holdout_years, s.window_years)
    boundary, start = known.years[s.holdout_years], known.years[s.window_years]
    asof = known.taken if asof is None else asof
    marked = mark_purged(df, gate, purges)
    frame = labelled_subset(marked, s, start)
    if s.purge_handling == "exclude":
        frame = frame.where(~F.col("purge_closed"))
    train = frame.where(F.col("requested_date") < dates.at(boundary))
    thresholds = materialize(
        category_thresholds(train, s.percentile, ignore_purged=s.purge_handling == "flag"),
        "thresholds",
    )
    fallback = global_threshold(thresholds)
    rows = apply_labels(frame, thresholds, fallback).withColumn("censored", F.lit(False))
    if include_overdue_open:
        late = overdue_open(marked, thresholds, asof, s, start, fallback)
        rows = rows.unionByName(late, allowMissingColumns=True)
    return Labels(add_split(rows, boundary), thresholds, boundary, asof)


def assert_no_leakage(columns) -> None:
    """Raise if any outcome-derived column is present."""
    names = columns.columns if isinstance(columns, DataFrame) else list(columns)
    found = sorted(c for c in names if c in LEAKY_COLUMNS)
    if found:
        raise LeakageError(f"leaky columns in feature matrix: {found}")
