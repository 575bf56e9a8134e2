"""Monthly series that re-check published findings, and the detector over them.

The labelled rows are scanned once into counts per (month, category, sector, weekday); every
rate series is arithmetic on those counts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.functions import dates
from civicspark.functions.numbers import ratio
from civicspark.operators.detect import ewma_flags, seasonal_residuals, sustained
from civicspark.operators.lookup import attach_sector, with_threshold
from civicspark.operators.ordered import DAYS_WIDTH, distribution, order_statistics
from civicspark.plans.labels import build_training_labels
from civicspark.plans.purge import mark_purged, purge_lookups
from civicspark.session import materialize
from civicspark.settings import (
    UNKNOWN,
    ControlSettings,
    GateSettings,
    LabelSettings,
    ScorecardSettings,
)

COLUMNS = ("month", "series", "key", "value", "n", "provisional")


@dataclass(frozen=True)
class Settled:
    """``rows``: labelled and past their deadline; ``pending``: unsettled share by month."""

    rows: DataFrame
    pending: DataFrame
    asof: int


def settled(
    raw: DataFrame, communities: DataFrame, asof: int | None = None,
    labels: LabelSettings | None = None, gate: GateSettings | None = None, purges=None,
) -> Settled:
    asof = dates.snapshot_micros(raw) if asof is None else asof
    built = build_training_labels(raw, labels, asof=asof, gate=gate, purges=purges)
    due = dates.plus_days("requested_date", "threshold_days")
    rows = attach_sector(built.rows.where(due < dates.at(asof)), communities).withColumns(
        {"month": dates.month_of("requested_date"), "dow": F.weekday("requested_date")}
    )
    waiting = (due >= dates.at(asof)).cast("double")
    pending = (
        with_threshold(raw, built.thresholds)
        .groupBy(dates.month_of("requested_date").alias("month"))
        .agg(F.avg(waiting).alias("pending"))
    )
    return Settled(rows, pending, asof)


def late_counts(rows: DataFrame, extra=()) -> DataFrame:
    """``n`` and ``late`` per month, category, sector and weekday (and ``extra`` keys)."""
    return rows.groupBy("month", "service_name", "sector", "dow", *extra).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("breach").cast("long")).alias("late")
    )


def _totals(cube: DataFrame, *keys) -> DataFrame:
    return cube.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("late").alias("late"))


def _series(df: DataFrame, series: str, key=None) -> DataFrame:
    return df.select(
        "month",
        F.lit(series).alias("series"),
        (F.lit("") if key is None else key).alias("key"),
        F.col("value").cast("double").alias("value"),
        F.col("n").cast("long").alias("n"),
    )


def city_late_mix_fixed(cube: DataFrame) -> DataFrame:
    """The city late rate with every month's mix held at the all-time mix."""
    known = cube.where(F.col("service_name").isNotNull())
    weights = known.groupBy("service_name").agg(F.sum("n").alias("w"))
    monthly = _totals(known, "month", "service_name").join(weights, "service_name")
    mixed = monthly.groupBy("month").agg(
        (F.sum(F.col("late") / F.col("n") * F.col("w")) / F.sum("w")).alias("value")
    )
    return _series(_totals(cube, "month").join(mixed, "month"), "city_late_mix_fixed")


def observed_expected(cube: DataFrame, cells, by) -> DataFrame:
    """Late rate over the mean rate its mix predicts, per ``by``; ``cells`` set the expectation.

    Rows of a null category have no expectation: they count among the rows and the late, and
    are left out of the mean only.
    """
    rate = _totals(cube, *cells).select(*cells, (F.col("late") / F.col("n")).alias("_e"))
    out = (
        cube.join(rate, list(cells), "left")
        .groupBy(*by)
        .agg(
            F.sum("late").alias("late"),
            F.sum(F.col("n") * F.col("_e")).alias("expected"),
            F.sum(F.when(F.col("_e").isNotNull(), F.col("n"))).alias("known"),
            F.sum("n").alias("n"),
        )
    )
    return out.withColumn("value", _over_expected("late", "n", "expected", "known"))


def _over_expected(late: str, n: str, expected: str, known: str):
    """(late / n) over (expected / known), null where nothing is expected."""
    return F.try_divide(F.col(late) / F.col(n), ratio(expected, known))


def sector_obs_expected(cube: DataFrame) -> DataFrame:
    oe = observed_expected(cube, ("month", "service_name"), ("month", "sector"))
    return _series(oe.where(F.col("sector") != UNKNOWN), "sector_obs_expected", F.col("sector"))


def segment_late_rate(cube: DataFrame, category: str, sector: str, series="waste_east_late") -> DataFrame:
    one = cube.where((F.col("service_name") == category) & (F.col("sector") == sector))
    rate = _totals(one, "month").withColumn("value", F.col("late") / F.col("n"))
    return _series(rate, series, F.lit(sector))


def weekend_ratio(cube: DataFrame) -> DataFrame:
    """Friday and Saturday against Monday to Thursday, each observed over expected."""
    side = F.when(F.col("dow").isin(4, 5), "end").when(F.col("dow") <= 3, "day")
    rate = _totals(cube, "service_name", "sector").select(
        "service_name", "sector", (F.col("late") / F.col("n")).alias("_e")
    )
    tagged = cube.join(rate, ["service_name", "sector"], "left").withColumn("side", side)

    def total(c, s):
        return F.sum(F.when(F.col("side") == s, c))

    exp = F.col("n") * F.col("_e")
    months = tagged.groupBy("month").agg(
        total(F.col("n"), "end").alias("n"),
        total(F.col("n"), "day").alias("n_day"),
        total(F.col("late"), "end").alias("late_end"),
        total(F.col("late"), "day").alias("late_day"),
        total(exp, "end").alias("exp_end"),
        total(exp, "day").alias("exp_day"),
        total(F.when(exp.isNotNull(), F.col("n")), "end").alias("known_end"),
        total(F.when(exp.isNotNull(), F.col("n")), "day").alias("known_day"),
    ).where(F.col("n").isNotNull() & F.col("n_day").isNotNull())
    oe = months.withColumns(
        {
            "_end": _over_expected("late_end", "n", "exp_end", "known_end"),
            "_day": _over_expected("late_day", "n_day", "exp_day", "known_day"),
        }
    )
    return _series(oe.withColumn("value", ratio("_end", "_day")), "fri_sat_vs_mon_thu")


def slowest_share(
    raw: DataFrame, asof: int, settings: ScorecardSettings | None = None, gate: GateSettings | None = None,
    purges=None,
) -> DataFrame:
    """Share of all waiting days owed to the slowest few, over trailing windows of filings.

    Rows become counts per (month, duration) before they spread over the windows that hold
    them, and the top share needs only the duration at its edge.
    """
    s = settings or ScorecardSettings()
    span = raw.agg(
        F.min(dates.month_of("requested_date")).alias("a"),
    ).withColumn("b", F.add_months(F.trunc(dates.at(asof), "month"), -1)).select(
        F.add_months("a", s.window_months - 1).cast("string").alias("lo"), F.col("b").cast("string").alias("hi")
    ).first()
    month = dates.month_of("requested_date")
    shape = "month date, series string, key string, value double, n bigint, pending double"
    if span["lo"] is None or span["lo"] > span["hi"]:
        return raw.sparkSession.createDataFrame([], shape)
    ends = F.explode(
        F.sequence(
            F.greatest(F.col("month"), F.lit(span["lo"]).cast("date")),
            F.least(F.add_months("month", s.window_months - 1), F.lit(span["hi"]).cast("date")),
            F.expr("INTERVAL 1 MONTH"),
        )
    )

    def spread(df, *keep):
        # a row filed after the last window's end, or before the first, can be in no window
        return df.where(
            (F.col("month") <= F.lit(span["hi"]).cast("date"))
            & (F.add_months("month", s.window_months - 1) >= F.lit(span["lo"]).cast("date"))
        ).select(ends.alias("window"), *keep)

    aged = mark_purged(raw, gate, purges).withColumns(
        {"month": month, "days": dates.days_between("requested_date", "closed_date")}
    )
    kept = aged.where((F.col("days") >= 0) & ~F.col("purge_closed"))
    per_month = distribution(kept, ["month"], "days")
    dist = materialize(
        spread(per_month, "value", "n").groupBy("window", "value").agg(F.sum("n").alias("n")),
        "waiting-days",
    )
    k = f"floor(rows * {s.slowest!r}D)"
    edge = order_statistics(
        dist, ["window"], {"edge": f"least(rows - {k}, rows - 1)"}, width=DAYS_WIDTH
    ).selectExpr("*", f"{k} AS k")
    above = F.col("value") > F.col("edge")
    weight = F.col("n") * F.col("value")
    sums = (
        dist.join(edge, "window")
        .groupBy("window", "rows", "k", "edge")
        .agg(
            F.coalesce(F.sum(F.when(above, weight)), F.lit(0.0)).alias("_top"),
            F.coalesce(F.sum(F.when(above, F.col("n"))), F.lit(0)).alias("_n"),
            F.sum(weight).alias("_all"),
        )
        .where(F.col("_all") > 0)
    )
    top = F.when(F.col("k") > 0, F.col("_top") + (F.col("k") - F.col("_n")) * F.col("edge")).otherwise(0.0)
    counts = raw.groupBy(month.alias("month")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("closed_date").isNull().cast("long")).alias("open")
    )
    pending = spread(counts, "rows", "open").groupBy("window").agg(
        (F.sum("open") / F.sum("rows")).alias("pending")
    )
    out = sums.select(
        F.col("window").alias("month"), (top / F.col("_all")).alias("value"), F.col("rows").alias("n")
    )
    return _series(out, "slowest5_share").join(
        pending.withColumnRenamed("window", "month"), "month", "left"
    )


def _provisional(series: DataFrame, share: float) -> DataFrame:
    return series.withColumn("provisional", F.coalesce("pending", F.lit(1.0)) > share).select(*COLUMNS)


def scorecard(
    raw: DataFrame, communities: DataFrame, asof: int | None = None,
    settings: ScorecardSettings | None = None, labels: LabelSettings | None = None,
    gate: GateSettings | None = None,
) -> DataFrame:
    """All five series, one row per month and key, unordered; sort at the sink."""
    s = settings or ScorecardSettings()
    purges = purge_lookups(raw, gate)
    done = settled(raw, communities, asof, labels, gate, purges)
    cube = materialize(late_counts(done.rows), "late-counts")
    parts = [
        city_late_mix_fixed(cube),
        sector_obs_expected(cube),
        segment_late_rate(cube, s.segment_category, s.segment_sector),
        weekend_ratio(cube),
    ]
    card = reduce(DataFrame.unionByName, parts).join(done.pending, "month", "left")
    return _provisional(card, s.provisional_share).unionByName(
        _provisional(slowest_share(raw, done.asof, s, gate, purges), s.slow_pending_share)
    )


def add_flags(card: DataFrame, control: ControlSettings | None = None) -> DataFrame:
    """``residual`` and ``flag`` on settled months; provisional months are never judged."""
    c = control or ControlSettings()
    keys = ["series", "key"]
    final = seasonal_residuals(card.where(~F.col("provisional")), keys)
    judged = sustained(
        ewma_flags(final, keys, settings=c), keys, "ewma_flag", name="flag", run=c.run
    ).drop("ewma_flag")
    rest = card.where(F.col("provisional")).withColumns(
        {"residual": F.lit(None).cast("double"), "flag": F.lit(False)}
    )
    return judged.unionByName(rest)


def latest(card: DataFrame) -> DataFrame:
    """Each series' newest settled month."""
    rest = [c for c in card.columns if c not in ("series", "key")]
    return (
        card.where(~F.col("provisional"))
        .groupBy("series", "key")
        .agg(F.max_by(F.struct(*rest), "month").alias("_t"))
        .select("series", "key", "_t.*")
    )


def recent_flags(card: DataFrame, months: int = 5) -> DataFrame:
    """Series flagged within ``months`` of the newest settled month."""
    newest = (
        card.where(~F.col("provisional"))
        .agg(F.add_months(F.max("month"), -months).cast("string").alias("m"))
        .first()["m"]
    )
    since = F.lit(newest).cast("date")
    return card.where(F.col("flag") & (F.col("month") >= since)).select("series", "key").distinct()


def community_ratio(cube: DataFrame, community: str = "comm_code", min_n: int = 1000) -> DataFrame:
    """Observed over expected per community, small ones dropped."""
    oe = observed_expected(cube, ("month", "service_name"), (community,))
    return oe.where(F.col("n") >= min_n).select(community, "value", "n")

