"""Exploration queries over the request table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.functions import dates
from civicspark.operators.ordered import VALUES_WIDTH, distribution, quantiles
from civicspark.plans.labels import category_thresholds
from civicspark.session import materialize


def window_rows(df: DataFrame, years: int | None, now_year: int) -> DataFrame:
    """Rows since 1 January, ``years`` calendar years before ``now_year``."""
    if not years:
        return df
    start = F.make_timestamp(*[F.lit(x) for x in (now_year - years, 1, 1, 0, 0)], F.lit(0.0))
    return df.where(F.col("requested_date") >= start)


def window_count(df: DataFrame, years: int | None, now_year: int) -> DataFrame:
    return window_rows(df, years, now_year).agg(F.count(F.lit(1)).alias("n"))


def status_breakdown(df: DataFrame) -> DataFrame:
    return df.groupBy("status_description").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("closed_date").isNull().cast("long")).alias("open")
    )


def top_categories(df: DataFrame, n: int = 15) -> DataFrame:
    return df.groupBy("service_name").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "service_name"
    ).limit(n)


def _whole_days():
    return F.datediff("closed_date", "requested_date")


def slowest_categories(df: DataFrame, min_n: int = 5000, n: int = 15) -> DataFrame:
    return (
        df.where(F.col("closed_date").isNotNull())
        .groupBy("service_name")
        .agg(F.count(F.lit(1)).alias("n"), F.avg(_whole_days()).alias("days"))
        .where(F.col("n") > min_n)
        .orderBy(F.desc("days"), "service_name")
        .limit(n)
    )


def monthly_totals(df: DataFrame, categories=()) -> DataFrame:
    """Requests by calendar month, for all categories (``*``) and for each named one."""
    month = F.month("requested_date").cast("long").alias("m")
    cells = df.groupBy(month, "service_name").agg(F.count(F.lit(1)).alias("n"))
    every = cells.groupBy("m").agg(F.sum("n").alias("n")).withColumn("service_name", F.lit("*"))
    named = cells.where(F.col("service_name").isin(*categories)) if categories else cells.limit(0)
    return every.unionByName(named)


def community_extremes(df: DataFrame, category: str, min_n: int = 200, n: int = 6) -> DataFrame:
    """The slowest and the fastest communities of one category: two short reports."""
    means = (
        df.where((F.col("service_name") == category) & F.col("closed_date").isNotNull())
        .groupBy("comm_name")
        .agg(F.count(F.lit(1)).alias("n"), F.avg(_whole_days()).alias("days"))
        .where(F.col("n") > min_n)
    )
    slow = means.orderBy(F.desc("days"), "comm_name").limit(n).withColumn("side", F.lit("slowest"))
    fast = means.orderBy("days", "comm_name").limit(n).withColumn("side", F.lit("fastest"))
    return slow.unionByName(fast)


def community_days(df: DataFrame, category: str) -> DataFrame:
    return (
        df.where(
            (F.col("service_name") == category)
            & F.col("closed_date").isNotNull()
            & F.col("comm_code").isNotNull()
        )
        .groupBy("comm_code")
        .agg(F.avg(_whole_days()).alias("value"), F.count(F.lit(1)).alias("n"))
    )


def breach_by_community(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Share of closed requests slower, in whole days, than their category's p75.

    Each category's cutoff is a percentile of its own distribution; ``approximate`` takes
    the sketch, else the interpolated value is exact.
    """
    closed = df.where(F.col("closed_date").isNotNull()).withColumn("_d", _whole_days().cast("double"))
    cuts = category_p75(closed, "_d", approximate)
    slow = (F.col("_d") > F.col("p75")).cast("double")
    return (
        closed.join(materialize(cuts, "p75"), "service_name")
        .groupBy("comm_code")
        .agg(F.avg(slow).alias("value"), F.count(F.lit(1)).alias("n"))
    )


#: How finely the approximate percentile ranks: it is off by 1 / ACCURACY of the rows at most.
ACCURACY = 10_000


def category_p75(closed: DataFrame, days: str, approximate: bool = False) -> DataFrame:
    if approximate:
        return closed.groupBy("service_name").agg(F.percentile_approx(days, 0.75, ACCURACY).alias("p75"))
    exact = category_thresholds(closed.withColumn("days_to_close", F.col(days)))
    return exact.select("service_name", F.col("threshold_days").alias("p75"))


def percentile_ranks(closed: DataFrame, days: str, q: float = 0.75) -> DataFrame:
    """Per category where the approximate percentile really stands: the share of rows ``below`` it and
    ``upto`` it, and whether ``q`` lies between them within the promised error."""
    cuts = materialize(category_p75(closed, days, approximate=True), "p75")
    v, cut = F.col(days), F.col("p75")
    known = closed.where(v.isNotNull()).join(cuts, "service_name")
    out = known.groupBy("service_name").agg(
        F.count(F.lit(1)).alias("n"), F.avg((v < cut).cast("double")).alias("below"), F.avg((v <= cut).cast("double")).alias("upto")
    )
    error = 1.0 / ACCURACY
    return out.withColumn("within", (F.col("below") - error <= q) & (F.col("upto") + error >= q))


def busy_vs_late(labelled: DataFrame, top: int = 20, min_n: int = 50, min_months: int = 24) -> DataFrame:
    """Across months: does a busy category run late? One correlation per top category."""
    cells = materialize(
        labelled.groupBy("service_name", dates.month_of("requested_date").alias("month")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("breach").cast("long")).alias("late")
        ),
        "monthly",
    )
    biggest = (
        cells.where(F.col("service_name").isNotNull())
        .groupBy("service_name")
        .agg(F.sum("n").alias("_all"))
        .orderBy(F.desc("_all"), "service_name")
        .limit(top)
        .select("service_name")
    )
    rate = (F.col("late") / F.col("n")).alias("late")
    return (
        cells.join(biggest, "service_name", "left_semi")
        .where(F.col("n") >= min_n)
        .select("service_name", F.col("n").cast("double").alias("n"), rate)
        .groupBy("service_name")
        .agg(F.count(F.lit(1)).alias("months"), F.corr("n", "late").alias("r"))
        .where(F.col("months") >= min_months)
    )


def seasonal_share(df: DataFrame, categories: dict, start: str, end: str) -> DataFrame:
    """Percent of each named category's requests by calendar month, one column per category."""
    kept = df.where(
        (F.col("requested_date") >= F.lit(start).cast("timestamp"))
        & (F.col("requested_date") < F.lit(end).cast("timestamp"))
        & F.col("service_name").isin(*categories.values())
    )
    counts = kept.groupBy(F.month("requested_date").cast("long").alias("month")).agg(
        *[
            F.sum((F.col("service_name") == name).cast("long")).alias(label)
            for label, name in categories.items()
        ]
    )
    months = df.sparkSession.range(1, 13).withColumnRenamed("id", "month")
    full = months.join(counts, "month", "left").fillna(0)
    totals = counts.agg(*[F.sum(label).alias(label) for label in categories]).first()
    return full.select(
        "month",
        *[
            (F.col(label) / F.nullif(F.lit(totals[label] or 0).cast("double"), F.lit(0.0)) * 100).alias(label)
            for label in categories
        ],
    )


def late_by_backlog_quintile(rows: DataFrame, backlog: str = "cat_open_30d", key: str = "service_name") -> DataFrame:
    """Late rate by fifth of the category's own backlog; equal backlogs share a fifth."""
    points = {f"_q{i}": i / 5 for i in range(1, 5)}
    cuts = materialize(
        quantiles(distribution(rows, [key], backlog), [key], points, width=VALUES_WIDTH).drop("rows"),
        "fifths",
    )
    fifth = F.lit(1)
    for name in points:
        fifth = fifth + (F.col(backlog) > F.col(name)).cast("int")
    return (
        rows.join(cuts, key)
        .groupBy(fifth.cast("long").alias("fifth"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("breach").cast("double")).alias("late_rate"))
    )


def distinct_rows(pages: DataFrame) -> DataFrame:
    """Rows pulled by overlapping pages, once each."""
    return pages.dropDuplicates()
