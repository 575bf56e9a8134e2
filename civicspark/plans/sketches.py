"""Drift profiles that merge: a small sketch per month and column, stored, so that a baseline is extended
by its new months alone and two spans of months are compared without reading a row again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.session import materialize

#: The size of the quantile sketch, and the rank error that it keeps to with 99% confidence, for one
#: quantile and for the largest gap between two distributions.
K, RANK_ERROR, GAP_ERROR = 1000, 0.005, 0.015
#: The exponent of the distinct-value sketch, and three of its standard errors.
LG_K, DISTINCT_ERROR = 14, 0.025
#: Quantiles by which two distributions are compared.
STEPS = 400
QUANTILES = {"p10": 0.1, "p50": 0.5, "p90": 0.9}


def _entries(numeric, categorical) -> Column:
    def entry(c, kind, value, text):
        return F.struct(F.lit(c).alias("column"), F.lit(kind).alias("kind"), value.cast("double").alias("value"), text.cast("string").alias("text"))

    none = F.lit(None)
    numbers = [entry(c, "numeric", F.col(c), F.col(c).cast("double")) for c in numeric]
    return F.explode(F.array(*numbers, *[entry(c, "string", none, F.col(c)) for c in categorical])).alias("e")


def month_profiles(df: DataFrame, month: str, numeric, categorical) -> tuple[DataFrame, DataFrame]:
    """Two tables: per month and column the counts, moments and sketches; and, per month, column and
    level, how often each level of a string column occurs. One pass, combined map-side."""
    rows = materialize(df.select(F.date_trunc("month", month).cast("date").alias("month"), _entries(numeric, categorical)).select("month", "e.*"), "profile-entries")
    value, there = F.col("value"), F.col("text").isNotNull()
    known = F.when(~F.isnan("value"), value)
    sketches = rows.groupBy("month", "column", "kind").agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(there, 1)).alias("present"), F.count(known).alias("n"),
        F.min(known).alias("min"), F.max(known).alias("max"), F.avg(known).alias("mean"), (F.var_pop(known) * F.count(known)).alias("m2"),
        F.kll_sketch_agg_double(known, F.lit(K)).alias("ranks"), F.hll_sketch_agg("text", F.lit(LG_K)).alias("distinct"),
    )
    levels = rows.where((F.col("kind") == "string") & there).groupBy("month", "column", F.col("text").alias("level"))
    return sketches, levels.agg(F.count(F.lit(1)).alias("n"))


class Store:
    """Month profiles under a path, a partition per month."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, df: DataFrame, month: str, numeric, categorical) -> None:
        """Profile the months of ``df`` and store them. A month that is stored already is replaced,
        others aren't touched, so ``df`` need only hold the months that are new or have changed."""
        for name, part in zip(("sketches", "levels"), month_profiles(df, month, numeric, categorical), strict=True):
            part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(f"{self.path}/{name}")

    def read(self, name: str, since: str | None = None, before: str | None = None) -> DataFrame:
        """``sketches`` or ``levels`` of the months from ``since`` up to, without, ``before`` (dates)."""
        out = self.spark.read.parquet(f"{self.path}/{name}")
        out = out if since is None else out.where(F.col("month") >= F.lit(since).cast("date"))
        return out if before is None else out.where(F.col("month") < F.lit(before).cast("date"))


def merged(sketches: DataFrame) -> DataFrame:
    """One row per column over all months given: counts, moments, and the merged sketches. Months in any
    order and grouping give the same counts and moments, and sketches of the same error."""
    parts = F.collect_list(F.struct("n", "mean", "m2"))  # a few numbers per month
    out = sketches.groupBy("column", "kind").agg(
        F.sum("rows").alias("rows"), F.sum("present").alias("present"), F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum(F.when(F.col("n") > 0, F.col("n")))).alias("mean"), parts.alias("_parts"),
        F.kll_merge_agg_double("ranks", F.lit(K)).alias("ranks"), F.hll_union_agg("distinct").alias("distinct"),
    )

    def spread(total, part):
        gap = part["mean"] - F.col("mean")
        return total + F.coalesce(part["m2"] + part["n"] * gap * gap, F.lit(0.0))

    return out.withColumn("m2", F.aggregate("_parts", F.lit(0.0), spread)).drop("_parts")


def profile(sketches: DataFrame) -> DataFrame:
    """Per column what :func:`civicspark.plans.drift.profile` says, from stored sketches: counts,
    completeness, range and moments are exact, quantiles and distinct values within the stated errors."""
    one = merged(sketches)
    points = [
        F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("ranks", F.lit(q))).alias(name) for name, q in QUANTILES.items()
    ]
    return one.select(
        "column", "kind", "rows", (F.col("rows") - F.col("present")).alias("missing"), (F.col("present") / F.col("rows")).alias("completeness"),
        F.hll_sketch_estimate("distinct").alias("distinct_values"), "min", "max", "mean", F.sqrt(F.col("m2") / F.nullif("n", F.lit(0))).alias("std"), *points,
    )


def _gap(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per number: the largest gap between the two distributions, each read off :data:`STEPS` quantiles
    of its sketch, at all quantiles of either."""
    both = a.where("n > 0").select("column", F.col("ranks").alias("_a")).join(b.where("n > 0").select("column", F.col("ranks").alias("_b")), "column")
    ranks = F.array(*[F.lit((i + 0.5) / STEPS) for i in range(STEPS)])
    grids = both.select("column", *[F.kll_sketch_get_quantile_double(c, ranks).alias(c) for c in ("_a", "_b")])

    def below(grid, p):
        return F.size(F.filter(grid, lambda q: q <= p)) / F.lit(float(STEPS))

    points = F.array_distinct(F.concat("_a", "_b"))
    gaps = F.transform(points, lambda p: F.abs(below(F.col("_a"), p) - below(F.col("_b"), p)))
    return materialize(grids, "grids").select("column", F.array_max(gaps).alias("distance"))


def _shares(levels: DataFrame, name: str) -> DataFrame:
    n = levels.groupBy("column", "level").agg(F.sum("n").alias("_n"))
    total = n.groupBy("column").agg(F.sum("_n").alias("_t"))
    return n.join(total, "column").select("column", "level", (F.col("_n") / F.col("_t")).alias(name))


def violations(baseline: tuple[DataFrame, DataFrame], check: tuple[DataFrame, DataFrame], threshold: float = 0.1) -> DataFrame:
    """``(column, check_type, observed)`` for every constraint that the check's months break; both sides
    are (sketches, levels). Shares of levels and completeness are exact, the gap between numbers is within
    :data:`GAP_ERROR`."""
    a, b = materialize(merged(baseline[0]), "merged"), materialize(merged(check[0]), "merged")
    fallen = a.select("column", (F.col("present") / F.col("rows")).alias("_a")).join(b.select("column", (F.col("present") / F.col("rows")).alias("_b")), "column")
    fallen = fallen.where("_b < _a").select("column", F.lit("completeness_check").alias("check_type"), F.col("_b").alias("observed"))
    levels = _shares(baseline[1], "_a").join(_shares(check[1], "_b"), ["column", "level"], "full").groupBy("column").agg(
        F.max(F.abs(F.coalesce("_a", F.lit(0.0)) - F.coalesce("_b", F.lit(0.0)))).alias("distance"),
        F.coalesce(F.sum(F.when(F.col("_a").isNull(), F.col("_b"))), F.lit(0.0)).alias("unseen"),
    )
    levels = materialize(levels, "level-gaps")
    unseen = levels.where("unseen > 0").select("column", F.lit("categorical_values_check").alias("check_type"), F.col("unseen").alias("observed"))
    moved = levels.select("column", "distance").unionByName(_gap(a, b)).where(F.col("distance") > threshold)
    return fallen.unionByName(unseen).unionByName(moved.select("column", F.lit("baseline_drift_check").alias("check_type"), F.col("distance").alias("observed")))
