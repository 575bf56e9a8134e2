"""Data drift: the intake window, a disclosed injection, the profile and the check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.functions import dates
from civicspark.functions.text import contains_text, department
from civicspark.operators.ordered import parts_for, quantiles, rank_rows, running_before, sample_exactly
from civicspark.plans.features import featurize
from civicspark.plans.labels import Labels, assert_no_leakage, recent
from civicspark.plans.scoring import context_frame
from civicspark.schemas import CATEGORICAL, FEATURE_SETS, TRAIN_YEARS
from civicspark.session import materialize
from civicspark.settings import DEPARTMENTS

COLUMNS = FEATURE_SETS["challenger"]
NUMERIC = tuple(c for c in COLUMNS if c not in CATEGORICAL)


def intake_rows(raw: DataFrame, asof: int, days: int = 30) -> DataFrame:
    """Requests filed in ``(asof - days, asof]``, open or closed."""
    start = dates.at(asof - days * dates.DAY_MICROS)
    return raw.where((F.col("requested_date") > start) & (F.col("requested_date") <= dates.at(asof)))


def _ready(features: DataFrame, known=DEPARTMENTS) -> DataFrame:
    assert_no_leakage(features)
    return features.withColumn("department", department("service_name", known))


def feature_table(
    rows: DataFrame, raw: DataFrame, thresholds: DataFrame, communities: DataFrame,
    holidays: DataFrame, known=DEPARTMENTS,
) -> DataFrame:
    """Challenger features of ``rows``; the rolling counts look across the whole snapshot."""
    context = context_frame(raw, rows)
    return _ready(
        featurize(rows, raw, thresholds, communities, holidays, context=context), known
    )


def baseline_table(
    labels: Labels, raw: DataFrame, communities: DataFrame, holidays: DataFrame,
    sample: int = 200_000, seed: int = 42, known=DEPARTMENTS,
) -> DataFrame:
    """The recent training rows' features, sampled only after the whole split is featurised."""
    train = recent(labels.train, TRAIN_YEARS["challenger"])
    full = materialize(
        _ready(featurize(train, raw, labels.thresholds, communities, holidays), known), "baseline"
    )
    return sample_exactly(full, sample, "service_request_id", seed) if sample else full


def inject(df: DataFrame, pattern: str, share: float, row_id: str = "service_request_id", seed: int = 7) -> DataFrame:
    """Rows whose category contains ``pattern`` resampled to ``share`` of the table, same size.

    Matches are drawn with replacement through their rank, the others thinned without
    replacement by a digest cut-off; both repeat for a seed.
    """
    if not 0 < share < 1:
        raise ValueError(f"share must be between 0 and 1, got {share}")
    marked = df.withColumn("_hit", contains_text(F.col("service_name"), pattern))
    counts = marked.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_hit").cast("long")).alias("k")
    ).first()
    n, k = counts["n"], counts["k"] or 0
    if not k:
        raise ValueError(f"no rows match {pattern!r}")
    n_hit = round(share * n)
    if n - n_hit > n - k:
        raise ValueError(f"{n - n_hit} rows without {pattern!r} wanted, {n - k} there: share {share} is below the present {k / n:.4f}")
    hits = materialize(
        rank_rows(
            marked.where(F.col("_hit")).withColumn("_zero", F.lit(0.0)), [], "_zero", row_id, name="_i",
            parts=parts_for(k),
        ).drop("_zero", "_hit"),
        "hits",
    )
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(k)) + 1
    drawn = df.sparkSession.range(n_hit).select(draw.alias("_i")).join(hits, "_i").drop("_i")
    rest = marked.where(~F.col("_hit")).drop("_hit")
    return drawn.unionByName(sample_exactly(rest, n - n_hit, row_id, seed) if n > n_hit else rest.limit(0))


def counted(df: DataFrame, numeric, categorical) -> DataFrame:
    """``(column, kind, value, level, n)``: how often each number and each level of each column
    occurs, in one pass. Written, for everything about a side of a comparison is arithmetic on it."""
    none = {"value": F.lit(None).cast("double"), "level": F.lit(None).cast("string")}

    def entry(c, kind, **own):
        return F.struct(
            F.lit(c).alias("column"), F.lit(kind).alias("kind"), *[v.alias(k) for k, v in {**none, **own}.items()]
        )

    entries = [entry(c, "numeric", value=F.col(c).cast("double")) for c in numeric]
    entries += [entry(c, "string", level=F.col(c).cast("string")) for c in categorical]
    keys = ["column", "kind", "value", "level"]
    rows = df.select(F.explode(F.array(*entries)).alias("p")).select("p.*")
    return materialize(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "counted")


QUANTILES = {"p10": 0.1, "p50": 0.5, "p90": 0.9}
SLICES = 4096  # of each column's own range


def _with_width(numbers: DataFrame) -> DataFrame:
    """Adds ``_width``: a slice of the column's range, so that no column's scale matters."""
    span = numbers.groupBy("column").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    width = F.coalesce(F.nullif((F.col("_hi") - F.col("_lo")) / SLICES, F.lit(0.0)), F.lit(1.0))
    return numbers.join(materialize(span.select("column", width.alias("_width")), "widths"), "column")


def profile(df: DataFrame, numeric, categorical) -> DataFrame:
    """Per column: rows, completeness, distinct values, and for numbers range, moments, quantiles."""
    table = counted(df, numeric, categorical)
    present = table.where(F.col("value").isNotNull()).select("column", "value", "n")
    spread = quantiles(present, ["column"], QUANTILES).drop("rows")
    there = F.col("value").isNotNull() | F.col("level").isNotNull()
    mean = F.sum(F.col("n") * F.col("value")) / F.sum(F.when(F.col("value").isNotNull(), F.col("n")))
    columns = materialize(
        table.groupBy("column", "kind").agg(
            F.sum("n").alias("rows"),
            F.coalesce(F.sum(F.when(~there, F.col("n"))), F.lit(0)).alias("missing"),
            F.count(F.when(there, 1)).alias("distinct_values"),
            F.min("value").alias("min"), F.max("value").alias("max"), mean.alias("mean"),
        ),
        "columns",
    )
    around = present.join(columns.select("column", "mean"), "column").groupBy("column").agg(
        F.sqrt(F.sum(F.col("n") * F.pow(F.col("value") - F.col("mean"), 2)) / F.sum("n")).alias("std")
    )
    return (
        columns.join(around, "column", "left").join(spread, "column", "left")
        .withColumn("completeness", 1 - F.col("missing") / F.col("rows"))
    )


def shares(table: DataFrame) -> DataFrame:
    """Share of each level of each string column, missing values left out."""
    levels = table.where(F.col("level").isNotNull()).select("column", "level", "n")
    total = levels.groupBy("column").agg(F.sum("n").alias("_all"))
    return levels.join(total, "column").select("column", "level", (F.col("n") / F.col("_all")).alias("share"))


def categorical_distance(baseline: DataFrame, check: DataFrame) -> DataFrame:
    """Per column: the largest change of any level's share, and how much mass is unseen. Both
    sides are :func:`counted` tables."""
    a = shares(baseline).withColumnRenamed("share", "_a")
    b = shares(check).withColumnRenamed("share", "_b")
    both = a.join(b, ["column", "level"], "full")
    gap = F.abs(F.coalesce("_a", F.lit(0.0)) - F.coalesce("_b", F.lit(0.0)))
    return both.groupBy("column").agg(
        F.max(gap).alias("distance"),
        F.coalesce(F.sum(F.when(F.col("_a").isNull(), F.col("_b"))), F.lit(0.0)).alias("unseen"),
    )


def numeric_distance(baseline: DataFrame, check: DataFrame) -> DataFrame:
    """Per column: the largest gap between the two cumulative distributions of :func:`counted`
    tables."""

    def side(table, a, b):
        return table.where(F.col("value").isNotNull()).select(
            "column", "value", (F.col("n") * a).alias("na"), (F.col("n") * b).alias("nb")
        )

    both = (
        side(baseline, 1, 0).unionByName(side(check, 0, 1))
        .groupBy("column", "value")
        .agg(F.sum("na").alias("na"), F.sum("nb").alias("nb"))
    )
    totals = both.groupBy("column").agg(F.sum("na").alias("_ta"), F.sum("nb").alias("_tb"))
    ran = running_before(_with_width(both), ["column"], "value", ["na", "nb"], width="_width").join(totals, "column")
    gap = F.abs(
        (F.col("before_na") + F.col("na")) / F.col("_ta") - (F.col("before_nb") + F.col("nb")) / F.col("_tb")
    )
    return ran.where((F.col("_ta") > 0) & (F.col("_tb") > 0)).groupBy("column").agg(
        F.max(gap).alias("distance")
    )


def violations(
    baseline: DataFrame, check: DataFrame, numeric, categorical, *, threshold: float = 0.1,
    completeness_drop: float = 0.0,
) -> DataFrame:
    """``(column, check_type, observed)`` for every constraint the check breaks."""
    a, b = counted(baseline, numeric, categorical), counted(check, numeric, categorical)

    def completeness(table, name):
        there = F.col("value").isNotNull() | F.col("level").isNotNull()
        return table.groupBy("column").agg((F.sum(F.when(there, F.col("n")).otherwise(0)) / F.sum("n")).alias(name))

    drop = (
        completeness(a, "_a").join(completeness(b, "_b"), "column")
        .where(F.col("_b") < F.col("_a") - completeness_drop)
        .select("column", F.lit("completeness_check").alias("check_type"), F.col("_b").alias("observed"))
    )
    levels = categorical_distance(a, b)
    unseen = levels.where(F.col("unseen") > 0).select(
        "column", F.lit("categorical_values_check").alias("check_type"), F.col("unseen").alias("observed")
    )
    moved = levels.select("column", "distance").unionByName(
        numeric_distance(a, b)
    ).where(F.col("distance") > threshold).select(
        "column", F.lit("baseline_drift_check").alias("check_type"), F.col("distance").alias("observed")
    )
    return drop.unionByName(unseen).unionByName(moved)

