"""Grading stored scores against what happened later."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.functions import dates
from civicspark.functions.numbers import ratio
from civicspark.operators.ordered import DAYS_WIDTH, distribution, quantiles
from civicspark.plans.fairness import dimension_metrics, quota_flag, reportable
from civicspark.session import materialize
from civicspark.settings import UNKNOWN

DIMENSIONS = ("sector", "srg")
MIN_COMPARED_POSITIVES = 30
GRADE_COLUMNS = (
    "usage", "scored_asof", "service_request_id", "service_name", "sector", "srg", "score",
    "flagged", "deadline", "threshold_days", "category_seen", "outcome", "outcome_snapshot",
)


def outcome(closed, deadline, taken):
    """``on_time``, ``late`` or ``undecided``."""
    return (
        F.when(closed.isNotNull() & (closed <= deadline), "on_time")
        .when(closed.isNotNull() | (taken > deadline), "late")
        .otherwise("undecided")
    )


def shadow_outcomes(scores: DataFrame, requests: DataFrame) -> DataFrame:
    """Each stored score with its request's fate in the latest snapshot."""
    taken = dates.at(dates.snapshot_micros(requests))
    now = requests.select("service_request_id", "closed_date")
    return (
        scores.drop("closed_date")
        .join(now, "service_request_id")
        .withColumnRenamed("asof", "scored_asof")
        .withColumns(
            {
                "outcome_snapshot": taken,
                "outcome": outcome(F.col("closed_date"), F.col("deadline"), taken),
            }
        )
    )


def first_scores(outcomes: DataFrame) -> DataFrame:
    """Each request once, on its earliest score; a plain minimum, combined map-side."""
    rest = [c for c in outcomes.columns if c not in ("service_request_id", "scored_asof")]
    return (
        outcomes.groupBy("service_request_id")
        .agg(F.min(F.struct("scored_asof", *rest)).alias("_f"))
        .select("service_request_id", "_f.*")
        .select(*outcomes.columns)
    )


def deadline_passed(outcomes: DataFrame) -> DataFrame:
    """Rows whose deadline passed before the outcome snapshot; an undecided one is an error."""
    guard = F.when(
        F.col("outcome") == "undecided",
        F.raise_error(F.lit("a row past its deadline is still undecided")).cast("string"),
    ).otherwise(F.col("outcome"))
    return outcomes.where(F.col("deadline") < F.col("outcome_snapshot")).withColumn("outcome", guard)


def reflag(outcomes: DataFrame, by, name: str, top_fraction: float = 0.10) -> DataFrame:
    """The flags each run would have set sharing its quota by ``by``.

    It needs every row of the run, so call it before :func:`first_scores`.
    """
    cells = [f"_c{i}" for i in range(len(by))]
    keyed = outcomes.withColumns(
        {c: F.coalesce(F.col(b).cast("string"), F.lit(UNKNOWN)) for c, b in zip(cells, by, strict=True)}
    )
    return quota_flag(
        keyed, by=["scored_asof", *cells], top_fraction=top_fraction, score="score", name=name
    ).drop(*cells)


def cohort_rates(cohort: DataFrame, flag: str = "flagged", by=()) -> DataFrame:
    """Late rates, lift and recall of a cohort, overall or per ``by``."""
    late = (F.col("outcome") == "late").cast("double")
    f = F.col(flag)
    out = cohort.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(late).alias("late_rate"),
        F.coalesce(F.sum(f.cast("long")), F.lit(0)).alias("flagged"),
        F.avg(F.when(f, late)).alias("late_rate_flagged"),
        F.avg(F.when(~f, late)).alias("late_rate_unflagged"),
        F.sum(F.when(f, late)).alias("_hits"),
        F.sum(late).alias("_late"),
    )
    return out.select(
        *by,
        "rows",
        F.round("late_rate", 4).alias("late_rate"),
        "flagged",
        F.round("late_rate_flagged", 4).alias("late_rate_flagged"),
        F.round("late_rate_unflagged", 4).alias("late_rate_unflagged"),
        F.round(ratio("late_rate_flagged", "late_rate"), 4).alias("lift"),
        F.round(F.coalesce(F.col("_hits"), F.lit(0.0)) / F.nullif("_late", F.lit(0.0)), 4).alias("recall"),
    )


def group_grades(cohort: DataFrame, dims=DIMENSIONS, flag: str = "flagged") -> DataFrame:
    """Per dimension and group: counts, rates, and whether the group is large enough to compare."""
    judged = cohort.withColumn("_late", (F.col("outcome") == "late").cast("int"))
    groups = dimension_metrics(judged, dims, flag=flag, label="_late")
    return groups.withColumn(
        "compared", reportable(groups) & (F.col("positives") >= MIN_COMPARED_POSITIVES)
    )


def dimension_grades(groups: DataFrame) -> DataFrame:
    """Lowest over highest recall per dimension; null with fewer than two groups compared."""
    ok = F.col("compared")
    spread = groups.groupBy("dimension").agg(
        F.sum(ok.cast("long")).alias("n"),
        F.min(F.when(ok, F.col("recall"))).alias("lo"),
        F.max(F.when(ok, F.col("recall"))).alias("hi"),
        F.min(F.when(ok, F.struct("recall", "group")))["group"].alias("worst"),
    )
    real = (F.col("n") >= 2) & (F.col("hi") > 0)
    return spread.select(
        "dimension",
        F.round(F.when(real, F.col("lo") / F.col("hi")), 4).alias("recall_ratio"),
        F.when(real, F.col("worst")).alias("lowest_recall_group"),
    )


def top_types(rows: DataFrame, column: str = "service_name", n: int = 10) -> DataFrame:
    """The ``n`` most frequent values: a report."""
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).limit(n)


def deadline_medians(scored: DataFrame) -> DataFrame:
    """Median deadline in days of all scored and of the graded rows."""
    parts = scored.withColumn(
        "part",
        F.explode(
            F.array_compact(
                F.array(
                    F.lit("all_scored"),
                    F.when(F.col("deadline") < F.col("outcome_snapshot"), "graded"),
                )
            )
        ),
    )
    return quantiles(
        distribution(parts, ["part"], "threshold_days"), ["part"], {"median_days": 0.5}, width=DAYS_WIDTH
    ).select("part", F.round("median_days", 4).alias("median_days"))


def shadow_grade(outcomes: DataFrame) -> DataFrame:
    """The console table: late rate by flag over the graded cohort."""
    late = (F.col("outcome") == "late").cast("long")
    return (
        deadline_passed(first_scores(outcomes))
        .groupBy("usage", "flagged")
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.sum(late).alias("late"),
            F.round(F.avg(late.cast("double")), 3).alias("late_rate"),
        )
    )


@dataclass(frozen=True)
class Grade:
    coverage: DataFrame
    rates: DataFrame
    dimensions: DataFrame
    groups: DataFrame
    medians: DataFrame
    outcomes: DataFrame
    top_types: DataFrame


def grade(outcomes: DataFrame) -> Grade:
    """The whole grade, under the job's own flags and under the sector x srg quota.

    Runs are re-flagged over all their rows before each request is reduced to its first score.
    """
    flagged = reflag(outcomes, ("sector",), "flagged_by_sector")
    flagged = reflag(flagged, ("sector", "srg"), "flagged_post_hoc")
    scored = materialize(first_scores(flagged), "first-scores")
    cohort = deadline_passed(scored)
    seen = cohort.where(F.col("category_seen"))
    passed = F.col("deadline") < F.col("outcome_snapshot")
    coverage = scored.agg(
        F.count(F.lit(1)).alias("rows_scored"),
        F.coalesce(F.sum(passed.cast("long")), F.lit(0)).alias("rows_graded"),
        F.round(F.avg(passed.cast("double")), 4).alias("coverage"),
        F.coalesce(
            F.sum((F.col("flagged_by_sector") != F.col("flagged")).cast("long")), F.lit(0)
        ).alias("sector_reflag_mismatches"),
    )
    quotas = {"job": "flagged", "post_hoc": "flagged_post_hoc"}
    rates = [
        cohort_rates(cohort.where(F.col("category_seen")), f).withColumns(
            {"quota": F.lit(q), "cohort": F.lit("seen")}
        )
        for q, f in quotas.items()
    ]
    rates.append(
        cohort_rates(cohort.where(~F.col("category_seen"))).withColumns(
            {"quota": F.lit("job"), "cohort": F.lit("unseen")}
        )
    )
    groups = [
        group_grades(seen, flag=f).withColumn("quota", F.lit(q)) for q, f in quotas.items()
    ]
    dims = [dimension_grades(g).withColumn("quota", F.lit(q)) for g, q in zip(groups, quotas, strict=True)]
    return Grade(
        coverage,
        rates[0].unionByName(rates[1]).unionByName(rates[2]),
        dims[0].unionByName(dims[1]),
        groups[0].unionByName(groups[1]),
        deadline_medians(scored),
        top_types(scored, "outcome"),
        top_types(cohort),
    )


def summary_lines(report: Grade) -> DataFrame:
    """The grade as text lines."""
    head = report.coverage.select(
        F.lit(0).alias("ord"),
        F.format_string(
            "graded %,d of %,d (%.0f%%); sector re-flag mismatches %d", "rows_graded", "rows_scored",
            F.col("coverage") * 100, "sector_reflag_mismatches",
        ).alias("line"),
    )
    rates = report.rates.select(
        F.lit(1).alias("ord"),
        F.format_string(
            "%s, %s categories: late flagged %s, unflagged %s, all %s; lift %s; recall %s",
            "quota", "cohort", *[
                F.col(c).cast("string")
                for c in ("late_rate_flagged", "late_rate_unflagged", "late_rate", "lift", "recall")
            ],
        ).alias("line"),
    )
    dims = report.dimensions.select(
        F.lit(2).alias("ord"),
        F.format_string(
            "  %s, %s: recall ratio %s (lowest %s)", "quota", "dimension",
            F.col("recall_ratio").cast("string"), "lowest_recall_group",
        ).alias("line"),
    )
    rows = report.groups.select(
        F.lit(3).alias("ord"),
        F.concat(
            F.format_string(
                "    %s, %-13s rows %,6d  late %,5d  recall %s  lift %s", "quota", "group", "rows",
                "positives", F.round("recall", 4).cast("string"), F.round("lift", 4).cast("string"),
            ),
            F.when(F.col("compared"), "").otherwise("  (too few late to compare)"),
        ).alias("line"),
    )
    return head.unionByName(rates).unionByName(dims).unionByName(rows)
