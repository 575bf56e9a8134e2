"""Scoring open, undecided requests: rows, context, quota flag and rank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.functions import dates
from civicspark.operators.lookup import attach_groups, seen_categories, with_threshold
from civicspark.operators.ordered import rank_rows
from civicspark.plans.fairness import quota_flag
from civicspark.schemas import SCORES
from civicspark.settings import USAGE

CONTEXT_DAYS = 31
OUTPUT_COLUMNS = SCORES.fieldNames()


def scoring_rows(raw: DataFrame, thresholds: DataFrame, asof: int) -> DataFrame:
    """Open requests still inside their deadline at ``asof``: the complement of the overdue."""
    open_rows = raw.where(
        F.col("closed_date").isNull() & (F.col("requested_date") <= dates.at(asof))
    )
    due = with_threshold(open_rows, thresholds).withColumn(
        "deadline", dates.plus_days("requested_date", "threshold_days")
    )
    return seen_categories(due.where(F.col("deadline") >= dates.at(asof)), thresholds)


def context_frame(raw: DataFrame, rows: DataFrame, days: int = CONTEXT_DAYS) -> DataFrame:
    """Every request since shortly before the oldest scored one; a literal, so it prunes."""
    oldest = rows.agg(F.unix_micros(F.min("requested_date")).alias("t")).first()["t"]
    if oldest is None:
        return raw.limit(0)
    return raw.where(F.col("requested_date") >= dates.at(oldest - days * dates.DAY_MICROS))


def flag(scored: DataFrame, top_fraction: float = 0.10, score: str = "pred") -> DataFrame:
    """``flagged`` within each sector's quota and ``rank_in_sector`` by score."""
    flagged = quota_flag(scored, by=["sector"], top_fraction=top_fraction, score=score)
    return rank_rows(flagged, ["sector"], score, "service_request_id", name="rank_in_sector")


def stamp(
    rows: DataFrame, communities: DataFrame, *, model_ref: str, asof: int, scored_at: str,
    score: str = "pred",
) -> DataFrame:
    """The scored table's columns from rows that carry a prediction."""
    out = flag(attach_groups(rows, communities), score=score)
    return (
        out.withColumnRenamed(score, "score")
        .withColumns(
            {
                "usage": F.lit(USAGE),
                "model_ref": F.lit(model_ref),
                "snapshot_asof": dates.day_text(dates.at(asof)),
                "scored_at": F.lit(scored_at),
            }
        )
        .select(*OUTPUT_COLUMNS)
    )


def score_summary(scores: DataFrame) -> DataFrame:
    """Per sector and overall (``*``): rows, flagged, unseen share, mean score."""
    per = scores.groupBy("sector").agg(
        F.count(F.lit(1)).alias("scored"),
        F.sum(F.col("flagged").cast("long")).alias("flagged"),
        F.sum((~F.col("category_seen")).cast("long")).alias("_unseen"),
        F.sum("score").alias("_sum"),
    )
    both = per.unionByName(
        per.groupBy(F.lit("*").alias("sector")).agg(
            *[F.sum(c).alias(c) for c in ("scored", "flagged", "_unseen", "_sum")]
        )
    )
    return both.select(
        "sector",
        "scored",
        "flagged",
        F.round(F.col("_unseen") / F.col("scored"), 4).alias("unseen_category_share"),
        F.round(F.col("_sum") / F.col("scored"), 4).alias("score_mean"),
    )


def top_flagged(scores: DataFrame, asof: str, n: int = 20) -> DataFrame:
    """The run's highest flagged scores: a report of ``n`` rows."""
    return (
        scores.where((F.col("asof") == asof) & F.col("flagged"))
        .orderBy(F.desc("score"), "service_request_id")
        .limit(n)
        .select("usage", "service_name", "comm_name", "sector", "score", "rank_in_sector")
    )
