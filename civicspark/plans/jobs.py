"""Job health from a job-history table: cost, rows read, and the ratio rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.functions.numbers import cost_usd
from civicspark.operators.asof import last_before
from civicspark.operators.detect import ratio_flags
from civicspark.settings import ControlSettings

SNAPSHOT_KINDS = ("train", "score", "pipeline-")


def rows_at(jobs: DataFrame, snapshots: DataFrame, name: str = "rows") -> DataFrame:
    """Each job's snapshot size: the newest snapshot taken on or before its start."""
    return last_before(
        jobs, snapshots, keys=[], row_time="created", event_time="taken", value="rows", name=name
    )


def reads_snapshot(kind, kinds=SNAPSHOT_KINDS):
    hit = F.lit(False)
    for k in kinds:
        hit = hit | F.col(kind).startswith(k)
    return hit


def assess(
    jobs: DataFrame, snapshots: DataFrame, settings: ControlSettings | None = None, kinds=SNAPSHOT_KINDS
) -> DataFrame:
    """Cost, rows, seconds per million rows, and a flag with its reason.

    Jobs that read the snapshot are judged per million rows, the others on billed seconds.
    """
    s = settings or ControlSettings()
    whole = reads_snapshot("kind", kinds)
    out = rows_at(jobs, snapshots).withColumns(
        {
            "usd": cost_usd(F.col("instance_type"), F.col("billed_seconds")),
            "rows": F.when(whole, F.col("rows")),
        }
    )
    out = out.withColumn(
        "sec_per_mrows", F.col("billed_seconds") / F.nullif(F.col("rows") / 1e6, F.lit(0.0))
    ).withColumn("_measure", F.when(whole, F.col("sec_per_mrows")).otherwise(F.col("billed_seconds")))
    judged = ratio_flags(
        out, "kind", "_measure", factor=s.ratio, name="_slow", only=F.col("status") == "Completed"
    )
    failed = F.col("status") == "Failed"
    reason = (
        F.when(failed, "failed").when(F.col("_slow"), f"> {s.ratio:g}x its kind's median").otherwise("")
    )
    return judged.withColumns({"flag": F.col("_slow") | failed, "reason": reason}).drop("_slow", "_measure")


def alert_lines(assessed: DataFrame) -> DataFrame:
    """One line per flagged job, plus a heading with their number when there are any."""
    flagged = assessed.where(F.col("flag"))
    seconds = F.coalesce(F.format_string("%.0f s", F.when(F.col("billed_seconds").isNotNull(), F.col("billed_seconds"))), F.lit(""))
    lines = flagged.select(
        F.lit(1).alias("ord"),
        F.concat(
            F.lit("- "), "name", F.lit(" ("), "kind", F.lit("): "), "reason", F.lit("; "),
            F.when(F.col("billed_seconds").isNull(), "no billed time").otherwise(seconds),
        ).alias("line"),
    )
    head = (
        flagged.agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 0)
        .select(F.lit(0).alias("ord"), F.format_string("%,d job(s) flagged", "n").alias("line"))
    )
    return head.unionByName(lines)


def run_report(steps: DataFrame, instance_type: str = "ml.t3.xlarge") -> DataFrame:
    """Per step: billed seconds and cost; a cached step costs nothing."""
    billed = F.when(~F.col("cached"), F.round("billed_seconds")).cast("double")
    return steps.withColumn("billed_seconds", billed).withColumn(
        "usd", F.coalesce(cost_usd(F.lit(instance_type), F.col("billed_seconds")), F.lit(0.0))
    )


def verdict(runs: DataFrame) -> DataFrame:
    """What each run means: ``status`` with the gate's outcome and the registered package."""
    return runs.withColumn(
        "verdict",
        F.when(
            (F.col("status") == "Succeeded") & (F.col("gate_outcome") == "True"),
            F.concat(
                F.lit("PASSED the gate; registered "), F.coalesce("package", F.lit("None")),
                F.lit(" as PendingManualApproval"),
            ),
        )
        .when(F.col("gate_outcome") == "False", "REJECTED by the gate; nothing was registered")
        .otherwise(F.concat(F.lit("run "), "status", F.lit(" before the gate decided"))),
    )
