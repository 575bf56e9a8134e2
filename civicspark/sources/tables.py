"""Side tables: communities, metrics, predictions, and the scored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from civicspark.schemas import COMMUNITIES, METRICS, PREDICTIONS, SCORES


def load_communities(spark: SparkSession, path: str) -> DataFrame:
    """The community lookup, a JSON array."""
    return spark.read.schema(COMMUNITIES).option("multiLine", True).json(path)


def load_metrics(spark: SparkSession, path: str) -> DataFrame:
    """``comm_code, value, n`` from CSV; rows without a code or a value are skipped."""
    rows = spark.read.schema(METRICS).option("header", True).csv(path)
    return rows.where(F.col("comm_code").isNotNull() & F.col("value").isNotNull()).withColumn(
        "n", F.floor("n").cast("long")
    )


def load_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PREDICTIONS).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_scores(scores: DataFrame, path: str, asof: str) -> None:
    """One run under ``asof=``, replacing only that run; millisecond timestamps."""
    spark = scores.sparkSession
    key = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(key)
    spark.conf.set(key, "TIMESTAMP_MILLIS")
    try:
        (
            scores.withColumn("asof", F.lit(asof))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("asof")
            .parquet(path)
        )
    finally:
        spark.conf.set(key, before)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """The scored table; ``asof`` is its partition, so a run's filter opens that run only."""
    return spark.read.schema(StructType([*SCORES, StructField("asof", StringType())])).parquet(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """The small report beside the scores, in a folder of its own."""
    summary.coalesce(1).write.mode("overwrite").json(path)
