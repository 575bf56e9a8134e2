"""The scored table in the catalog, and its questions as SQL views."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from civicspark.schemas import SCORES

SCORED_COLUMNS = [f.name for f in SCORES]


def create_scores_table(spark: SparkSession, table: str, location: str) -> None:
    """The scored table, a partition per run, kept where ``location`` says."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SCORES)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, `asof` string) USING parquet PARTITIONED BY (`asof`) LOCATION '{location}'")


def create_requests_table(spark: SparkSession, table: str, requests: DataFrame, location: str) -> None:
    """A snapshot of the requests as a table; a later call replaces it."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    requests.write.mode("overwrite").option("path", location).saveAsTable(table)


def insert_run(scores: DataFrame, table: str, asof: str) -> None:
    """Store one run. A run that is there already is replaced, no other partition is touched."""
    run = dt.date.fromisoformat(asof).isoformat()  # a date and nothing else gets into the statement
    spark, view = scores.sparkSession, f"run_{uuid.uuid4().hex}"
    scores.select(*SCORED_COLUMNS).createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (`asof` = '{run}') SELECT {', '.join(f'`{c}`' for c in SCORED_COLUMNS)} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def create_views(spark: SparkSession, scores: str, requests: str, prefix: str) -> dict[str, str]:
    """The outcome, grade and top views over the two tables; returns their names.

    An outcome is on time up to the deadline, late after it or when the snapshot is, undecided
    else. The grade takes each request on its first score, past its deadline only.
    """
    names = {k: f"{prefix}_{k}" for k in ("outcomes", "grade", "top")}
    taken = f"(SELECT date_trunc('DAY', max(requested_date)) + INTERVAL 1 DAY FROM {requests})"
    rest = ", ".join(f"s.`{c}`" for c in SCORED_COLUMNS if c != "service_request_id")
    spark.sql(
        f"""CREATE OR REPLACE VIEW {names['outcomes']} AS
        SELECT *, CASE WHEN closed_date <= deadline THEN 'on_time' WHEN closed_date IS NOT NULL OR outcome_snapshot > deadline THEN 'late'
          ELSE 'undecided' END AS outcome
        FROM (SELECT s.service_request_id, {rest}, s.`asof` AS scored_asof, r.closed_date, {taken} AS outcome_snapshot
          FROM {scores} s JOIN {requests} r USING (service_request_id))"""
    )
    spark.sql(
        f"""CREATE OR REPLACE VIEW {names['grade']} AS
        SELECT f.usage, f.flagged, count(*) AS requests, count_if(f.outcome = 'late') AS late,
          round(count_if(f.outcome = 'late') / count(*), 3) AS late_rate
        FROM (SELECT min_by(struct(usage, flagged, outcome, deadline, outcome_snapshot), scored_asof) AS f
          FROM {names['outcomes']} GROUP BY service_request_id)
        WHERE f.deadline < f.outcome_snapshot GROUP BY f.usage, f.flagged"""
    )
    spark.sql(
        f"""CREATE OR REPLACE VIEW {names['top']} AS
        SELECT `asof`, usage, service_request_id, service_name, comm_name, sector, score, rank_in_sector FROM {scores} WHERE flagged"""
    )
    return names
