"""Time the headline queries: one JSON line, seconds per query.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Building the request snapshot and
the scored table, which every deployment does once per snapshot, is timed on its own.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from civicspark.session import build_session, release
from civicspark.testbed import adapter, queries
from civicspark.testbed.queries import QUERIES

HEADLINE = (
    "asof_range_agg", "backlog_30d", "late_rate_90d", "history_features", "feature_matrix",
    "category_thresholds", "stale_close_mask", "training_labels", "breach_by_community",
    "validation_report", "quota_flag", "rank_in_sector", "roc_auc", "average_precision",
    "fairness_report", "scoring_rows", "shadow_outcomes", "grade_report", "scorecard_flags",
    "slowest5_share", "job_health", "profile_baseline", "drift_violations", "dedupe_requests",
    "rebuild_processed",
)
#: Timed as well if ``BENCH_MODEL`` is set: minutes of fitting, named apart from the total.
MODEL = ("train_model", "score_open")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    start = time.time()
    rows = adapter.requests(spark, path).count()
    took["setup_requests"] = round(time.time() - start, 3)
    start = time.time()
    run(adapter.outcomes(spark, path))
    took["setup_scores"] = round(time.time() - start, 3)
    start = time.time()
    run(queries.featured(spark, path))
    took["setup_features"] = round(time.time() - start, 3)
    for name in HEADLINE:
        start = time.time()
        run(QUERIES[name](spark, path))
        took[name] = round(time.time() - start, 3)
    for name in MODEL if os.environ.get("BENCH_MODEL") else ():
        start = time.time()
        run(QUERIES[name](spark, path))
        took[f"setup_{name}"] = round(time.time() - start, 3)
    total = round(sum(v for k, v in took.items() if not k.startswith("setup")), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total", "value": total, "unit": "sec", "queries": took,
                "sf": path.rstrip("/").rsplit("sf", 1)[-1], "requests": rows, "cpus": int(cpus),
            }
        )
    )
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
