"""Every query has a name in both places, and a spread of them equals its SQL."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows_of
from civicspark.session import new_path, release
from civicspark.plans import drift, metrics
from civicspark.testbed import adapter
from civicspark.testbed.queries import ORACLE, QUERIES

#: The package of text operators has its own tests; the model is fitted once per session.
CHECKED = sorted(n for n in QUERIES if n in ORACLE)
#: What these report is too rare for the smallest tables to have any.
RARE = {"busy_vs_late", "check_bulk_close", "check_group_outliers", "drift_violations", "filter_min_n"}


@pytest.fixture(scope="module")
def duck():
    """A connection per folder of tables."""
    kept = {}

    def connect(folder):
        if folder not in kept:
            kept[folder] = duckdb.connect()
            for t in TABLES:
                kept[folder].execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
        return kept[folder]

    return connect


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, sf, duck, name):
    folder = sf.replace("0.001", "0.01") if name in RARE else sf
    out = entry.queries()[name](spark, folder)
    cur = duck(folder).execute(entry.oracle_sql()[name])
    want = rows_of([c[0] for c in cur.description], cur.fetchall())
    assert rows_of(out.columns, [tuple(r) for r in out.collect()]) == want
    assert want, "nothing to compare: the query belongs in RARE"


def test_the_model_reproduces_itself(spark, sf):
    rows = entry.queries()["save_load_model"](spark, sf).collect()
    assert {r["metric"] for r in rows} == {"roc_auc", "pr_auc", "top_decile_lift"}
    assert all(r["matches"] for r in rows)


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 125
    assert entry.entry(spark).count() > 0


def test_the_gate_runs_on_measured_figures(spark, sf):
    row = QUERIES["promotion_run"](spark, sf).first()
    assert 0 <= row["pr_auc"] <= 1 and row["champion_exists"] == 1 and row["margin"] is not None
    assert row["promoted"] in (True, False)


def test_a_model_that_differs_is_refused(spark):
    shape = "metric string, value double"
    now, then = (spark.createDataFrame([("roc_auc", v), ("pr_auc", 0.5)], shape) for v in (0.7, 0.71))
    with pytest.raises(metrics.MetricMismatch, match="roc_auc"):
        metrics.require_match(now, then, ("roc_auc", "pr_auc"))
    assert metrics.require_match(now, now, ("roc_auc", "pr_auc")).count() == 2


def test_a_share_below_the_present_one_is_refused(spark):
    rows = spark.createDataFrame([(str(i), "Urgent" if i % 2 else "Calm") for i in range(40)], "service_request_id string, service_name string")
    with pytest.raises(ValueError, match="below the present"):
        drift.inject(rows, "urgent", 0.2)
    assert drift.inject(rows, "urgent", 0.8).count() == 40


def test_nothing_stays_behind(spark):
    """Intermediate tables go when the session is done with them. Last, as others read theirs."""
    path = new_path(spark, "left")
    spark.range(3).write.parquet(path)
    folder = Path(path.removeprefix("file:")).parent
    assert folder.is_dir()
    adapter._built.clear()
    release(spark)
    assert not folder.exists()
