"""One query per operator over the benchmark tables, each with its independent SQL if it has one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.functions import dates
from civicspark.functions.numbers import band, cost_usd, ratio_band
from civicspark.functions.text import department, job_kind, report_value
from civicspark.operators import detect
from civicspark.operators.asof import Span, range_agg
from civicspark.operators.lookup import attach_groups, attach_sector, with_threshold
from civicspark.operators.ordered import rank_rows, sample_exactly
from civicspark.plans import (
    champion,
    drift,
    explore,
    fairness,
    features,
    grading,
    jobs,
    labels,
    maps,
    metrics,
    model,
    purge,
    quality,
    scorecard,
    scoring,
    sketches,
)
from civicspark.plans import registry as versions
from civicspark.schemas import CATEGORICAL, FEATURE_SETS, LEAKY_COLUMNS
from civicspark.session import new_path
from civicspark.settings import (
    ControlSettings,
    FairnessSettings,
    LabelSettings,
    LateRate,
    PromotionSettings,
    ScorecardSettings,
    USAGE,
)
from civicspark.sources import requests as raw_zone
from civicspark.sources import catalog, paging, published, snapshots, tables
from civicspark.testbed import adapter
from civicspark.testbed.oracle import DAY, sql

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return register


def stamp_text(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def six(column, name: str | None = None):
    return F.round(F.col(column).cast("double"), 6).alias(name or column)


T = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"
REQ, CLO, DUE = (T.format(c) for c in ("requested_date", "closed_date", "deadline"))
ID = "service_request_id"
CATEGORY = "1-URGENT - BUILDING"
DEPARTMENTS = ("1-URGENT", "2-HIGH", "3-MEDIUM")
CARD = ScorecardSettings(segment_category=CATEGORY, segment_sector="AMERICA")
TIGHT = ControlSettings(limit=0.5)  # narrow limits, so these short series have flags to check
SMALL_FAIR = FairnessSettings(min_group_rows=50, min_group_positives=10)


def asof_of(spark, d) -> int:
    return dates.snapshot_micros(adapter.requests(spark, d))


def built(spark, d, **kw):
    return labels.build_training_labels(adapter.requests(spark, d), gate=adapter.GATE, **kw)


def judged(spark, d) -> DataFrame:
    """Every request with its group, a label and a pseudo-score."""
    rows = attach_groups(adapter.requests(spark, d), adapter.communities(spark, d))
    aged = with_threshold(labels.add_days_to_close(rows), adapter.base_thresholds(spark, d))
    late = F.col("closed_date").isNull() | (F.col("days_to_close") > F.col("threshold_days"))
    return aged.withColumns({"breach": late.cast("int"), "pred": adapter.synthetic_score()})


def flagged(spark, d) -> DataFrame:
    return fairness.quota_flag(judged(spark, d), by=["sector"])


# --- sources and sinks ----------------------------------------------------------------


def raw_base(spark, d) -> str:
    """The request table landed as raw snapshots, one ``asof=`` per year of filing."""
    key = (spark.sparkContext.applicationId, d, "raw")
    if key not in adapter._built:
        base = new_path(spark, "raw")
        rows = adapter.requests(spark, d)
        text = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
        (
            text.withColumn("asof", F.concat(F.year(F.col("requested_date").cast("timestamp")), F.lit("-12-31")))
            .write.partitionBy("asof").option("compression", "gzip").json(base)
        )
        adapter._built[key] = base
    return adapter._built[key]


@query("read_raw", sql("SELECT source, count(*) AS n, count(closed_date) AS closed FROM requests GROUP BY 1", "requests"))
def read_raw(spark, d):
    raw = raw_zone.read_raw(adapter.prepare(spark), raw_base(spark, d))
    return raw.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count("closed_date").alias("closed"))


DIRTY_CASES = 4


def dirty_text(spark, d) -> DataFrame:
    """Request dates as the mixed text a feed delivers; every 97th is junk."""
    key = F.col(ID).cast("long")
    text = (
        F.when(key % 97 == 0, "not a date")
        .when(key % DIRTY_CASES == 0, F.date_format("requested_date", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
        .when(key % DIRTY_CASES == 1, F.concat(F.date_format("requested_date", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")))
        .when(key % DIRTY_CASES == 2, F.concat(F.date_format("requested_date", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".123+00:00")))
        .otherwise(F.date_format("requested_date", "yyyy-MM-dd"))
    )
    rows = adapter.requests(spark, d)
    return rows.select(
        ID,
        text.alias("requested_date"),
        F.when(key % 89 == 0, "??").otherwise(F.date_format("closed_date", "yyyy-MM-dd HH:mm:ss")).alias("closed_date"),
        F.when(key % 53 == 0, "west").otherwise(F.col("longitude").cast("string")).alias("longitude"),
        F.col("latitude").cast("string").alias("latitude"),
    )


@query(
    "cast_intake",
    sql(
        f"""SELECT service_request_id,
        CASE WHEN k % 97 = 0 THEN NULL WHEN k % 4 = 2 THEN strftime(requested_date, '%Y-%m-%d %H:%M:%S') || '.123'
        ELSE strftime(requested_date, '%Y-%m-%d %H:%M:%S') || '.000' END AS requested_date,
        CASE WHEN k % 89 = 0 THEN NULL ELSE strftime(closed_date, '%Y-%m-%d %H:%M:%S') END AS closed_date,
        CASE WHEN k % 53 = 0 THEN NULL ELSE longitude END AS longitude, latitude
        FROM (SELECT *, CAST(service_request_id AS BIGINT) AS k FROM requests)""",
        "requests",
    ),
)
def cast_intake(spark, d):
    out = raw_zone.cast_intake(dirty_text(spark, d))
    return out.select(
        ID, F.date_format("requested_date", "yyyy-MM-dd HH:mm:ss.SSS").alias("requested_date"),
        stamp_text("closed_date"), "longitude", "latitude",
    )


@query(
    "derive_partitions",
    sql(
        """SELECT year(requested_date)::BIGINT AS year, month(requested_date)::BIGINT AS month, count(*) AS n
        FROM requests WHERE CAST(service_request_id AS BIGINT) % 97 <> 0 GROUP BY 1, 2""",
        "requests",
    ),
)
def derive_partitions(spark, d):
    out = raw_zone.derive_partitions(raw_zone.cast_intake(dirty_text(spark, d)))
    return out.groupBy(F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "dedupe_requests",
    """SELECT k AS line_key, strftime(l_shipdate, '%Y-%m-%d') AS shipped, l_extendedprice AS price FROM (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY l_shipdate DESC, l_extendedprice DESC) AS rn FROM
    (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS k, * FROM lineitem)) WHERE rn = 1""",
)
def dedupe_requests(spark, d):
    lines = adapter.table(spark, d, "lineitem").select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("line_key"),
        "l_shipdate",
        F.col("l_extendedprice").alias("price"),
    )
    out = raw_zone.dedupe(lines, "line_key", "l_shipdate")
    return out.select("line_key", F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"), "price")


def processed_path(spark, d) -> str:
    key = (spark.sparkContext.applicationId, d, "processed")
    if key not in adapter._built:
        path = new_path(adapter.prepare(spark), "processed")
        raw_zone.rebuild_processed(spark, raw_base(spark, d), path)
        adapter._built[key] = path
    return adapter._built[key]


@query(
    "rebuild_processed",
    sql("SELECT year(requested_date)::BIGINT AS year, month(requested_date)::BIGINT AS month, count(*) AS n FROM requests GROUP BY 1, 2", "requests"),
)
def rebuild_processed(spark, d):
    path = new_path(adapter.prepare(spark), "rebuilt")
    for _ in range(2):  # the second build replaces the first
        raw_zone.rebuild_processed(spark, raw_base(spark, d), path, unique=True)
    stored = published.read_published(spark, path).select(*[F.col(c).cast("long").alias(c) for c in raw_zone.PARTITIONS])
    return stored.groupBy(*raw_zone.PARTITIONS).agg(F.count(F.lit(1)).alias("n"))


@query(
    "changed_months",
    sql(
        """SELECT year(requested_date)::BIGINT AS year, month(requested_date)::BIGINT AS month, count(*) AS rows,
        CASE WHEN min(requested_date) > TIMESTAMP '2000-01-01' THEN 'new'
        WHEN max(requested_date) <= TIMESTAMP '2000-01-01' AND coalesce(max(closed_date) <= TIMESTAMP '2000-01-01', true) THEN 'kept'
        ELSE 'changed' END AS state FROM requests GROUP BY 1, 2""",
        "requests",
    ),
)
def changed_months(spark, d):
    """What a later snapshot rewrites of the table that an earlier one left."""
    path, rows = new_path(adapter.prepare(spark), "published"), adapter.requests(spark, d)
    for snapshot in (adapter.known_at(rows, adapter.run_micros(spark, "2000-01-01")), rows):
        report = published.publish(raw_zone.derive_partitions(snapshot), path)
    return report.select(F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month"), "rows", "state")


@query(
    "published_rows",
    sql(f"SELECT service_request_id, {REQ}, {CLO} FROM requests WHERE requested_date >= TIMESTAMP '1998-06-01'", "requests"),
)
def published_rows(spark, d):
    """The rows that readers see after three builds, from the folders of more than one of them."""
    path, rows = new_path(adapter.prepare(spark), "published"), adapter.requests(spark, d)
    early = rows.where(F.col("requested_date") < F.lit("1999-01-01").cast("timestamp"))
    for snapshot in (early, adapter.known_at(rows, adapter.run_micros(spark, "2000-01-01")), rows):
        published.publish(raw_zone.derive_partitions(snapshot), path)
    out = published.read_published(spark, path, since="1998-06-01")
    return out.select(ID, stamp_text("requested_date"), stamp_text("closed_date"))


#: A worker holds and sorts a range at a time: larger feeds have more ranges, not larger ones.
RANGE_ROWS = 250_000
LINES = "l_orderkey long, l_linenumber long, l_extendedprice double"


def keyed_folder(rows: DataFrame, key: str, files: int) -> str:
    """``rows`` as a service keeps them, in files by key: a range is read from those that hold it and
    not from the whole table again."""
    path = new_path(rows.sparkSession, "feed")
    rows.repartitionByRange(files, key).sortWithinPartitions(key).write.parquet(path)
    return path.removeprefix("file://").removeprefix("file:")


def pulled_lines(spark, d) -> tuple[str, DataFrame]:
    """The order lines pulled as a feed by their order, a key of several rows: stopped after the first
    wave, then taken up again."""
    kept, key = (spark.sparkContext.applicationId, d, "pull"), "l_orderkey"
    lines = adapter.table(spark, d, "lineitem")
    if kept in adapter._built:
        return adapter._built[kept], lines.select(key)
    path = new_path(spark, "pull")
    shape = lines.select(F.col(key).cast("long").alias(key), F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_extendedprice").schema
    count = lines.count()
    size = min(max(50, count // 40), RANGE_ROWS)
    feed = paging.FolderFeed(keyed_folder(lines.select(*shape.names), key, -(-count // size) or 1), key, tuple(shape.names))
    for waves in (1, None):
        paging.pull(
            spark, feed, lines.select(key), key, shape, path, rows_per_range=size, page_size=max(7, size // 9), ranges_per_wave=max(16, count // size // 3), waves=waves
        )
    adapter._built[kept] = path
    return path, lines.select(key)


@query("paged_pull", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_extendedprice FROM lineitem")
def paged_pull(spark, d):
    return paging.read_pull(spark, pulled_lines(spark, d)[0])


@query(
    "pull_audit",
    "SELECT count(*) AS stored, count(*) AS logged, count(*) AS there, true AS complete, max(l_orderkey) AS high FROM lineitem",
)
def pull_audit(spark, d):
    path, keys = pulled_lines(spark, d)
    top = paging.read_pull(spark, path).agg(F.max("l_orderkey").alias("high"))
    return paging.audit(spark, path, keys).drop("waves").crossJoin(top)


@query(
    "load_requests",
    sql(
        f"SELECT service_request_id, service_name, {REQ}, {CLO} FROM requests WHERE requested_date >= TIMESTAMP '2000-03-15'",
        "requests",
    ),
)
def load_requests(spark, d):
    rows = raw_zone.load_requests(spark, processed_path(spark, d), since="2000-03-15")
    return rows.select(ID, "service_name", stamp_text("requested_date"), stamp_text("closed_date"))


@query("load_communities", sql("SELECT comm_code, name, sector, srg FROM comms", "comms"))
def load_communities(spark, d):
    path = new_path(adapter.prepare(spark), "communities")
    # one JSON array, as the lookup is published: a dimension of a few hundred rows
    listed = F.to_json(F.collect_list(F.struct("comm_code", "name", "sector", "srg", "class")))
    adapter.communities(spark, d).agg(listed.alias("value")).write.text(path)
    return tables.load_communities(spark, path).select("comm_code", "name", "sector", "srg")


@query(
    "latest_asof",
    sql("SELECT CAST(max(year(requested_date)) AS VARCHAR) || '-12-31' AS \"asof\" FROM requests", "requests"),
)
def latest_asof(spark, d):
    return snapshots.latest_asof(adapter.prepare(spark), raw_base(spark, d))


@query(
    "replay_snapshot",
    sql("SELECT service_name, count(*) AS n FROM requests WHERE year(requested_date) = 1998 GROUP BY 1", "requests"),
)
def replay_snapshot(spark, d):
    path = new_path(adapter.prepare(spark), "replayed")
    snapshots.replay(spark, raw_base(spark, d), path, asof="1998-12-31")
    return raw_zone.load_requests(spark, path).groupBy("service_name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stale_keys",
    "SELECT CAST(o_orderkey AS VARCHAR) AS key FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def stale_keys(spark, d):
    present = adapter.table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("key"))
    written = adapter.table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("key"))
    return snapshots.stale_keys(present, written)


@query(
    "snapshot_manifest",
    sql(
        """SELECT 'requests' AS resource, '2001-08-02' AS "asof", '' AS window_where, count(*) AS row_count,
        '2001-08-02T06:00:00+00:00' AS pulled_at, 50000::BIGINT AS page_size FROM requests""",
        "requests",
    ),
)
def snapshot_manifest(spark, d):
    return raw_zone.pull_snapshot(
        adapter.requests(spark, d), new_path(spark, "pulled"), "2001-08-02", resource="requests",
        pulled_at="2001-08-02T06:00:00+00:00",
    )


@query(
    "window_count",
    sql("SELECT count(*) AS n FROM requests WHERE requested_date >= TIMESTAMP '1999-01-01'", "requests"),
)
def window_count(spark, d):
    return explore.window_count(adapter.requests(spark, d), 2, 2001)


@query(
    "keyset_page",
    sql(
        f"""SELECT service_request_id, {REQ} FROM requests WHERE service_request_id > '1300'
        ORDER BY service_request_id LIMIT 500""",
        "requests",
    ),
)
def keyset_page(spark, d):
    page = raw_zone.keyset_page(adapter.requests(spark, d), ID, "1300", 500)
    return page.select(ID, stamp_text("requested_date"))


@query(
    "new_rows",
    sql(f"SELECT service_request_id, {REQ} FROM requests WHERE service_request_id > '1300'", "requests"),
)
def new_rows(spark, d):
    """Paging to the end, all pages at once."""
    rows = raw_zone.new_rows(adapter.requests(spark, d), ID, "1300")
    return rows.select(ID, stamp_text("requested_date"))


@query(
    "write_scores",
    sql('SELECT run AS "asof", count(*) AS n, sum(CAST(flagged AS INT))::BIGINT AS flagged FROM scores GROUP BY 1', "scores"),
)
def write_scores(spark, d):
    stored = adapter.scores(spark, d)
    path = new_path(spark, "score-copy")
    for run in (*adapter.RUNS, adapter.RUNS[0]):  # a repeated run replaces only itself
        tables.write_scores(stored.where(F.col("asof") == run).drop("asof"), path, run)
    return tables.read_scores(spark, path).groupBy("asof").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("flagged").cast("long")).alias("flagged")
    )


def catalogued(spark, d) -> dict[str, str]:
    """Both runs in a catalog table, the first one stored again, and the views over it."""
    key = (spark.sparkContext.applicationId, d, "catalog")
    if key not in adapter._built:
        mark = f"t{abs(hash(key)):x}"
        stored, scored, filed = adapter.scores(spark, d), f"scores_{mark}", f"requests_{mark}"
        catalog.create_scores_table(spark, scored, new_path(spark, "catalog-scores"))
        for run in (*adapter.RUNS, adapter.RUNS[0]):
            catalog.insert_run(stored.where(F.col("asof") == run), scored, run)
        catalog.create_requests_table(spark, filed, adapter.requests(spark, d), new_path(spark, "catalog-requests"))
        adapter._built[key] = {"scores": scored, **catalog.create_views(spark, scored, filed, mark)}
    return adapter._built[key]


@query(
    "catalog_scores",
    sql('SELECT run AS "asof", count(*) AS n, sum(CAST(flagged AS INT))::BIGINT AS flagged FROM scores GROUP BY 1', "scores"),
)
def catalog_scores(spark, d):
    return spark.sql(f"SELECT `asof`, count(*) AS n, count_if(flagged) AS flagged FROM {catalogued(spark, d)['scores']} GROUP BY 1")


@query(
    "outcomes_view",
    sql(
        f"""SELECT usage, scored_asof, service_request_id, sector, srg, round(score, 6) AS score,
        rank_in_sector::BIGINT AS rank_in_sector, flagged, {DUE}, {CLO}, outcome FROM outcomes""",
        "outcomes",
    ),
)
def outcomes_view(spark, d):
    return spark.table(catalogued(spark, d)["outcomes"]).select(
        "usage", "scored_asof", ID, "sector", "srg", six("score"), "rank_in_sector", "flagged",
        stamp_text("deadline"), stamp_text("closed_date"), "outcome",
    )


@query(
    "grade_view",
    sql(
        """SELECT usage, flagged, count(*) AS requests, sum(CASE WHEN outcome = 'late' THEN 1 ELSE 0 END)::BIGINT AS late,
        round(avg(CASE WHEN outcome = 'late' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 3) AS late_rate
        FROM cohort GROUP BY 1, 2""",
        "cohort",
    ),
)
def grade_view(spark, d):
    return spark.table(catalogued(spark, d)["grade"])


@query(
    "load_metrics",
    sql(
        """SELECT comm_code, round(avg(days), 6) AS value, count(*) AS n FROM aged
        WHERE days IS NOT NULL GROUP BY 1 HAVING CAST(comm_code AS BIGINT) % 5 <> 0""",
        "aged",
    ),
)
def load_metrics(spark, d):
    path = new_path(adapter.prepare(spark), "metrics")
    aged = labels.add_days_to_close(adapter.requests(spark, d))
    value = F.when(F.col("comm_code").cast("long") % 5 != 0, F.avg("days_to_close"))
    per = aged.where(F.col("days_to_close").isNotNull()).groupBy("comm_code").agg(
        value.alias("value"), F.count(F.lit(1)).cast("double").alias("n")
    )
    tables.write_csv(per, path)
    return tables.load_metrics(spark, path).select("comm_code", six("value"), "n")


@query(
    "privacy_projection",
    sql(
        f"""SELECT service_request_id, {REQ}, service_name, agency_responsible, comm_code, comm_name, source,
        longitude, latitude, {T.format('updated_date')}, {CLO}, status_description, location_type FROM requests""",
        "requests",
    ),
)
def privacy_projection(spark, d):
    wide = adapter.requests(spark, d).withColumn("address", F.concat(F.lit("1 "), "comm_name"))
    out = raw_zone.privacy_projection(wide)
    times = ("requested_date", "updated_date", "closed_date")
    return out.select(*[stamp_text(c) if c in times else F.col(c) for c in out.columns])


# --- projections and filters ----------------------------------------------------------


@query("days_to_close", sql("SELECT service_request_id, days AS days_to_close FROM aged", "aged"))
def days_to_close(spark, d):
    return labels.add_days_to_close(adapter.requests(spark, d)).select(ID, "days_to_close")


@query(
    "labelled_subset",
    sql("SELECT service_request_id, days AS days_to_close FROM subset", "subset"),
)
def labelled_subset(spark, d):
    return labels.labelled_subset(adapter.requests(spark, d)).select(ID, "days_to_close")


@query(
    "time_split",
    sql(
        """SELECT service_request_id, CASE WHEN requested_date < boundary THEN 'train' ELSE 'test' END AS split
        FROM requests, bounds""",
        "requests", "bounds",
    ),
)
def time_split(spark, d):
    rows = adapter.requests(spark, d)
    return labels.add_split(rows, labels.holdout_boundary(rows)).select(ID, "split")


GUARDED = LEAKY_COLUMNS


@query(
    "leakage_guard",
    sql(
        f"""SELECT {", ".join(f"count({c}) AS {c}" for c in GUARDED)}, '{",".join(sorted(GUARDED))}' AS refused
        FROM (SELECT *, days AS days_to_close FROM labels)""",
        "labels",
    ),
)
def leakage_guard(spark, d):
    """Which columns of the labelled table the guard refuses, and how many rows carry them."""
    rows = built(spark, d).rows
    names = [c for c in rows.columns if c in LEAKY_COLUMNS]
    try:
        labels.assert_no_leakage(rows)
        refused = ""
    except labels.LeakageError as e:
        refused = ",".join(sorted(c for c in rows.columns if f"'{c}'" in str(e)))
    return rows.agg(*[F.count(c).alias(c) for c in names]).withColumn("refused", F.lit(refused))


@query(
    "recent_rows",
    sql(
        """SELECT service_request_id FROM (SELECT r.*, max(requested_date) OVER () AS m FROM requests r, bounds
        WHERE requested_date < boundary) WHERE requested_date >= m - INTERVAL 2 YEAR""",
        "requests", "bounds",
    ),
)
def recent_rows(spark, d):
    train, _ = labels.time_split(adapter.requests(spark, d))
    return labels.recent(train, 2).select(ID)


@query(
    "sample_rows",
    sql(
        "SELECT service_request_id FROM requests ORDER BY substr(md5('42:' || service_request_id), 1, 13) LIMIT 1000",
        "requests",
    ),
)
def sample_rows(spark, d):
    return sample_exactly(adapter.requests(spark, d), 1000, ID, 42).select(ID)


@query(
    "overdue_open",
    sql(
        f"""SELECT service_request_id, round(coalesce(t, g), 6) AS threshold_days, 1::BIGINT AS breach, true AS censored
        FROM requests LEFT JOIN bthr USING (service_name), bg, bounds
        WHERE closed_date IS NULL AND requested_date >= cutoff
        AND epoch_us(taken) - epoch_us(requested_date) > coalesce(t, g) * {DAY}""",
        "requests", "bthr", "bg", "bounds",
    ),
)
def overdue_open(spark, d):
    rows = adapter.requests(spark, d)
    out = labels.overdue_open(rows, adapter.base_thresholds(spark, d), asof_of(spark, d))
    return out.select(ID, six("threshold_days"), F.col("breach").cast("long").alias("breach"), "censored")


@query(
    "scoring_rows",
    sql(
        f"""SELECT service_request_id, round(threshold_days, 6) AS threshold_days, {DUE}, category_seen
        FROM open_at WHERE run = '2000-01-01'""",
        "open_at",
    ),
)
def scoring_rows(spark, d):
    asof = adapter.run_micros(spark, "2000-01-01")
    rows = adapter.known_at(adapter.requests(spark, d), asof)
    out = scoring.scoring_rows(rows, adapter.base_thresholds(spark, d), asof)
    return out.select(ID, six("threshold_days"), stamp_text("deadline"), "category_seen")


@query(
    "snapshot_time",
    sql("SELECT strftime(taken, '%Y-%m-%d %H:%M:%S') AS taken_at FROM bounds", "bounds"),
)
def snapshot_time(spark, d):
    return spark.range(1).select(
        F.date_format(dates.at(asof_of(spark, d)), "yyyy-MM-dd HH:mm:ss").alias("taken_at")
    )


@query(
    "context_frame",
    sql(
        """SELECT service_request_id FROM requests, (SELECT min(requested_date) AS m FROM open_at WHERE run = '2000-01-01')
        WHERE requested_date >= m - INTERVAL 31 DAY""",
        "requests", "open_at",
    ),
)
def context_frame(spark, d):
    asof = adapter.run_micros(spark, "2000-01-01")
    rows = adapter.requests(spark, d)
    scored = scoring.scoring_rows(adapter.known_at(rows, asof), adapter.base_thresholds(spark, d), asof)
    return scoring.context_frame(rows, scored).select(ID)


@query(
    "intake_rows",
    sql(
        f"""SELECT service_request_id, {REQ} FROM requests, bounds
        WHERE requested_date > taken - INTERVAL 30 DAY AND requested_date <= taken""",
        "requests", "bounds",
    ),
)
def intake_rows(spark, d):
    out = drift.intake_rows(adapter.requests(spark, d), asof_of(spark, d))
    return out.select(ID, stamp_text("requested_date"))


@query(
    "department",
    sql(
        """SELECT CASE WHEN p IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN p ELSE 'Other' END AS department, count(*) AS n
        FROM (SELECT trim(split_part(service_name, ' - ', 1)) AS p FROM requests) GROUP BY 1""",
        "requests",
    ),
)
def department_counts(spark, d):
    return (
        adapter.requests(spark, d)
        .groupBy(department("service_name", DEPARTMENTS).alias("department"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "filter_min_n",
    sql(
        """SELECT comm_code, round(avg(days), 6) AS value, count(*) AS n FROM aged WHERE closed_date IS NOT NULL
        AND service_name = '1-URGENT - BUILDING' GROUP BY 1 HAVING count(*) >= 15""",
        "aged",
    ),
)
def filter_min_n(spark, d):
    out = maps.filter_min_n(explore.community_days(adapter.requests(spark, d), CATEGORY), 15)
    return out.select("comm_code", six("value"), "n")


@query(
    "deadline_cohort",
    sql(f"SELECT service_request_id, scored_asof, {DUE}, outcome FROM outcomes WHERE deadline < outcome_snapshot", "outcomes"),
)
def deadline_cohort(spark, d):
    out = grading.deadline_passed(adapter.outcomes(spark, d))
    return out.select(ID, "scored_asof", stamp_text("deadline"), "outcome")


@query(
    "align_schema",
    sql(
        """WITH f AS (SELECT requests.*, requested_date < boundary AND service_name <> '5-LOW - MACHINERY'
          AND comm_name <> 'NATION_3' AS base FROM requests, bounds)
        SELECT comm, svc, count(*) AS n FROM (SELECT
        CASE WHEN service_name IN (SELECT service_name FROM f WHERE base) THEN service_name END AS svc,
        CASE WHEN comm_name IN (SELECT comm_name FROM f WHERE base) THEN comm_name END AS comm
        FROM f) GROUP BY 1, 2""".replace("WITH f AS (", "SELECT * FROM (WITH f AS (") + ")",
        "requests", "bounds",
    ),
)
def align_schema(spark, d):
    rows = adapter.requests(spark, d)
    train, _ = labels.time_split(rows)
    base = train.where((F.col("service_name") != adapter.UNSEEN) & (F.col("comm_name") != "NATION_3"))
    cats = ("service_name", "comm_name")
    levels = features.category_levels(base, cats)
    out = features.align_to_schema(rows, cats, levels, cats)
    return out.groupBy(F.col("comm_name").alias("comm"), F.col("service_name").alias("svc")).agg(
        F.count(F.lit(1)).alias("n")
    )


# --- joins ----------------------------------------------------------------------------


@query("attach_sector", sql("SELECT service_request_id, sector FROM placed", "placed"))
def attach_sector_query(spark, d):
    return attach_sector(adapter.requests(spark, d), adapter.communities(spark, d)).select(ID, "sector")


@query("attach_groups", sql("SELECT service_request_id, sector, srg FROM placed", "placed"))
def attach_groups_query(spark, d):
    return attach_groups(adapter.requests(spark, d), adapter.communities(spark, d)).select(ID, "sector", "srg")


@query(
    "threshold_join",
    sql(
        "SELECT service_request_id, round(coalesce(t, g), 6) AS threshold_days FROM requests LEFT JOIN bthr USING (service_name), bg",
        "requests", "bthr", "bg",
    ),
)
def threshold_join(spark, d):
    out = with_threshold(adapter.requests(spark, d), adapter.base_thresholds(spark, d))
    return out.select(ID, six("threshold_days"))


@query(
    "shadow_outcomes",
    sql(
        f"""SELECT usage, scored_asof, service_request_id, sector, srg, round(score, 6) AS score,
        rank_in_sector::BIGINT AS rank_in_sector, flagged, {DUE}, {CLO}, outcome FROM outcomes""",
        "outcomes",
    ),
)
def shadow_outcomes(spark, d):
    out = grading.shadow_outcomes(adapter.scores(spark, d), adapter.requests(spark, d))
    return out.select(
        "usage", "scored_asof", ID, "sector", "srg", six("score"), "rank_in_sector", "flagged",
        stamp_text("deadline"), stamp_text("closed_date"), "outcome",
    )


P75 = """SELECT service_name, quantile_cont(date_diff('day', requested_date, closed_date)::DOUBLE, 0.75::DOUBLE) AS p75
        FROM requests WHERE closed_date IS NOT NULL GROUP BY 1"""


@query(
    "breach_by_community",
    sql(
        f"""SELECT comm_code, round(avg(CASE WHEN date_diff('day', requested_date, closed_date) > p75
        THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS value, count(*) AS n
        FROM requests JOIN ({P75}) USING (service_name) WHERE closed_date IS NOT NULL GROUP BY 1""",
        "requests",
    ),
)
def breach_by_community(spark, d):
    out = explore.breach_by_community(adapter.requests(spark, d))
    return out.select("comm_code", six("value"), "n")


@query(
    "asof_range_agg",
    """SELECT event_id, n_1::BIGINT AS n_1, round(s_1, 4) AS s_1, n_7::BIGINT AS n_7, round(s_7, 4) AS s_7 FROM (
    SELECT event_id, coalesce(count(*) OVER a, 0) AS n_1, coalesce(sum(value) OVER a, 0) AS s_1,
    coalesce(count(*) OVER b, 0) AS n_7, coalesce(sum(value) OVER b, 0) AS s_7 FROM events WINDOW
    a AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING),
    b AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING))""",
)
def asof_range_agg(spark, d):
    events = adapter.table(spark, d, "events").select(
        "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "value"
    )
    out = range_agg(
        events, events, keys=["event_type"], row_time="ts", event_time="ts", value="value",
        spans=[Span("a", 1), Span("b", 7)],
    )
    return out.select(
        "event_id",
        F.col("a_n").alias("n_1"),
        F.abs(F.round("a_sum", 4)).alias("s_1"),
        F.col("b_n").alias("n_7"),
        F.abs(F.round("b_sum", 4)).alias("s_7"),
    )


@query("rows_at", sql("SELECT job_id, coalesce(rows, -1)::BIGINT AS rows FROM job_rows", "job_rows"))
def rows_at(spark, d):
    out = jobs.rows_at(adapter.jobs(spark, d), adapter.snapshots(spark, d))
    return out.select("job_id", F.coalesce("rows", F.lit(-1)).alias("rows"))


@query(
    "holiday_week",
    sql("SELECT id AS service_request_id, req_is_holiday_week FROM calendar WHERE req_is_holiday_week = 1", "calendar"),
)
def holiday_week(spark, d):
    weeks = features.holiday_weeks(adapter.holidays(spark, d))
    rows = adapter.requests(spark, d).withColumn("_week", dates.week_of("requested_date"))
    return rows.join(weeks, "_week", "left_semi").select(ID, F.lit(1).cast("long").alias("req_is_holiday_week"))


def registry(spark, d) -> DataFrame:
    """Events as a model registry: a group per event type, one version per event."""
    e = adapter.table(spark, d, "events")
    status = F.when(F.col("event_id") % 7 == 0, "Approved").when(F.col("event_id") % 7 == 1, "Rejected")
    return e.select(
        F.col("event_type").alias("model_group"),
        F.col("event_id").alias("version"),
        status.otherwise("PendingManualApproval").alias("status"),
        F.col("ts").cast("timestamp").alias("created"),
        F.when(F.col("event_id") % 5 != 0, "shadow-not-for-use").alias("usage"),
        F.col("user_id").cast("string").alias("run"),
        (F.col("value") / 500).alias("pr_auc"),
    )


@query(
    "unregistered_runs",
    """SELECT CAST(c_custkey AS VARCHAR) AS run FROM customer
    WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'signup')""",
)
def unregistered_runs(spark, d):
    runs = adapter.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("run"))
    return champion.unregistered_runs(runs, registry(spark, d).where(F.col("model_group") == "signup"))


# --- aggregates -----------------------------------------------------------------------


@query(
    "category_thresholds",
    sql(
        """SELECT service_name, round(t, 6) AS threshold_days FROM thr UNION ALL
        SELECT '__global__', round(g, 6) FROM gthr""",
        "thr", "gthr",
    ),
)
def category_thresholds(spark, d):
    marked = purge.mark_purged(adapter.requests(spark, d), adapter.GATE)
    edge = labels.holdout_boundary(adapter.requests(spark, d))
    train = labels.labelled_subset(marked).where(F.col("requested_date") < dates.at(edge))
    return labels.category_thresholds(train, ignore_purged=True).select("service_name", six("threshold_days"))


@query("category_p75_approx")
def category_p75_approx(spark, d):
    return explore.breach_by_community(adapter.requests(spark, d), approximate=True)


@query(
    "percentile_ranks",
    sql("SELECT service_name, count(days) AS n, true AS within FROM aged WHERE service_name IS NOT NULL GROUP BY 1 HAVING count(days) > 0", "aged"),
)
def percentile_ranks(spark, d):
    """The exact rank of each category's approximate percentile is where the error bound says."""
    aged = labels.add_days_to_close(adapter.requests(spark, d))
    return explore.percentile_ranks(aged, "days_to_close").select("service_name", "n", "within")


@query(
    "quantile_breaks",
    sql(
        """SELECT max(v) FILTER (rn = ceil(c * 1 / 5.0)) AS b1, max(v) FILTER (rn = ceil(c * 2 / 5.0)) AS b2,
        max(v) FILTER (rn = ceil(c * 3 / 5.0)) AS b3, max(v) FILTER (rn = ceil(c * 4 / 5.0)) AS b4
        FROM (SELECT days AS v, row_number() OVER (ORDER BY days) AS rn, count(*) OVER () AS c
        FROM aged WHERE days IS NOT NULL)""",
        "aged",
    ),
)
def quantile_breaks(spark, d):
    return maps.quantile_breaks(labels.add_days_to_close(adapter.requests(spark, d)), "days_to_close", 5)


GROUP_SQL = """count(*) AS rows, sum(breach)::BIGINT AS positives, sum(CAST(flagged AS INT))::BIGINT AS flagged,
    sum(breach * CAST(flagged AS INT))::BIGINT AS hits,
    round(sum(breach) / count(*)::DOUBLE, 6) AS base_rate,
    round(sum(CAST(flagged AS INT)) / count(*)::DOUBLE, 6) AS flag_rate,
    round(sum(breach * CAST(flagged AS INT)) / nullif(sum(breach), 0)::DOUBLE, 6) AS recall,
    round(sum(breach * CAST(flagged AS INT)) / nullif(sum(CAST(flagged AS INT)), 0)::DOUBLE
      / nullif(sum(breach) / count(*)::DOUBLE, 0), 6) AS lift"""


@query("group_metrics", sql(f'SELECT sector AS "group", {GROUP_SQL} FROM flagged GROUP BY 1', "flagged"))
def group_metrics(spark, d):
    out = fairness.group_metrics(flagged(spark, d), "sector")
    return out.select(
        "group", "rows", "positives", "flagged", "hits", *[six(c) for c in ("base_rate", "flag_rate", "recall", "lift")]
    )


RATES_SQL = """count(*) AS rows, round(avg(late), 4) AS late_rate, coalesce(sum(CAST({f} AS INT)), 0)::BIGINT AS flagged,
    round(avg(late) FILTER ({f}), 4) AS late_rate_flagged, round(avg(late) FILTER (NOT {f}), 4) AS late_rate_unflagged,
    round(avg(late) FILTER ({f}) / nullif(avg(late), 0), 4) AS lift,
    round(coalesce(sum(late) FILTER ({f}), 0) / nullif(sum(late), 0), 4) AS recall"""
LATE_OF = "(SELECT *, CASE WHEN outcome = 'late' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS late FROM {0})"


@query(
    "cohort_rates",
    sql(f"SELECT category_seen, {RATES_SQL.format(f='flagged')} FROM {LATE_OF.format('cohort')} GROUP BY 1", "cohort"),
)
def cohort_rates(spark, d):
    cohort = grading.deadline_passed(grading.first_scores(adapter.outcomes(spark, d)))
    return grading.cohort_rates(cohort, by=("category_seen",))


@query(
    "score_summary",
    sql(
        """SELECT coalesce(sector, '*') AS sector, count(*) AS scored, sum(CAST(flagged AS INT))::BIGINT AS flagged,
        round(avg(CASE WHEN category_seen THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END), 4) AS unseen_category_share,
        round(avg(score), 4) AS score_mean FROM scores WHERE run = '2000-01-01' GROUP BY ROLLUP (sector)""",
        "scores",
    ),
)
def score_summary(spark, d):
    return scoring.score_summary(adapter.scores(spark, d).where(F.col("asof") == "2000-01-01"))


@query(
    "shadow_grade",
    sql(
        """SELECT usage, flagged, count(*) AS requests, sum(CASE WHEN outcome = 'late' THEN 1 ELSE 0 END)::BIGINT AS late,
        round(avg(CASE WHEN outcome = 'late' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 3) AS late_rate
        FROM cohort GROUP BY 1, 2""",
        "cohort",
    ),
)
def shadow_grade(spark, d):
    return grading.shadow_grade(adapter.outcomes(spark, d))


@query(
    "top_types",
    sql("SELECT service_name, count(*) AS n FROM cohort GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", "cohort"),
)
def top_types(spark, d):
    return grading.top_types(grading.deadline_passed(grading.first_scores(adapter.outcomes(spark, d))))


@query(
    "deadline_medians",
    sql(
        """SELECT 'all_scored' AS part, round(quantile_cont(threshold_days, 0.5::DOUBLE), 4) AS median_days FROM first_score
        UNION ALL SELECT 'graded', round(quantile_cont(threshold_days, 0.5::DOUBLE), 4) FROM cohort""",
        "first_score", "cohort",
    ),
)
def deadline_medians(spark, d):
    return grading.deadline_medians(grading.first_scores(adapter.outcomes(spark, d)))


@query(
    "busy_vs_late",
    sql(
        """SELECT service_name, count(*) AS months, round(corr(n, late), 6) AS r FROM
        (SELECT service_name, date_trunc('month', requested_date) AS m, count(*)::DOUBLE AS n, avg(breach) AS late
        FROM labels WHERE service_name IN
          (SELECT service_name FROM labels GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 20)
        GROUP BY 1, 2 HAVING count(*) >= 5) GROUP BY 1 HAVING count(*) >= 24""",
        "labels",
    ),
)
def busy_vs_late(spark, d):
    return explore.busy_vs_late(built(spark, d).rows, min_n=5).select("service_name", "months", six("r"))


SHAPES = {"urgent": CATEGORY, "high": "2-HIGH - MACHINERY", "low": "5-LOW - FURNITURE"}


@query(
    "seasonal_share",
    sql(
        "SELECT m AS month, "
        + ", ".join(
            f"round(coalesce(sum(c) FILTER (s = '{v}'), 0) / (SELECT count(*) FROM k WHERE s = '{v}') * 100, 6) AS {n}"
            for n, v in SHAPES.items()
        )
        + """ FROM (SELECT unnest(generate_series(1, 12))::BIGINT AS m) LEFT JOIN
        (SELECT month(requested_date) AS km, s, count(*)::DOUBLE AS c FROM k GROUP BY 1, 2) ON km = m GROUP BY 1""",
        "requests",
    ).replace(
        "\nSELECT m AS month",
        """, k AS (SELECT *, service_name AS s FROM requests WHERE requested_date >= TIMESTAMP '1996-01-01'
        AND requested_date < TIMESTAMP '2001-01-01')\nSELECT m AS month""",
    ),
)
def seasonal_share(spark, d):
    out = explore.seasonal_share(adapter.requests(spark, d), SHAPES, "1996-01-01", "2001-01-01")
    return out.select("month", *[six(c) for c in SHAPES])


@query(
    "late_by_backlog_quintile",
    sql(
        """SELECT (1 + CAST(n > q[1] AS INT) + CAST(n > q[2] AS INT) + CAST(n > q[3] AS INT) + CAST(n > q[4] AS INT))::BIGINT AS fifth,
        count(*) AS n, round(avg(breach), 6) AS late_rate
        FROM judged JOIN roll_cat ON id = service_request_id JOIN
        (SELECT service_name, quantile_cont(n::DOUBLE, [0.2::DOUBLE, 0.4, 0.6, 0.8]) AS q
        FROM judged JOIN roll_cat ON id = service_request_id GROUP BY 1) USING (service_name) GROUP BY 1""",
        "judged", "roll_cat",
    ),
)
def late_by_backlog_quintile(spark, d):
    rows = features.add_backlog_features(judged(spark, d))
    return explore.late_by_backlog_quintile(rows).select("fifth", "n", six("late_rate"))


@query(
    "status_breakdown",
    sql(
        """SELECT status_description, count(*) AS n, sum(CASE WHEN closed_date IS NULL THEN 1 ELSE 0 END)::BIGINT AS open
        FROM requests WHERE requested_date >= TIMESTAMP '1996-01-01' GROUP BY 1""",
        "requests",
    ),
)
def status_breakdown(spark, d):
    return explore.status_breakdown(explore.window_rows(adapter.requests(spark, d), 5, 2001))


@query(
    "top_categories",
    sql(
        """SELECT service_name, count(*) AS n FROM requests WHERE requested_date >= TIMESTAMP '1996-01-01'
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
        "requests",
    ),
)
def top_categories(spark, d):
    return explore.top_categories(explore.window_rows(adapter.requests(spark, d), 5, 2001))


@query(
    "slowest_categories",
    sql(
        """SELECT service_name, count(*) AS n, round(avg(date_diff('day', requested_date, closed_date)), 6) AS days
        FROM requests WHERE closed_date IS NOT NULL GROUP BY 1 HAVING count(*) > 40 ORDER BY 3 DESC, 1 LIMIT 15""",
        "requests",
    ),
)
def slowest_categories(spark, d):
    return explore.slowest_categories(adapter.requests(spark, d), min_n=40).select("service_name", "n", six("days"))


@query(
    "monthly_totals",
    sql(
        f"""SELECT '*' AS service_name, month(requested_date)::BIGINT AS m, count(*) AS n FROM requests GROUP BY 2
        UNION ALL SELECT service_name, month(requested_date)::BIGINT, count(*) FROM requests
        WHERE service_name IN ('{CATEGORY}', '2-HIGH - MACHINERY') GROUP BY 1, 2""",
        "requests",
    ),
)
def monthly_totals(spark, d):
    return explore.monthly_totals(adapter.requests(spark, d), (CATEGORY, "2-HIGH - MACHINERY"))


MEANS = f"""SELECT comm_name, count(*) AS n, avg(date_diff('day', requested_date, closed_date)) AS days FROM requests
    WHERE closed_date IS NOT NULL AND service_name = '{CATEGORY}' GROUP BY 1 HAVING count(*) > 5"""


@query(
    "community_extremes",
    sql(
        f"""SELECT comm_name, n, round(days, 6) AS days, side FROM (
        SELECT *, 'slowest' AS side FROM (SELECT * FROM ({MEANS}) ORDER BY days DESC, comm_name LIMIT 6)
        UNION ALL SELECT *, 'fastest' FROM (SELECT * FROM ({MEANS}) ORDER BY days, comm_name LIMIT 6))""",
        "requests",
    ),
)
def community_extremes(spark, d):
    out = explore.community_extremes(adapter.requests(spark, d), CATEGORY, min_n=5)
    return out.select("comm_name", "n", six("days"), "side")


@query(
    "community_days",
    sql(
        f"""SELECT comm_code, round(avg(date_diff('day', requested_date, closed_date)), 6) AS value, count(*) AS n
        FROM requests WHERE closed_date IS NOT NULL AND service_name = '{CATEGORY}' GROUP BY 1""",
        "requests",
    ),
)
def community_days(spark, d):
    out = explore.community_days(adapter.requests(spark, d), CATEGORY)
    return out.select("comm_code", six("value"), "n")


USD = """round(CASE instance_type WHEN 'ml.t3.xlarge' THEN 0.22::DOUBLE WHEN 'ml.t3.medium' THEN 0.05::DOUBLE ELSE 0 END
    * {0} * (billed_seconds / 3600.0::DOUBLE) * {1}, 4)"""


@query(
    "run_cost",
    sql(
        f"""SELECT instance_type, round(sum({USD.format('1.0::DOUBLE', 1)}), 4) AS usd,
        round(sum({USD.format('0.3::DOUBLE', 2)}), 4) AS spot_usd, count(*) AS n FROM jobs GROUP BY 1""",
        "jobs",
    ),
)
def run_cost(spark, d):
    kind, secs = F.col("instance_type"), F.col("billed_seconds")
    return adapter.jobs(spark, d).groupBy("instance_type").agg(
        F.round(F.sum(cost_usd(kind, secs)), 4).alias("usd"),
        F.round(F.sum(cost_usd(kind, secs, count=2, spot=True)), 4).alias("spot_usd"),
        F.count(F.lit(1)).alias("n"),
    )


def run_steps(spark, d) -> DataFrame:
    """Events as pipeline steps: one run per user, cached every fourth."""
    e = adapter.table(spark, d, "events")
    return e.select(
        F.col("user_id").alias("run"),
        F.col("event_type").alias("step"),
        (F.col("event_id") % 4 == 0).alias("cached"),
        F.col("value").alias("billed_seconds"),
    )


@query(
    "run_report",
    """SELECT run, steps, cached_steps, usd, CASE
      WHEN run % 3 = 0 THEN 'PASSED the gate; registered pkg-' || CAST(run AS VARCHAR) || ' as PendingManualApproval'
      WHEN run % 3 = 1 THEN 'REJECTED by the gate; nothing was registered'
      ELSE 'run Stopped before the gate decided' END AS verdict FROM (
    SELECT user_id AS run, count(*) AS steps, sum(CAST(event_id % 4 = 0 AS INT))::BIGINT AS cached_steps,
    round(sum(CASE WHEN event_id % 4 = 0 THEN 0 ELSE round(0.22::DOUBLE * (round(value) / 3600.0::DOUBLE), 4) END), 4) AS usd
    FROM events GROUP BY 1)""",
)
def run_report(spark, d):
    per_run = jobs.run_report(run_steps(spark, d)).groupBy("run").agg(
        F.count(F.lit(1)).alias("steps"),
        F.sum(F.col("cached").cast("long")).alias("cached_steps"),
        F.round(F.sum("usd"), 4).alias("usd"),
    )
    third = F.col("run") % 3
    runs = per_run.withColumns(
        {
            "status": F.when(third == 2, "Stopped").otherwise("Succeeded"),
            "gate_outcome": F.when(third == 0, "True").when(third == 1, "False"),
            "package": F.concat(F.lit("pkg-"), F.col("run").cast("string")),
        }
    )
    return jobs.verdict(runs).select("run", "steps", "cached_steps", "usd", "verdict")


# --- windows --------------------------------------------------------------------------


@query(
    "backlog_30d",
    sql(
        """SELECT c.id AS service_request_id, c.n AS cat_open_30d, m.n AS comm_req_30d
        FROM roll_cat c JOIN roll_comm m USING (id)""",
        "roll_cat", "roll_comm",
    ),
)
def backlog_30d(spark, d):
    out = features.add_backlog_features(adapter.requests(spark, d))
    return out.select(ID, *[F.col(c).cast("long").alias(c) for c in ("cat_open_30d", "comm_req_30d")])


def history(spark, d):
    return features.build_history(
        adapter.requests(spark, d), adapter.base_thresholds(spark, d), adapter.communities(spark, d)
    )


@query(
    "late_rate_90d",
    sql("SELECT id AS service_request_id, round(sector_late_90d, 6) AS sector_late_90d FROM sector_late_90d", "sector_late_90d"),
)
def late_rate_90d(spark, d):
    rows = attach_sector(adapter.requests(spark, d), adapter.communities(spark, d))
    out = features.add_late_rates(rows, history(spark, d), [LateRate("sector_late_90d", ("sector",), 90, 20)])
    return out.select(ID, six("sector_late_90d"))


@query(
    "backlog_ratio",
    sql(
        """SELECT y.id AS service_request_id, round(CASE WHEN y.n >= 30 THEN m.n / greatest(y.n * 30 / 365.0::DOUBLE, 1e-9) END, 6)
        AS cat_backlog_ratio FROM roll_year y JOIN roll_cat m USING (id)""",
        "roll_year", "roll_cat",
    ),
)
def backlog_ratio(spark, d):
    return features.add_backlog_ratio(adapter.requests(spark, d), history(spark, d)).select(ID, six("cat_backlog_ratio"))


@query("quota_flag", sql("SELECT service_request_id, flagged FROM flagged", "flagged"))
def quota_flag(spark, d):
    return flagged(spark, d).select(ID, "flagged")


@query(
    "rank_in_sector",
    sql(
        """SELECT service_request_id, sector, row_number() OVER (PARTITION BY sector
        ORDER BY round(pred, 2) DESC, md5(service_request_id), service_request_id) AS rank_in_sector FROM judged""",
        "judged",
    ),
)
def rank_in_sector(spark, d):
    rows = judged(spark, d).withColumn("pred", F.round("pred", 2))
    return rank_rows(rows, ["sector"], "pred", ID, name="rank_in_sector").select(ID, "sector", "rank_in_sector")


@query(
    "reflag",
    sql(
        """SELECT scored_asof, service_request_id, score >= quantile_cont(score, 0.8::DOUBLE)
        OVER (PARTITION BY scored_asof, sector, srg) AS again FROM outcomes""",
        "outcomes",
    ),
)
def reflag(spark, d):
    out = grading.reflag(adapter.outcomes(spark, d), ("sector", "srg"), "again", top_fraction=0.2)
    return out.select("scored_asof", ID, "again")


@query(
    "first_scores",
    sql("SELECT service_request_id, scored_asof, round(score, 6) AS score, outcome FROM first_score", "first_score"),
)
def first_scores(spark, d):
    return grading.first_scores(adapter.outcomes(spark, d)).select(ID, "scored_asof", six("score"), "outcome")


@query(
    "closed_groups",
    sql(
        """SELECT service_name, comm_name, strftime(closed_date, '%Y-%m-%d') AS closed_day, days, group_rows FROM
        (SELECT *, count(*) OVER (PARTITION BY service_name, comm_name) AS group_rows FROM aged WHERE days >= 0)
        WHERE group_rows >= 8""",
        "aged",
    ),
)
def closed_groups(spark, d):
    out = quality.closed_groups(adapter.requests(spark, d), adapter.GATE)
    return out.select(
        "service_name", "comm_name", F.date_format("closed_day", "yyyy-MM-dd").alias("closed_day"), "days", "group_rows"
    )


def monthly_series(spark, d) -> DataFrame:
    """Requests and mean days per month and source, a table of series."""
    aged = labels.add_days_to_close(adapter.requests(spark, d))
    return aged.groupBy(F.col("source").alias("series"), dates.month_of("requested_date").alias("month")).agg(
        F.avg("days_to_close").alias("value")
    )


MONTHS = """m AS (SELECT source AS series, date_trunc('month', requested_date)::DATE AS month, avg(days) AS value
    FROM aged GROUP BY 1, 2), r AS (SELECT *, value - avg(value) OVER (PARTITION BY series, month(month)
    ORDER BY year(month) RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS residual FROM m)"""


def month_sql(body: str) -> str:
    head = sql("SELECT 1", "aged").rsplit("\nSELECT 1", 1)[0]
    return f"{head},\n{MONTHS}\n{body}"


@query(
    "seasonal_residuals",
    month_sql("SELECT series, strftime(month, '%Y-%m-%d') AS month, round(residual, 6) AS residual FROM r"),
)
def seasonal_residuals(spark, d):
    out = detect.seasonal_residuals(monthly_series(spark, d), ["series"])
    return out.select("series", F.date_format("month", "yyyy-MM-dd").alias("month"), six("residual"))


EWMA = """, p AS (SELECT series, month, residual AS x, row_number() OVER (PARTITION BY series ORDER BY month) AS i
    FROM r WHERE residual IS NOT NULL),
    c AS (SELECT series, avg(x) FILTER (i <= 10) AS mu, stddev_samp(x) FILTER (i <= 10) AS sg FROM p
      GROUP BY 1 HAVING count(*) >= 10 AND stddev_samp(x) FILTER (i <= 10) > 0),
    z AS (SELECT p.series, p.month, p.i, any_value(mu) AS mu, any_value(sg) AS sg,
      any_value(mu) * pow(0.7, p.i) + sum(0.3 * pow(0.7, p.i - q.i) * q.x) AS z
      FROM p JOIN p q ON q.series = p.series AND q.i <= p.i JOIN c ON c.series = p.series GROUP BY 1, 2, 3),
    e AS (SELECT r.series, r.month, coalesce(abs(z - mu) > 1.5 * sg * sqrt(0.3 / 1.7 * (1 - pow(0.7, 2 * i))), false)
      AS ewma_flag FROM r LEFT JOIN z USING (series, month))"""


def ewma_series(spark, d) -> DataFrame:
    resid = detect.seasonal_residuals(monthly_series(spark, d), ["series"])
    return detect.ewma_flags(resid, ["series"], settings=ControlSettings(limit=1.5))


@query(
    "ewma_flags",
    month_sql("SELECT series, strftime(month, '%Y-%m-%d') AS month, ewma_flag FROM e").replace(
        "\nSELECT series, strftime(month, '%Y-%m-%d') AS month, ewma_flag", EWMA + "\nSELECT series, strftime(month, '%Y-%m-%d') AS month, ewma_flag"
    ),
)
def ewma_flags(spark, d):
    return ewma_series(spark, d).select("series", F.date_format("month", "yyyy-MM-dd").alias("month"), "ewma_flag")


@query(
    "sustained_runs",
    month_sql(
        EWMA
        + """
    SELECT series, strftime(month, '%Y-%m-%d') AS month, ewma_flag AND count(*) OVER (PARTITION BY series, b) >= 3 AS sustained
    FROM (SELECT *, sum(t) OVER (PARTITION BY series ORDER BY month) AS b FROM (SELECT *,
      CAST(ewma_flag IS DISTINCT FROM lag(ewma_flag) OVER (PARTITION BY series ORDER BY month) AS INT) AS t FROM e))"""
    ).replace("\n, p AS", ", p AS"),
)
def sustained_runs(spark, d):
    out = detect.sustained(ewma_series(spark, d), ["series"], "ewma_flag")
    return out.select("series", F.date_format("month", "yyyy-MM-dd").alias("month"), "sustained")


@query(
    "ratio_flags",
    """SELECT event_id, coalesce(c >= 3 AND value > 2.0::DOUBLE * (CASE WHEN c % 2 = 1
      THEN CASE WHEN rn <= h THEN (a1 + a2) / 2 WHEN rn = h + 1 THEN (a0 + a2) / 2 ELSE (a0 + a1) / 2 END
      ELSE CASE WHEN rn <= h THEN a1 ELSE a0 END END), false) AS flag FROM
    (SELECT *, max(value) FILTER (rn = h) OVER (PARTITION BY event_type) AS a0,
      max(value) FILTER (rn = h + 1) OVER (PARTITION BY event_type) AS a1,
      max(value) FILTER (rn = h + 2) OVER (PARTITION BY event_type) AS a2 FROM
    (SELECT *, c // 2 AS h FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) AS rn,
      count(*) OVER (PARTITION BY event_type) AS c FROM events)))""",
)
def ratio_flags(spark, d):
    events = adapter.table(spark, d, "events").select("event_id", "event_type", "value")
    return detect.ratio_flags(events, "event_type", "value").select("event_id", "flag")


def card(spark, d) -> DataFrame:
    return scorecard.scorecard(
        adapter.requests(spark, d), adapter.communities(spark, d), settings=CARD, gate=adapter.GATE
    )


CARD_OUT = "strftime(month, '%Y-%m-%d') AS month, series, key, round(value, 6) AS value, n::BIGINT AS n"


def card_out(df, *more):
    return df.select(
        F.date_format("month", "yyyy-MM-dd").alias("month"), "series", "key", six("value"),
        F.col("n").cast("long").alias("n"), *more,
    )


@query(
    "scorecard_latest",
    sql(
        f"""SELECT {CARD_OUT} FROM (SELECT *, row_number() OVER (PARTITION BY series, key ORDER BY month DESC) AS rn
        FROM card WHERE NOT provisional) WHERE rn = 1""",
        "card",
    ),
)
def scorecard_latest(spark, d):
    return card_out(scorecard.latest(card(spark, d)))


@query(
    "stored_scorecard",
    sql("SELECT strftime(month, '%Y-%m-%d') AS month, series, nullif(key, '') AS key, round(value, 6) AS value, n::BIGINT AS n FROM card", "card"),
)
def stored_scorecard(spark, d):
    """The scorecard as the CSV file it is published in, read back."""
    path = new_path(adapter.prepare(spark), "scorecard")
    tables.write_csv(card(spark, d), path)
    shape = "month date, series string, key string, value double, n long, provisional boolean"
    return card_out(spark.read.schema(shape).option("header", True).csv(path))


@query(
    "stored_summary",
    sql(
        """SELECT coalesce(sector, '*') AS sector, count(*) AS scored, sum(CAST(flagged AS INT))::BIGINT AS flagged
        FROM scores WHERE run = '2000-01-01' GROUP BY ROLLUP (sector)""",
        "scores",
    ),
)
def stored_summary(spark, d):
    """The score summary as the file beside the scores, read back."""
    path = new_path(adapter.prepare(spark), "summary")
    tables.write_summary(scoring.score_summary(adapter.scores(spark, d).where(F.col("asof") == "2000-01-01")), path)
    return spark.read.schema("sector string, scored long, flagged long").json(path)


@query(
    "risk_deciles",
    sql(
        """SELECT greatest(ceil((rn - 1) * 10 / (c - 1)::DOUBLE), 1)::BIGINT AS decile, count(*) AS n,
        round(avg(breach), 6) AS late_rate FROM (SELECT *, row_number() OVER
        (ORDER BY pred, md5(service_request_id), service_request_id) AS rn, count(*) OVER () AS c FROM judged) GROUP BY 1""",
        "judged",
    ),
)
def risk_deciles(spark, d):
    ranked = rank_rows(judged(spark, d), [], "pred", ID, descending=False)
    return metrics.risk_deciles(ranked).select("decile", "n", six("late_rate"))


@query(
    "explore_backlog",
    sql("SELECT id AS service_request_id, n - 1 AS cat_30d FROM roll_right", "roll_right"),
)
def explore_backlog(spark, d):
    return features.explore_backlog(adapter.requests(spark, d)).select(ID, "cat_30d")


@query(
    "slowest5_share",
    sql(f"SELECT {CARD_OUT}, round(pending, 6) AS pending FROM slow JOIN slow_pending USING (month)", "slow", "slow_pending"),
)
def slowest5_share(spark, d):
    rows = adapter.requests(spark, d)
    return card_out(scorecard.slowest_share(rows, asof_of(spark, d), gate=adapter.GATE), six("pending"))


@query(
    "top_flagged",
    sql(
        """SELECT usage, service_name, comm_name, sector, round(score, 6) AS score, rank_in_sector::BIGINT AS rank_in_sector
        FROM scores WHERE run = '2000-01-01' AND flagged ORDER BY score DESC, service_request_id LIMIT 20""",
        "scores",
    ),
)
def top_flagged(spark, d):
    out = scoring.top_flagged(adapter.scores(spark, d), "2000-01-01")
    return out.withColumn("score", F.round("score", 6))


@query("scorecard", sql(f"SELECT {CARD_OUT}, provisional FROM card", "card"))
def scorecard_query(spark, d):
    return card_out(card(spark, d), "provisional").orderBy("series", "key", "month")


# --- sets and scalars -----------------------------------------------------------------


@query(
    "training_labels",
    sql(
        f"""SELECT service_request_id, {REQ}, split, purge_closed, censored, breach::BIGINT AS breach,
        round(threshold_days, 6) AS threshold_days FROM labels""",
        "labels",
    ),
)
def training_labels(spark, d):
    return built(spark, d).rows.select(
        ID, stamp_text("requested_date"), "split", "purge_closed", "censored",
        F.col("breach").cast("long").alias("breach"), six("threshold_days"),
    )


@query(
    "schema_check",
    sql(
        """SELECT 'schema' AS name, 'fail' AS severity, true AS passed, 'all required columns present' AS detail,
        '{"missing":"","rows":' || count(*)::VARCHAR || '}' AS observed FROM requests
        UNION ALL SELECT 'schema', 'fail', false, 'missing columns: [''comm_name'']',
        '{"missing":"comm_name","rows":' || count(*)::VARCHAR || '}' FROM requests""",
        "requests",
    ),
)
def schema_check(spark, d):
    rows = adapter.requests(spark, d)
    return quality.check_schema(rows).unionByName(quality.check_schema(rows.drop("comm_name")))


@query("distinct_rows", sql("SELECT service_name, comm_name, source FROM requests GROUP BY ALL", "requests"))
def distinct_rows(spark, d):
    pages = adapter.requests(spark, d).select("service_name", "comm_name", "source")
    return explore.distinct_rows(pages.unionByName(pages))


@query(
    "job_kind",
    """SELECT event_id AS job_id, CASE WHEN event_id % 5 = 0 THEN 'pipeline-' || event_type
    WHEN event_id % 5 = 1 THEN 'pipeline' WHEN event_id % 5 = 2 THEN NULL ELSE event_type END AS kind FROM events""",
)
def job_kinds(spark, d):
    fifth = F.col("event_id") % 5
    name = (
        F.when(fifth == 0, F.concat(F.lit("pipelines-x1-"), F.initcap("event_type"), F.lit("-Ab9")))
        .when(fifth == 1, "pipelines-x1")
        .when(fifth == 2, F.concat(F.lit("other-"), "event_type"))
        .otherwise(
            F.concat(F.lit("civic-"), "event_type", F.lit("-"), F.date_format("ts", "yyyyMMdd-HHmmss"))
        )
    )
    events = adapter.table(spark, d, "events").withColumn("name", name)
    return events.select(F.col("event_id").alias("job_id"), job_kind("name", "civic").alias("kind"))


BREAKS = (50, 200, 400, 800)


@query(
    "classify",
    sql(
        "SELECT service_request_id, "
        + " + ".join(f"CAST(days > {b} AS BIGINT)" for b in BREAKS)
        + " AS class FROM aged WHERE days IS NOT NULL",
        "aged",
    ),
)
def classify(spark, d):
    aged = labels.add_days_to_close(adapter.requests(spark, d)).where(F.col("days_to_close").isNotNull())
    return aged.select(ID, band("days_to_close", BREAKS).alias("class"))


@query(
    "ratio_class",
    """SELECT event_id, CAST(r > 0.85::DOUBLE AS BIGINT) + CAST(r > 0.95::DOUBLE AS BIGINT) + CAST(r > 1.05::DOUBLE AS BIGINT)
    + CAST(r > 1.15::DOUBLE AS BIGINT) AS class FROM (SELECT event_id, value / 50.0::DOUBLE AS r FROM events)""",
)
def ratio_class(spark, d):
    events = adapter.table(spark, d, "events")
    return events.select("event_id", ratio_band(F.col("value") / 50.0).alias("class"))


@query(
    "report_path",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k, value AS pr_auc FROM events",
)
def report_path(spark, d):
    report = F.concat(
        F.lit('{"metrics": {"pr_auc": {"value": '), F.col("value").cast("string"), F.lit("}}}")
    )
    events = adapter.table(spark, d, "events").withColumn("report", report)
    return events.select(
        "event_id", report_value("props", "k").alias("k"), report_value("report", "metrics.pr_auc.value").alias("pr_auc")
    )


@query(
    "exterior_rings",
    sql(
        """SELECT service_request_id, CASE WHEN k % 5 = 0 THEN 0 WHEN k % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS rings,
        CASE WHEN k % 5 = 0 THEN 0 WHEN k % 3 = 0 THEN 8 ELSE 4 END::BIGINT AS points
        FROM (SELECT *, CAST(service_request_id AS BIGINT) AS k FROM requests)""",
        "requests",
    ),
)
def exterior_rings(spark, d):
    """A square (every third one inside a multipolygon, every fifth a point) around each request."""
    key = F.col(ID).cast("long")
    x, y = F.col("longitude").cast("string"), F.col("latitude").cast("string")
    ring = F.concat(
        F.lit("[["), x, F.lit(","), y, F.lit("],["), x, F.lit(","), (F.col("latitude") + 1).cast("string"), F.lit("],["),
        (F.col("longitude") + 1).cast("string"), F.lit(","), y, F.lit("],["), x, F.lit(","), y, F.lit("]]"),
    )
    geometry = (
        F.when(key % 5 == 0, F.concat(F.lit('{"type":"Point","coordinates":['), x, F.lit(","), y, F.lit("]}")))
        .when(key % 3 == 0, F.concat(F.lit('{"type":"MultiPolygon","coordinates":[['), ring, F.lit("],["), ring, F.lit("]]}")))
        .otherwise(F.concat(F.lit('{"type":"Polygon","coordinates":['), ring, F.lit(","), ring, F.lit("]}")))
    )
    out = maps.exterior_rings(adapter.requests(spark, d).withColumn("geometry", geometry))
    return out.select(
        ID, F.size("rings").cast("long").alias("rings"),
        F.aggregate("rings", F.lit(0), lambda a, r: a + F.size(r)).cast("long").alias("points"),
    )


# --- labels and features --------------------------------------------------------------


@query(
    "apply_labels",
    sql(
        """SELECT service_request_id, days AS days_to_close, round(coalesce(t, g), 6) AS threshold_days,
        coalesce(CAST(days > coalesce(t, g) AS BIGINT), 0) AS breach FROM aged LEFT JOIN bthr USING (service_name), bg""",
        "aged", "bthr", "bg",
    ),
)
def apply_labels(spark, d):
    out = labels.apply_labels(adapter.requests(spark, d), adapter.base_thresholds(spark, d))
    return out.select(ID, "days_to_close", six("threshold_days"), F.col("breach").cast("long").alias("breach"))


CAL = ("req_month", "req_dow", "req_is_weekend", "req_is_holiday_week")


@query("calendar_features", sql(f"SELECT id AS service_request_id, {', '.join(CAL)} FROM calendar", "calendar"))
def calendar_features(spark, d):
    out = features.add_calendar_features(adapter.requests(spark, d), adapter.holidays(spark, d))
    return out.select(ID, *[F.col(c).cast("long").alias(c) for c in CAL])


@query(
    "history_outcomes",
    sql(f"SELECT service_name, comm_name, sector, {DUE}, late::BIGINT AS late FROM history", "history"),
)
def history_outcomes(spark, d):
    out = history(spark, d).outcomes
    return out.select(
        "service_name", "comm_name", "sector", stamp_text("deadline"), F.col("late").cast("long").alias("late")
    )


HIST = features.HISTORY_COLUMNS


@query(
    "history_features",
    sql(f"SELECT service_request_id, {', '.join(f'round({c}, 6) AS {c}' for c in HIST)} FROM matrix", "matrix"),
)
def history_features(spark, d):
    out = features.add_history_features(
        adapter.requests(spark, d), history(spark, d), adapter.communities(spark, d)
    )
    return out.select(ID, *[six(c) for c in HIST])


def matrix_out(df):
    return df.select(
        ID, *CATEGORICAL, *[F.col(c).cast("long").alias(c) for c in (*CAL, "cat_open_30d", "comm_req_30d")],
        *[six(c) for c in HIST],
    )


MATRIX = f"""service_request_id, {', '.join(CATEGORICAL)}, {', '.join(CAL)}, cat_open_30d, comm_req_30d,
    {', '.join(f'round({c}, 6) AS {c}' for c in HIST)}"""


@query("feature_matrix", sql(f"SELECT {MATRIX} FROM matrix", "matrix"))
def feature_matrix(spark, d):
    rows = adapter.requests(spark, d)
    out = features.featurize(
        rows, rows, adapter.base_thresholds(spark, d), adapter.communities(spark, d), adapter.holidays(spark, d)
    )
    return matrix_out(out)


# --- data-quality gate ----------------------------------------------------------------


@query(
    "check_row_count",
    sql(
        """SELECT 'row_count' AS name, 'fail' AS severity, n >= 100 AND abs((n - 1000) / 1000.0::DOUBLE) <= 0.25 AS passed, n
        FROM (SELECT count(*) AS n FROM requests)""",
        "requests",
    ),
)
def check_row_count(spark, d):
    rows = adapter.requests(spark, d)
    out = quality.check_row_count(rows, adapter.GATE, baseline_rows=1000)
    return out.select("name", "severity", "passed", F.get_json_object("observed", "$.rows").cast("long").alias("n"))


@query(
    "check_unique_ids",
    """SELECT false AS passed, (count(*) - count(DISTINCT l_orderkey))::BIGINT AS duplicates,
    round((count(*) - count(DISTINCT l_orderkey)) / count(*)::DOUBLE, 6) AS rate FROM lineitem""",
)
def check_unique_ids(spark, d):
    lines = adapter.table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias(ID))
    out = quality.check_unique_ids(lines, adapter.GATE)
    return out.select(
        "passed",
        F.get_json_object("observed", "$.duplicates").cast("long").alias("duplicates"),
        F.round(F.get_json_object("observed", "$.rate").cast("double"), 6).alias("rate"),
    )


@query(
    "check_null_rates",
    sql(
        """SELECT r <= 0.1::DOUBLE AND c <= 0.001::DOUBLE AS passed, round(r, 6) AS comm_name, round(c, 6) AS service_name FROM
        (SELECT count(*) FILTER (CAST(service_request_id AS BIGINT) % 9 = 0) / count(*)::DOUBLE AS r,
        count(*) FILTER (service_name IS NULL) / count(*)::DOUBLE AS c FROM requests)""",
        "requests",
    ),
)
def check_null_rates(spark, d):
    holes = F.when(F.col(ID).cast("long") % 9 != 0, F.col("comm_name"))
    out = quality.check_null_rates(adapter.requests(spark, d).withColumn("comm_name", holes), adapter.GATE)
    return out.select(
        "passed",
        F.round(F.get_json_object("observed", "$.comm_name").cast("double"), 6).alias("comm_name"),
        F.round(F.get_json_object("observed", "$.service_name").cast("double"), 6).alias("service_name"),
    )


@query(
    "check_dates",
    sql(
        """SELECT false AS passed, round((sum(CAST(k % 97 = 0 AS INT)) + sum(CAST(k % 89 = 0 AS INT))) / count(*)::DOUBLE, 6) AS unparseable_rate,
        round(sum(CASE WHEN k % 97 <> 0 AND k % 89 <> 0 AND closed_date < requested_date + CASE WHEN k % 4 = 2
          THEN INTERVAL 123 MILLISECOND ELSE INTERVAL 0 DAY END THEN 1 ELSE 0 END) / count(*)::DOUBLE, 6) AS negative_duration_rate,
        sum(CASE WHEN k % 97 <> 0 AND requested_date + CASE WHEN k % 4 = 2 THEN INTERVAL 123 MILLISECOND
          ELSE INTERVAL 0 DAY END > TIMESTAMP '2001-01-02' THEN 1 ELSE 0 END)::BIGINT AS future_rows
        FROM (SELECT *, CAST(service_request_id AS BIGINT) AS k FROM requests)""",
        "requests",
    ),
)
def check_dates(spark, d):
    asof = adapter.run_micros(adapter.prepare(spark), "2001-01-01")
    out = quality.check_dates(dirty_text(spark, d), asof, adapter.GATE)

    def seen(c):
        return F.round(F.get_json_object("observed", f"$.{c}").cast("double"), 6).alias(c)

    return out.select(
        "passed", seen("unparseable_rate"), seen("negative_duration_rate"),
        seen("future_rows").cast("long").alias("future_rows"),
    )


BULK = """SELECT service_name, comm_name, rows, strftime(day, '%Y-%m-%d') AS closed_day, n AS closed_that_day,
        round(n / rows::DOUBLE, 3) AS share, round(mean, 1) AS mean_days_to_close FROM (
          SELECT *, row_number() OVER (PARTITION BY service_name, comm_name ORDER BY n DESC, day) AS rn FROM (
            SELECT service_name, comm_name, closed_date::DATE AS day, count(*) AS n,
            CAST(sum(count(*)) OVER g AS BIGINT) AS rows, sum(sum(days)) OVER g / sum(count(*)) OVER g AS mean
            FROM aged WHERE days >= 0 AND service_name IS NOT NULL AND comm_name IS NOT NULL GROUP BY 1, 2, 3
            WINDOW g AS (PARTITION BY service_name, comm_name)))
        WHERE rn = 1 AND rows >= 8 AND n / rows::DOUBLE >= 0.1::DOUBLE AND n >= 2"""
STALE = """SELECT service_name, strftime(s.day, '%Y-%m-%d') AS closed_day, count(*) AS tickets,
        count(DISTINCT comm_name) AS communities, round(quantile_cont(days, 0.5::DOUBLE), 1) AS median_age_days
        FROM stale s JOIN pdays p USING (service_name, day) GROUP BY 1, s.day"""
OUTLIERS = """SELECT service_name, comm_name, n AS tickets, round(mean, 1) AS mean_days_to_close, round(med, 1) AS category_median_days FROM
        (SELECT *, quantile_cont(mean, 0.5::DOUBLE) OVER (PARTITION BY service_name) AS med FROM
          (SELECT service_name, comm_name, avg(days) AS mean, count(*) AS n FROM aged WHERE days >= 0 AND service_name IS NOT NULL
           AND comm_name IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 8))
        WHERE mean >= 1.2::DOUBLE * med AND mean - med >= 5"""
FOUND = f"""SELECT 'bulk_close' AS name, service_name, comm_name, closed_day, closed_that_day AS tickets FROM ({BULK})
        UNION ALL SELECT 'stale_bulk_close', service_name, NULL, closed_day, tickets FROM ({STALE})
        UNION ALL SELECT 'group_outliers', service_name, comm_name, NULL, tickets FROM ({OUTLIERS})"""
NULL_SHARE = "avg(CASE WHEN {0} IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"
CHECKS = f"""SELECT 'schema' AS name, 'fail' AS severity, true AS passed, count(*)::BIGINT AS seen FROM requests
        UNION ALL SELECT 'row_count', 'fail', count(*) >= 100, count(*) FROM requests
        UNION ALL SELECT 'unique_ids', 'fail', count(*) = count(DISTINCT service_request_id), count(*) - count(DISTINCT service_request_id) FROM requests
        UNION ALL SELECT 'null_rates', 'fail', {NULL_SHARE.format('requested_date')} <= 0 AND {NULL_SHARE.format('service_name')} <= 0.001::DOUBLE
          AND {NULL_SHARE.format('agency_responsible')} <= 0.01::DOUBLE AND {NULL_SHARE.format('source')} <= 0.01::DOUBLE
          AND {NULL_SHARE.format('comm_name')} <= 0.1::DOUBLE, NULL FROM requests
        UNION ALL SELECT 'dates', 'fail', {NULL_SHARE.format('requested_date')} < 2 AND
          sum(CASE WHEN closed_date < requested_date THEN 1 ELSE 0 END) / count(*)::DOUBLE <= 0.005::DOUBLE, NULL FROM requests
        UNION ALL SELECT k, 'warn', count(name) = 0, coalesce(sum(tickets), 0)::BIGINT FROM
          (VALUES ('bulk_close'), ('stale_bulk_close'), ('group_outliers')) v(k) LEFT JOIN ({FOUND}) ON name = k GROUP BY 1"""


@query(
    "check_bulk_close",
    sql(
        BULK,
        "aged",
    ),
)
def check_bulk_close(spark, d):
    return quality.bulk_closes(adapter.requests(spark, d), adapter.GATE)


@query("stale_close_mask", sql("SELECT service_request_id, purge_closed FROM marked", "marked"))
def stale_close_mask(spark, d):
    return purge.mark_purged(adapter.requests(spark, d), adapter.GATE).select(ID, "purge_closed")


@query(
    "check_stale_bulk_close",
    sql(
        STALE,
        "stale", "pdays",
    ),
)
def check_stale_bulk_close(spark, d):
    return purge.purge_events(adapter.requests(spark, d), adapter.GATE)


@query(
    "check_group_outliers",
    sql(
        OUTLIERS,
        "aged",
    ),
)
def check_group_outliers(spark, d):
    return quality.group_outliers(adapter.requests(spark, d), adapter.GATE)


@query("validation_report", sql(CHECKS, "stale", "pdays"))
def validation_report(spark, d):
    """Every check with its verdict and its first figure: rows, duplicates, or tickets in all."""
    checks = quality.validate(adapter.requests(spark, d), asof_of(spark, d), adapter.GATE)
    seen = F.coalesce(*[F.get_json_object("observed", f"$.{c}") for c in ("rows", "duplicates", "tickets")])
    return checks.select("name", "severity", "passed", seen.cast("long").alias("seen"))


@query("validation_findings", sql(FOUND, "stale", "pdays"))
def validation_findings(spark, d):
    found = quality.examine(adapter.requests(spark, d), asof_of(spark, d), adapter.GATE)[1]
    return found.select("name", "service_name", "comm_name", "closed_day", "tickets")


@query(
    "validation_verdict",
    sql(
        f"""SELECT strftime(any_value(taken), '%Y-%m-%d %H:%M:%S') AS "asof", false AS strict, bool_and(passed OR severity = 'warn') AS passed,
        coalesce(string_agg(name, ',' ORDER BY name) FILTER (NOT passed AND severity = 'fail'), '') AS failed,
        coalesce(string_agg(name, ',' ORDER BY name) FILTER (NOT passed AND severity = 'warn'), '') AS warnings,
        max(seen) FILTER (name = 'schema') AS rows FROM ({CHECKS}), bounds""",
        "stale", "pdays", "bounds",
    ),
)
def validation_verdict(spark, d):
    """Two gated runs; the second is held against the row count that the first one wrote."""
    rows, asof, path = adapter.requests(spark, d), asof_of(spark, d), new_path(spark, "gate")
    quality.run_gate(rows, asof, path=f"{path}/first", settings=adapter.GATE)
    before = quality.previous_rows(spark, f"{path}/*/report")
    quality.run_gate(rows, asof, path=f"{path}/second", settings=adapter.GATE, baseline_rows=before)
    shape = "asof string, strict boolean, passed boolean, failed string, warnings string, rows long"
    return spark.read.schema(shape).json(f"{path}/second/report")


# --- model and metrics ----------------------------------------------------------------

# Durations here run to years, so a longer holdout is needed for late rows to appear in it.
LONG = LabelSettings(window_years=6, holdout_years=3)


def fitted(spark, d, feature_set="challenger"):
    """Labels, features with their label, and the model, fitted once per session with the
    published parameters."""
    key = (spark.sparkContext.applicationId, d, "model", feature_set)
    if key not in adapter._built:
        adapter._built[key] = fit(spark, d, feature_set)
    return adapter._built[key]


def fit(spark, d, feature_set):
    done = built(spark, d, settings=LONG)
    raw, comms, hol = adapter.requests(spark, d), adapter.communities(spark, d), adapter.holidays(spark, d)
    train = labels.recent(done.train, 2)
    parts = []
    for part in (train, done.test):
        parts.append(
            features.featurize(part, raw, done.thresholds, comms, hol, feature_set, carry=("breach", "comm_code"))
        )
    train_x, test_x = (adapter.materialize(p, "features") for p in parts)
    return done, train_x, test_x, model.train(train_x, done.thresholds, feature_set)


@query("train_model")
def train_model(spark, d):
    _, train_x, test_x, m = fitted(spark, d)
    found = metrics.evaluate(m.predict(test_x))
    return spark.createDataFrame(
        [(k, float(v)) for k, v in found.items() if v is not None], "metric string, value double"
    )


@query("separability")
def separability(spark, d):
    done = built(spark, d, settings=LONG)
    rows = features.explore_backlog(done.rows.where(F.col("closed_date").isNotNull())).withColumns(
        {"mon": F.month("requested_date").cast("double"), "dow": F.weekday("requested_date").cast("double")}
    )
    parts = [adapter.materialize(rows.where(F.col("split") == s), "separability") for s in ("train", "test")]
    return model.separability(*parts, ["mon", "dow", "cat_30d"])


@query(
    "roc_auc",
    sql(
        """SELECT round((sum(rk) FILTER (breach = 1) - p * (p + 1) / 2.0::DOUBLE) / (p * (c - p)::DOUBLE), 6) AS roc_auc FROM
        (SELECT *, (rank() OVER (ORDER BY pred) + (count(*) OVER (PARTITION BY pred) - 1) / 2.0)::DOUBLE AS rk,
        sum(breach) OVER () AS p, count(*) OVER () AS c FROM judged) GROUP BY p, c""",
        "judged",
    ),
)
def roc_auc(spark, d):
    return metrics.roc_auc(judged(spark, d)).select(six("roc_auc"))


@query(
    "average_precision",
    sql(
        """SELECT round(sum(pos * tp / n) / sum(pos), 6) AS pr_auc FROM (SELECT pos,
        sum(pos) OVER (ORDER BY pred DESC)::DOUBLE AS tp, sum(c) OVER (ORDER BY pred DESC)::DOUBLE AS n FROM
        (SELECT pred, sum(breach) AS pos, count(*) AS c FROM judged GROUP BY 1))""",
        "judged",
    ),
)
def average_precision(spark, d):
    return metrics.average_precision(judged(spark, d)).select(six("pr_auc"))


@query(
    "top_decile",
    sql(
        """SELECT round(avg(breach), 4) AS base_rate, round(avg(breach) FILTER (pred >= cut), 4) AS top_decile_rate,
        round(avg(breach) FILTER (pred >= cut) / avg(breach), 3) AS top_decile_lift,
        round(sum(breach) FILTER (pred >= cut) / sum(breach)::DOUBLE, 4) AS top_decile_recall, count(*) AS n_test
        FROM judged, (SELECT quantile_cont(pred, 0.9::DOUBLE) AS cut FROM judged)""",
        "judged",
    ),
)
def top_decile(spark, d):
    return metrics.top_decile(judged(spark, d))


@query("predict")
def predict(spark, d):
    _, _, test_x, m = fitted(spark, d)
    return m.predict(test_x).select(ID, "breach", six("pred"))


@query("save_load_model")
def save_load_model(spark, d):
    """Save, load, rescore: the reloaded model must reproduce its own metrics."""
    _, _, test_x, m = fitted(spark, d)
    path = new_path(spark, "model")
    before = metrics.evaluate(m.predict(test_x))
    model.save(m, path, before)
    again, saved = model.load(spark, path)
    after = metrics.evaluate(again.predict(test_x))
    shape = "metric string, value double"
    now = spark.createDataFrame([(k, float(v)) for k, v in after.items() if v is not None], shape)
    then = spark.createDataFrame([(k, float(v)) for k, v in saved.items() if v is not None], shape)
    return metrics.require_match(now, then, ("roc_auc", "pr_auc", "top_decile_lift"))


@query(
    "metric_match",
    sql(
        """SELECT sector AS metric, round(abs(a - b), 6) AS difference, round(abs(a - b), 6) <= 0.05::DOUBLE AS matches FROM
        (SELECT sector, avg(breach) AS a, avg(breach) FILTER (requested_date < TIMESTAMP '2000-01-01') AS b
        FROM judged GROUP BY 1) WHERE sector IN ('ASIA', 'EUROPE', 'AMERICA')""",
        "judged",
    ),
)
def metric_match(spark, d):
    rows = judged(spark, d)
    rate = F.avg(F.col("breach").cast("double")).alias("value")
    now = rows.groupBy(F.col("sector").alias("metric")).agg(rate)
    old = rows.where(F.col("requested_date") < F.lit("2000-01-01").cast("timestamp"))
    then = old.groupBy(F.col("sector").alias("metric")).agg(rate)
    return metrics.metric_match(now, then, ("ASIA", "EUROPE", "AMERICA"), tolerance=0.05)


@query("feature_importance")
def feature_importance(spark, d):
    m = fitted(spark, d)[3]
    return spark.createDataFrame(m.importance(), "feature string, share double")


# --- promotion ------------------------------------------------------------------------


def fair(spark, d):
    return fairness.fairness_report(
        judged(spark, d).drop("sector", "srg"), adapter.communities(spark, d), SMALL_FAIR
    )


GROUPS = f"""SELECT dimension, "group", rows, positives, flagged, hits, hits / nullif(positives, 0)::DOUBLE AS recall,
    (hits / nullif(flagged, 0)::DOUBLE) / nullif(positives / rows::DOUBLE, 0) AS lift,
    rows >= 50 AND positives >= 10 AND "group" <> 'UNKNOWN' AS gated FROM (
    SELECT 'sector' AS dimension, sector AS "group", {GROUP_SQL.split('round(')[0].rstrip().rstrip(',')} FROM flagged GROUP BY 2
    UNION ALL SELECT 'srg', srg, {GROUP_SQL.split('round(')[0].rstrip().rstrip(',')} FROM flagged GROUP BY 2)"""


@query(
    "load_predictions",
    sql("SELECT comm_code, count(*) AS rows, sum(breach)::BIGINT AS late, round(sum(pred), 6) AS risk FROM judged GROUP BY 1", "judged"),
)
def load_predictions(spark, d):
    """Predictions as the CSV file a training run leaves, read back."""
    path = new_path(adapter.prepare(spark), "predictions")
    tables.write_csv(judged(spark, d).select("comm_code", "breach", "pred"), path)
    return tables.load_predictions(spark, path).groupBy("comm_code").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("breach").cast("long")).alias("late"), F.round(F.sum("pred"), 6).alias("risk")
    )


@query(
    "fairness_report",
    sql(
        f"""SELECT dimension, count(*) FILTER (gated) >= 2 AND min(recall) FILTER (gated) / max(recall) FILTER (gated) >= 0.8::DOUBLE
        AND min(lift) FILTER (gated) >= 1.5::DOUBLE AS passed,
        round(min(recall) FILTER (gated) / max(recall) FILTER (gated), 4) AS recall_ratio,
        round(min(lift) FILTER (gated), 4) AS min_group_lift,
        arg_min("group", recall) FILTER (gated) AS lowest_recall_group FROM ({GROUPS}) GROUP BY 1""",
        "flagged",
    ),
)
def fairness_report(spark, d):
    return fair(spark, d).dimensions.drop("problems")


@query("report_lines")
def report_lines(spark, d):
    first = fairness.report_lines(fair(spark, d)).select("ord", "line")
    second = grading.summary_lines(grading.grade(adapter.outcomes(spark, d)))
    return first.withColumn("report", F.lit("fairness")).unionByName(second.withColumn("report", F.lit("grade")))


@query(
    "latest_approved",
    """SELECT event_type AS model_group, arg_max(event_id, ts) AS version FROM events WHERE event_id % 7 = 0 GROUP BY 1""",
)
def latest_approved(spark, d):
    return champion.latest_approved(registry(spark, d)).select("model_group", "version")


def rescored(rows: DataFrame) -> DataFrame:
    """A second score that knows a little about the label."""
    return rows.withColumn("pred", F.round(0.7 * F.col("pred") + 0.3 * F.col("breach"), 9))


AP = """SELECT sum(pos * tp / n) / sum(pos) AS ap FROM (SELECT pos, sum(pos) OVER (ORDER BY p DESC)::DOUBLE AS tp,
    sum(c) OVER (ORDER BY p DESC)::DOUBLE AS n FROM (SELECT {0} AS p, sum(breach) AS pos, count(*) AS c FROM judged GROUP BY 1))"""
BETTER = "round(0.7::DOUBLE * pred + 0.3::DOUBLE * breach, 9)"
MARGIN = f"""SELECT 1::BIGINT AS champion_exists, round(b.ap, 4) AS champion_pr_auc,
    round(round(a.ap, 4) - round(b.ap, 4), 4) AS margin FROM ({AP.format(BETTER)}) a, ({AP.format('pred')}) b"""


@query("champion_margin", sql(MARGIN, "judged"))
def champion_margin(spark, d):
    rows = judged(spark, d)
    return champion.champion_margin(
        metrics.average_precision(rescored(rows)), metrics.average_precision(rows)
    )


@query(
    "promotion_gate",
    sql(
        """SELECT version, coalesce(pr >= 0.25::DOUBLE AND rr >= 0.8::DOUBLE AND lift >= 1.5::DOUBLE
        AND (e = 0 OR margin >= 0.005::DOUBLE), false) AS promoted FROM (SELECT event_id AS version, value / 100 AS pr,
        1 - (event_id % 10) / 20.0::DOUBLE AS rr, 1 + (event_id % 11) / 10.0::DOUBLE AS lift, event_id % 2 AS e,
        CASE WHEN event_id % 13 = 0 THEN NULL ELSE (event_id % 17) / 1000.0::DOUBLE END AS margin FROM events)"""
    ),
)
def promotion_gate(spark, d):
    e, key = adapter.table(spark, d, "events"), F.col("event_id")
    rows = e.select(
        key.alias("version"),
        (F.col("value") / 100).alias("pr_auc"),
        (1 - (key % 10) / F.lit(20.0)).alias("recall_ratio"),
        (1 + (key % 11) / F.lit(10.0)).alias("min_group_lift"),
        (key % 2).alias("champion_exists"),
        F.when(key % 13 != 0, (key % 17) / F.lit(1000.0)).alias("margin"),
    )
    return champion.promotion_gate(rows, PromotionSettings()).select("version", "promoted")


GROUP = "late-risk"


def model_registry(spark, d) -> DataFrame:
    """A registry on disk with two stored versions: a smaller approved one with the baseline features,
    then the challenger, recorded as pending."""
    key = (spark.sparkContext.applicationId, d, "model-registry")
    if key not in adapter._built:
        done, train_x, _, m = fitted(spark, d)
        base = new_path(spark, "versions")
        older = model.train(train_x.select(ID, *FEATURE_SETS["baseline"], "breach"), done.thresholds, "baseline", maxIter=20)
        for version, stored in ((1, older), (2, m)):
            model.save(stored, f"{base}/{version}", {"rows": 0.0})
        entry = F.struct(F.lit(GROUP).alias("model_group"), "version", "status", "created", F.lit(USAGE).alias("usage"), F.col("version").cast("string").alias("run"), "path", "recorded")
        shape = "version long, status string, created timestamp, path string, recorded timestamp"
        for row in ((1, "PendingManualApproval", 1), (1, "Approved", 2), (2, "PendingManualApproval", 3)):
            when = F.timestamp_seconds(F.lit(978_307_200 + 86_400 * row[2]))
            one = spark.createDataFrame([(row[0], row[1], None, f"{base}/{row[0]}", None)], shape)
            versions.record(one.withColumns({"created": when, "recorded": when}).select(entry.alias("e")).select("e.*"), f"{base}/registry")
        adapter._built[key] = f"{base}/registry"
    return versions.read_registry(spark, adapter._built[key])


def compared(spark, d):
    """The fitted challenger against the stored champion, both over the same holdout rows."""
    key = (spark.sparkContext.applicationId, d, "compared")
    if key not in adapter._built:
        done, _, _, m = fitted(spark, d)
        adapter._built[key] = versions.compare(
            model_registry(spark, d), GROUP, m, done.test, adapter.requests(spark, d), adapter.communities(spark, d),
            adapter.holidays(spark, d), carry=("breach", "comm_code"),
        )
    return adapter._built[key]


@query("version_scores")
def version_scores(spark, d):
    """Every holdout row under both versions: features computed once, each version's own columns."""
    return compared(spark, d)[0].select(ID, "breach", six("pred_challenger"), six("pred_champion"))


@query(
    "champion_versions",
    """SELECT event_type AS model_group, arg_max(event_id, ts) AS version, 'models/' || arg_max(event_id, ts) AS path
    FROM events WHERE event_id % 7 = 0 OR event_id % 11 = 0 GROUP BY 1""",
)
def champion_versions(spark, d):
    """The stored version that each group's challenger has to beat, from a registry to which approvals
    were appended later."""
    path = new_path(adapter.prepare(spark), "registry")
    rows = registry(spark, d).withColumn("path", F.concat(F.lit("models/"), F.col("version").cast("string")))
    versions.record(rows.withColumn("recorded", F.col("created")), path)
    later = rows.where(F.col("version") % 11 == 0).withColumns({"status": F.lit("Approved"), "recorded": F.col("created") + F.expr("INTERVAL 1 DAY")})
    versions.record(later, path)
    return champion.latest_approved(versions.read_registry(spark, path)).select("model_group", "version", "path")


@query("promotion_run")
def promotion_run(spark, d):
    """Train, evaluate, judge fairness, rescore the stored champion on the same rows, and gate: one row
    of measured figures with the verdict."""
    scores, margin = compared(spark, d)
    scored = scores.withColumnRenamed("pred_challenger", "pred")
    found = metrics.evaluate(scored)
    fair_ = fairness.fairness_report(scored, adapter.communities(spark, d), SMALL_FAIR).overall
    own = margin.first()
    row = fair_.select(
        F.lit(found["pr_auc"]).alias("pr_auc"), F.lit(found["roc_auc"]).alias("roc_auc"), "recall_ratio", "min_group_lift",
        *[F.lit(own[c]).alias(c) for c in ("champion_exists", "champion_version", "champion_pr_auc", "margin")], F.col("problems"),
    )
    return champion.promotion_gate(row, PromotionSettings())


@query(
    "approval_blockers",
    """SELECT event_id AS version, CASE WHEN event_id % 3 = 0 THEN 'no fairness report attached'
    WHEN event_id % 3 = 1 THEN 'fairness check failed: lift < 1.5 in ' || event_type ELSE '' END AS blocker FROM events""",
)
def approval_blockers(spark, d):
    third = F.col("event_id") % 3
    rows = adapter.table(spark, d, "events").select(
        F.col("event_id").alias("version"),
        F.when(third != 0, third == 2).alias("fairness_passed"),
        F.concat(F.lit("lift < 1.5 in "), "event_type").alias("problems"),
    )
    return champion.approval_blockers(rows).select("version", "blocker")


@query(
    "pick_version",
    """SELECT event_type AS model_group, version, CASE WHEN version % 7 = 0 THEN 'approved; a shadow version never is'
    WHEN version % 5 = 0 THEN 'not marked shadow-not-for-use' ELSE '' END AS refusal
    FROM (SELECT event_type, arg_max(event_id, ts) AS version FROM events GROUP BY 1)""",
)
def pick_version(spark, d):
    return champion.candidate_versions(registry(spark, d)).select("model_group", "version", "refusal")


# --- scoring and grading --------------------------------------------------------------


@query("score_open")
def score_open(spark, d):
    """Score what was open on the run date with the stored model: its schema, its thresholds."""
    path = new_path(adapter.prepare(spark), "model")
    model.save(fitted(spark, d)[3], path, {"rows": 0.0})
    m, _ = model.load(spark, path)
    asof = adapter.run_micros(spark, "2001-01-01")
    raw, comms = adapter.known_at(adapter.requests(spark, d), asof), adapter.communities(spark, d)
    rows = scoring.scoring_rows(raw, m.thresholds, asof)
    context = scoring.context_frame(raw, rows)
    x = features.featurize(
        rows, raw, m.thresholds, comms, adapter.holidays(spark, d), m.feature_set, context=context
    )
    scored = rows.join(m.predict(x).select(ID, "pred"), ID)
    out = scoring.stamp(scored, comms, model_ref="model-1", asof=asof, scored_at="2001-01-01T06:00:00")
    return out.select(ID, "sector", "category_seen", six("score"), "rank_in_sector", "flagged", stamp_text("deadline"))


REFLAG = """SELECT *, score >= quantile_cont(score, 0.9::DOUBLE) OVER (PARTITION BY scored_asof, sector) AS by_sector,
    score >= quantile_cont(score, 0.9::DOUBLE) OVER (PARTITION BY scored_asof, sector, srg) AS post_hoc FROM outcomes"""
GRADED = f"""(SELECT *, CASE WHEN outcome = 'late' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS late FROM (SELECT *,
    row_number() OVER (PARTITION BY service_request_id ORDER BY scored_asof) AS rn FROM ({REFLAG}))
    WHERE rn = 1 AND deadline < outcome_snapshot)"""


@query(
    "grade_report",
    sql(
        f"""SELECT 'job' AS quota, CASE WHEN category_seen THEN 'seen' ELSE 'unseen' END AS cohort,
        {RATES_SQL.format(f='flagged')} FROM {LATE_OF.format('cohort')} GROUP BY 2""",
        "cohort",
    ),
)
def grade_report(spark, d):
    return grading.grade(adapter.outcomes(spark, d)).rates.where(F.col("quota") == "job")


@query(
    "grade_post_hoc",
    sql(
        f"""SELECT dimension, quota, round(min(r) / max(r), 4) AS recall_ratio, arg_min(g, r) AS lowest_recall_group FROM (
        SELECT 'sector' AS dimension, q AS quota, sector AS g, sum(late * f) / sum(late) AS r FROM x GROUP BY ALL
          HAVING sum(late) >= 30 AND sector <> 'UNKNOWN'
        UNION ALL SELECT 'srg', q, srg, sum(late * f) / sum(late) FROM x GROUP BY ALL
          HAVING sum(late) >= 30 AND srg <> 'UNKNOWN') GROUP BY 1, 2""",
        "outcomes",
    ).replace(
        "\nSELECT dimension, quota",
        f""", x AS (SELECT late, sector, srg, 'job' AS q, CAST(flagged AS INT) AS f FROM {GRADED} WHERE category_seen
        UNION ALL SELECT late, sector, srg, 'post_hoc', CAST(post_hoc AS INT) FROM {GRADED} WHERE category_seen)
        SELECT dimension, quota""",
    ),
)
def grade_post_hoc(spark, d):
    return grading.grade(adapter.outcomes(spark, d)).dimensions


# --- monitoring -----------------------------------------------------------------------


@query(
    "drift_baseline",
    sql(
        """SELECT CASE WHEN split_part(l.service_name, ' - ', 1) IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
        THEN split_part(l.service_name, ' - ', 1) ELSE 'Other' END AS department, count(*) AS n,
        round(avg(r.n), 6) AS backlog FROM train_recent l JOIN roll_train r ON r.id = l.service_request_id GROUP BY 1""",
        "train_recent", "roll_train",
    ),
)
def drift_baseline(spark, d):
    rows = adapter.requests(spark, d)
    out = drift.baseline_table(
        built(spark, d), rows, adapter.communities(spark, d), adapter.holidays(spark, d), known=DEPARTMENTS,
    )
    return out.groupBy("department").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("cat_open_30d"), 6).alias("backlog"))


@query(
    "drift_intake",
    sql(
        f"""SELECT {MATRIX}, CASE WHEN split_part(service_name, ' - ', 1) IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
        THEN split_part(service_name, ' - ', 1) ELSE 'Other' END AS department
        FROM matrix, bounds WHERE requested_date > taken - INTERVAL 30 DAY AND requested_date <= taken""",
        "matrix", "bounds",
    ),
)
def drift_intake(spark, d):
    rows = adapter.requests(spark, d)
    out = drift.feature_table(
        drift.intake_rows(rows, asof_of(spark, d)), rows, adapter.base_thresholds(spark, d),
        adapter.communities(spark, d), adapter.holidays(spark, d), known=DEPARTMENTS,
    )
    return matrix_out(out).join(out.select(ID, "department"), ID)


INJECTED = """SELECT department, count(*) AS n FROM (
    SELECT '1-URGENT' AS department FROM range((SELECT round_even(0.4::DOUBLE * count(*), 0)::BIGINT FROM requests))
    UNION ALL SELECT * FROM (SELECT CASE WHEN split_part(service_name, ' - ', 1) IN ('2-HIGH', '3-MEDIUM') THEN split_part(service_name, ' - ', 1)
      ELSE 'Other' END FROM requests WHERE NOT coalesce(contains(lower(service_name), 'urgent'), false)
      ORDER BY substr(md5('7:' || service_request_id), 1, 13)
      LIMIT (SELECT count(*) - round_even(0.4::DOUBLE * count(*), 0)::BIGINT FROM requests))) GROUP BY 1"""


@query("inject_drift", sql(INJECTED, "requests"))
def inject_drift(spark, d):
    """Urgent requests raised to two fifths; a share below the present one is refused."""
    rows = adapter.requests(spark, d)
    try:
        drift.inject(rows, "urgent", 0.01)
    except ValueError:
        out = drift.inject(rows, "urgent", 0.4)
    return out.groupBy(department("service_name", DEPARTMENTS).alias("department")).agg(F.count(F.lit(1)).alias("n"))


LEVELS = (*CATEGORICAL, "department")
FEATURED = """mx AS (SELECT *, CASE WHEN split_part(service_name, ' - ', 1) IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
        THEN split_part(service_name, ' - ', 1) ELSE 'Other' END AS department FROM matrix)"""


def featured(spark, d) -> DataFrame:
    """The drift monitor's own table over all requests: every feature, and the department."""
    rows = adapter.requests(spark, d)
    key = (spark.sparkContext.applicationId, d, "featured")
    if key not in adapter._built:
        out = drift.feature_table(
            rows, rows, adapter.base_thresholds(spark, d), adapter.communities(spark, d), adapter.holidays(spark, d),
            known=DEPARTMENTS,
        )
        adapter._built[key] = adapter.materialize(out, "featured")
    return adapter._built[key]


def filed(spark, d) -> DataFrame:
    """The drift monitor's table with the time of each request, a row for a row."""
    times = adapter.requests(spark, d).select(ID, F.col("requested_date").alias("_t"))
    return featured(spark, d).join(times.hint("merge"), ID)


def behind(text: str, more: str) -> str:
    """``text`` with ``more`` behind its last common table expression."""
    head, body = text.rsplit("\nSELECT '", 1)
    return f"{head}, {more}\nSELECT '{body}"


PROFILE = " UNION ALL ".join(
    [
        f"""SELECT '{c}' AS "column", 'numeric' AS kind, count(*) AS rows, (count(*) - count({c}))::BIGINT AS missing,
        count(DISTINCT {c}) AS distinct_values, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, round(avg({c}), 4) AS mean,
        round(stddev_pop({c}), 4) AS std, round(quantile_cont({c}::DOUBLE, 0.1::DOUBLE), 4) AS p10,
        round(quantile_cont({c}::DOUBLE, 0.5::DOUBLE), 4) AS p50, round(quantile_cont({c}::DOUBLE, 0.9::DOUBLE), 4) AS p90 FROM mx"""
        for c in drift.NUMERIC
    ]
    + [
        f"""SELECT '{c}', 'string', count(*), (count(*) - count({c}))::BIGINT, count(DISTINCT {c}),
        NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM mx"""
        for c in LEVELS
    ]
)


@query("profile_baseline", behind(sql(PROFILE, "matrix"), FEATURED))
def profile_baseline(spark, d):
    out = drift.profile(featured(spark, d), drift.NUMERIC, LEVELS)
    return out.select(
        "column", "kind", "rows", "missing", "distinct_values", "min", "max",
        *[F.round(c, 4).alias(c) for c in ("mean", "std", "p10", "p50", "p90")],
    )


def month_store(spark, d) -> sketches.Store:
    """Month profiles of the feature table, stored in two steps: the months before 1998, then the others."""
    key = (spark.sparkContext.applicationId, d, "month-store")
    if key not in adapter._built:
        rows = filed(spark, d)
        store, edge = sketches.Store(spark, new_path(spark, "profiles")), F.lit("1998-01-01").cast("timestamp")
        for part in (rows.where(F.col("_t") < edge), rows.where(F.col("_t") >= edge)):
            store.add(part, "_t", drift.NUMERIC, LEVELS)
        adapter._built[key] = store
    return adapter._built[key]


MERGED = " UNION ALL ".join(
    [
        f"""SELECT '{c}' AS "column", count(*) AS rows, (count(*) - count({c}))::BIGINT AS missing, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max,
        round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS std, CASE WHEN count({c}) > 0 THEN true END AS median_within, true AS distinct_within FROM mx"""
        for c in drift.NUMERIC
    ]
    + [f"SELECT '{c}', count(*), (count(*) - count({c}))::BIGINT, NULL, NULL, NULL, NULL, NULL, true FROM mx" for c in LEVELS]
)


@query("merged_profile", behind(sql(MERGED, "matrix"), FEATURED))
def merged_profile(spark, d):
    """The profile of all months from their stored sketches; the median's exact rank and the exact number
    of distinct values are within the stated errors."""
    out = adapter.materialize(sketches.profile(month_store(spark, d).read("sketches")), "merged-profile")
    counts = drift.counted(featured(spark, d), drift.NUMERIC, LEVELS)
    there = F.col("value").isNotNull() | F.col("level").isNotNull()
    exact = counts.join(out.select("column", "p50"), "column").groupBy("column").agg(
        F.count(F.when(there, 1)).alias("_distinct"),
        (F.sum(F.when(F.col("value") < F.col("p50"), F.col("n")).otherwise(0)) / F.sum(F.when(F.col("value").isNotNull(), F.col("n")))).alias("_below"),
        (F.sum(F.when(F.col("value") <= F.col("p50"), F.col("n")).otherwise(0)) / F.sum(F.when(F.col("value").isNotNull(), F.col("n")))).alias("_upto"),
    )
    near = (F.col("_below") - sketches.RANK_ERROR <= 0.5) & (F.col("_upto") + sketches.RANK_ERROR >= 0.5)
    close = F.abs(F.col("distinct_values") - F.col("_distinct")) <= sketches.DISTINCT_ERROR * F.col("_distinct") + 0.5
    return out.join(exact, "column").select(
        "column", "rows", "missing", "min", "max", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"),
        near.alias("median_within"), close.alias("distinct_within"),
    )


SHARE = "(SELECT {0} AS v, count(*) / (sum(count(*)) OVER ())::DOUBLE AS {1} FROM {2} WHERE {0} IS NOT NULL GROUP BY 1)"
MOVED = " UNION ALL ".join(
    [
        f"""SELECT '{c}' AS "column", 'completeness_check' AS check_type, round(b, 6) AS observed FROM
        (SELECT count({c}) / count(*)::DOUBLE AS a FROM early), (SELECT count({c}) / count(*)::DOUBLE AS b FROM late_rows) WHERE b < a"""
        for c in (*drift.NUMERIC, *LEVELS)
    ]
    + [
        f"""SELECT '{c}', 'baseline_drift_check', round(d, 6) FROM (SELECT max(abs(coalesce(a, 0) - coalesce(b, 0))) AS d FROM
        {SHARE.format(c, 'a', 'early')} FULL JOIN {SHARE.format(c, 'b', 'late_rows')} USING (v)) WHERE d > 0.1
        UNION ALL SELECT '{c}', 'categorical_values_check', round(u, 6) FROM (SELECT sum(b) AS u FROM
        {SHARE.format(c, 'b', 'late_rows')} LEFT JOIN {SHARE.format(c, 'a', 'early')} USING (v) WHERE a IS NULL) WHERE u > 0"""
        for c in LEVELS
    ]
    + [
        f"""SELECT '{c}', 'baseline_drift_check', round(d, 6) FROM (SELECT max(abs(fa - fb)) AS d FROM (
        SELECT sum(CAST(e AS INT)) OVER w / nullif((SELECT count({c}) FROM early), 0)::DOUBLE AS fa,
        sum(CAST(NOT e AS INT)) OVER w / nullif((SELECT count({c}) FROM late_rows), 0)::DOUBLE AS fb FROM
        (SELECT {c} AS x, true AS e FROM early WHERE {c} IS NOT NULL UNION ALL
        SELECT {c}, false FROM late_rows WHERE {c} IS NOT NULL) WINDOW w AS (ORDER BY x))) WHERE d > 0.1"""
        for c in drift.NUMERIC
    ]
)
SPLIT_FEATURES = f"""{FEATURED}, early AS (SELECT * FROM mx WHERE requested_date < TIMESTAMP '1998-01-01'),
        late_rows AS (SELECT * FROM mx WHERE requested_date >= TIMESTAMP '1998-01-01')"""


@query("drift_violations", behind(sql(MOVED, "matrix"), SPLIT_FEATURES))
def drift_violations(spark, d):
    rows = filed(spark, d)
    edge = F.lit("1998-01-01").cast("timestamp")
    out = drift.violations(rows.where(F.col("_t") < edge), rows.where(F.col("_t") >= edge), drift.NUMERIC, LEVELS)
    return out.select("column", "check_type", six("observed"))


SKETCHED = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", true AS within FROM (SELECT count({c}) AS a FROM early), (SELECT count({c}) AS b FROM late_rows) WHERE a > 0 AND b > 0"""
    for c in (*drift.NUMERIC, *LEVELS)
)


@query("sketched_distances", behind(sql(SKETCHED, "matrix"), SPLIT_FEATURES))
def sketched_distances(spark, d):
    """How far each column has moved, from stored months alone, is within the stated error of how far
    its rows say."""
    store, edge = month_store(spark, d), "1998-01-01"
    sides = [(store.read("sketches", **span), store.read("levels", **span)) for span in ({"before": edge}, {"since": edge})]
    rows = filed(spark, d)
    cut = F.lit(edge).cast("timestamp")
    exact = drift.violations(rows.where(F.col("_t") < cut), rows.where(F.col("_t") >= cut), drift.NUMERIC, LEVELS, threshold=-1.0)
    drifted = F.col("check_type") == "baseline_drift_check"
    near = sketches.violations(*sides, threshold=-1.0).where(drifted).select("column", F.col("observed").alias("_near"))
    both = exact.where(drifted).join(near, "column")
    return both.select("column", (F.abs(F.col("observed") - F.col("_near")) <= sketches.GAP_ERROR).alias("within"))


def cube(spark, d) -> DataFrame:
    done = scorecard.settled(adapter.requests(spark, d), adapter.communities(spark, d), gate=adapter.GATE)
    return scorecard.late_counts(done.rows)


@query("city_late_mix_fixed", sql(f"SELECT {CARD_OUT} FROM city", "city"))
def city_late_mix_fixed(spark, d):
    return card_out(scorecard.city_late_mix_fixed(adapter.materialize(cube(spark, d), "cube")))


@query("sector_obs_expected", sql(f"SELECT {CARD_OUT} FROM sector_oe", "sector_oe"))
def sector_obs_expected(spark, d):
    return card_out(scorecard.sector_obs_expected(adapter.materialize(cube(spark, d), "cube")))


@query("segment_late_rate", sql(f"SELECT {CARD_OUT} FROM segment", "segment"))
def segment_late_rate(spark, d):
    return card_out(scorecard.segment_late_rate(cube(spark, d), CATEGORY, "AMERICA"))


@query("weekend_ratio", sql(f"SELECT {CARD_OUT} FROM weekend", "weekend"))
def weekend_ratio(spark, d):
    return card_out(scorecard.weekend_ratio(adapter.materialize(cube(spark, d), "cube")))


@query(
    "settled",
    sql(
        """SELECT strftime(month, '%Y-%m-%d') AS month, count(*) AS n, sum(breach)::BIGINT AS late,
        round(any_value(pending), 6) AS pending FROM settled JOIN pending USING (month) GROUP BY 1""",
        "settled", "pending",
    ),
)
def settled(spark, d):
    done = scorecard.settled(adapter.requests(spark, d), adapter.communities(spark, d), gate=adapter.GATE)
    counts = done.rows.groupBy("month").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("breach").cast("long")).alias("late")
    )
    return counts.join(done.pending, "month").select(
        F.date_format("month", "yyyy-MM-dd").alias("month"), "n", "late", six("pending")
    )


@query(
    "scorecard_flags",
    sql(
        """SELECT strftime(month, '%Y-%m-%d') AS month, series, key, round(residual, 6) AS residual, flag FROM runs_of
        UNION ALL SELECT strftime(month, '%Y-%m-%d'), series, key, NULL, false FROM card WHERE provisional""",
        "runs_of", "card",
    ),
)
def scorecard_flags(spark, d):
    out = scorecard.add_flags(adapter.materialize(card(spark, d), "card"), TIGHT)
    return out.select(
        F.date_format("month", "yyyy-MM-dd").alias("month"), "series", "key", six("residual"), "flag"
    )


@query(
    "recent_flags",
    sql(
        """SELECT DISTINCT series, key FROM runs_of WHERE flag AND month >=
        (SELECT max(month) FROM card WHERE NOT provisional) - INTERVAL 60 MONTH""",
        "runs_of", "card",
    ),
)
def recent_flags(spark, d):
    flags = adapter.materialize(scorecard.add_flags(adapter.materialize(card(spark, d), "card"), TIGHT), "flags")
    return scorecard.recent_flags(flags, 60)


HEAVY = ("click", "view")


def assessed(spark, d) -> DataFrame:
    return jobs.assess(adapter.jobs(spark, d), adapter.snapshots(spark, d), kinds=HEAVY)


@query(
    "job_health",
    sql(
        f"""SELECT job_id, usd, rows, round(sec, 6) AS sec_per_mrows, coalesce(slow, false) OR status = 'Failed' AS flag,
        CASE WHEN status = 'Failed' THEN 'failed' WHEN slow THEN '> 2x its kind''s median' ELSE '' END AS reason FROM (
        SELECT *, judged AND c >= 3 AND m > 2.0::DOUBLE * (CASE WHEN c % 2 = 1
          THEN CASE WHEN rn <= h THEN (a1 + a2) / 2 WHEN rn = h + 1 THEN (a0 + a2) / 2 ELSE (a0 + a1) / 2 END
          ELSE CASE WHEN rn <= h THEN a1 ELSE a0 END END) AS slow FROM (
        SELECT *, max(m) FILTER (judged AND rn = h) OVER k AS a0, max(m) FILTER (judged AND rn = h + 1) OVER k AS a1,
          max(m) FILTER (judged AND rn = h + 2) OVER k AS a2 FROM (
        SELECT *, c // 2 AS h FROM (
        SELECT *, row_number() OVER (PARTITION BY kind, judged ORDER BY m, job_id) AS rn,
          count(*) OVER (PARTITION BY kind, judged) AS c FROM (
        SELECT *, status = 'Completed' AND m IS NOT NULL AS judged FROM (
        SELECT *, CASE WHEN heavy THEN sec ELSE billed_seconds END AS m FROM (
        SELECT * REPLACE (CASE WHEN heavy THEN rows::DOUBLE END AS rows),
          CASE WHEN heavy THEN billed_seconds / nullif(rows / 1e6, 0) END AS sec FROM (
        SELECT *, kind IN ('click', 'view') AS heavy, {USD.format('1.0::DOUBLE', 1)} AS usd FROM job_rows))))))
        WINDOW k AS (PARTITION BY kind)))""",
        "job_rows",
    ),
)
def job_health(spark, d):
    return assessed(spark, d).select(
        "job_id", "usd", F.col("rows").cast("double").alias("rows"), six("sec_per_mrows"), "flag", "reason"
    )


@query(
    "alert_lines",
    f"""WITH bad AS (SELECT h.*, e.* FROM ({ORACLE['job_health']}) h JOIN events e ON e.event_id = h.job_id WHERE h.flag)
    SELECT 0 AS ord, format('{{:,}}', count(*)) || ' job(s) flagged' AS line FROM bad HAVING count(*) > 0
    UNION ALL SELECT 1, '- civic-' || event_type || '-' || strftime(ts, '%Y%m%d-%H%M%S') || ' (' || event_type || '): ' || reason || '; '
      || CASE WHEN value IS NULL THEN 'no billed time' ELSE round(value)::BIGINT::VARCHAR || ' s' END FROM bad""",
)
def alert_lines(spark, d):
    return jobs.alert_lines(assessed(spark, d))


@query(
    "community_oe",
    sql(
        """SELECT comm_code, round(v, 6) AS value, n,
        CAST(v > 0.85::DOUBLE AS BIGINT) + CAST(v > 0.95::DOUBLE AS BIGINT)
        + CAST(v > 1.05::DOUBLE AS BIGINT) + CAST(v > 1.15::DOUBLE AS BIGINT) AS class
        FROM (SELECT comm_code, avg(breach) / nullif(avg(e), 0) AS v, count(*) AS n FROM (SELECT *, CASE WHEN service_name
          IS NOT NULL THEN avg(breach) OVER (PARTITION BY month, service_name) END AS e FROM settled) GROUP BY 1) WHERE n >= 20""",
        "settled",
    ),
)
def community_oe(spark, d):
    done = scorecard.settled(adapter.requests(spark, d), adapter.communities(spark, d), gate=adapter.GATE)
    counts = adapter.materialize(scorecard.late_counts(done.rows, ["comm_code"]), "cube")
    out = scorecard.community_ratio(counts, min_n=20)
    return out.select("comm_code", six("value"), "n", ratio_band("value").alias("class"))
