"""The data-quality gate. Every check is one row: name, severity, passed, detail, observed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark.functions.dates import at, days_between
from civicspark.operators.ordered import DAYS_WIDTH, distribution, quantiles
from civicspark.plans.purge import purge_events
from civicspark.schemas import REQUIRED_COLUMNS
from civicspark.session import materialize, new_path
from civicspark.settings import GateSettings


class DataValidationError(RuntimeError):
    """At least one failing check."""


def parse_time(df: DataFrame, column: str) -> Column:
    """A timestamp from ISO text, null when it does not parse; timestamps and dates pass through."""
    if isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col(column).cast("timestamp")
    return F.try_to_timestamp(F.col(column).cast("string"))


def _check(df: DataFrame, name: str, severity: str, passed, detail, observed) -> DataFrame:
    return df.select(
        F.lit(name).alias("name"),
        F.lit(severity).alias("severity"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        detail.alias("detail"),
        F.to_json(F.struct(*observed)).alias("observed"),
    )


def missing_columns(df: DataFrame, required=REQUIRED_COLUMNS) -> list[str]:
    return [c for c in required if c not in df.columns]


def check_schema(df: DataFrame, required=REQUIRED_COLUMNS) -> DataFrame:
    return _schema_check(df.agg(F.count(F.lit(1)).alias("rows")), missing_columns(df, required))


def _schema_check(counted: DataFrame, missing: list[str]) -> DataFrame:
    text = f"missing columns: {missing}" if missing else "all required columns present"
    names = F.lit(",".join(missing))
    return _check(counted, "schema", "fail", F.lit(not missing), F.lit(text), [names.alias("missing"), "rows"])


def row_count(df: DataFrame, baseline_rows: int | None = None) -> DataFrame:
    return _change(df.agg(F.count(F.lit(1)).alias("rows")), baseline_rows)


def _change(counted: DataFrame, baseline_rows: int | None) -> DataFrame:
    base = F.lit(baseline_rows).cast("long")
    return counted.withColumns(
        {
            "baseline_rows": base,
            "change": (F.col("rows") - base) / F.nullif(base.cast("double"), F.lit(0.0)),
        }
    )


def check_row_count(df, settings=None, baseline_rows: int | None = None) -> DataFrame:
    return _row_check(row_count(df, baseline_rows), settings)


def _row_check(counted: DataFrame, settings=None) -> DataFrame:
    s = settings or GateSettings()
    few = F.when(
        F.col("rows") < s.min_rows,
        F.format_string(f"%,d rows < minimum {s.min_rows:,}", F.col("rows")),
    )
    moved = F.when(
        F.abs("change") > s.max_row_change,
        F.format_string(
            f"%+.1f%% vs previous run (%,d rows), limit ±{s.max_row_change * 100:.0f}%%",
            F.col("change") * 100,
            F.col("baseline_rows"),
        ),
    )
    problems = F.concat_ws("; ", few, moved)
    return _check(
        counted,
        "row_count",
        "fail",
        problems == "",
        F.when(problems == "", F.format_string("%,d rows", F.col("rows"))).otherwise(problems),
        ["rows", "baseline_rows", "change"],
    )


def duplicate_ids(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each id; null counts as one id."""
    per_id = df.groupBy("service_request_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        (
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
            / F.greatest(F.coalesce(F.sum("n"), F.lit(0)), F.lit(1))
        ).alias("rate"),
    )


def check_unique_ids(df: DataFrame, settings=None) -> DataFrame:
    s = settings or GateSettings()
    text = F.format_string(
        "%,d duplicate service_request_id (%.3f%%), limit "
        f"{s.max_duplicate_id_rate * 100:.3f}%%",
        F.col("duplicates"),
        F.col("rate") * 100,
    )
    return _check(
        duplicate_ids(df), "unique_ids", "fail", F.col("rate") <= s.max_duplicate_id_rate, text,
        ["duplicates", "rate"],
    )


def _null_shares(df: DataFrame, ceilings: dict) -> list[Column]:
    return [
        F.coalesce(F.avg(F.col(c).isNull().cast("double")), F.lit(0.0)).alias(c)
        for c in ceilings
        if c in df.columns
    ]


def null_rates(df: DataFrame, ceilings: dict) -> DataFrame:
    """One row: the null share of each listed column that exists."""
    return df.agg(*_null_shares(df, ceilings))


def check_null_rates(df: DataFrame, settings=None) -> DataFrame:
    return _null_check(null_rates(df, (settings or GateSettings()).max_null_rate), settings)


def _null_check(rates: DataFrame, settings=None) -> DataFrame:
    ceilings = (settings or GateSettings()).max_null_rate
    over = [
        F.when(
            F.col(c) > ceilings[c],
            F.format_string(f"{c} %.2f%% > {ceilings[c] * 100:.2f}%%", F.col(c) * 100),
        )
        for c in rates.columns
    ]
    text = F.concat_ws("; ", *over)
    return _check(
        rates, "null_rates", "fail", text == "",
        F.when(text == "", "null rates within limits").otherwise(text), rates.columns,
    )


def date_health(df: DataFrame, asof: int) -> DataFrame:
    """Unparseable, negative, future and stale figures in one pass over the raw text."""
    return df.agg(*_date_figures(df, asof))


def _date_figures(df: DataFrame, asof: int) -> list[Column]:
    req, clo = parse_time(df, "requested_date"), parse_time(df, "closed_date")
    n = F.greatest(F.count(F.lit(1)), F.lit(1))

    def count(condition):
        return F.coalesce(F.sum(condition.cast("long")), F.lit(0))

    bad = count(req.isNull() & F.col("requested_date").isNotNull()) + count(
        clo.isNull() & F.col("closed_date").isNotNull()
    )
    lag = (F.lit(asof) - F.unix_micros(F.max(req))) / F.lit(86_400_000_000.0)
    return [
        (bad / n).alias("unparseable_rate"),
        (count(clo < req) / n).alias("negative_duration_rate"),
        count(req > at(asof + 86_400_000_000)).alias("future_rows"),
        F.date_format(F.max(req), "yyyy-MM-dd HH:mm:ss").alias("newest_requested"),
        F.floor(lag).alias("stale_days"),
    ]


def check_dates(df: DataFrame, asof: int, settings=None) -> DataFrame:
    return _date_check(date_health(df, asof), settings)


def _date_check(health: DataFrame, settings=None) -> DataFrame:
    s = settings or GateSettings()
    stale = F.col("stale_days")
    problems = F.concat_ws(
        "; ",
        F.when(
            F.col("unparseable_rate") > s.max_unparseable_date_rate,
            F.format_string("%.2f%% unparseable dates", F.col("unparseable_rate") * 100),
        ),
        F.when(
            F.col("negative_duration_rate") > s.max_negative_duration_rate,
            F.format_string("%.2f%% closed before requested", F.col("negative_duration_rate") * 100),
        ),
        F.when(
            F.col("future_rows") > 0,
            F.format_string("%,d requests dated after as-of", F.col("future_rows")),
        ),
        F.when(
            stale.isNull() | (stale > s.max_staleness_days),
            F.concat(
                F.lit("newest request is "),
                F.coalesce(stale.cast("string"), F.lit("unknown")),
                F.lit(f" days before as-of, limit {s.max_staleness_days}"),
            ),
        ),
    )
    return _check(
        health, "dates", "fail", problems == "",
        F.when(problems == "", "dates parse, order and freshness OK").otherwise(problems),
        health.columns,
    )


def _closed(df: DataFrame) -> DataFrame:
    return df.select(
        "service_name",
        "comm_name",
        F.to_date(parse_time(df, "closed_date")).alias("closed_day"),
        days_between(parse_time(df, "requested_date"), parse_time(df, "closed_date")).alias("days"),
    ).where(
        F.col("service_name").isNotNull() & F.col("comm_name").isNotNull() & (F.col("days") >= 0)
    )


def closed_groups(df: DataFrame, settings=None) -> DataFrame:
    """Closed rows of (category, community) groups with enough of them."""
    s = settings or GateSettings()
    closed = _closed(df)
    sizes = closed.groupBy("service_name", "comm_name").agg(F.count(F.lit(1)).alias("group_rows"))
    large = materialize(sizes.where(F.col("group_rows") >= s.group_min_rows), "group-sizes")
    return closed.join(large, ["service_name", "comm_name"])


def closed_days(df: DataFrame) -> DataFrame:
    """Closures and their summed days per (category, community, day): both group checks read it."""
    return _closed(df).groupBy("service_name", "comm_name", "closed_day").agg(
        F.count(F.lit(1)).alias("n"), F.sum("days").alias("days")
    )


def bulk_closes(df: DataFrame, settings=None, daily: DataFrame | None = None) -> DataFrame:
    """Groups whose closures pile onto one day; the earliest such day wins a tie."""
    s = settings or GateSettings()
    keys = ["service_name", "comm_name"]
    daily = closed_days(df) if daily is None else daily
    groups = daily.groupBy(*keys).agg(
        F.sum("n").alias("rows"),
        F.sum("days").alias("_days"),
        F.max(F.struct("n", (-F.unix_date("closed_day")).alias("d"))).alias("top"),
    )
    share = F.col("top.n") / F.col("rows")
    return groups.where(
        (F.col("rows") >= s.group_min_rows)
        & (share >= s.bulk_close_day_share)
        & (F.col("top.n") >= s.bulk_close_min_rows)
    ).select(
        *keys,
        "rows",
        F.date_format(F.date_from_unix_date((-F.col("top.d")).cast("int")), "yyyy-MM-dd").alias("closed_day"),
        F.col("top.n").alias("closed_that_day"),
        F.round(share, 3).alias("share"),
        F.round(F.col("_days") / F.col("rows"), 1).alias("mean_days_to_close"),
    )


def group_outliers(df: DataFrame, settings=None, daily: DataFrame | None = None) -> DataFrame:
    """Groups whose mean is far above their category's median group mean."""
    s = settings or GateSettings()
    daily = closed_days(df) if daily is None else daily
    means = (
        daily.groupBy("service_name", "comm_name")
        .agg(F.sum("n").alias("n"), (F.sum("days") / F.sum("n")).alias("mean"))
        .where(F.col("n") >= s.group_min_rows)
    )
    medians = quantiles(
        distribution(means, ["service_name"], "mean"), ["service_name"], {"cat_median": 0.5},
        width=DAYS_WIDTH,
    ).drop("rows")
    return (
        means.join(medians, "service_name")
        .where(
            (F.col("mean") >= s.group_mean_ratio * F.col("cat_median"))
            & (F.col("mean") - F.col("cat_median") >= s.group_mean_min_excess_days)
        )
        .select(
            "service_name",
            "comm_name",
            F.col("n").alias("tickets"),
            F.round("mean", 1).alias("mean_days_to_close"),
            F.round("cat_median", 1).alias("category_median_days"),
        )
    )


# The sentences of the report, and what it says when nothing is found.
CLEAN = {
    "bulk_close": "no single-day bulk closes",
    "stale_bulk_close": "no stale bulk closes",
    "group_outliers": "no community far outside its category's norm",
}
LINES = {
    "bulk_close": ("%s / %s: %.0f%% closed on %s", ("comm_name", "service_name", "_share", "closed_day")),
    "stale_bulk_close": (
        "%s on %s: %,d tickets, median age %.0fd", ("service_name", "closed_day", "tickets", "median_age_days")
    ),
    "group_outliers": (
        "%s / %s: %.1fd vs %.1fd typical",
        ("comm_name", "service_name", "mean_days_to_close", "category_median_days"),
    ),
}
FINDING = ("name", "service_name", "comm_name", "closed_day", "tickets", "weight", "detail")
NAMED = 5  # findings that a check's text names; the findings table has them all


def _found(found: DataFrame, name: str, tickets: str, weight: str) -> DataFrame:
    line, columns = LINES[name]
    if name == "bulk_close":
        found = found.withColumn("_share", F.col("share") * 100)

    def given(c):
        return F.col(c).cast("string") if c in found.columns else F.lit(None).cast("string")

    return found.select(
        F.lit(name).alias("name"), "service_name", given("comm_name").alias("comm_name"),
        given("closed_day").alias("closed_day"), F.col(tickets).cast("long").alias("tickets"),
        F.col(weight).cast("double").alias("weight"),
        F.format_string(line, *columns).alias("detail"),
    )


def findings(df: DataFrame, settings=None, daily: DataFrame | None = None) -> DataFrame:
    """Every group and event behind a warning, one row each: the check's name, the group, its
    tickets, and the sentence. Nothing is left out."""
    typed = df.withColumns({c: parse_time(df, c) for c in ("requested_date", "closed_date")})
    return reduce(
        DataFrame.unionByName,
        [
            _found(bulk_closes(df, settings, daily), "bulk_close", "closed_that_day", "closed_that_day"),
            _found(purge_events(typed, settings), "stale_bulk_close", "tickets", "tickets"),
            _found(group_outliers(df, settings, daily), "group_outliers", "tickets", "mean_days_to_close"),
        ],
    )


def check_findings(found: DataFrame) -> DataFrame:
    """A warning row per kind of finding: how many, how many tickets in all, the heaviest few by
    name, and how many more there are."""
    kinds = found.sparkSession.createDataFrame([(k, v) for k, v in CLEAN.items()], "kind string, clean string")
    totals = found.groupBy("name").agg(F.count(F.lit(1)).alias("found"), F.sum("tickets").alias("tickets"))
    heavy = None
    for kind in CLEAN:
        top = found.where(F.col("name") == kind).orderBy(F.desc("weight"), "detail").limit(NAMED)
        heavy = top if heavy is None else heavy.unionByName(top)
    place = F.struct((-F.col("weight")).alias("w"), F.col("detail").alias("t"))
    named = heavy.groupBy("name").agg(F.sort_array(F.collect_list(place)).alias("l")).select(
        "name", F.concat_ws("; ", F.transform("l", lambda x: x["t"])).alias("largest")
    )
    rows = kinds.join(totals.join(named, "name"), F.col("kind") == F.col("name"), "left").fillna(0, ["found", "tickets"])
    more = F.when(F.col("found") > NAMED, F.format_string("; and %,d more", F.col("found") - NAMED)).otherwise("")
    text = F.when(F.col("found") == 0, F.col("clean")).otherwise(
        F.concat(F.format_string("%,d found. Largest: ", F.col("found")), "largest", more)
    )
    return rows.select(
        F.col("kind").alias("name"), F.lit("warn").alias("severity"), (F.col("found") == 0).alias("passed"),
        text.alias("detail"), F.to_json(F.struct("found", "tickets")).alias("observed"),
    )


def _one_kind(found: DataFrame, name: str) -> DataFrame:
    return check_findings(found).where(F.col("name") == name)


def check_bulk_close(df: DataFrame, settings=None) -> DataFrame:
    found = _found(bulk_closes(df, settings), "bulk_close", "closed_that_day", "closed_that_day")
    return _one_kind(found, "bulk_close")


def check_stale_bulk_close(df: DataFrame, settings=None) -> DataFrame:
    typed = df.withColumns({c: parse_time(df, c) for c in ("requested_date", "closed_date")})
    return _one_kind(_found(purge_events(typed, settings), "stale_bulk_close", "tickets", "tickets"), "stale_bulk_close")


def check_group_outliers(df: DataFrame, settings=None) -> DataFrame:
    found = _found(group_outliers(df, settings), "group_outliers", "tickets", "mean_days_to_close")
    return _one_kind(found, "group_outliers")


def examine(
    df: DataFrame, asof: int, settings: GateSettings | None = None, baseline_rows: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(checks, findings)``: all checks, one row each, and what the warnings are about.

    One aggregate answers rows, nulls and dates, one table of closures per day both group
    checks; both are written and read by the rest. With columns missing there is only the
    schema row.
    """
    missing = missing_columns(df)
    if missing:
        none = df.sparkSession.createDataFrame([], ", ".join(
            f"{c} {'long' if c == 'tickets' else 'double' if c == 'weight' else 'string'}" for c in FINDING
        ))
        return check_schema(df), none
    ceilings = (settings or GateSettings()).max_null_rate
    shares, figures = _null_shares(df, ceilings), _date_figures(df, asof)
    facts = materialize(
        df.agg(
            F.count(F.lit(1)).alias("rows"), F.struct(*shares).alias("nulls"), F.struct(*figures).alias("dates")
        ),
        "facts",
    )
    found = materialize(findings(df, settings, materialize(closed_days(df), "closed-days")), "findings")
    parts = [
        _schema_check(facts, missing),
        _row_check(_change(facts.select("rows"), baseline_rows), settings),
        check_unique_ids(df, settings),
        _null_check(facts.select("nulls.*"), settings),
        _date_check(facts.select("dates.*"), settings),
        check_findings(found),
    ]
    return reduce(DataFrame.unionByName, parts), found


def validate(
    df: DataFrame, asof: int, settings: GateSettings | None = None, baseline_rows: int | None = None
) -> DataFrame:
    """All checks, one row each; only the schema row when columns are missing."""
    return examine(df, asof, settings, baseline_rows)[0]


def _verdict(checks: DataFrame, strict: bool) -> DataFrame:
    blocking = F.lit(True) if strict else F.col("severity") == "fail"
    failed = F.sort_array(F.collect_list(F.when(~F.col("passed") & blocking, F.col("name"))))
    warned = F.sort_array(F.collect_list(F.when(~F.col("passed") & ~blocking, F.col("name"))))
    rows = F.when(F.col("name") == "schema", F.get_json_object("observed", "$.rows").cast("long"))
    return checks.agg(
        F.concat_ws(",", failed).alias("failed"), F.concat_ws(",", warned).alias("warnings"), F.max(rows).alias("rows")
    ).withColumn("passed", F.col("failed") == "")


def gate(checks: DataFrame, *, strict: bool = False) -> DataFrame:
    """One row: passed, and the failed and warned checks by name."""
    return _verdict(checks, strict).select("passed", "failed", "warnings")


def report(checks: DataFrame, asof: int, *, strict: bool = False) -> DataFrame:
    """The verdict of one run, one row: as-of, strict, passed, failed, warnings and rows."""
    return _verdict(checks, strict).select(
        F.date_format(at(asof), "yyyy-MM-dd HH:mm:ss").alias("asof"), F.lit(strict).alias("strict"),
        "passed", "failed", "warnings", "rows",
    )


def previous_rows(spark, path: str) -> int | None:
    """The row count of the newest report under ``path``: the baseline of the next run."""
    shape = "asof string, rows long"
    newest = spark.read.schema(shape).option("recursiveFileLookup", True).json(path)
    return newest.agg(F.max_by("rows", "asof").alias("rows")).first()["rows"]


def run_gate(
    df: DataFrame, asof: int, *, path: str | None = None, settings: GateSettings | None = None,
    baseline_rows: int | None = None, strict: bool = False,
) -> DataFrame:
    """Write checks, findings and verdict, then raise if the gate fails, so a failed run leaves
    its evidence."""
    checks, found = examine(df, asof, settings, baseline_rows)
    checks = materialize(checks, "checks")
    path = path or new_path(df.sparkSession, "validation")
    checks.coalesce(1).write.mode("overwrite").json(f"{path}/checks")
    found.write.mode("overwrite").json(f"{path}/findings")
    report(checks, asof, strict=strict).coalesce(1).write.mode("overwrite").json(f"{path}/report")
    verdict = gate(checks, strict=strict).first()
    if not verdict["passed"]:
        raise DataValidationError(f"data validation failed: {verdict['failed']}")
    return checks
