"""Intake-time features: calendar, backlog and decided-outcome history."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.functions import dates
from civicspark.operators.asof import Ask, Events, Span, range_agg_many
from civicspark.operators.lookup import attach_sector
from civicspark.plans.labels import assert_no_leakage
from civicspark.schemas import FEATURE_SETS, HISTORY
from civicspark.settings import GLOBAL_CATEGORY, LATE_RATES

BACKLOG_KEYS = {"cat_open_30d": "service_name", "comm_req_30d": "comm_name"}


def holiday_weeks(holidays: DataFrame, day: str = "holiday") -> DataFrame:
    """The distinct Mondays of weeks that contain a holiday."""
    return holidays.select(dates.week_of(day).alias("_week")).distinct()


def add_calendar_features(df: DataFrame, holidays: DataFrame) -> DataFrame:
    """Month, weekday (Monday = 0), weekend and holiday-week flags."""
    weeks = holiday_weeks(holidays).withColumn("_hit", F.lit(1))
    dow = F.weekday("requested_date")
    return (
        df.withColumns(
            {
                "req_month": F.month("requested_date"),
                "req_dow": dow,
                "req_is_weekend": (dow >= 5).cast("int"),
                "_week": dates.week_of("requested_date"),
            }
        )
        .join(weeks, "_week", "left")
        .withColumn("req_is_holiday_week", F.coalesce("_hit", F.lit(0)))
        .drop("_week", "_hit")
    )


def _backlog_asks(around: DataFrame) -> list[Ask]:
    filed = Events(around.select(*BACKLOG_KEYS.values(), "requested_date"), "requested_date")
    return [Ask(filed, (key,), (Span(f"_{name}", 30),)) for name, key in BACKLOG_KEYS.items()]


def _backlog_columns() -> dict:
    return {n: F.coalesce(f"_{n}_n", F.lit(0)).cast("int") for n in BACKLOG_KEYS}


def _answer(df: DataFrame, asks, columns: dict, closed: str = "left") -> DataFrame:
    spans = [s.name for a in asks for s in a.spans]
    out = range_agg_many(df, "requested_date", asks, closed).withColumns(columns)
    return out.drop(*[f"{s}_{part}" for s in spans for part in ("n", "sum")])


def add_backlog_features(df: DataFrame, context: DataFrame | None = None) -> DataFrame:
    """Same-category and same-community requests in the 30 days strictly before each row.

    Rows are counted in ``context`` (by default the frame itself).
    """
    return _answer(df, _backlog_asks(df if context is None else context), _backlog_columns())


def explore_backlog(df: DataFrame, key: str = "service_name", name: str = "cat_30d") -> DataFrame:
    """The exploratory variant: ``(t - 30 d, t]`` without the row itself."""
    filed = Events(df.select(key, "requested_date"), "requested_date")
    asks = [Ask(filed, (key,), (Span("_w", 30),))]
    return _answer(df, asks, {name: (F.coalesce("_w_n", F.lit(1)) - 1).cast("long")}, "right")


@dataclass(frozen=True)
class History:
    """``outcomes``: decided requests by deadline; ``filed``: when each request came in."""

    outcomes: DataFrame
    filed: DataFrame


def build_history(requests: DataFrame, thresholds: DataFrame, communities: DataFrame) -> History:
    """Deadlines in whole seconds; categories without a threshold of their own stay out."""
    own = thresholds.where(F.col("service_name") != GLOBAL_CATEGORY)
    seconds = F.unix_seconds("requested_date") + F.floor(
        F.col("threshold_days") * dates.DAY_SECONDS
    ).cast("long")
    outcomes = (
        attach_sector(requests, communities)
        .drop("threshold_days")
        .join(own, "service_name")
        .select(
            "service_name",
            "comm_name",
            "sector",
            F.timestamp_seconds(seconds).alias("deadline"),
            (F.col("closed_date").isNull() | (F.unix_seconds("closed_date") > seconds))
            .cast("int")
            .alias("late"),
        )
    )
    return History(outcomes, requests.select("service_name", F.col("requested_date").alias("t")))


def _late_asks(history: History, rates) -> list[Ask]:
    decided = Events(history.outcomes, "deadline", "late", "seconds")
    return [Ask(decided, tuple(r.keys), (Span(f"_{r.name}", r.days),)) for r in rates]


def _late_columns(rates) -> dict:
    return {
        r.name: F.when(F.col(f"_{r.name}_n") >= r.min_n, F.col(f"_{r.name}_sum") / F.col(f"_{r.name}_n"))
        for r in rates
    }


def add_late_rates(query: DataFrame, history: History, rates=LATE_RATES) -> DataFrame:
    """Late share of same-key requests whose deadline fell in ``[t - days, t)``; null if few."""
    return _answer(query, _late_asks(history, rates), _late_columns(rates))


def _ratio_asks(history: History) -> list[Ask]:
    filed = Events(history.filed, "t", unit="seconds")
    return [Ask(filed, ("service_name",), (Span("_month", 30), Span("_year", 365)))]


def _ratio_column(min_year: int = 30) -> dict:
    typical = F.greatest(F.col("_year_n") * 30 / F.lit(365.0), F.lit(1e-9))
    return {"cat_backlog_ratio": F.when(F.col("_year_n") >= min_year, F.col("_month_n") / typical)}


def add_backlog_ratio(query: DataFrame, history: History, min_year: int = 30) -> DataFrame:
    """The category's last 30 days over its typical 30 days in the past year."""
    return _answer(query, _ratio_asks(history), _ratio_column(min_year))


def add_history_features(
    frame: DataFrame, history: History, communities: DataFrame, *, backlog: DataFrame | None = None
) -> DataFrame:
    """The six history features in one pass; with ``backlog`` the two 30-day counts as well."""
    asks = _ratio_asks(history) + _late_asks(history, LATE_RATES)
    columns = {**_ratio_column(), **_late_columns(LATE_RATES)}
    if backlog is not None:
        asks += _backlog_asks(backlog)
        columns |= _backlog_columns()
    return _answer(attach_sector(frame, communities), asks, columns)


def build_features(
    df: DataFrame, holidays: DataFrame, *, context: DataFrame | None = None,
    history: History | None = None, communities: DataFrame | None = None, carry=(),
) -> DataFrame:
    """The feature matrix with its id; ``carry`` keeps extra columns outside the matrix.

    With ``history`` and ``communities`` it is the challenger's set, else the baseline's.
    """
    around = df if context is None else context
    if history is None:
        out, columns = add_backlog_features(df, around), FEATURE_SETS["baseline"]
    elif communities is None:
        raise ValueError("history features need the community lookup")
    else:
        out = add_history_features(df, history, communities, backlog=around)
        columns = FEATURE_SETS["challenger"]
    out = add_calendar_features(out, holidays)
    assert_no_leakage(columns)
    return out.select("service_request_id", *columns, *carry)


def featurize(
    frame: DataFrame, raw: DataFrame, thresholds: DataFrame, communities: DataFrame | None,
    holidays: DataFrame, feature_set: str = "challenger", *, context: DataFrame | None = None,
    carry=(),
) -> DataFrame:
    """Features of ``frame``; history looks back over the whole snapshot ``raw``."""
    if feature_set == "baseline":
        return build_features(frame, holidays, context=context, carry=carry)
    history = build_history(raw, thresholds, communities)
    return build_features(
        frame, holidays, context=context, history=history, communities=communities, carry=carry
    )


def of_version(column: str, key: str) -> str:
    """The name that a late rate under the thresholds of ``key`` has beside those of other versions."""
    return f"{column}__{key}"


def featurize_versions(
    frame: DataFrame, raw: DataFrame, thresholds: dict, communities: DataFrame, holidays: DataFrame,
    *, context: DataFrame | None = None, carry=(),
) -> DataFrame:
    """The features of several model versions in one pass over ``frame``.

    ``thresholds`` maps a key to a version's own thresholds, on which its late rates depend; these
    come back under :func:`of_version` names. All other features don't depend on them and come back
    once. However many versions there are, their as-of questions share one join.
    """
    around = frame if context is None else context
    histories = {key: build_history(raw, own, communities) for key, own in thresholds.items()}
    asks, columns = _backlog_asks(around), dict(_backlog_columns())
    for n, (key, history) in enumerate(histories.items()):
        rates = tuple(replace(r, name=of_version(r.name, key)) for r in LATE_RATES)
        asks += _late_asks(history, rates)
        columns |= _late_columns(rates)
        if n == 0:
            asks += _ratio_asks(history)
            columns |= _ratio_column()
    out = _answer(attach_sector(frame, communities) if histories else frame, asks, columns)
    out = add_calendar_features(out, holidays)
    shared = FEATURE_SETS["baseline"] + (("cat_backlog_ratio",) if histories else ())
    rates = tuple(of_version(r.name, key) for key in histories for r in LATE_RATES)
    assert_no_leakage(shared)
    return out.select("service_request_id", *shared, *rates, *carry)


def category_levels(features: DataFrame, columns) -> DataFrame:
    """``(column, level)`` pairs the model was trained on."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in columns])
    )
    return features.select(pairs.alias("p")).select("p.*").where(F.col("level").isNotNull()).distinct()


def align_to_schema(features: DataFrame, columns, levels: DataFrame, categorical, carry=()) -> DataFrame:
    """Saved column order; a level the model never saw becomes null."""
    out = features
    for c in categorical:
        known = levels.where(F.col("column") == c).select(F.col("level").alias("_lv"))
        out = (
            out.join(known, F.col(c) == F.col("_lv"), "left").withColumn(c, F.col("_lv")).drop("_lv")
        )
    return out.select(*columns, *carry)


HISTORY_COLUMNS = HISTORY
