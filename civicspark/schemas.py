"""Explicit schemas and column allow-lists; nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

# What is known when a request is filed.
INTAKE_COLUMNS = (
    "service_request_id",
    "requested_date",
    "service_name",
    "agency_responsible",
    "comm_code",
    "comm_name",
    "source",
    "longitude",
    "latitude",
)
# The only columns kept from the public feed (no street address).
ALLOWED_COLUMNS = (*INTAKE_COLUMNS, "updated_date", "closed_date", "status_description", "location_type")
# Columns that give the outcome away.
LEAKY_COLUMNS = (
    "updated_date",
    "closed_date",
    "status_description",
    "days_to_close",
    "breach",
    "purge_closed",
    "censored",
)
# What the gate requires.
REQUIRED_COLUMNS = (*INTAKE_COLUMNS, "closed_date")

DATE_COLUMNS = ("requested_date", "updated_date", "closed_date")
COORDINATE_COLUMNS = ("longitude", "latitude")

RAW_REQUESTS = T.StructType([T.StructField(c, T.StringType()) for c in ALLOWED_COLUMNS])
COMMUNITIES = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("comm_code", "name", "sector", "srg", "class")]
)
METRICS = T.StructType(
    [
        T.StructField("comm_code", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("n", T.DoubleType()),
    ]
)
PREDICTIONS = T.StructType(
    [
        T.StructField("comm_code", T.StringType()),
        T.StructField("breach", T.IntegerType()),
        T.StructField("pred", T.DoubleType()),
    ]
)
# The scored table, in order.
SCORES = T.StructType(
    [
        T.StructField("usage", T.StringType()),
        T.StructField("service_request_id", T.StringType()),
        T.StructField("service_name", T.StringType()),
        T.StructField("comm_code", T.StringType()),
        T.StructField("comm_name", T.StringType()),
        T.StructField("sector", T.StringType()),
        T.StructField("srg", T.StringType()),
        T.StructField("requested_date", T.TimestampType()),
        T.StructField("deadline", T.TimestampType()),
        T.StructField("threshold_days", T.DoubleType()),
        T.StructField("category_seen", T.BooleanType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rank_in_sector", T.LongType()),
        T.StructField("flagged", T.BooleanType()),
        T.StructField("model_ref", T.StringType()),
        T.StructField("snapshot_asof", T.StringType()),
        T.StructField("scored_at", T.StringType()),
    ]
)

# The features of each set, in order, and the years each set trains on.
CATEGORICAL = ("service_name", "agency_responsible", "comm_name", "source")
CALENDAR = ("req_month", "req_dow", "req_is_weekend", "req_is_holiday_week")
BACKLOG = ("cat_open_30d", "comm_req_30d")
HISTORY = (
    "cat_backlog_ratio",
    "cat_late_90d",
    "comm_late_90d",
    "sector_late_90d",
    "cat_sector_late_90d",
    "comm_cat_late_180d",
)
FEATURE_SETS = {
    "baseline": (*CATEGORICAL, *CALENDAR, *BACKLOG),
    "challenger": (*CATEGORICAL, *CALENDAR, *BACKLOG, *HISTORY),
}
TRAIN_YEARS = {"baseline": 0, "challenger": 2}
