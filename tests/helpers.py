"""Small builders the tests share."""

from __future__ import annotations

import datetime as dt

UTC = dt.timezone.utc

REQUEST = (
    "service_request_id string, requested_date timestamp, closed_date timestamp, service_name string, "
    "agency_responsible string, comm_code string, comm_name string, source string"
)


def day(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


def micros(text: str) -> int:
    return int(day(text).timestamp() * 1_000_000)


def requests(spark, rows):
    """``rows``: (id, requested, closed or None, category[, community])."""
    data = [
        (
            str(r[0]), day(r[1]), day(r[2]) if r[2] else None, r[3], "Roads", "X1",
            r[4] if len(r) > 4 else "X", "Phone",
        )
        for r in rows
    ]
    return spark.createDataFrame(data, REQUEST)


def thresholds(spark, **days):
    return spark.createDataFrame(
        [(k.replace("GLOBAL", "__global__"), float(v)) for k, v in days.items()],
        "service_name string, threshold_days double",
    )
