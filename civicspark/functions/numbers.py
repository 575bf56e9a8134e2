"""Bands, ratios and cost."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicspark.settings import HOURLY_USD, RATIO_BREAKS, SPOT_FACTOR


def ratio(top: str, bottom: str) -> Column:
    """``top / bottom``, null when ``bottom`` is zero or null."""
    return F.col(top) / F.nullif(F.col(bottom).cast("double"), F.lit(0.0))


def band(value, breaks) -> Column:
    """How many of ``breaks`` lie below ``value``: 0 is the lowest class."""
    value = F.col(value) if isinstance(value, str) else value
    steps = [(value > F.lit(float(b))).cast("long") for b in breaks]
    return reduce(lambda a, b: a + b, steps, F.lit(0).cast("long"))


def ratio_band(value) -> Column:
    return band(value, RATIO_BREAKS)


def cost_usd(instance_type, seconds, count: int = 1, spot: bool = False, rates=None) -> Column:
    """Hourly rate x hours x instances, to 4 decimals; an unlisted type costs nothing."""
    pairs = [F.lit(x) for kv in (rates or HOURLY_USD).items() for x in kv]
    hourly = F.coalesce(F.try_element_at(F.create_map(*pairs), instance_type), F.lit(0.0))
    return F.round(hourly * (SPOT_FACTOR if spot else 1.0) * (seconds / 3600.0) * count, 4)
