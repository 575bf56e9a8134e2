"""Map inputs as tables: class breaks, bands and polygon rings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.operators.ordered import DAYS_WIDTH, distribution, order_statistics


def filter_min_n(metric: DataFrame, min_n: int) -> DataFrame:
    return metric.where(F.col("n") >= min_n)


def quantile_breaks(df: DataFrame, value: str, k: int = 5, width: float = DAYS_WIDTH) -> DataFrame:
    """One row with the ``k - 1`` interior nearest-rank cut points ``b1 .. b(k-1)``."""
    ranks = {
        f"b{i}": f"(rows * {i} + {k} - 1) div {k} - 1" for i in range(1, k)
    }
    found = order_statistics(distribution(df, [], value), [], ranks, width=width)
    short = F.raise_error(F.lit(f"need at least {k} values"))
    return found.select(
        *[F.when(F.col("rows") < k, short.cast("double")).otherwise(F.col(b)).alias(b) for b in ranks]
    )


_POINTS = "array<array<double>>"


def exterior_rings(features: DataFrame, geometry: str = "geometry") -> DataFrame:
    """``rings``: the outer ring of every (multi)polygon in a GeoJSON geometry, else empty."""
    kind = F.get_json_object(geometry, "$.type")
    coordinates = F.get_json_object(geometry, "$.coordinates")
    one = F.array(F.from_json(coordinates, f"array<{_POINTS}>")[0])
    many = F.transform(F.from_json(coordinates, f"array<array<{_POINTS}>>"), lambda p: p[0])
    none = F.expr(f"CAST(array() AS array<{_POINTS}>)")
    return features.withColumn(
        "rings", F.when(kind == "Polygon", one).when(kind == "MultiPolygon", many).otherwise(none)
    )
