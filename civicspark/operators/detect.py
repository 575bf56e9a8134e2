"""Detectors over monthly series and short job histories.

Series tables have one row per (series keys, month), so their windows are bounded by the
number of months.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicspark.operators.ordered import distribution, order_statistics, running_before
from civicspark.session import materialize
from civicspark.settings import ControlSettings


def ratio_flags(
    df: DataFrame, kind: str, value: str, *, factor: float = 2.0, name: str = "flag",
    width: float = 1.0 / 64, only=None,
) -> DataFrame:
    """True where ``value`` exceeds ``factor`` x the median of the other values of its kind.

    The median without one member needs only the two or three middle values of the kind, so
    no row is compared with another. Kinds with fewer than three values never flag. Rows
    outside ``only`` are neither judged nor counted.
    """
    judged = F.col(value).isNotNull() if only is None else only & F.col(value).isNotNull()
    dist = distribution(df.where(judged & F.col(kind).isNotNull()), [kind], value)
    middle = {
        "_below": "greatest(rows div 2 - 1, 0)",
        "_mid": "rows div 2",
        "_above": "least(rows div 2 + 1, rows - 1)",
    }
    mid = materialize(
        order_statistics(dist, [kind], middle, width=width).withColumnRenamed("rows", "_rows"), "middles"
    )
    v, lo, at, hi = F.col(value), F.col("_below"), F.col("_mid"), F.col("_above")
    odd = (
        F.when(v < at, (at + hi) / 2).when(v > at, (lo + at) / 2).otherwise((lo + hi) / 2)
    )
    even = F.when(v <= lo, at).otherwise(lo)
    others = F.when(F.col("_rows") % 2 == 1, odd).otherwise(even)
    verdict = judged & (F.col("_rows") >= 3) & (v > factor * others)
    return (
        df.join(mid, kind, "left")
        .withColumn(name, F.coalesce(verdict, F.lit(False)))
        .drop("_rows", "_below", "_mid", "_above")
    )


def seasonal_residuals(
    df: DataFrame, keys, month: str = "month", value: str = "value", name: str = "residual"
) -> DataFrame:
    """Each month minus the mean of the same calendar month in earlier years; else null."""
    earlier = (
        Window.partitionBy(*keys, F.month(month))
        .orderBy(F.year(month))
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    return df.withColumn(name, F.col(value) - F.avg(value).over(earlier))


#: Points of a series up to which one window numbers it.
SHORT = 1 << 16
#: Points of a block, at most, and how far the powers of the decay may stretch within one.
BLOCK, STRETCH = 4096, 250.0


def decaying_sum(df: DataFrame, keys, index: str, value: str, decay: float, longest: int, name: str = "sum") -> DataFrame:
    """Adds ``name``: ``s_i = decay * s_(i-1) + value_i`` along each series, with nothing before the first.

    ``index`` numbers a series' points from 0 without gaps. The step is an affine map, and maps
    compose: blocks of points are summed side by side, the blocks' own totals are a series with the
    decay of a whole block, and are summed the same way; then every point adds what its block
    was handed. A window never holds more than a block, whatever the length of a series (``longest``).
    """
    if decay == 0.0:
        return df.withColumn(name, F.col(value))
    size = int(max(2, min(BLOCK, STRETCH / -math.log10(decay)))) if decay < 1.0 else BLOCK
    # inside a block, the powers of the decay turn the recursion into a running sum
    own = df.withColumns({"_block": F.expr(f"`{index}` div {size}"), "_place": F.col(index) % size})
    power = F.pow(F.lit(decay), F.col("_place").cast("double"))
    inside = Window.partitionBy(*keys, "_block").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = own.withColumn("_own", F.sum(F.col(value) / power).over(inside) * power)
    if longest <= size:
        return own.withColumn(name, F.col("_own")).drop("_block", "_place", "_own")
    ends = own.where(F.col("_place") == size - 1).select(*keys, F.col("_block").alias("_index"), F.col("_own").alias("_total"))
    ends = materialize(ends, "block-totals")
    handed = decaying_sum(ends, keys, "_index", "_total", decay**size, longest // size, "_sum")
    handed = handed.select(*keys, (F.col("_index") + 1).alias("_block"), F.col("_sum").alias("_handed"))
    both = own.join(handed, [*keys, "_block"], "left")
    carried = F.coalesce(F.col("_handed"), F.lit(0.0)) * power * decay
    return both.withColumn(name, F.col("_own") + carried).drop("_block", "_place", "_own", "_handed")


def _numbered(df: DataFrame, keys, order: str) -> DataFrame:
    """Adds ``_i``, each row's place in its series from 0; slices are parts of the series' own range."""
    at = df.withColumn("_at", F.unix_micros(F.col(order).cast("timestamp")).cast("double"))
    span = at.groupBy(*keys).agg(((F.max("_at") - F.min("_at")) / 4096 + 1.0).alias("_width"))
    line = at.select(*keys, "_at").withColumn("_one", F.lit(1)).join(span, keys)
    return at.join(running_before(line, keys, "_at", ["_one"], width="_width", prefix="_i_").select(*keys, "_at", F.col("_i__one").alias("_i")), [*keys, "_at"]).drop("_at")


def ewma_flags(
    df: DataFrame, keys, month: str = "month", value: str = "residual", name: str = "ewma_flag",
    settings: ControlSettings | None = None,
) -> DataFrame:
    """True where the EWMA of ``value`` leaves its control limits.

    Mean and sigma come from the first ``min_points`` non-null points. The recursion
    ``z = w x + (1 - w) z`` starts at the mean and is summed block by block.
    """
    s, keys = settings or ControlSettings(), list(keys)
    w, decay = s.weight, 1.0 - s.weight
    present = df.where(F.col(value).isNotNull()).select(*keys, month, F.col(value).cast("double").alias("_x"))
    most = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if most <= SHORT:
        points = present.withColumn("_i", F.row_number().over(Window.partitionBy(*keys).orderBy(month)) - 1)
    else:
        points = materialize(_numbered(present, keys, month), "points")
    early = F.when(F.col("_i") < s.min_points, F.col("_x"))
    base = points.groupBy(*keys).agg(F.avg(early).alias("_mu"), F.stddev_samp(early).alias("_sigma"), F.count(F.lit(1)).alias("_n"))
    base = materialize(base.where((F.col("_n") >= s.min_points) & (F.col("_sigma") > 0)), "limits")
    longest = base.agg(F.max("_n")).first()[0]
    if longest is None:
        return df.withColumn(name, F.lit(False))
    charted = points.join(base, keys).withColumn("_u", F.lit(w) * F.col("_x"))
    summed = decaying_sum(charted, keys, "_i", "_u", decay, longest, "_s")
    steps = F.col("_i").cast("double") + 1.0
    z = F.col("_s") + F.pow(F.lit(decay), steps) * F.col("_mu")
    spread = F.lit(w / (2.0 - w)) * (1.0 - F.pow(F.lit(decay), 2.0 * steps))
    out = F.abs(z - F.col("_mu")) > F.lit(s.limit) * F.col("_sigma") * F.sqrt(spread)
    return df.join(summed.select(*keys, month, out.alias(name)), [*keys, month], "left").withColumn(name, F.coalesce(name, F.lit(False)))


def sustained(
    df: DataFrame, keys, flag: str, month: str = "month", name: str = "sustained", run: int = 3
) -> DataFrame:
    """Keep only flags that belong to ``run`` or more consecutive flags of their series."""
    ordered = Window.partitionBy(*keys).orderBy(month)
    turn = (F.col(flag) != F.lag(flag).over(ordered)).cast("int")
    block = F.sum(F.coalesce(turn, F.lit(0))).over(
        ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys, "_block"))
    return (
        df.withColumn("_block", block)
        .withColumn(name, F.col(flag) & (size >= run))
        .drop("_block")
    )
