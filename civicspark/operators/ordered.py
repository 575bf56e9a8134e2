"""Order-dependent aggregates that no single task has to finish alone.

A window over ``PARTITION BY key ORDER BY x`` sends a whole key to one task. Here each key
is cut into slices of the ordering value (``floor(x / width)``), the slice totals are summed
in their own small window, and the running part stays inside a slice. The slice is a pure
function of the value, so a recomputed task always places rows the same way. With the width
near the square root of ``range x resolution`` both windows stay bounded however many rows a
key holds, because equal values are counted before they are ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Days at microsecond resolution: about 21 s per slice.
DAYS_WIDTH = 1.0 / 4096
# Counts and other plain numbers.
VALUES_WIDTH = 1.0
# Scores in [0, 1].
SCORE_WIDTH = 1.0 / (1 << 20)


def distribution(df: DataFrame, keys, value, name: str = "value", extra=()) -> DataFrame:
    """One row per (keys, value) with its count ``n`` (and ``extra`` sums); combined map-side."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias(name))
        .agg(F.count(F.lit(1)).alias("n"), *extra)
    )


def _slice(order: str, width: float | str) -> Column:
    # a name stands for a column of ``df``: each key brings a width that suits its own range
    # never null, so no branch of the plan gains a filter the other lacks and the exchange
    # below both of them is reused
    unit = f"`{width}`" if isinstance(width, str) else f"{width!r}D"
    return F.expr(f"coalesce(floor(`{order}` / {unit}), 0L)")


#: Cells that a digit tells apart.
DIGIT = 1 << 16


def _digit(start: str, unit: str) -> Column:
    """The cell of ``value`` from ``start`` on; it never falls as the value grows."""
    return F.expr(f"CAST(greatest(least(floor((CAST(value AS double) - ({start})) / {unit}), {DIGIT - 1}), 0) AS bigint)")


def _quoted(names) -> list[str]:
    return [f"`{n}`" for n in names]


def running_before(
    df: DataFrame, keys, order: str, sums, *, width: float | str, prefix: str = "before_"
) -> DataFrame:
    """Add, for each of ``sums``, its total over rows of the same keys with a smaller ``order``.

    ``df`` has one row per (keys, order), with no null among the keys.
    """
    cut = df.withColumn("_cut", _slice(order, width))
    here = [*keys, "_cut"]
    first = Window.unboundedPreceding
    inside = Window.partitionBy(*here).orderBy(order).rowsBetween(first, -1)
    earlier = Window.partitionBy(*keys).orderBy("_cut").rowsBetween(first, -1)
    offsets = cut.groupBy(*here).agg(*[F.sum(s).alias(s) for s in sums]).select(
        *here, *[F.sum(s).over(earlier).alias(f"_off_{s}") for s in sums]
    )
    ran = cut.select("*", *[F.sum(s).over(inside).alias(f"_in_{s}") for s in sums])
    return ran.join(offsets, here).selectExpr(
        *_quoted(df.columns), *[f"coalesce(_in_{s}, 0) + coalesce(_off_{s}, 0) AS {prefix}{s}" for s in sums]
    )


def _located(cells: DataFrame, keys, ranks: DataFrame | str, cut: str) -> DataFrame:
    """Which cell of each key (and question) holds the wanted rank, and the rank inside it."""
    earlier = Window.partitionBy(*keys).orderBy(cut).rowsBetween(Window.unboundedPreceding, -1)
    before = cells.withColumn("_b", F.coalesce(F.sum("_m").over(earlier), F.lit(0)))
    if isinstance(ranks, str):
        before = before.withColumn("rows", F.sum("_m").over(Window.partitionBy(*keys))).selectExpr("*", f"inline(array({ranks}))")
    return before.where("_at >= _b AND _at < _b + _m").withColumn("_at", F.col("_at") - F.col("_b")).drop("_b", "_m")


def _matching(left: list[str], right: DataFrame, names: list[str]) -> tuple[DataFrame, Column]:
    """``right`` under names of its own, and the null-safe condition that joins it."""
    renamed = right.withColumnsRenamed({n: f"_r_{n}" for n in names})
    return renamed, F.expr(" AND ".join(f"`{n}` <=> `_r_{n}`" for n in left))


def order_statistics(dist: DataFrame, keys, ranks: dict, *, width: float | str | None = None) -> DataFrame:
    """The values at given 0-based ranks of each key, plus the key's ``rows``.

    ``dist`` comes from :func:`distribution`; ``ranks`` maps an output column to an SQL
    expression over ``rows``. Cell counts locate the cell that holds each rank, and only what is
    in it is looked at again. Without a ``width`` the cells are digits of the place in the key's own
    range, two of 16 bits: whatever the range and however many values there are, no window sees
    more than 65,536 cells, and the last one only the values of a 2**32nd part of the range.
    """
    keys = list(keys)
    wanted = ", ".join(f"struct('{k}' AS _what, CAST({r} AS bigint) AS _at)" for k, r in ranks.items())
    if width is not None:
        cut = dist.withColumn("_cut", _slice("value", width))
    else:
        span = dist.groupBy(*keys).agg(F.min("value").cast("double").alias("_lo"), F.max("value").cast("double").alias("_hi"))
        unit = F.coalesce(F.nullif((F.col("_hi") - F.col("_lo")) / DIGIT, F.lit(0.0)), F.lit(1.0))
        spans, same = _matching(keys, span.select(*keys, "_lo", unit.alias("_unit")), keys) if keys else (span.select("_lo", unit.alias("_unit")), F.lit(True))
        cut = dist.join(spans, same).drop(*[f"_r_{k}" for k in keys]).withColumn("_cut", _digit("_lo", "_unit"))
    found = _located(cut.groupBy(*keys, "_cut").agg(F.sum("n").alias("_m")), keys, wanted, "_cut")
    found, same = _matching([*keys, "_cut"], found, [*keys, "_cut"])
    held = cut.join(found, same).drop(*[f"_r_{k}" for k in (*keys, "_cut")])
    here = [*keys, "_what"]
    if width is None:
        finer = held.withColumn("_cut", _digit("_lo + _cut * _unit", f"(_unit / {DIGIT})"))
        cells = finer.groupBy(*here, "_cut").agg(F.sum("n").alias("_m"), F.max("_at").alias("_at"))
        found, same = _matching([*here, "_cut"], _located(cells, here, finer, "_cut").select(*here, "_cut", "_at"), [*here, "_cut", "_at"])
        held = finer.drop("_at").join(found, same).withColumnRenamed("_r__at", "_at")
    upto = Window.partitionBy(*here).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit = held.select(*keys, "value", "n", "rows", "_what", "_at", F.sum("n").over(upto).alias("_upto")).where("_at < _upto AND _at >= _upto - n")
    return hit.groupBy(*keys).agg(
        F.max("rows").alias("rows"),
        *[F.expr(f"max(value) FILTER (WHERE _what = '{k}')").alias(k) for k in ranks],
    )


def quantiles(dist: DataFrame, keys, points: dict, *, width: float | str | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles: ``points`` maps an output column to a fraction."""
    ranks, out = {}, []
    for name, q in points.items():
        place, lo, hi = f"(rows - 1) * {float(q)!r}D", f"_lo_{name}", f"_hi_{name}"
        ranks |= {lo: f"floor({place})", hi: f"ceil({place})"}
        out.append(f"{lo} + ({hi} - {lo}) * ({place} - floor({place})) AS {name}")
    return order_statistics(dist, keys, ranks, width=width).selectExpr(*_quoted(keys), "rows", *out)


def rank_rows(
    df: DataFrame, keys, score: str, row_id: str, *, width: float = SCORE_WIDTH,
    name: str = "rank", descending: bool = True, parts: int = 3,
) -> DataFrame:
    """Add the 1-based rank of each row in its keys by ``score``; ties go by ``md5(row_id)``.

    The digest gives ties a fixed order that also splits them: a tie that holds most of a
    key is numbered in 16**``parts`` parts, 4,096 by default. A null key ranks on its own; a null score ranks last.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    order = -F.col(score) if descending else F.col(score)
    digest = F.md5(F.coalesce(F.col(row_id).cast("string"), F.lit("")).cast("binary"))
    tagged = df.withColumns(
        {
            **{
                n: F.coalesce(F.col(k).cast("string"), F.lit("__na__"))
                for n, k in zip(names, keys, strict=True)
            },
            "_o": F.coalesce(order.cast("double"), F.lit(float(1 << 40))),
            "_d": F.coalesce(digest, F.lit("")),
        }
    ).withColumn("_p", F.substring("_d", 1, parts))
    cells = tagged.groupBy(*names, "_o", "_p").agg(F.count(F.lit(1)).alias("n"))
    ties = cells.groupBy(*names, "_o").agg(F.sum("n").alias("n"))
    base = running_before(ties, names, "_o", ["n"], width=width).select(*names, "_o", "before_n")
    within = Window.partitionBy(*names, "_o").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cells.withColumn("_tie", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .join(base, [*names, "_o"])
        .select(*names, "_o", "_p", (F.col("_tie") + F.col("before_n")).alias("_start"))
    )
    inside = Window.partitionBy(*names, "_o", "_p").orderBy("_d", row_id)
    return (
        tagged.withColumn("_r", F.row_number().over(inside))
        .join(starts, [*names, "_o", "_p"])
        .withColumn(name, (F.col("_start") + F.col("_r")).cast("long"))
        .drop(*names, "_o", "_d", "_p", "_r", "_start")
    )


def parts_for(rows: int, most: int = 1 << 20) -> int:
    """Digits of a digest that cut ``rows`` rows in parts of about ``most`` or fewer."""
    parts = 1
    while rows > most << 4 * parts:
        parts += 1
    return parts


def _lowest(df: DataFrame, digest: Column, n: int, name: str) -> tuple[DataFrame, DataFrame, int]:
    """Of ``df`` the rows below the ``n``-th smallest digest, those that share it, and how many of these
    are still wanted. The digest has 52 bits, so a double holds it exactly."""
    keyed = df.withColumn(name, digest)
    cut = order_statistics(distribution(keyed, [], name), [], {"cut": f"least({n}, rows) - 1"}).first()
    edge = F.lit(cut["cut"] if cut and cut["cut"] is not None else -1)
    below = keyed.where(F.col(name) < edge)
    return below.drop(name), keyed.where(F.col(name) == edge).drop(name), n - below.count()


def sample_exactly(df: DataFrame, n: int, row_id: str, seed: int, name: str = "_h") -> DataFrame:
    """``n`` rows (or all, if there are fewer) picked by a seeded digest of the id; the same every time.

    The cut-off digest is an order statistic, so nothing is sorted whole or sent to the driver. Rows
    that share it, those of a repeated id, are told apart by a digest of all their columns; rows
    that are alike in every column can stand for each other.
    """
    if n <= 0:
        return df.limit(0)
    text = F.concat_ws(":", F.lit(str(seed)), F.col(row_id).cast("string"))
    digest = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")
    below, edge, wanted = _lowest(df, digest, n, name)
    if edge.limit(wanted + 1).count() <= wanted:
        return below.unionByName(edge)
    row = F.xxhash64(F.lit(seed), *[F.col(c) for c in df.columns], *[F.col(c).isNull() for c in df.columns])
    first, alike, wanted = _lowest(edge, F.shiftrightunsigned(row, 12), wanted, name)
    return below.unionByName(first).unionByName(alike.limit(wanted))
