"""As-of aggregates: what had happened to a key in a window before each row's own time."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicspark.functions.dates import DAY_MICROS
from civicspark.session import materialize

NO_KEY = "__na__"  # a null key is a key of its own
# Slices of a key's time line: a week holds 604,800 whole seconds and a decade 520 weeks; finer
# clocks get slices of an hour. A slice with more moments than SLICE_ROWS is cut further.
SECONDS_SLICE = 7 * DAY_MICROS
MICROS_SLICE = DAY_MICROS // 24
SLICE_ROWS = 1 << 20


@dataclass(frozen=True)
class Span:
    """One look-back window: ``days`` long, written to ``<name>_n`` and ``<name>_sum``."""

    name: str
    days: int


def _names(keys) -> list[str]:
    return [f"_k_{k}" for k in keys]


def _keyed(keys) -> list[Column]:
    return [
        F.coalesce(F.col(k).cast("string"), F.lit(NO_KEY)).alias(n)
        for k, n in zip(keys, _names(keys), strict=True)
    ]


@dataclass(frozen=True)
class Events:
    """What is counted: a table, its time, an optional summed value, and the clock's unit.

    ``unit="seconds"`` floors both the events' and the rows' times to whole seconds.
    """

    df: DataFrame
    time: str
    value: str | None = None
    unit: str = "micros"


@dataclass(frozen=True)
class Ask:
    """One as-of question: which events, by which keys, over which spans."""

    events: Events
    keys: tuple
    spans: tuple


def _clock(unit: str, micros: str) -> str:
    return f"floor({micros} / 1000000) * 1000000" if unit == "seconds" else micros


def _joined(keys) -> str:
    return f"concat_ws('\\u001f', {', '.join(_names(keys))})"


def _facts(source: Events, asks) -> DataFrame:
    """Events counted once by every key in use, then spread over the questions about them."""
    used = list(dict.fromkeys(k for _, a in asks for k in a.keys))
    cube = (
        source.df.where(F.col(source.time).isNotNull())
        .withColumn("_e", F.unix_micros(source.time))
        .groupBy(*_keyed(used), F.expr(_clock(source.unit, "_e")).alias("_at"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            (F.sum(source.value) if source.value else F.lit(0.0)).cast("double").alias("s"),
        )
    )
    spread = ", ".join(f"struct({q} AS _q, {_joined(a.keys)} AS _k)" for q, a in asks)
    return (
        cube.selectExpr(f"inline(array({spread}))", "_at", "n", "s")
        .groupBy("_q", "_k", "_at")
        .agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    )


def _probes(points: DataFrame, asks) -> DataFrame:
    """Per question and distinct (key, time): the moment itself (mark 0) and each span's start."""
    moments = points.selectExpr(f"inline(array({_wanted(asks)}))").distinct()
    marks = " ".join(
        f"WHEN {q} THEN array("
        + ", ".join(
            f"struct({m} AS _mark, _own - {days * DAY_MICROS} AS _at)"
            for m, days in enumerate([0, *(s.days for s in a.spans)])
        )
        + ")"
        for q, a in enumerate(asks)
    )
    return moments.selectExpr("_q", "_k", "_own", f"inline(CASE _q {marks} END)")


def _sliced(line: DataFrame, keys, at: str, width: str) -> DataFrame:
    """Adds ``_cut``, the start of the slice that a moment is in; ``width`` is the SQL of its length.

    A slice that holds more than ``SLICE_ROWS`` moments, as in a burst, is cut in 64, and so on
    down to a microsecond; the counts decide, so no (key, slice) grows with the data. The place
    of a moment is a function of its time alone.
    """
    place = F.expr(f"coalesce({at} - pmod({at}, _width), 0L)")  # never null, see ordered._slice
    cut = line.withColumn("_width", F.expr(width)).withColumn("_cut", place)
    here = [*keys, "_cut", "_width"]
    while True:
        dense = cut.groupBy(*here).agg(F.count(F.lit(1)).alias("_m")).where((F.col("_m") > SLICE_ROWS) & (F.col("_width") > 1))
        dense = materialize(dense.select(*here, F.lit(True).alias("_dense")), "dense-slices")
        if not dense.limit(1).count():
            return cut.drop("_width")
        finer = F.when(F.col("_dense"), F.greatest(F.expr("_width div 64"), F.lit(1))).otherwise(F.col("_width"))
        cut = cut.join(dense, here, "left").withColumn("_width", finer).withColumn("_cut", place).drop("_dense")


def _totals(facts: DataFrame, probes: DataFrame, asks, closed: str) -> DataFrame:
    """Per (key, time), the running count and sum at each mark: ``_n0, _s0, _n1, ...``."""
    line = facts.selectExpr(
        "_q", "_k", "_at", "n", "s", "CAST(NULL AS bigint) AS _own", "CAST(NULL AS int) AS _mark"
    ).unionByName(
        probes.selectExpr("_q", "_k", "_at", "0L AS n", "0D AS s", "_own", "_mark")
    )
    coarse = ", ".join(str(q) for q, a in enumerate(asks) if a.events.unit == "seconds") or "-1"
    width = f"CASE WHEN _q IN ({coarse}) THEN {SECONDS_SLICE}L ELSE {MICROS_SLICE}L END"
    line = _sliced(materialize(line, "moments"), ["_q", "_k"], "_at", width)
    here = ["_q", "_k", "_cut"]
    inside = (
        Window.partitionBy(*here)
        .orderBy("_at")
        .rangeBetween(Window.unboundedPreceding, -1 if closed == "left" else 0)
    )
    earlier = Window.partitionBy("_q", "_k").orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        line.groupBy(*here)
        .agg(F.sum("n").alias("_n"), F.sum("s").alias("_s"))
        .select(*here, F.sum("_n").over(earlier).alias("_off_n"), F.sum("_s").over(earlier).alias("_off_s"))
    )
    ran = (
        line.select("*", F.sum("n").over(inside).alias("_in_n"), F.sum("s").over(inside).alias("_in_s"))
        .where("_mark IS NOT NULL")
        .join(offsets.hint("merge"), here)
        .selectExpr(
            "_q", "_k", "_own", "_mark",
            "coalesce(_in_n, 0L) + coalesce(_off_n, 0L) AS _n",
            "coalesce(_in_s, 0D) + coalesce(_off_s, 0D) AS _s",
        )
    )
    most = max(len(a.spans) for a in asks)
    return ran.groupBy("_q", "_k", "_own").agg(
        *[
            F.expr(f"sum({c}) FILTER (WHERE _mark = {m})").alias(f"{c}{m}")
            for m in range(most + 1)
            for c in ("_n", "_s")
        ]
    )


def _wanted(asks) -> str:
    """Each question about a point: its number, key and moment, as an array of structs."""
    return ", ".join(
        f"struct({q} AS _q, {_joined(a.keys)} AS _k, {_clock(a.events.unit, '_t')} AS _own)"
        for q, a in enumerate(asks)
    )


def range_agg_many(rows: DataFrame, row_time: str, asks, closed: str = "left") -> DataFrame:
    """``rows`` plus, per question and span, how many same-key events came before the row.

    ``closed="left"`` counts ``[t - d, t)``, ``closed="right"`` counts ``(t - d, t]``. Every
    question runs through one pass over (question, key, slice), so the cost grows with
    neither the window length nor the number of plans. The distinct (keys, time) combinations
    of the rows ask all their questions at once: one join on (question, key, time), one
    grouping back, and one join to the rows, so a wide row is shuffled at most once.
    """
    keys = list(dict.fromkeys(k for a in asks for k in a.keys))
    names = _names(keys)
    asked = rows.withColumns(
        {**dict(zip(names, _keyed(keys), strict=True)), "_t": F.unix_micros(row_time)}
    )
    points = asked.where("_t IS NOT NULL").select(*names, "_t").distinct()
    numbered = list(enumerate(asks))
    sources = {id(a.events): a.events for a in asks}
    facts = reduce(
        DataFrame.unionByName,
        [_facts(e, [(q, a) for q, a in numbered if a.events is e]) for e in sources.values()],
    )
    totals = _totals(facts, _probes(points, asks), asks, closed)
    # both sides and the answers grow with the rows, which a plan takes for less behind ``inline``
    met = points.selectExpr(*names, "_t", f"inline(array({_wanted(asks)}))").join(totals.hint("merge"), ["_q", "_k", "_own"])
    answers = met.groupBy(*names, "_t").agg(
        *[
            F.expr(f"max({c}0 - {c}{i}) FILTER (WHERE _q = {q})").alias(f"{s.name}{end}")
            for q, a in numbered
            for i, s in enumerate(a.spans, 1)
            for c, end in (("_n", "_n"), ("_s", "_sum"))
        ]
    )
    return asked.join(answers.hint("merge"), [*names, "_t"], "left").drop(*names, "_t")


def range_agg(
    rows: DataFrame, events: DataFrame, *, keys, row_time: str, event_time: str, spans,
    value: str | None = None, closed: str = "left", unit: str = "micros",
) -> DataFrame:
    """:func:`range_agg_many` with one question."""
    source = Events(events, event_time, value, unit)
    return range_agg_many(rows, row_time, [Ask(source, tuple(keys), tuple(spans))], closed)


def last_before(
    rows: DataFrame, events: DataFrame, *, keys, row_time: str, event_time: str, value: str,
    name: str, slice_micros: int = DAY_MICROS,
) -> DataFrame:
    """``rows`` plus the ``value`` of the newest same-key event at or before the row's time.

    Of several events at one instant the largest ``value`` counts. The last value of each
    slice is carried forward in a small window over slices; a slice that a burst fills is cut
    further, by its count.
    """
    names = _names(keys)
    facts = (
        events.where(F.col(event_time).isNotNull() & F.col(value).isNotNull())
        .groupBy(*_keyed(keys), F.unix_micros(event_time).alias("_t"))
        .agg(F.max(value).alias("_v"))
    )
    asked = rows.withColumns(
        {**dict(zip(names, _keyed(keys), strict=True)), "_t": F.unix_micros(row_time)}
    )
    line = (
        facts.withColumn("_ask", F.lit(0))
        .unionByName(
            asked.select(*names, "_t").distinct().withColumn("_ask", F.lit(1)),
            allowMissingColumns=True,
        )
    )
    line = _sliced(materialize(line, "moments"), names, "_t", f"{slice_micros}L")
    inside = (
        Window.partitionBy(*names, "_cut").orderBy("_t", "_ask")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    per_slice = line.groupBy(*names, "_cut").agg(
        F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_t"))).alias("_tail")
    )
    group = Window.partitionBy(*names).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_slice.select(
        *names, "_cut", F.last("_tail", ignorenulls=True).over(group).alias("_carry")
    )
    found = (
        line.withColumn("_here", F.last("_v", ignorenulls=True).over(inside))
        .where(F.col("_ask") == 1)
        .join(carried.hint("merge"), [*names, "_cut"])
        .select(*names, "_t", F.coalesce("_here", "_carry").alias(name))
    )
    return asked.join(found.hint("merge"), [*names, "_t"], "left").drop(*names, "_t")
