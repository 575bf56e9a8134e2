"""Sources mixed to target weights along a curriculum whose weights change with time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicspark.llm.columns import WORD, fresh, whole
from civicspark.session import materialize

#: Documents that share one running total, on average.
PER_SLICE = 4096


def rank_sources(sources: DataFrame) -> DataFrame:
    """Adds ``rank``, from 0, by code point with null last.

    Sources are range-partitioned and numbered inside each range, so that no task holds all of them.
    """
    parts = materialize(
        sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources"
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return parts.withColumn("inside", inside).join(starts, "part").withColumn("rank", F.col("first") + F.col("inside") - 1).drop("part", "inside", "first", "n")


def share_targets(sources: DataFrame, max_repeats: int) -> DataFrame:
    """Adds ``target``: the total of all sizes shared by ``weight``, none above ``max_repeats``
    times its source; what is above goes to the others by weight until none is above.

    Each pass is one sum over the sources; the level that one unit of weight gets comes back as
    a single row. A pass fixes at least one more source at its ceiling, or ends.
    """
    cap, weight = F.col("source_size") * max_repeats, F.col("weight")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, fixed = None, -1
    while True:
        capped = F.lit(False) if level is None else weight * F.lit(level) >= cap
        got = sources.agg(
            F.count(F.when(capped, 1)).alias("n"), F.sum(F.when(capped, cap).otherwise(0)).alias("caps"), F.sum(F.when(~capped, weight)).alias("w")
        ).first()
        if got["w"] is None or got["n"] == fixed:
            break
        fixed, level = got["n"], (total - got["caps"]) / got["w"]
    share = F.lit(0.0) if level is None else F.least(cap.cast("double"), weight * F.lit(float(level)))
    return sources.withColumn("target", share.cast("double"))


def when_due(demand: Column, start: Column, end: Column) -> Column:
    """The moment in [0, 1] by which a source whose weight goes linearly from ``start`` to ``end``
    has used the share ``demand`` of its tokens: the inverse of the integrated schedule."""
    slope, need = end - start, demand * (start + end) / 2
    root = F.sqrt(F.greatest(start * start + 2 * slope * need, F.lit(0.0)))
    # 2 * need / (start + root) is the root that also holds for a flat schedule.
    return F.least(F.lit(1.0), F.coalesce(F.try_divide(2 * need, start + root), F.lit(0.0)))


def plan_mix(
    docs: DataFrame, weights: tuple = (1, 2, 3), schedules: tuple = ((1.0, 1.0), (2.0, 1.0), (1.0, 3.0)), max_repeats: int = 3,
    seed: str = "", doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """One row per document: id, size, source, source_size, target, copies, taken, body, start, end, offset.

    A document's size is its number of words (null: 0). Sources ranked by code point, null last,
    take ``weights`` and the (start, end) weights of ``schedules`` in turn. Every document is taken
    target // source_size times; what is left goes to documents in the order of a keyed digest of
    their id, a document that straddles the end counting if at least half of it is inside. So a
    source meets its target to within half a document and no document is taken more than
    ``max_repeats`` times. Reruns agree, whatever the partitions; rows equal in id, source and text
    are interchangeable and get copies of their own; a source without words takes nothing.

    A source's running total is cut into slices of some thousand documents by the digest: slice
    totals are summed first, then each slice on its own, so that a source of a third of all rows
    is spread over the cluster.
    """
    sized = materialize(
        docs.select(
            F.col(doc_id).alias("id"), F.col(source).alias("source"), F.regexp_count(whole(text), F.lit(WORD)).cast("long").alias("size"),
            F.xxhash64(whole(text)).alias("body"),
            F.md5(F.concat(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary")).alias("order"),
        ),
        "sized",
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    turn = F.col("rank").cast("int")
    pick = lambda values: F.element_at(F.array(*(F.lit(v) for v in values)), (turn % len(values) + 1).cast("int"))
    ranked = rank_sources(totals).withColumn("weight", pick(weights))
    ranked = ranked.withColumn("start", pick([float(a) for a, _ in schedules])).withColumn("end", pick([float(b) for _, b in schedules]))
    sources = share_targets(materialize(ranked, "ranked"), max_repeats)
    ratio = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))
    sources = materialize(
        sources.withColumn("full", F.least(F.floor(ratio), F.lit(max_repeats)).cast("long"))
        .withColumn("rest", F.col("target") - F.col("full") * F.col("source_size"))
        .withColumn("slices", F.ceil(F.col("n_docs") / PER_SLICE).cast("long")),
        "targets",
    )
    at = F.conv(F.substring("order", 1, 12), 16, 10).cast("double") / float(16**12)
    rows = sized.join(sources.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    rows = rows.withColumn("slice", F.floor(at * F.col("slices")))
    past = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = rows.groupBy("source", "slice").agg(F.sum("size").alias("s")).withColumn("before", F.coalesce(F.sum("s").over(past), F.lit(0)))
    slices = slices.select(F.col("source").alias("s_source"), F.col("slice").alias("s_slice"), "before")
    own = Window.partitionBy("source", "slice").orderBy("order", "size", "body").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(own), F.lit(0)))
    rows = rows.join(slices, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("slice") == F.col("s_slice")))
    offset = F.col("before") + F.col("inside")
    extra = ((offset + F.col("size") / 2 <= F.col("rest")) & (F.col("full") < max_repeats)).cast("long")
    copies = F.when(F.col("size") > 0, F.col("full") + extra).otherwise(0).cast("long")
    return rows.select(
        "id", "size", "source", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), "body", "start", "end",
        offset.alias("offset"),
    )


def positions(plan: DataFrame) -> DataFrame:
    """One row per copy that the mix takes: id, body, copy, position in [0, 1].

    Copy k of a document stands at the tokens its source has used by then; the source's integrated
    schedule turns that demand into a moment of the training run.
    """
    copies = plan.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    used = (F.col("copy") - 1) * F.col("source_size") + F.col("offset")
    return copies.select("id", "body", "copy", when_due(F.least(F.lit(1.0), used / F.col("target")), F.col("start"), F.col("end")).alias("position"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The training order itself: the columns of ``docs``, a row per copy, range-sorted by position.

    Documents the mix doesn't take are left out, repeated ones are repeated. A row of ``docs`` is
    met by id and text. Rows equal in both would meet each other's copies, so only one of them is
    matched, which then stands for the copies of all.
    """
    plan = plan_mix(docs, doc_id=doc_id, text=text, **options)
    p = fresh(docs)
    due = positions(plan)
    one = docs.withColumn(p + "body", F.xxhash64(whole(text)))
    twins = plan.groupBy("id", "body").count().filter("count > 1").limit(1).count()
    if twins:
        one = one.dropDuplicates([doc_id, p + "body"])
    due = due.select(*(F.col(c).alias(p + "due_" + c) for c in due.columns))
    met = one.join(due, F.col(doc_id).eqNullSafe(F.col(p + "due_id")) & (F.col(p + "body") == F.col(p + "due_body")))
    order = [F.col(p + "due_position"), F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.col(p + "due_copy")]
    return met.repartitionByRange(*order).sortWithinPartitions(*order).select(*docs.columns)


def op2_mix(spark, sf_dir: str) -> DataFrame:
    plan = plan_mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    due = when_due(F.least(F.lit(1.0), F.coalesce(F.try_divide(F.col("offset").cast("double"), F.col("target")), F.lit(0.0))), F.col("start"), F.col("end"))
    out = plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies", due.alias("first_position"))
    return out.repartitionByRange("first_position", "doc_id").sortWithinPartitions("first_position", "doc_id").drop("first_position")


OP2_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source
),
levels AS (
  SELECT 0 AS step, (SELECT sum(source_size) FROM sources)::DOUBLE / (SELECT sum(weight) FROM sources)::DOUBLE AS level, 0::BIGINT AS fixed
  UNION ALL
  SELECT step + 1,
         ((SELECT sum(source_size) FROM sources) - coalesce((SELECT sum(3 * source_size) FROM sources WHERE weight * level >= 3 * source_size), 0))::DOUBLE
           / (SELECT sum(weight) FROM sources WHERE NOT weight * level >= 3 * source_size)::DOUBLE,
         (SELECT count(*) FROM sources WHERE weight * level >= 3 * source_size)
  FROM levels
  WHERE (SELECT count(*) FROM sources WHERE weight * level >= 3 * source_size) > fixed
    AND EXISTS (SELECT 1 FROM sources WHERE NOT weight * level >= 3 * source_size)
),
targets AS (
  SELECT s.*, least((3 * source_size)::DOUBLE, weight * (SELECT level FROM levels ORDER BY step DESC LIMIT 1)) AS target FROM sources s
),
planned AS (
  SELECT t.*, CASE WHEN source_size = 0 THEN 0 ELSE least(floor(target / source_size::DOUBLE), 3)::BIGINT END AS full_copies FROM targets t
),
placed AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.full_copies, p.target - p.full_copies * p.source_size AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(d.doc_id::VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized d JOIN planned p ON d.source IS NOT DISTINCT FROM p.source
),
done AS (
  SELECT *, CASE WHEN size = 0 THEN 0
                 ELSE full_copies + CASE WHEN before + size / 2.0 <= rest AND full_copies < 3 THEN 1 ELSE 0 END END AS copies
  FROM placed
)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies::BIGINT AS copies FROM done
"""
