"""Near-duplicate documents by b-bit MinHash, confirmed on the full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark.llm.columns import fresh, whole
from civicspark.llm.graph import components
from civicspark.llm.words import groups, hash_words, mix, shingles, slices, text_bytes
from civicspark.session import arrow_rows, materialize

#: 32 bands of 5 minima: two sets of similarity 0.8 share no band once in 300,000 times.
BANDS, ROWS = 32, 5
#: Bits kept of each minimum, and minima in one 64-bit number.
BITS = 4
PACKED = 64 // BITS
#: How far below the threshold the estimate may fall before a candidate is left out: more than
#: four standard deviations of an estimate from 160 minima.
SLACK = 0.14
#: Hubs that the members of a band meet before they meet each other.
HUBS = 3
#: Shingles in one block of what is compared member by member.
BLOCK = 1 << 18
#: Shingles hashed in one go.
CHUNK = 1 << 16
#: Rows that pass to Python at a time, and bytes of text whose words are looked at in one go; the
#: arrays beside them take some twenty times as much.
BATCH, TEXT = 1000, 1 << 20

_RNG = np.random.default_rng(96)
_XOR = _RNG.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
_MUL = _RNG.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = np.random.default_rng(5).integers(0, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of texts: the first text's number, the distinct shingles of all, where each text's
    begin, and which texts have no words; those have a lone 0 here."""
    hashes, first, _ = hash_words(*text_bytes(column))
    all_, at = shingles(hashes, first, width)
    begin, size, sets = 0, 0, []
    for i in range(len(at) - 1):
        own = np.unique(all_[at[i] : at[i + 1]]) if at[i + 1] > at[i] else np.zeros(1, np.uint64)
        sets.append(own)
        size += len(own)
        if size >= CHUNK or i == len(at) - 2:
            starts = np.cumsum([0, *(len(x) for x in sets)])
            yield begin, np.concatenate(sets), starts, np.diff(at[begin : i + 2]) == 0
            begin, size, sets = i + 1, 0, []


def _digests(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set, whatever the order of its members."""
    return np.add.reduceat(mix(values), starts[:-1]).view(np.int64), np.add.reduceat(mix(values * _FACTORS[0]), starts[:-1]).view(np.int64)


def _list(values: np.ndarray) -> pa.Array:
    """Rows of a matrix as lists."""
    n, k = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * k + 1, k), pa.int32()), pa.array(values.reshape(-1).view(np.int64)))


def _features(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", TEXT)):
            for begin, values, starts, blank in _sets(batch["text"], width):
                k = len(starts) - 1
                minima = np.empty((k, BANDS * ROWS), np.uint64)
                for j in range(BANDS * ROWS):
                    minima[:, j] = np.minimum.reduceat((values ^ _XOR[j]) * _MUL[j], starts[:-1])
                minima = mix(minima)
                low = (minima & np.uint64((1 << BITS) - 1)).reshape(k, -1, PACKED)
                signature = np.bitwise_or.reduce(low << (np.arange(PACKED, dtype=np.uint64) * np.uint64(BITS)), axis=2)
                bands = (minima.reshape(k, BANDS, ROWS) * _FACTORS).sum(axis=2, dtype=np.uint64)
                bands = mix(bands + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                k1, k2 = _digests(values, starts)
                n = np.where(blank, 0, np.diff(starts))
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].slice(begin, k), batch["body"].slice(begin, k), pa.array(n.astype(np.int64)), pa.array(k1), pa.array(k2), _list(signature), _list(bands)],
                    names=["id", "body", "n", "k1", "k2", "signature", "bands"],
                )

    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", TEXT)):
            for _, values, starts, _ in _sets(batch["text"], width):
                k1, k2 = _digests(values, starts)
                members = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), members], names=["k1", "k2", "members"])

    return run


def estimate(a: Column, b: Column) -> Column:
    """Similarity from packed signatures: the share of equal b-bit minima, less the share that
    would be equal by chance."""
    parts = BANDS * ROWS // PACKED
    ones = F.lit(sum(1 << (BITS * i) for i in range(PACKED)))
    differ = F.lit(0)
    for i in range(parts):
        x = F.get(a, i).bitwiseXOR(F.get(b, i))
        any_ = x
        for s in range(1, BITS):
            any_ = any_.bitwiseOR(F.shiftrightunsigned(x, s))
        differ = differ + F.bit_count(any_.bitwiseAND(ones))
    chance = 2.0**-BITS
    return (1 - differ / (BANDS * ROWS) - chance) / (1 - chance)


def _sets_of(docs: DataFrame, classes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """cid, members: the full sets of the classes ``wanted``, made again from one text of each."""
    wanted = materialize(classes.join(wanted, "cid", "left_semi").select("cid", "least", "k1", "k2"), "wanted")
    # The ids alone are a small table: while it is, no text is shuffled to find these.
    ids = materialize(wanted.select("least").distinct(), "wanted_ids")
    found = docs.join(ids, F.col("id").eqNullSafe(F.col("least")), "left_semi")
    sets = found.select("text").mapInArrow(_full_sets(width), "k1 long, k2 long, members array<long>")
    sets = sets.join(wanted.select("cid", "k1", "k2"), ["k1", "k2"]).select("cid", "members")
    with arrow_rows(docs.sparkSession, BATCH):
        return materialize(sets.dropDuplicates(["cid"]), "sets")


def _confirm(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold; no group is gathered."""
    both = pairs.join(sets.select(F.col("cid").alias("a"), F.col("members").alias("x")), "a")
    both = both.join(sets.select(F.col("cid").alias("b"), F.col("members").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return materialize(both.filter(100 * shared >= percent * (F.size("x") + F.size("y") - shared)).select("a", "b"), "links")


def _likely(x: str, y: str, percent: int) -> Column:
    """Whether two marks (set size and signature) may belong to sets that reach the threshold:
    their sizes allow it, and so does the estimate."""
    m, n = F.col(f"{x}.n"), F.col(f"{y}.n")
    sizes = 100 * F.least(m, n) >= percent * F.greatest(m, n)
    return sizes & (estimate(F.col(f"{x}.signature"), F.col(f"{y}.signature")) >= percent / 100 - SLACK)


def _labelled(frame: DataFrame, labels: DataFrame, cid: str, name: str) -> DataFrame:
    """Adds the component of column ``cid``: its own number where it has no link yet."""
    own = labels.select(F.col("node").alias(cid), F.col("component").alias(name + "_"))
    return frame.join(own, cid, "left").withColumn(name, F.coalesce(name + "_", cid)).drop(name + "_")


def _block_links(percent: int):
    """Links between members of two blocks that are in different components: sizes and estimate
    choose whom to compare, the full sets decide."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ones = np.uint64(sum(1 << (BITS * i) for i in range(PACKED)))
        enough, chance = percent / 100 - SLACK, 2.0**-BITS
        for group in groups(batches, ("cluster", "p", "q")):
            ids, of, n, block = (group[c].to_numpy() for c in ("cid", "of", "n", "block"))
            marks = group["signature"].combine_chunks() if isinstance(group["signature"], pa.ChunkedArray) else group["signature"]
            marks = np.array(marks.flatten().to_numpy()).view(np.uint64).reshape(len(ids), -1)
            across = group["p"][0].as_py() != group["q"][0].as_py()
            out: tuple[list, list] = ([], [])
            for i in range(len(ids) - 1):
                j = np.arange(i + 1, len(ids))
                low, high = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
                j = j[(of[j] != of[i]) & (100 * low >= percent * high) & ((block[j] != block[i]) | (not across))]
                differ = marks[j] ^ marks[i]
                for shift in range(BITS.bit_length() - 1):
                    differ |= differ >> np.uint64(1 << shift)
                equal = 1 - np.bitwise_count(differ & ones).sum(axis=1) / (BANDS * ROWS)
                j = j[(equal - chance) / (1 - chance) >= enough]
                own = group["members"][i].values.to_numpy() if len(j) else None
                for k in j.tolist():
                    shared = len(np.intersect1d(own, group["members"][k].values.to_numpy(), assume_unique=True))
                    if 100 * shared >= percent * (int(n[i]) + int(n[k]) - shared):
                        out[0].append(int(ids[i]))
                        out[1].append(int(ids[k]))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())], names=["a", "b"])

    return run


def _compared(rows: DataFrame, percent: int) -> DataFrame:
    """The links between components inside each cluster. A cluster is cut in blocks of about as many
    shingles as a task holds easily, and every two blocks meet in a task of their own: what is
    alike without linking is compared there and never becomes a row."""
    sizes = rows.groupBy("cluster").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"))
    own = rows.join(materialize(sizes, "sizes"), "cluster").withColumn("block", F.pmod(F.hash("cid"), F.col("blocks")))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = own.select("cluster", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "cid", "of", "n", "block", "signature", "members")
    own = own.repartition("cluster", "p", "q").sortWithinPartitions("cluster", "p", "q")
    with arrow_rows(rows.sparkSession, BATCH):
        return materialize(own.mapInArrow(_block_links(percent), "a long, b long"), "block_links")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept, body (a digest of the text).

    A document's set holds the distinct shingles of ``width`` words (A-Z lower-cased); with fewer
    words the whole sequence is its one shingle, and a null, empty or blank text has none and links
    with nothing. Documents link if the intersection of their sets is at least ``percent`` hundredths
    of the union, confirmed on the full sets. component_id is the least id that links reach. Null
    ids count as larger than all others; among null ids only, component_id is null and all are
    kept, as are rows that repeat the least id. An empty table gives an empty result.

    Documents of equal sets are one class, so copies cost one row. Classes sharing a band meet three
    hubs of the band, stars and not all pairs. What is left in different components of one band is
    compared block by block.
    """
    docs = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.xxhash64(whole(text)).alias("body"))
    kind = docs.schema["id"].dataType.simpleString()
    features = docs.mapInArrow(_features(width), f"id {kind}, body long, n long, k1 long, k2 long, signature array<long>, bands array<long>")
    with arrow_rows(docs.sparkSession, BATCH):
        features = materialize(features, "features")
    classes = features.filter("n > 0").groupBy("k1", "k2", "n")
    classes = classes.agg(F.min("id").alias("least"), F.first("signature").alias("signature"), F.first("bands").alias("bands"))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    marks = classes.select("cid", F.struct("n", "signature").alias("mark"))

    buckets = classes.select("cid", F.explode("bands").alias("band"))
    order = [F.xxhash64("cid", F.lit(j)) for j in range(HUBS)]
    hubs = buckets.groupBy("band").agg(*(F.min_by("cid", o).alias(f"h{j}") for j, o in enumerate(order)), F.count(F.lit(1)).alias("size"))
    hubs = materialize(hubs.filter("size > 1").drop("size"), "hubs")
    buckets = materialize(buckets.join(hubs, "band"), "buckets")
    stars = buckets.select("cid", F.explode(F.array(*(f"h{j}" for j in range(HUBS)))).alias("hub"))
    stars = stars.select(F.least("cid", "hub").alias("a"), F.greatest("cid", "hub").alias("b")).filter("a <> b").distinct()
    stars = stars.join(marks.select(F.col("cid").alias("a"), F.col("mark").alias("x")), "a")
    stars = stars.join(marks.select(F.col("cid").alias("b"), F.col("mark").alias("y")), "b")
    stars = materialize(stars.filter(_likely("x", "y", percent)).select("a", "b"), "stars")
    ids = stars.select(F.col("a").alias("cid")).union(stars.select("b")).distinct()
    sets = _sets_of(docs, classes, ids, width)
    links = _confirm(sets, stars, percent)
    labels = materialize(components(links), "labels")

    # Members of one band that are still apart; its hubs have met them all.
    apart = buckets.filter(" AND ".join(f"cid <> h{j}" for j in range(HUBS))).select("band", "cid")
    apart = materialize(_labelled(apart, labels, "cid", "of"), "apart")
    several = apart.groupBy("band").agg(F.min("of").alias("low"), F.max("of").alias("high"), F.min("cid").alias("first")).filter("low <> high")
    apart = materialize(apart.join(materialize(several.select("band", "first"), "several"), "band"), "still_apart")
    if apart.limit(1).count():
        clusters = materialize(components(apart.select(F.col("cid").alias("a"), F.col("first").alias("b"))), "clusters")
        ids = materialize(clusters.select(F.col("node").alias("cid")).join(sets.select("cid"), "cid", "left_anti"), "more")
        if ids.limit(1).count():
            sets = sets.union(_sets_of(docs, classes, ids, width))
        rows = _labelled(clusters.withColumnRenamed("node", "cid").withColumnRenamed("component", "cluster"), labels, "cid", "of")
        rows = rows.join(classes.select("cid", "n", "signature"), "cid").join(sets, "cid")
        labels = materialize(components(links.union(_compared(rows, percent))), "labels")

    named = classes.select("k1", "k2", "n", "cid", "least").join(labels.withColumnRenamed("node", "cid"), "cid", "left")
    named = named.withColumn("component", F.coalesce("component", "cid"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(named.join(materialize(least, "least"), "component").select("k1", "k2", "n", "component_id"), "named")
    own = features.select("id", "body", "n", "k1", "k2").join(named, ["k1", "k2", "n"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return own.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"), "body")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, all their columns as they are. Rows that
    repeat both id and text are one document, of which one row stays."""
    found = near_duplicates(docs, doc_id=doc_id, text=text, **options).filter("kept").select("id", "body")
    found = materialize(found, "kept")
    p = fresh(docs)
    keys = found.distinct().select(F.col("id").alias(p + "id"), F.col("body").alias(p + "text"))
    marked = docs.withColumn(p + "body", F.xxhash64(whole(text)))
    out = marked.join(keys, F.col(doc_id).eqNullSafe(F.col(p + "id")) & (F.col(p + "body") == F.col(p + "text")), "left_semi")
    if found.groupBy("id", "body").count().filter("count > 1").limit(1).count():
        out = out.dropDuplicates([doc_id, p + "body"])
    return out.select(*docs.columns)


def op6_minhash(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=2)
    return out.withColumnRenamed("id", "doc_id").drop("body")


OP6_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                                      ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM words
),
sizes AS (SELECT w.doc_id, count(s) AS n FROM words w LEFT JOIN sets USING (doc_id) GROUP BY w.doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)
),
reach AS (SELECT doc_id, doc_id AS other FROM words UNION SELECT reach.doc_id, b FROM reach JOIN links ON a = other)
SELECT s.doc_id, s.n AS n_shingles, min(other) AS component_id, s.doc_id = min(other) AS kept
FROM sizes s JOIN reach USING (doc_id) GROUP BY s.doc_id, s.n
"""
