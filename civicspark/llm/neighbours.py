"""Near-duplicate vectors by NN-descent, every link confirmed in double precision."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.graph import components
from civicspark.llm.words import groups
from civicspark.session import materialize

#: Neighbours on a list at first.
K = 8
#: Orders by random hyperplanes that the first lists are read from, and rows compared in each.
ORDERS, WINDOW = 8, 128
#: Members of one local join that see each other; more are split.
REVERSE = 32
#: Vectors in one block of the final comparison.
BLOCK = 256
#: Vectors that the audit compares with all others.
AUDITED = 256
#: Members of a clump that look beyond it in each order, and vectors compared with all others at once
#: where the search by lists has failed its audit.
SCOUTS, CHUNK = 8, 4096
#: Links of a vector up to which its group counts as small in the audit.
SMALL = 16
#: What single precision may take from a similarity.
ROUNDING = 1e-4


def _raw(dims: int):
    """Vectors as the bytes of ``dims`` doubles, missing components zero; null if not usable."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch["v"].to_pylist():
                if x is None or any(c is None for c in x):
                    out.append(None)
                    continue
                v = np.zeros(dims)
                v[: len(x)] = x
                out.append((v + 0.0).tobytes() if np.isfinite(v).all() and v.any() else None)
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(out, pa.binary())], names=["id", "raw"])

    return run


def _matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def units(raw: np.ndarray) -> np.ndarray:
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)  # squares can't overflow
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _codes(seed: int):
    """Unit vectors in single precision, and for each order the signs against 63 random planes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.int64(1) << np.arange(62, -1, -1, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = units(_matrix(batch["raw"]))
            planes = np.random.default_rng(seed).standard_normal((v.shape[1], ORDERS * 63))
            bits = (v @ planes > 0).reshape(len(v), ORDERS, 63)
            codes = (bits * weights).sum(axis=2)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, ORDERS), pa.int32()), pa.array(codes.reshape(-1)))
            small = pa.array([x.tobytes() for x in v.astype(np.float32)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["cid"], small, lists], names=["cid", "v", "codes"])

    return run


LISTS = "src long, dst long, sim float"


def _out(src: list, dst: list, sim: list) -> pa.RecordBatch:
    columns = [np.concatenate(x) if x else np.zeros(0, kind) for x, kind in ((src, np.int64), (dst, np.int64), (sim, np.float32))]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float32())], names=["src", "dst", "sim"])


def _best(ids: np.ndarray, sims: np.ndarray, k: int, worst: np.ndarray | None = None):
    """The ``k`` best others of each row, of those above ``worst``."""
    np.fill_diagonal(sims, -2)
    k = min(k, len(ids) - 1)
    if k < 1:
        return ids[:0], ids[:0], sims[:0, 0]
    at = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    found = np.take_along_axis(sims, at, axis=1)
    good = found > (-2 if worst is None else worst[:, None])
    return np.repeat(ids, k)[good.ravel()], ids[at][good], found[good]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First lists: each vector's best among those beside it in one order, in overlapping windows."""
    ids, rows = np.zeros(0, np.int64), None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = _matrix(batch["v"], np.float32)
        ids, rows = np.concatenate([ids, batch["cid"].to_numpy()]), new if rows is None else np.concatenate([rows, new])
        out, lo = ([], [], []), 0
        while lo + WINDOW <= len(ids):
            x = rows[lo : lo + WINDOW]
            for held, part in zip(out, _best(ids[lo : lo + WINDOW], x @ x.T, K)):
                held.append(part)
            lo += WINDOW // 2
        ids, rows = ids[lo:], rows[lo:]
        yield _out(*out)
    if len(ids) > 1:
        yield _out(*([part] for part in _best(ids, rows @ rows.T, K)))


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The neighbours of one vector meet each other; only what betters a list is kept."""
    out, size = ([], [], []), 0
    for group in groups(batches, ("center", "chunk")):
        ids, first = np.unique(group["member"].to_numpy(), return_index=True)
        if len(ids) < 2:
            continue
        x, worst = _matrix(group["v"].take(pa.array(first)), np.float32), group["worst"].to_numpy()[first]
        for held, part in zip(out, _best(ids, x @ x.T, K // 2, worst)):
            held.append(part)
        size += len(out[0][-1])
        if size > 100_000:
            yield _out(*out)
            out, size = ([], [], []), 0
    yield _out(*out)


def _top(pairs: DataFrame, threshold: float, enlarged: int) -> DataFrame:
    """The best of each list. A list whose last place still holds a link is saturated and may
    become ``enlarged`` times as long."""
    lists = pairs.groupBy("src", "dst").agg(F.max("sim").alias("sim")).groupBy("src")
    lists = lists.agg(F.reverse(F.array_sort(F.collect_list(F.struct("sim", "dst")))).alias("best"))
    full = F.coalesce(F.get("best", F.lit(K - 1))["sim"] >= threshold, F.lit(False))
    lists = lists.select("src", F.slice("best", F.lit(1), F.when(full, K * enlarged).otherwise(K)).alias("best"))
    return lists.select("src", F.explode("best").alias("x")).select("src", "x.dst", "x.sim")


def _descend(vectors: DataFrame, lists: DataFrame, threshold: float, enlarged: int) -> DataFrame:
    """One round: neighbours of neighbours, forward and back, are compared and the lists bettered.

    Few vectors are on very many lists; those that list them are split in chunks, each
    of which meets the vector's own list.
    """
    worst = lists.groupBy("src").agg(F.when(F.count(F.lit(1)) >= K, F.min("sim")).otherwise(F.lit(-2.0)).cast("float").alias("worst"))
    chunks = lists.groupBy("dst").agg(F.ceil(F.count(F.lit(1)) / REVERSE).cast("int").alias("chunks"))
    chunks = materialize(chunks.select(F.col("dst").alias("center"), "chunks"), "chunks")
    forward = lists.select(F.col("src").alias("center"), F.col("dst").alias("member")).join(chunks, "center", "left")
    forward = forward.select("center", "member", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)).alias("chunk"))
    back = lists.select(F.col("dst").alias("center"), F.col("src").alias("member")).join(chunks, "center")
    back = back.select("center", "member", F.pmod(F.hash("member"), F.col("chunks")).alias("chunk"))
    known = materialize(vectors.join(worst, vectors["cid"] == worst["src"]).select(F.col("cid").alias("member"), "v", "worst"), "known")
    met = materialize(forward.union(back), "members").join(known, "member").repartition("center", "chunk").sortWithinPartitions("center", "chunk")
    found = met.select("center", "chunk", "member", "v", "worst").mapInArrow(_local, LISTS)
    return materialize(_top(lists.union(found), threshold, enlarged), "lists")


def _compare(threshold: float):
    """Two blocks of one component against each other, in double precision: how many vectors
    each one links with, and a root that its links reach inside the two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ("component", "p", "q")):
            ids, n, block = (group[c].to_numpy() for c in ("cid", "n", "block"))
            v, p, q = units(_matrix(group["raw"])), group["p"][0].as_py(), group["q"][0].as_py()
            linked = v @ v.T >= threshold
            np.fill_diagonal(linked, False)
            if p != q:
                linked &= block[:, None] != block[None, :]
            roots = np.arange(len(ids))
            while True:
                least = np.minimum(roots, np.where(linked, roots[None, :], len(ids)).min(axis=1))
                least = least[least]
                if (least == roots).all():
                    break
                roots = least
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array((linked * n).sum(axis=1)), pa.array(ids[roots])], names=["cid", "links", "root"])

    return run


def _links(classes: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """cid, links, root of every vector that shares a candidate component with another. Components
    are cut in blocks and every two blocks meet in a task of their own."""
    sizes = materialize(labels.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "sizes")
    own = labels.join(sizes, "component").withColumn("block", F.pmod(F.hash("node"), F.col("blocks")))
    own = materialize(own.withColumnRenamed("node", "cid"), "blocks").join(classes.select("cid", "raw", "n"), "cid")
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = own.select("component", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "cid", "block", "n", "raw")
    own = own.repartition("component", "p", "q").sortWithinPartitions("component", "p", "q")
    return materialize(own.mapInArrow(_compare(threshold), "cid long, links long, root long"), "compared")


def _brute(queries: np.ndarray, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(queries), np.int64)
        for batch in batches:
            if batch.num_rows:
                total += (batch["n"].to_numpy()[:, None] * (units(_matrix(batch["raw"])) @ queries.T >= threshold)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(queries))), pa.array(total)], names=["query", "links"])

    return run


def audit(classes: DataFrame, compared: DataFrame, threshold: float, sample: int = AUDITED) -> float:
    """The share of its true links that a vector finds, on average, of about ``sample`` vectors drawn by a
    hash of their number from those with links and as many from the rest, each compared with all
    vectors. Vectors of small and of large groups are averaged apart and the lower average counts,
    so a large group can't hide what small ones miss."""
    found = compared.groupBy("cid").agg(F.sum("links").alias("found"))
    both = classes.select("cid", "raw", "n").join(found, "cid", "left").withColumn("lone", F.coalesce("found", F.lit(0)) == 0)
    both = materialize(both, "audited")
    sizes = {r["lone"]: r["count"] for r in both.groupBy("lone").count().collect()}
    drawn = F.pmod(F.xxhash64("cid", F.lit("audit")), F.lit(1 << 30)) < F.lit(float(sample << 30)) / F.when(F.col("lone"), sizes.get(True, 1)).otherwise(sizes.get(False, 1))
    rows = both.filter(drawn).collect()
    if not rows:
        return 1.0
    queries = units(np.array([np.frombuffer(r["raw"]) for r in rows]))
    sums = classes.select("n", "raw").mapInArrow(_brute(queries, threshold), "query long, links long").groupBy("query").agg(F.sum("links").alias("links"))
    true = {r["query"]: r["links"] for r in sums.collect()}
    # A vector links with its own class too; each stands for the vectors of its stratum.
    shares: dict[bool, list[tuple[Fraction, Fraction]]] = {True: [], False: []}
    drawn_of = {lone: sum(r["lone"] == lone for r in rows) for lone in (True, False)}
    for i, r in enumerate(rows):
        if (wanted := true[i] - r["n"]) > 0:
            shares[wanted <= SMALL].append((Fraction(r["found"] or 0, wanted), Fraction(sizes[r["lone"]], drawn_of[r["lone"]])))
    return float(min((sum(x * w for x, w in part) / sum(w for _, w in part) for part in shares.values() if part), default=1))


def _strangers(threshold: float):
    """Links between vectors of different components that stand beside each other in one order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, own, rows = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = _matrix(batch["v"], np.float32)
            ids, own = np.concatenate([ids, batch["cid"].to_numpy()]), np.concatenate([own, batch["component"].to_numpy()])
            rows = new if rows is None else np.concatenate([rows, new])
            pairs, lo = [], 0
            while lo < len(ids) and (lo == 0 or lo + WINDOW // 2 < len(ids)):
                at, to = slice(lo, lo + WINDOW), own[lo : lo + WINDOW]
                hit = (rows[at] @ rows[at].T >= threshold - ROUNDING) & (to[:, None] < to[None, :])
                pairs += [np.stack([ids[at][i], ids[at][j]]) for i, j in [np.nonzero(hit)]]
                lo += WINDOW // 2
            keep = max(0, len(ids) - WINDOW)
            ids, own, rows = ids[keep:], own[keep:], rows[keep:]
            a, b = np.concatenate(pairs, axis=1) if pairs else (np.zeros(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def _joined(compared: DataFrame) -> DataFrame:
    """(node, component) of the vectors that link."""
    return materialize(components(compared.select(F.col("cid").alias("a"), F.col("root").alias("b"))), "labels")


def _between_clumps(coded: DataFrame, lists: DataFrame, labels: DataFrame, threshold: float, longest: int) -> DataFrame | None:
    """Links between clumps whose members' lists are full of their own kind, or None. A vector with room
    on its list has seen what is near; two that have none can miss each other. Of each such clump a
    few members, others in every order, meet those of other clumps: a clump counts as one neighbour."""
    full = lists.groupBy("src").agg(F.count(F.lit(1)).alias("m"), F.min("sim").alias("worst")).filter((F.col("m") >= longest) & (F.col("worst") >= threshold - ROUNDING))
    clumps = full.join(labels, full["src"] == labels["node"]).select("component").distinct()
    members = labels.join(clumps, "component").select(F.col("node").alias("cid"), "component")
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    members = materialize(members.join(sizes, "component"), "clumps")
    if members.select("component").distinct().limit(2).count() < 2:
        return None
    scouts = coded.join(members, "cid")
    found = None
    for i in range(ORDERS):
        drawn = F.pmod(F.xxhash64("cid", F.lit(i)), F.ceil(F.col("size") / SCOUTS)) == 0
        part = scouts.filter(drawn).select("cid", "component", "v", F.get("codes", F.lit(i)).alias("code"))
        part = part.repartitionByRange("code", "cid").sortWithinPartitions("code", "cid").select("cid", "component", "v")
        part = part.mapInArrow(_strangers(threshold), "a long, b long")
        found = part if found is None else found.union(part)
    return materialize(found.distinct(), "between-clumps")


def _against(ids: np.ndarray, own: np.ndarray, queries: np.ndarray, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            mine = batch["component"].to_numpy()
            row, other = np.nonzero((units(_matrix(batch["raw"])) @ queries.T >= threshold) & (mine[:, None] != own[None, :]))
            _, one = np.unique(np.stack([row, own[other]]), axis=1, return_index=True)  # one link into each component
            yield pa.RecordBatch.from_arrays([pa.array(batch["cid"].to_numpy()[row[one]]), pa.array(ids[other[one]])], names=["a", "b"])

    return run


def _exhaustive(classes: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """Every link between components, by comparing all vectors with all, ``CHUNK`` of them at a time. The
    way out where lists fail: its work grows with the square of the table."""
    every = classes.select("cid", "raw").join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    every = materialize(every, "labelled")
    chunks, found = -(-every.count() // CHUNK), None
    for c in range(chunks):
        rows = every.filter(F.pmod(F.xxhash64("cid"), F.lit(chunks)) == c).collect()
        if rows:
            ids, own = (np.array([r[x] for r in rows], np.int64) for x in ("cid", "component"))
            queries = units(np.array([np.frombuffer(r["raw"]) for r in rows]))
            part = materialize(every.mapInArrow(_against(ids, own, queries, threshold), "a long, b long"), "against")
            found = part if found is None else found.union(part)
    return found


def near_vectors(
    vectors: DataFrame, threshold: float = 0.95, rounds: int = 2, recall: float = 0.995, tries: int = 3, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id, kept.

    Two vectors link if their cosine in double precision is at least ``threshold``. Vectors that are
    null, empty, zero, or hold a null or non-finite component link with nothing and are their own
    component; a shorter vector counts as filled up with zeros. component_id is the least id that
    links reach; rows of equal vectors are linked to each other. Null ids count as larger than all
    others, and rows with only null ids get a null component_id and are kept. An empty table gives
    an empty result.

    Equal vectors are one class. First lists come from neighbours in a few sorted orders of random
    hyperplane signs, then ``rounds`` of NN-descent better them; a list that is full of links grows. What
    links at all then shares a component, and inside components every two blocks are compared in
    full. Clumps whose members' grown lists are still full of their own kind look for each other by a
    few members each, until no two of them link. An audit against all vectors measures recall per
    vector, small and large groups apart; below ``recall`` the search is done again from other
    hyperplanes, up to ``tries`` times, keeping all lists found so far, and if that fails too
    all components are compared with all, block by block.
    """
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 0
    kind = rows.schema["id"].dataType.simpleString()
    rows = materialize(rows.mapInArrow(_raw(max(1, dims)), f"id {kind}, raw binary"), "raw")
    classes = rows.filter("raw IS NOT NULL").groupBy("raw").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    lists, longest, done = None, K * 2**rounds, False
    for attempt in range(tries):
        coded = classes.select("cid", "raw").mapInArrow(_codes(attempt), "cid long, v binary, codes array<long>")
        coded = materialize(coded, "codes")
        found = None
        for i in range(ORDERS):
            code = F.get("codes", F.lit(i))
            part = coded.select("cid", "v", code.alias("code")).repartitionByRange("code", "cid").sortWithinPartitions("code", "cid")
            part = part.select("cid", "v").mapInArrow(_windows, LISTS)
            found = part if found is None else found.union(part)
        grown = 1 if lists is None else 2**rounds
        lists = materialize(_top(found if lists is None else found.union(lists), threshold, grown), "lists")
        for step in range(rounds):
            lists = _descend(coded.select("cid", "v"), lists, threshold, max(grown, 2 ** (step + 1)))
        near = lists.filter(F.col("sim") >= threshold - ROUNDING).select(F.col("src").alias("a"), F.col("dst").alias("b"))
        compared = _links(classes, materialize(components(near), "candidates"), threshold)
        while (more := _between_clumps(coded, lists, _joined(compared), threshold, longest)) is not None and more.limit(1).count():
            near = near.union(more)
            compared = _links(classes, materialize(components(near), "candidates"), threshold)
        if done := audit(classes, compared, threshold) >= recall:
            break
    if not done:
        near = near.union(_exhaustive(classes, _joined(compared), threshold))
        compared = _links(classes, materialize(components(near), "candidates"), threshold)
    labels = _joined(compared)
    counted = compared.groupBy("cid").agg(F.sum("links").alias("links"))
    named = classes.select("cid", "raw", "least", "n").join(labels.withColumnRenamed("node", "cid"), "cid", "left").join(counted, "cid", "left")
    named = materialize(named.withColumn("component", F.coalesce("component", "cid")), "named")
    least = materialize(named.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    named = named.join(least, "component").select("raw", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    out = rows.join(materialize(named, "named"), "raw", "left")
    component = F.when(F.col("raw").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def op5_near_vectors(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumnRenamed("id", "vec_id")


OP5_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT reach.vec_id, b FROM reach JOIN links ON a = other),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT r.vec_id, coalesce(any_value(c.n), 0) AS n_links, min(other) AS component_id, r.vec_id = min(other) AS kept
FROM reach r LEFT JOIN counts c USING (vec_id) GROUP BY r.vec_id
"""
