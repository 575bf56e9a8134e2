"""Ranked lexical search of many items at once: what items share is summed once for all of them."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicspark.llm.columns import LOWER, UPPER, lower_ascii, whole
from civicspark.session import materialize

#: A term: a run of digits, letters and whatever is beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The same over UTF-8: A-Z to lower case, and a space for what is in no term.
TABLE = bytes(ord(chr(b).lower()) if chr(b).isalnum() and b < 128 else b if b >= 128 else 32 for b in range(256))
#: Bytes of a text that are split into terms at once.
STEP = 1 << 22
#: (item, term) entries of a block of items, whose plan travels to every task; a longer item is a
#: block of its own.
BLOCK = 1 << 17
#: Cells that a task sums at once.
CELLS = 1 << 22

#: One block: its terms; per (term, repeats) the set that sums it; the nodes above the sets as pairs of
#: lower nodes, by level; the items and the nodes that they are the sum of.
PLAN = (
    "block long, terms array<string>, entry_term array<int>, entry_times array<long>, entry_set array<int>, n_sets int, "
    "left array<int>, right array<int>, levels array<int>, items array<long>, item_nodes array<int>, item_ends array<int>"
)
COUNTED = "doc_id long, n long, term array<int>, tf array<int>"
FOUND = "item long, score long, doc_id long"


def count_terms(data: bytes, number: Callable[[bytes], int | None]) -> tuple[int, Counter]:
    """How many terms a text has, and how often it has those that ``number`` knows."""
    data = data.translate(TABLE)
    n, lo, counts = 0, 0, Counter()
    while lo < len(data):
        hi = len(data) if len(data) - lo <= STEP else max(data.rfind(b" ", lo, lo + STEP), lo)
        if hi == lo:
            hi = data.find(b" ", lo + STEP)
            hi = len(data) if hi < 0 else hi
        terms = data[lo:hi].split()
        n += len(terms)
        counts.update(map(number, terms))
        lo = hi
    counts.pop(None, None)
    return n, counts


def share(sequences: dict[int, list[int]], n_sets: int) -> tuple[list[tuple[int, int]], list[int], dict[int, list[int]]]:
    """The sharing graph above the term sets: pairs of nodes that are neighbours in two items or more
    become a node of their own, in rounds, until no pair repeats.

    Every item lists its nodes from the most used on, so that items which share much begin alike.
    In a round no node takes part in two pairs, so an item's replacements can't clash. Returns
    the pairs, how many of them each round added, and what is left of each item.
    """
    uses = Counter(x for s in sequences.values() for x in s)
    left = {i: sorted(s, key=lambda x: (-uses[x], x)) for i, s in sequences.items()}
    pairs, levels = [], []
    while True:
        seen = Counter(p for s in left.values() for p in zip(s, s[1:]))
        chosen, taken = {}, set()
        for (a, b), n in sorted(((p, n) for p, n in seen.items() if n > 1), key=lambda x: (-x[1], x[0])):
            if a not in taken and b not in taken:
                chosen[a] = (b, n_sets + len(pairs))
                taken |= {a, b}
                pairs.append((a, b))
        if not chosen:
            return pairs, levels, left
        levels.append(len(chosen))
        for item, s in left.items():
            out, i = [], 0
            while i < len(s):
                partner = chosen.get(s[i])
                if partner and i + 1 < len(s) and s[i + 1] == partner[0]:
                    out.append(partner[1])
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            left[item] = out


def plan(table: pa.Table) -> pa.Table:
    """The plan of one block from its (item, term, times): terms that the same items hold equally
    often are one shared set."""
    rows = sorted(zip(*(table[c].to_pylist() for c in ("term", "times", "item")), strict=True))
    terms = sorted({t for t, _, _ in rows})
    number = {t: i for i, t in enumerate(terms)}
    holders: dict[tuple[int, int], list[int]] = {}
    for term, times, item in rows:
        holders.setdefault((number[term], times), []).append(item)
    sets: dict[tuple[int, ...], int] = {}
    entry_set = [sets.setdefault(tuple(items), len(sets)) for items in holders.values()]
    sequences: dict[int, list[int]] = {}
    for items, s in sets.items():
        for item in items:
            sequences.setdefault(item, []).append(s)
    pairs, levels, left = share(sequences, len(sets))
    items = sorted(left)
    out = {
        "block": table["block"][0].as_py(), "terms": terms, "entry_term": [t for t, _ in holders], "entry_times": [k for _, k in holders],
        "entry_set": entry_set, "n_sets": len(sets), "left": [a for a, _ in pairs], "right": [b for _, b in pairs], "levels": levels,
        "items": items, "item_nodes": [x for i in items for x in left[i]], "item_ends": np.cumsum([len(left[i]) for i in items]).tolist(),
    }
    i, n = pa.list_(pa.int32()), pa.list_(pa.int64())
    kinds = [pa.int64(), pa.list_(pa.string()), i, n, i, pa.int32(), i, i, i, n, i, i]
    return pa.table({k: pa.array([v], t) for (k, v), t in zip(out.items(), kinds, strict=True)})


def plans(items: DataFrame, block: int = BLOCK) -> tuple[DataFrame, int]:
    """A plan per block of (item, text), and the number of blocks; no block has more than ``block``
    entries unless it is one item."""
    found = F.explode(F.regexp_extract_all(lower_ascii(whole("text")), F.lit(TERM), F.lit(0))).alias("term")
    wanted = materialize(items.select("item", found).groupBy("item", "term").agg(F.count(F.lit(1)).alias("times")), "wanted_terms")
    sizes = materialize(wanted.groupBy("item").agg(F.count(F.lit(1)).alias("entries")), "item_sizes")
    n = max(1, -(-2 * wanted.count() // block))
    while True:
        place = F.pmod(F.xxhash64("item"), F.lit(n))
        full = sizes.groupBy(place.alias("block")).agg(F.sum("entries").alias("entries"), F.count(F.lit(1)).alias("items"))
        if not full.filter((F.col("entries") > block) & (F.col("items") > 1)).limit(1).count():
            return materialize(wanted.withColumn("block", place).groupBy("block").applyInArrow(plan, PLAN), "plans"), n
        n *= 2


def term_counts(docs: DataFrame, terms: list[str], doc_id: str, text: str) -> DataFrame:
    """Per document its number of terms and, of ``terms``, the numbers of those that it holds and how
    often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t.encode(): i for i, t in enumerate(terms)}.get
        for batch in batches:
            found = [count_terms(data, number) for data in batch["text"].cast(pa.binary()).to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(c) for _, c in found])]).astype(np.int32)
            lists = [[x for _, c in found for x in c.keys()], [x for _, c in found for x in c.values()]]
            columns = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v, pa.int32())) for v in lists]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([n for n, _ in found], pa.int64()), *columns], names=["doc_id", "n", "term", "tf"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text")).mapInArrow(run, COUNTED)


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


class Ranking:
    """The best documents of each item so far."""

    def __init__(self, n_items: int, top: int):
        self.top, self.floor = top, np.ones(n_items, np.int64)
        self.kept = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]  # item, score, id, id is null

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.floor[:, None])
        if not len(item):
            return
        item, score, i, none = (np.concatenate(x) for x in zip(self.kept, (item, scores[item, doc], ids[doc], null[doc]), strict=True))
        order = np.lexsort([i, none, -score, item])
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order, item, place = order[place < self.top], item[place < self.top], place[place < self.top]
        self.kept = [item, score[order], i[order], none[order]]
        full = place == self.top - 1
        self.floor[item[full]] = self.kept[1][full]


def score_block(row: dict, df: np.ndarray, n_docs: int, n_terms: int, top: int) -> Callable:
    """A function over batches of :func:`term_counts` that gives a task's best documents per item."""
    weight = weights(df, n_docs)
    entry_term, times, sets = (np.array(row[k], np.int64) for k in ("entry_term", "entry_times", "entry_set"))  # sorted by term
    first = np.searchsorted(entry_term, np.arange(len(weight) + 1))
    left, right = np.array(row["left"], np.int64), np.array(row["right"], np.int64)
    steps = np.concatenate([[0], np.cumsum(row["levels"])]).astype(np.int64)
    n_sets, nodes, ends = row["n_sets"], np.array(row["item_nodes"], np.int64), np.array(row["item_ends"], np.int64)
    items, starts = np.array(row["items"], np.int64), np.concatenate([[0], ends[:-1]])
    width = max(1, CELLS // (n_sets + len(left) + len(nodes)))

    def accumulate(n: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        wide = 75 * n_docs * int(n.max(initial=0)) >= 1 << 63
        length = 25 + np.array([75 * x * n_docs // n_terms for x in n.tolist()], np.int64) if wide else 25 + 75 * n * n_docs // n_terms
        doc = np.repeat(np.arange(len(n)), sizes)
        value = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * length[doc]))
        many = first[term + 1] - first[term]
        at = np.repeat(first[term] - np.cumsum(many) + many, many) + np.arange(many.sum())
        sums = np.zeros((n_sets + len(left), len(n)), np.int64)
        np.add.at(sums.reshape(-1), sets[at] * len(n) + np.repeat(doc, many), times[at] * np.repeat(value, many))
        for lo, hi in zip(steps[:-1], steps[1:], strict=True):
            sums[n_sets + lo : n_sets + hi] = sums[left[lo:hi]] + sums[right[lo:hi]]
        return np.add.reduceat(sums[nodes], starts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Ranking(len(items), top)
        for batch in batches:
            ids, null = batch["doc_id"].fill_null(0).to_numpy(zero_copy_only=False), batch["doc_id"].is_null().to_numpy(zero_copy_only=False)
            n, offsets = batch["n"].to_numpy(), batch["term"].offsets.to_numpy()
            term, tf = (batch[c].values.to_numpy().astype(np.int64) for c in ("term", "tf"))
            for lo in range(0, batch.num_rows, width):
                hi = min(lo + width, batch.num_rows)
                inside = slice(offsets[lo], offsets[hi])
                if offsets[hi] > offsets[lo]:
                    best.add(accumulate(n[lo:hi], np.diff(offsets[lo : hi + 1]), term[inside], tf[inside]), ids[lo:hi], null[lo:hi])
        item, score, i, none = best.kept
        yield pa.RecordBatch.from_arrays(
            [pa.array(items[item]), pa.array(score), pa.array(i, mask=none)], names=["item", "score", "doc_id"]
        )

    return run


def _block_results(docs: DataFrame, row: dict, top: int, doc_id: str, text: str) -> DataFrame | None:
    counts = materialize(term_counts(docs, row["terms"], doc_id, text), "term_counts")
    n_docs, n_terms = counts.filter("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return None
    df = np.zeros(len(row["terms"]), np.int64)
    held = counts.select(F.explode("term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).toArrow()
    df[held["term"].to_numpy()] = held["n"].to_numpy()
    return counts.filter(F.size("term") > 0).mapInArrow(score_block(row, df, n_docs, n_terms, top), FOUND)


def rank_documents(
    docs: DataFrame, items: DataFrame, top: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block: int = BLOCK
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of every row of ``items`` among all
    rows of ``docs``, scores above 0 only, equal scores by ascending id, a null id last.

    Items are taken in blocks of bounded size, most often one. For a block every text is split into
    terms once; of a document only the counts of the block's terms are kept. Terms that the same
    items hold are one shared set: a document's partial score of a set is summed once, then
    sums of sets that items share are formed along the block's sharing graph, and each item adds
    what is left. A task passes on its ``top`` best per item, nothing else is shuffled.

    Null and empty texts have no terms. Ids are whole numbers. Repeated rows of ``docs`` are
    documents of their own and can both be ranked; a repeated row of ``items`` is answered again.
    Items without a term, without a document, and all items where ``docs`` is empty have no rows.
    """
    asked = materialize(items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("item_id"), F.col(item_text).alias("text")), "items")
    per_block, n = plans(asked, block)
    results = []
    for b in range(n):
        rows = per_block.filter(F.col("block") == b).toArrow().to_pylist()
        found = _block_results(docs, rows[0], top, doc_id, text) if rows else None
        results += [] if found is None else [found]
    if not results:
        results = [docs.sparkSession.createDataFrame([], FOUND)]
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = reduce(DataFrame.union, results).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op13_search(spark, sf_dir: str) -> DataFrame:
    return rank_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _terms(text: str) -> str:
    return f"unnest(regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{TERM}'))"


OP13_SQL = f"""
WITH held AS (
  SELECT r, doc_id, term, count(*) AS tf FROM (SELECT r, doc_id, {_terms("text")} AS term FROM (SELECT *, row_number() OVER () AS r FROM documents))
  GROUP BY ALL
),
sized AS (SELECT r, sum(tf)::BIGINT AS n FROM held GROUP BY r),
whole AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM sized),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, {_terms("text")} AS term FROM benchmark) GROUP BY ALL),
weighed AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM held, whole
  WHERE term IN (SELECT term FROM asked) GROUP BY term, docs
),
scored AS (
  SELECT item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words))))::BIGINT AS score
  FROM asked JOIN weighed USING (term) JOIN held USING (term) JOIN sized USING (r), whole GROUP BY item_id, r, doc_id
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= 10
"""
