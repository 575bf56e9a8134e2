"""Exact duplicates against a history that is kept behind a minimal perfect hash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark.llm.columns import lower_ascii, whole
from civicspark.session import materialize

#: Digests that share one small hash table; tables are built and read one at a time.
PER_BUCKET = 256
SPREAD = 1.5
INDEX = "bucket long, levels array<int>, bits binary, digests binary, winners array<long>, counts array<long>"
FOUND = "digest binary, member boolean, old_winner long, old_count long"


def text_digest(text: str = "text") -> Column:
    """SHA-256 of the text with A-Z lower-cased, null counting as empty: 32 bytes."""
    return F.unhex(F.sha2(lower_ascii(whole(text)).cast("binary"), 256))


def _words(digests: list[bytes] | np.ndarray) -> np.ndarray:
    raw = digests if isinstance(digests, np.ndarray) else np.frombuffer(b"".join(digests), np.uint8)
    return raw.view(np.uint64).reshape(-1, 4)


def _place(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """The position of each digest on one level; every level mixes all 32 bytes anew."""
    x = np.full(len(words), (0x9E3779B97F4A7C15 * (2 * level + 1)) & (2**64 - 1), np.uint64)
    for i in range(4):
        x = (x ^ words[:, i]) * np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(32)
    return (x % np.uint64(size)).astype(np.int64)


def build_table(words: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Level sizes and the bits of all levels: a digest alone at its position sets that bit,
    the others try the next level. The rank of its bit is the digest's slot."""
    sizes, levels, left = [], [], words
    while len(left):
        size = max(2, int(len(left) * SPREAD))
        at = _place(left, len(sizes), size)
        once = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        levels.append(once)
        left = left[~once[at]]
    return sizes, np.concatenate(levels) if levels else np.zeros(0, bool)


def slots_of(words: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """The slot of each digest, -1 where no level has its bit. A stranger may get any slot."""
    rank = np.cumsum(bits) - 1
    slot, start = np.full(len(words), -1, np.int64), 0
    open_ = np.arange(len(words))
    for level, size in enumerate(sizes):
        at = start + _place(words[open_], level, size)
        hit = bits[at]
        slot[open_[hit]] = rank[at[hit]]
        open_, start = open_[~hit], start + size
    return slot


def _build(table: pa.Table) -> pa.Table:
    words = _words(table["digest"].to_pylist())
    sizes, bits = build_table(words)
    order = np.argsort(slots_of(words, sizes, bits))
    return pa.table(
        {
            "bucket": pa.array([table["bucket"][0].as_py()], pa.int64()),
            "levels": pa.array([sizes], pa.list_(pa.int32())),
            "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
            "digests": pa.array([words[order].tobytes()], pa.binary()),
            "winners": pa.array([table["winner"].take(order).to_pylist()], pa.list_(pa.int64())),
            "counts": pa.array([table["n"].take(order).to_pylist()], pa.list_(pa.int64())),
        }
    )


def _look_up(new: pa.Table, index: pa.Table) -> pa.Table:
    digests = new["digest"].to_pylist()
    member = np.zeros(len(digests), bool)
    winner: list[int | None] = [None] * len(digests)
    count: list[int | None] = [None] * len(digests)
    if digests and index.num_rows:
        words, row = _words(digests), index.slice(0, 1).to_pylist()[0]
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(row["levels"])).astype(bool)
        slot, kept = slots_of(words, row["levels"], bits), _words(np.frombuffer(row["digests"], np.uint8))
        member = (slot >= 0) & (kept[np.maximum(slot, 0)] == words).all(axis=1)
        for i in np.flatnonzero(member):
            winner[i], count[i] = row["winners"][slot[i]], row["counts"][slot[i]]
    return pa.table(
        {
            "digest": pa.array(digests, pa.binary()),
            "member": pa.array(member),
            "old_winner": pa.array(winner, pa.int64()),
            "old_count": pa.array(count, pa.int64()),
        }
    )


def _groups(digests: DataFrame) -> DataFrame:
    """Distinct digests with their largest id and their rows; partial sums first, so a text of a
    third of all rows is one row per task before it moves."""
    return digests.groupBy("digest").agg(F.max("id").alias("winner"), F.count(F.lit(1)).alias("n"))


def _bucket(n_buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(n_buckets)).alias("bucket")


def build_index(groups: DataFrame, n_buckets: int) -> DataFrame:
    """The history's index, one row per bucket of some hundred digests: the minimal perfect hash,
    and per slot the full digest, the winner's id and the number of rows."""
    return groups.select(_bucket(n_buckets), "digest", "winner", "n").groupBy("bucket").applyInArrow(_build, INDEX)


def dedup_exact(docs: DataFrame, history: Column | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Rows for which
    ``history`` holds are indexed first; the others are looked up in the index, each slot's full
    digest compared. Members join their slot's group, nonmembers group among themselves. Of equal
    texts the largest id stays. A null id never wins against a number; where all ids are null
    keep_id is null and every row counts as kept, as do rows that repeat the winner's id. An empty
    table gives an empty result, and a null ``history`` verdict counts as not historical.
    """
    old = F.lit(True) if history is None else F.coalesce(history, F.lit(False))
    rows = materialize(docs.select(F.col(doc_id).alias("id"), text_digest(text).alias("digest"), old.alias("old")), "digests")
    past, new = materialize(_groups(rows.filter("old")), "past"), materialize(_groups(rows.filter("NOT old")), "new")
    n_buckets = max(1, -(-max(past.count(), new.count()) // PER_BUCKET))
    index = materialize(build_index(past, n_buckets), "hash_index")
    found = (
        new.select(_bucket(n_buckets), "digest")
        .groupBy("bucket")
        .cogroup(index.groupBy("bucket"))
        .applyInArrow(_look_up, FOUND)
    )
    # Members raise their slot's winner and count; strangers stand alone.
    seen = new.join(found, "digest").select(
        "digest", F.greatest("winner", "old_winner").alias("winner"), (F.col("n") + F.coalesce("old_count", F.lit(0))).alias("n"), "member"
    )
    untouched = past.join(seen.filter("member"), "digest", "left_anti").select("digest", "winner", "n")
    groups = materialize(seen.select("digest", "winner", "n").union(untouched), "groups")
    return rows.join(groups, "digest").select(
        "id",
        F.col("winner").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("winner")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """The older half of the id range is the history, the newer half the arriving batch."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ends = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = 0 if ends[0] is None else (ends[0] + ends[1]) // 2
    return dedup_exact(docs, F.col("doc_id") <= middle).withColumnRenamed("id", "doc_id")


OP3_SQL = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM t
"""
