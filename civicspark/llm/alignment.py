"""Two tokenizers of one text aligned by bytes, each distinct text tokenised once."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import reduce
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from civicspark.llm.columns import floor_of_most
from civicspark.llm.words import slices
from civicspark.session import materialize

BYTES_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: A lone space between two characters that are no white space. Neither tokenizer has a token
#: across it: what stands between two such spaces, a stretch, is tokenised alike wherever it occurs.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Stretches whose tokens a task keeps, and their characters; beyond either it starts anew.
KEPT, KEPT_CHARS = 1 << 19, 1 << 24
#: Stretches tokenised in one call.
CHUNK = 1000
#: Pairs whose counts travel to every task, twenty megabytes at most. All others meet theirs in a join.
FRONT = 1 << 18

ALIGNED = (
    "digest binary, copies long, n_a int, n_b int, n_groups int, groups_sha256 string, codes array<long>, times array<int>"
)


def _byte_table() -> dict[str, int]:
    """The characters that byte-level vocabularies write for the 256 byte values: printable ones
    stand for themselves, the others follow from 256 on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the stretches that were tokenised lately."""

    def __init__(self, bytes_model: str, proto: bytes):
        self.a = Tokenizer.from_str(bytes_model)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=proto)
        own, vocabulary = _byte_table(), self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(own[c] for c in token) if all(c in own for c in token) else token.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        if any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.get_piece_size())):
            raise ValueError("a piece crosses a space: texts can't be cut there")
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.names = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.groups: list[str] = []
        self.n_a, self.n_b, self.ends, self.codes, self.chars = array("q"), array("q"), array("q", [0]), array("q"), 0

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """A's and B's ids of space+text, or None where the bytes of either differ from it."""
        a, b = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.b.encode(text, num_threads=1)
        wanted = b" " + text.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != wanted or b"".join(map(self.b_bytes.__getitem__, b)) != wanted:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def common(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte offsets where tokens of both end, and the numbers of the tokens that end there. No
        token is empty, so there is one of each, and a group has one link."""
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        return cuts, np.searchsorted(a_ends, cuts), np.searchsorted(b_ends, cuts)

    def written(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> list[str]:
        """Each group as ``a1,a2|b1``."""
        names, lo_a, lo_b, out = self.names, 0, 0, []
        a_names, b_names = [names[i] for i in a.tolist()], [names[i] for i in b.tolist()]
        for x, y in zip((at_a + 1).tolist(), (at_b + 1).tolist(), strict=True):
            left = a_names[lo_a] if x - lo_a == 1 else ",".join(a_names[lo_a:x])
            right = b_names[lo_b] if y - lo_b == 1 else ",".join(b_names[lo_b:y])
            out.append(left + "|" + right)
            lo_a, lo_b = x, y
        return out

    def _keep(self, stretches: list[str], found: tuple[np.ndarray, np.ndarray]) -> None:
        a, b = found
        cuts, at_a, at_b = self.common(a, b)
        ends = np.cumsum([len(s.encode()) + 1 for s in stretches])
        last = np.searchsorted(cuts, ends, "right")
        groups, base = self.written(a, b, at_a, at_b), len(self.codes)
        self.codes.frombytes((a[at_a] * len(self.b_bytes) + b[at_b]).tobytes())
        for mine, at in ((self.n_a, at_a), (self.n_b, at_b)):
            mine.frombytes(np.diff(at[last - 1] + 1, prepend=0).tobytes())
        self.ends.frombytes((base + last).tobytes())
        self.place.update(zip(stretches, range(len(self.groups), len(self.groups) + len(stretches)), strict=True))
        self.chars += sum(map(len, stretches))
        lo = 0
        for hi in last.tolist():
            self.groups.append(groups[lo] if hi - lo == 1 else ";".join(groups[lo:hi]))
            lo = hi

    def learn(self, parts: list[list[str]]) -> None:
        """Tokenises the stretches that aren't kept: many in one call where white space at neither
        end could change their neighbours. One whose bytes don't come back gets the place -1."""
        new = [s for s in dict.fromkeys(chain.from_iterable(parts)) if s not in self.place]
        # only a text's first and last stretch can begin or end in white space
        edges = {s for p in parts for s in (p[0], p[-1]) if s[0].isspace() or s[-1].isspace()}
        alone = [s for s in new if s in edges]
        joined = [s for s in new if s not in edges] if alone else new
        for i in range(0, len(joined), CHUNK):
            chunk = joined[i : i + CHUNK]
            found = self.tokens(" ".join(chunk))
            if found is None:
                alone += chunk
            else:
                self._keep(chunk, found)
        for s in alone:
            found = self.tokens(s)
            if found is None:
                self.place[s] = -1
            else:
                self._keep([s], found)

    def batch(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        if len(self.place) > KEPT or self.chars > KEPT_CHARS:
            self.forget()
        texts = batch["text"].to_pylist()
        parts = [CUT.split(t) for t in texts]
        self.learn(parts)
        numbers = np.fromiter(map(self.place.__getitem__, chain.from_iterable(parts)), np.int64)
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        n_a, n_b, ends, codes = (np.frombuffer(x, np.int64) if len(x) else np.zeros(0, np.int64) for x in (self.n_a, self.n_b, self.ends, self.codes))
        # A text with a stretch that doesn't come back is judged, and tokenised, as a whole.
        odd = np.add.reduceat(numbers < 0, bounds[:-1]) > 0 if len(texts) else np.zeros(0, bool)
        good = numbers[np.repeat(~odd, np.diff(bounds))]
        row = np.repeat(np.arange(len(texts)), np.where(odd, 0, np.diff(bounds)))
        sizes = ends[good + 1] - ends[good] if len(good) else np.zeros(0, np.int64)
        many = np.cumsum(sizes)
        flat = codes[np.repeat(ends[good] - (many - sizes), sizes) + np.arange(many[-1])] if len(good) else codes[:0]
        sums = [np.bincount(row, x, len(texts)).astype(np.int64) for x in ((n_a[good], n_b[good], sizes) if len(good) else ([], [], []))]
        keys = [np.repeat(row, sizes), flat]
        digests = []
        for i, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            groups = None
            if not odd[i]:
                groups = map(self.groups.__getitem__, numbers[lo:hi].tolist())
            elif (found := self.tokens(texts[i])) is not None:
                a, b = found
                cuts, at_a, at_b = self.common(a, b)
                groups = self.written(a, b, at_a, at_b)
                for total, value in zip(sums, (len(a), len(b), len(cuts)), strict=True):
                    total[i] = value
                keys[0] = np.concatenate([keys[0], np.full(len(cuts), i)])
                keys[1] = np.concatenate([keys[1], a[at_a] * len(self.b_bytes) + b[at_b]])
            digests.append("" if groups is None else sha256(";".join(groups).encode()).hexdigest())
        span = len(self.a_bytes) * len(self.b_bytes)
        both, times = np.unique(keys[0].astype(np.int64) * span + keys[1], return_counts=True)
        first = np.searchsorted(both, np.arange(len(texts) + 1) * span).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(first), pa.array(v)) for v in (both % span, times.astype(np.int32))]
        plain = [pa.array(s.astype(np.int32)) for s in sums]
        return pa.RecordBatch.from_arrays(
            [batch["digest"], batch["copies"], *plain, pa.array(digests, pa.string()), *lists],
            names=["digest", "copies", "n_a", "n_b", "n_groups", "groups_sha256", "codes", "times"],
        )


_ready: dict[tuple[int, int], Aligner] = {}


def _aligner(bytes_model: str, proto: bytes) -> Aligner:
    """One per Python worker, for as long as it lives."""
    key = hash(bytes_model), hash(proto)
    if key not in _ready:
        _ready[key] = Aligner(bytes_model, proto)
    return _ready[key]


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256))


def align_texts(docs: DataFrame, text: str = "text", bytes_model: str = BYTES_MODEL, pieces_model: str = PIECES_MODEL) -> tuple[DataFrame, int]:
    """A row per distinct text that isn't empty: its sha256, its rows, the tokens of both, the groups
    and their digest, and its pair codes with how often the text links each (A id times B's size
    plus B id); and B's size. Rows meet by their full text, copies counted before they move.

    A text whose bytes don't come back from either tokenizer has zeros, '' and no pairs.
    """
    a, b = open(bytes_model, encoding="utf-8").read(), open(pieces_model, "rb").read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a, b)
        for batch in batches:
            yield from map(aligner.batch, slices(batch, "text"))

    rows = docs.select(F.col(text).alias("text")).filter("text IS NOT NULL AND text <> ''")
    distinct = rows.groupBy("text").agg(F.count(F.lit(1)).alias("copies")).select("text", _digest("text").alias("digest"), "copies")
    out = materialize(distinct.mapInArrow(run, ALIGNED), "aligned")
    return out, sentencepiece.SentencePieceProcessor(model_proto=b).get_piece_size()


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """(code, n, best): how many links of the corpus hold the pair, each text's times its copies, and
    whether no pair of its B id has more."""
    links = aligned.select("copies", F.explode(F.arrays_zip("codes", "times")).alias("p"))
    counts = links.groupBy(F.col("p.codes").alias("code")).agg(F.sum(F.col("p.times") * F.col("copies")).alias("n"))
    counts = materialize(counts.withColumn("b", F.col("code") % b_size), "pairs")
    top = counts.groupBy("b").agg(F.max("n").alias("most"))
    return materialize(counts.join(top, "b").select("code", "n", (F.col("n") == F.col("most")).alias("best")), "pair_counts")


def link_measures(aligned: DataFrame, counts: DataFrame, front: int = FRONT) -> DataFrame:
    """(digest, n_best, count_sum) of each text. Frequent pairs find their counts in a bounded
    broadcast, so a text is one row before it is shuffled; its other pairs meet theirs in a join."""
    cut = floor_of_most(counts, front)
    links = aligned.select("digest", F.explode(F.arrays_zip("codes", "times")).alias("p")).select("digest", F.col("p.codes").alias("code"), F.col("p.times").alias("times"))
    met = links.join(F.broadcast(counts.filter(F.col("n") >= cut)), "code", "left")
    part = met.groupBy("digest", F.when(F.col("n").isNull(), F.col("code")).alias("open")).agg(
        F.sum("times").alias("times"), F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    part = materialize(part, "link_parts")
    rare = part.filter("open IS NOT NULL").select("digest", "open", "times").join(counts.filter(F.col("n") < cut), F.col("open") == F.col("code"))
    sides = [
        part.filter("open IS NULL").select("digest", "n_best", "count_sum"),
        rare.select("digest", F.when(F.col("best"), F.col("times")).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum")),
    ]
    every = reduce(DataFrame.union, sides)
    return every.groupBy("digest").agg(F.coalesce(F.sum("n_best"), F.lit(0)).alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", front: int = FRONT, **models) -> DataFrame:
    """One row per row of ``docs``: its id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Null and empty texts, and texts that don't come back from both tokenizers, have zeros and an
    empty digest. Repeated rows and repeated texts each get a row and count as often as they
    occur; null ids stay null; an empty table gives an empty result; other columns are ignored.
    A text is never cut: very long ones go through both tokenizers stretch by stretch.
    """
    rows = materialize(docs.select(F.col(doc_id).alias("doc_id"), _digest(text).alias("digest")), "text_digests")
    aligned, b_size = align_texts(docs, text, **models)
    sums = link_measures(aligned, pair_counts(aligned, b_size), front)
    measures = materialize(aligned.select("digest", "n_a", "n_b", "n_groups", "groups_sha256").join(sums, "digest", "left"), "measures")
    out = rows.join(measures, "digest", "left")

    def number(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("long")

    return out.select(
        "doc_id", number("n_a").alias("n_a"), number("n_b").alias("n_b"), number("n_groups").alias("n_groups"), number("n_groups").alias("n_links"),
        number("n_best").alias("n_best"), number("count_sum").alias("count_sum"), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )


def op12_alignment(spark, sf_dir: str) -> DataFrame:
    return align_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
