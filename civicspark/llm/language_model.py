"""A hashed maximum-entropy language model with a class-factored softmax.

P(word | context) = P(class | context) * P(word | class, context). The commonest words sit in classes
of some dozen words each; all others fall in classes by their last byte, inside which a word has its
smoothed share. Contexts are hashed features: the word before, the pair of words before, and the
words two and three places back (skips). Weights are bounded by the parameters; counts of
words are not, and stay in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.columns import remainder
from civicspark.llm.words import hash_words, slices, text_bytes
from civicspark.session import materialize

#: The token that ends a text.
END = np.uint64(0x5E5E5E5E5E5E5E5F)
#: Commonest words whose counts travel to every task, at most: a megabyte.
FRONT = 1 << 16
#: Classes of common words and their size, classes of other words.
CLASSES, MEMBERS, OTHERS = 8, 32, 8
KINDS, MODEL = CLASSES + OTHERS, CLASSES * MEMBERS
#: Buckets of one word, of a pair, and of the word before inside a class.
ONE, PAIR, INSIDE = 4096, 8192, 512
START = ONE - 1
#: First row of each feature's weights: before, pair, two back, three back.
TABLES = (0, ONE, ONE + PAIR, 2 * ONE + PAIR)
ROWS = 3 * ONE + PAIR
FEATURES = 4
#: Sums are dealt out and collected in so many blocks.
BLOCKS = 256
#: Tokens in one set of arrays.
CHUNK = 1 << 15
#: Weight of the prior in an update: rows seen a few times hardly move.
PRIOR = 3.0


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes with the end token after each text, where each text begins, and the class
    that a token has if it isn't a common word."""
    data, bounds = text_bytes(column)
    hashes, first, last = hash_words(data, bounds)
    texts = len(first) - 1
    at = np.arange(len(hashes)) + np.repeat(np.arange(texts), np.diff(first))
    tokens, other = np.full(len(hashes) + texts, END), np.zeros(len(hashes) + texts, np.int64)
    tokens[at] = hashes
    other[at] = (data[last].astype(np.int64) * 40503 >> 8) % OTHERS if len(last) else 0
    return tokens, first + np.arange(texts + 1), other


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each token with its class and how often it occurs, summed over a few million tokens at a time."""

    def out() -> pa.RecordBatch:
        tokens, first, n = np.unique(np.concatenate(held), return_index=True, return_counts=True)
        kinds = np.concatenate(other)[first]
        return pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(kinds.astype(np.int32)), pa.array(n)], names=["token", "other", "n"])

    held, other, size = [], [], 0
    for batch in batches:
        for part in slices(batch, "text"):
            tokens, _, kinds = _tokens(part["text"])
            held.append(tokens)
            other.append(kinds)
            size += len(tokens)
            if size >= 1 << 22:
                yield out()
                held, other, size = [], [], 0
    if held:
        yield out()


class Front(NamedTuple):
    """The commonest tokens, sorted by hash: counts, and codes for those the model knows by word."""

    hashes: np.ndarray
    counts: np.ndarray
    codes: np.ndarray
    all_: float
    types: float
    others: np.ndarray  # what a share inside each class of other words is divided by


CODED = (
    "tokens long, known long, base double, inside double, codes binary, buckets binary, rare array<long>, times array<int>, kinds array<int>"
)


def _binary(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    offsets = pa.py_buffer((starts * values.itemsize).astype(np.int32).tobytes())
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts) - 1, [None, offsets, pa.py_buffer(values.tobytes())])


def _code(front: Front):
    """Texts as codes and buckets, two bytes each, with the sums that need only the front's counts;
    tokens behind the front are listed with how often they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = np.log10((front.counts + 0.1) / (front.all_ + 0.1 * (front.types + 1)))
        for batch in (part for whole in batches for part in slices(whole, "text")):
            tokens, starts, other = _tokens(batch["text"])
            at = np.minimum(np.searchsorted(front.hashes, tokens), len(front.hashes) - 1)
            hit = front.hashes[at] == tokens
            code = np.where(hit, front.codes[at], -1)
            inside = np.where(hit & (code < 0), np.log10((front.counts[at] + 0.1) / front.others[other]), 0.0)
            codes = np.where(code < 0, MODEL + other, code).astype(np.uint16)
            buckets = (tokens >> np.uint64(52)).astype(np.uint16)
            texts = len(starts) - 1
            text = np.repeat(np.arange(texts), np.diff(starts))[~hit]
            rare = tokens[~hit]
            order = np.lexsort((rare, text))
            text, rare, kinds = text[order], rare[order], other[~hit][order]
            new = np.ones(len(rare), bool)
            new[1:] = (text[1:] != text[:-1]) | (rare[1:] != rare[:-1])
            at_new = np.flatnonzero(new)
            times = np.diff(np.append(at_new, len(rare)))
            ends = pa.array(np.searchsorted(text[at_new], np.arange(texts + 1)), pa.int32())
            lists = [
                pa.ListArray.from_arrays(ends, x)
                for x in (pa.array(rare[at_new].view(np.int64)), pa.array(times, pa.int32()), pa.array(kinds[at_new], pa.int32()))
            ]
            sums = [np.add.reduceat(x, starts[:-1]) for x in ((hit & (front.counts[at] > 0)).astype(np.int64), np.where(hit, base[at], 0.0), inside)]
            yield pa.RecordBatch.from_arrays(
                [*(batch[i] for i in range(batch.num_columns - 1)), pa.array(np.diff(starts)), *map(pa.array, sums), _binary(codes, starts), _binary(buckets, starts), *lists],
                names=[*batch.schema.names[:-1], "tokens", "known", "base", "inside", "codes", "buckets", "rare", "times", "kinds"],
            )

    return run


class Model(NamedTuple):
    """Weights: of the classes by feature row, and of the words of a class by the bucket before."""

    kind_bias: np.ndarray  # KINDS
    kind: np.ndarray  # ROWS x KINDS
    word_bias: np.ndarray  # CLASSES x MEMBERS
    word: np.ndarray  # INSIDE x CLASSES x MEMBERS


def _read(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of texts: the first text's number, where each begins, codes, and the four feature rows."""
    at = 0
    while at < batch.num_rows:
        codes, buckets, starts = [], [], [0]
        begin = at
        while at < batch.num_rows and (at == begin or starts[-1] < CHUNK):
            codes.append(np.frombuffer(batch["codes"][at].as_buffer(), np.uint16))
            buckets.append(np.frombuffer(batch["buckets"][at].as_buffer(), np.uint16))
            starts.append(starts[-1] + len(codes[-1]))
            at += 1
        begins, codes, own = np.array(starts), np.concatenate(codes), np.concatenate(buckets).astype(np.int64)
        back = []
        for k in (1, 2, 3):
            before = np.full(len(own), START)
            before[k:] = own[:-k]
            for j in range(k):
                edge = begins[:-1] + j
                before[edge[edge < begins[1:]]] = START
            back.append(before)
        pair = (back[0] * 0x9E3779B1 + back[1] * 0x85EBCA77 >> 7) % PAIR
        yield begin, begins, codes, np.stack([TABLES[0] + back[0], TABLES[1] + pair, TABLES[2] + back[1], TABLES[3] + back[2]])


def _pieces(starts: np.ndarray, codes: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """A very long text in pieces, so that the arrays of a step stay small."""
    for lo in range(0, len(codes), 2 * CHUNK):
        yield lo, codes[lo : lo + 2 * CHUNK], rows[:, lo : lo + 2 * CHUNK]


def _kinds(codes: np.ndarray) -> np.ndarray:
    return np.where(codes < MODEL, codes // MEMBERS, CLASSES + codes.astype(np.int64) - MODEL).astype(np.int64)


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def _forward(model: Model, codes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """P(class) of every token; which tokens are common words; P(word) inside their class."""
    logits = model.kind_bias + model.kind[rows[0]]
    for i in range(1, FEATURES):
        logits += model.kind[rows[i]]
    common = np.flatnonzero(codes < MODEL)
    group = codes[common] // MEMBERS
    words = model.word[rows[0][common] % INSIDE, group] + model.word_bias[group]
    return _softmax(logits), common, _softmax(words)


def _spread(sums: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Adds each row of ``values`` to its row of ``sums``."""
    order = np.argsort(rows, kind="stable")
    sorted_ = rows[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    sums[sorted_[starts]] += np.add.reduceat(values[order], starts, axis=0)


def _tally(model: Model | None):
    """Observed and, given a model, expected counts of (feature, class) and (bucket, word), in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, word = np.zeros((2, ROWS, KINDS)), np.zeros((2, INSIDE * CLASSES, MEMBERS))
        for batch in batches:
            for _, starts, codes_, rows_ in _read(batch):
                for _, codes, rows in _pieces(starts, codes_, rows_):
                    kinds = _kinds(codes)
                    for i in range(FEATURES):
                        kind[0] += np.bincount(rows[i] * KINDS + kinds, minlength=ROWS * KINDS).reshape(ROWS, KINDS)
                    common = np.flatnonzero(codes < MODEL)
                    group = codes[common].astype(np.int64) // MEMBERS
                    inside = (rows[0][common] % INSIDE) * CLASSES + group
                    word[0] += np.bincount(inside * MEMBERS + codes[common] % MEMBERS, minlength=word[0].size).reshape(word[0].shape)
                    if model is not None:
                        p_kind, _, p_word = _forward(model, codes, rows)
                        for i in range(FEATURES):
                            _spread(kind[1], rows[i], p_kind)
                        if len(common):
                            _spread(word[1], inside, p_word)
        sides = 1 if model is None else 2
        flat = np.concatenate([kind[:sides].reshape(sides, -1), word[:sides].reshape(sides, -1)], axis=1).astype(np.float32)
        for block, part in enumerate(np.array_split(flat, BLOCKS, axis=1)):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["block", "sums"])

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of each block's rows, as they stream in."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, raw in zip(batch["block"].to_pylist(), batch["sums"]):
            values = np.frombuffer(raw.as_buffer(), np.float32).astype(np.float64)
            held[block] = held[block] + values if block in held else values
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())], names=["block", "sums"])


def _gather(coded: DataFrame, model: Model | None) -> tuple[np.ndarray, np.ndarray]:
    """Observed and expected counts over all training texts. A task sends its sums once, whatever
    its texts; blocks are added up on the cluster, and the driver gets one model's worth of numbers."""
    sums = coded.select("codes", "buckets").mapInArrow(_tally(model), "block int, sums binary")
    rows = sums.repartition("block").mapInArrow(_add, "block int, sums binary").collect()
    sides = 1 if model is None else 2
    parts = [np.frombuffer(r["sums"], np.float64).reshape(sides, -1) for r in sorted(rows, key=lambda r: r["block"])]
    flat = np.concatenate(parts, axis=1) if parts else np.zeros((sides, ROWS * KINDS + INSIDE * MODEL))
    return flat[:, : ROWS * KINDS].reshape(sides, ROWS, KINDS), flat[:, ROWS * KINDS :].reshape(sides, INSIDE, CLASSES, MEMBERS)


def train(coded: DataFrame, rounds: int = 2) -> Model:
    """Weights by ``rounds`` full-batch updates.

    The gradient of a weight is its observed less its expected count. A step moves it by the log of
    their ratio, damped by a prior and divided by the features that are active together, which
    keeps the steps stable without a rate. Before the first step the model knows shares only, so
    its expected counts follow from the observed ones without a pass.
    """
    (kind,), (word,) = _gather(coded, None)
    per_kind = kind[: ONE].sum(axis=0) + 1.0
    shares = per_kind / per_kind.sum()
    per_word = word.sum(axis=0) + 0.5
    word_shares = per_word / per_word.sum(axis=1, keepdims=True)
    model = Model(
        np.log(shares).astype(np.float32), np.zeros((ROWS, KINDS), np.float32),
        np.log(word_shares).astype(np.float32), np.zeros((INSIDE, CLASSES, MEMBERS), np.float32),
    )
    seen = np.stack([kind, kind.sum(axis=1, keepdims=True) * shares]), np.stack([word, word.sum(axis=2, keepdims=True) * word_shares])
    for step in range(rounds):
        kinds, words = seen if step == 0 else _gather(coded, model)
        # The prior pulls towards what is expected, in proportion to it.
        by_kind = np.log((kinds[0] + PRIOR * shares) / (kinds[1] + PRIOR * shares)) / (FEATURES / 2)
        by_word = np.log((words[0] + PRIOR * word_shares) / (words[1] + PRIOR * word_shares))
        model = model._replace(kind=(model.kind + by_kind).astype(np.float32), word=(model.word + by_word).astype(np.float32))
    return model


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, starts, codes_, rows_ in _read(batch):
                logs = np.empty(len(codes_))
                for lo, codes, rows in _pieces(starts, codes_, rows_):
                    p_kind, common, p_word = _forward(model, codes, rows)
                    own = np.log10(p_kind[np.arange(len(codes)), _kinds(codes)].astype(np.float64))
                    own[common] += np.log10(p_word[np.arange(len(common)), codes[common] % MEMBERS].astype(np.float64))
                    logs[lo : lo + len(codes)] = own
                k = len(starts) - 1
                yield pa.RecordBatch.from_arrays([batch["row"].slice(begin, k), pa.array(np.add.reduceat(logs, starts[:-1]))], names=["row", "model"])

    return run


def _commonest(counts: DataFrame, most: int) -> list:
    """At most ``most`` tokens with the highest counts, highest first. Tokens are first counted by
    size class, a few thousand rows at most; what comes to the driver is only the classes that
    fit in whole, and not every task's own best."""
    size = F.floor(F.log2("n") * 64)
    classes = counts.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("m")).collect()
    cut, held = None, 0
    for r in sorted(classes, key=lambda r: -r["size"]):
        held += r["m"]
        if held > most:
            break
        cut = r["size"]
    rows = [] if cut is None else counts.filter(size >= cut).select("token", "n").collect()
    return sorted(rows, key=lambda r: (-r["n"], r["token"]))


def score_texts(docs: DataFrame, modulus: int = 10, rounds: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from all rows whose id isn't held out (crc32 of the id as text modulo ``modulus`` is not
    0; a null id counts as an empty text), scores all of them. Tokens are words (A-Z lower-cased)
    and one end for each text, so a null or empty text has one token. Every row is a text of its
    own, repeated ones too. With nothing to learn from every word is unknown and the scores are
    defined all the same. An empty table gives an empty result.

    Counts of all words are made by Spark. The commonest ``FRONT`` of them travel to every task;
    the rest meet the texts in a join, where no word is hot, since all frequent ones are in front.
    """
    rows = docs.select(F.col(doc_id).alias("id"), (remainder(F.col(doc_id), modulus) == 0).alias("held_out"), F.col(text).alias("text"))
    counts = rows.filter("NOT held_out").select("text").mapInArrow(_count, "token long, other int, n long")
    counts = materialize(counts.groupBy("token").agg(F.sum("n").alias("n"), F.min("other").alias("other")), "counts")
    end = int(END)
    total = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    top = _commonest(counts.filter(F.col("token") != end), FRONT - 1)
    ends = counts.filter(F.col("token") == end).agg(F.sum("n")).first()[0] or 0
    hashes = np.array([end, *(r["token"] for r in top)], np.int64).view(np.uint64)
    known = np.array([ends, *(r["n"] for r in top)], np.int64)
    codes = np.where(np.arange(len(hashes)) < MODEL, np.arange(len(hashes)), -1)
    common = counts.filter(F.col("token").isin([int(h) for h in hashes[:MODEL].view(np.int64)]))
    inside, out = ({r["other"]: (r["s"], r["v"]) for r in x.groupBy("other").agg(F.sum("n").alias("s"), F.count(F.lit(1)).alias("v")).collect()} for x in (common, counts))
    rest = [[a - b for a, b in zip(out.get(k, (0, 0)), inside.get(k, (0, 0)))] for k in range(OTHERS)]
    others = np.array([s + 0.1 * (v + 1) for s, v in rest])
    order = np.argsort(hashes)
    all_, types = total[0] or 0, total[1]
    front = Front(hashes[order], known[order], codes[order], float(all_), float(types), others)

    kind = rows.schema["id"].dataType.simpleString()
    coded = rows.mapInArrow(_code(front), f"id {kind}, held_out boolean, {CODED}")
    coded = materialize(coded.withColumn("row", F.monotonically_increasing_id()), "coded")
    model = train(coded.filter("NOT held_out"), rounds)
    scored = coded.select("row", "codes", "buckets").mapInArrow(_score(model), "row long, model double")

    rare = coded.select("row", F.explode(F.arrays_zip("rare", "times", "kinds")).alias("x")).select("row", "x.*")
    met = rare.join(counts.select(F.col("token").alias("rare"), "n"), "rare", "left")
    n, times = F.coalesce("n", F.lit(0)), F.col("times")
    divisor = F.element_at(F.array(*(F.lit(float(x)) for x in others)), F.col("kinds") + 1)
    sums = met.groupBy("row").agg(
        F.sum(F.when(n > 0, times).otherwise(0)).alias("known_rare"),
        F.sum(times * F.log10((n + 0.1) / (all_ + 0.1 * (types + 1)))).alias("base_rare"),
        F.sum(times * F.log10((n + 0.1) / divisor)).alias("inside_rare"),
    )
    facts = coded.select("row", "id", "held_out", "tokens", "known", "base", "inside")
    both = facts.join(scored, "row").join(sums, "row", "left")
    plus = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return both.select(
        "id", "held_out", F.col("tokens").alias("n_tokens"), plus("known", "known_rare").alias("n_known"), F.lit(all_).cast("long").alias("train_tokens"),
        plus("base", "base_rare").alias("base_score"), (F.col("model") + plus("inside", "inside_rare")).alias("score"),
    )


def op10_language_model(spark, sf_dir: str) -> DataFrame:
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")
