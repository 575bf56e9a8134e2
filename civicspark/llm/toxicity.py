"""Toxic documents by a weighted lexicon that is learned from labels and matched in folded text."""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.columns import remainder
from civicspark.session import materialize

#: Letters of other scripts that look like Latin ones, and digits and signs put for letters.
HOMOGLYPHS = dict(zip("аеорсухкмтвнѕіјԁɡαεικνορτυχβη", "aeopcyxkmtbhsijdgaeiknoptuxbn"))
SUBSTITUTES = dict(zip("01345789@$", "oieastbgas"))
#: Phrases in which a listed word says nothing about the text.
EXCEPTIONS = ("trash can", "trash cans", "trash bag", "trash bags", "trash collection", "clown fish", "circus clown", "pond scum", "soap scum")


class Fold(dict):
    """A translation table filled as letters are met: look-alikes, digits and case go, letters that
    are often swapped (i, l, 1) become one, everything else becomes a space. ``plain`` takes the
    accents off as well; both kinds turn a character into equally many."""

    def __init__(self, plain: bool):
        super().__init__()
        self.plain = plain

    def __missing__(self, code: int) -> str:
        if unicodedata.category(chr(code)) in ("Cf", "Mn"):
            out = ""  # zero-width signs, and accents that stand alone
        else:
            letters = unicodedata.normalize("NFKC", chr(code).lower())
            bases = [unicodedata.normalize("NFKD", c)[0] for c in letters]
            folded = [SUBSTITUTES.get(x, HOMOGLYPHS.get(x, x)) for x in bases]
            # An accent stays only on a letter that is itself.
            kept = [y if self.plain or x != y else c for c, x, y in zip(letters, bases, folded)]
            out = "".join(("i" if c == "l" else c) if c.isalnum() else " " for c in kept) or " "
        self[code] = out
        return out


PLAIN, ACCENTED = Fold(True), Fold(False)


def fold(text: str | None, table: Fold = PLAIN) -> str:
    """Words parted by single spaces or more, a space at either end."""
    return f" {(text or '').translate(table)} "


class Scorer(NamedTuple):
    """Patterns with weights, and the logistic curve over the two length-normalised sums."""

    weights: dict[str, float]
    exceptions: tuple[str, ...]
    curve: tuple[float, float, float]

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for pattern, weight in self.weights.items():
            found.add_word(pattern, (len(pattern), weight))
        for phrase in self.exceptions:
            found.add_word(fold(phrase), (len(fold(phrase)), None))
        if len(found):
            found.make_automaton()
        return found


def grams(folded: str, shortest: int, longest: int) -> set[str]:
    """What a lexicon entry can be: a whole word, or the beginning of one."""
    out = set()
    for word in set(folded.split()):
        if shortest <= len(word) <= 24:
            out.add(f" {word} ")
        for k in range(shortest, min(longest, len(word) - 1) + 1):
            out.add(" " + word[:k])
    return out


def measure(text: str | None, automaton: ahocorasick.Automaton) -> tuple[float, float]:
    """The log of the matched weight, and of the matched weight per hundred words. Each word
    counts once, with its heaviest pattern, with or without its accents; words inside an
    exception phrase don't count."""
    folded, best, spared = fold(text), {}, []
    accented = fold(text, ACCENTED)
    for form in (folded, accented) if accented != folded else (folded,):
        for end, (length, weight) in automaton.iter(form) if len(automaton) else ():
            start = end - length + 1
            if weight is None:
                spared.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
    if spared and best:
        covered = np.zeros(len(folded), bool)
        for start, end in spared:
            covered[start:end] = True
        best = {k: v for k, v in best.items() if not covered[k]}
    total = sum(best.values())
    return float(np.log1p(total)), float(np.log1p(100 * total / max(1, len(folded.split()))))


def _count(shortest: int, longest: int, flush: int = 300_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0, 0])

        def out() -> pa.RecordBatch:
            columns = np.array(list(counts.values()), np.int64).reshape(-1, 4)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), *(pa.array(columns[:, i]) for i in range(4))], names=["gram", "p0", "n0", "p1", "n1"]
            )
            counts.clear()
            return batch

        for batch in batches:
            for text, toxic, half in zip(batch["text"], batch["toxic"], batch["half"]):
                at = 2 * half.as_py() + (0 if toxic.as_py() else 1)
                text = text.as_py()
                for gram in grams(fold(text) + fold(text, ACCENTED), shortest, longest):
                    counts[gram][at] += 1
                if len(counts) >= flush:
                    yield out()
        yield out()

    return run


def _weights(rows: list, toxic: float, clean: float, p: str, n: str, least: float, size: int) -> dict[str, float]:
    """Log-odds of the grams. A beginning goes if nearly all its support is one longer gram, which
    is more exact; a longer gram goes if a beginning that is left says as much."""
    found, support, longer = {}, {}, defaultdict(int)
    for r in rows:
        pos, neg = sum(r[c] for c in p.split()), sum(r[c] for c in n.split())
        weight = np.log((pos + 0.5) / (toxic + 1)) - np.log((neg + 0.5) / (clean + 1))
        if pos >= 2 and weight >= least:
            found[r["gram"]], support[r["gram"]] = float(weight), pos
    for gram, pos in support.items():
        for k in range(2, len(gram)):
            longer[gram[:k]] = max(longer[gram[:k]], pos)
    kept: dict[str, float] = {}
    for gram in sorted(found, key=len):
        parents = (kept.get(gram[:k], 0.0) for k in range(2, len(gram)))
        if longer[gram] < 0.9 * support[gram] and max(parents, default=0.0) < found[gram] - 0.5:
            kept[gram] = found[gram]
    return dict(sorted(kept.items(), key=lambda x: (-x[1], x[0]))[:size])


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Logistic regression by Newton's method."""
    x, w = np.column_stack([np.ones(len(x)), x]), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(3), x.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def learn(
    docs: DataFrame, labels: DataFrame, rows: int = 20_000, size: int = 4_000, least: float = 3.0, shortest: int = 3, longest: int = 8,
    exceptions: tuple[str, ...] = EXCEPTIONS, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic",
) -> Scorer:
    """A scorer from labelled documents.

    ``labels`` holds the rows to learn from; rows with a null id or label, and ids without a
    document, are left out. About ``rows`` of them are used, those with a digest of the id below a
    cut: the documented bound that lets their ids be broadcast. Grams are counted by Spark in two halves;
    each half's lexicon is measured on the other, so the curve is fitted to figures that no label
    has leaked into. The final lexicon of at most ``size`` patterns uses both. Without labels of
    both kinds the score is one constant, the share of toxic rows.
    """
    key = F.col(doc_id).cast("string")
    own = labels.select(F.col(doc_id).alias("id"), F.col(toxic).cast("int").alias("toxic"), F.md5(key).alias("order")).dropna().dropDuplicates(["id"])
    own = own.withColumn("half", (F.crc32(F.col("order").cast("binary")) % 2).cast("int"))
    own = materialize(own, "own_labels")
    n = own.count()
    if n > rows:
        own = own.filter(F.conv(F.substring("order", 1, 12), 16, 10).cast("double") / float(16**12) < rows / n)
    picked = materialize(own, "picked")
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(picked), "id")
    texts = materialize(texts.select("text", "toxic", "half"), "labelled")
    seen = {(r["toxic"] > 0, r["half"]): r["count"] for r in texts.groupBy("toxic", "half").count().collect()}
    t0, c0, t1, c1 = (seen.get(k, 0) for k in ((True, 0), (False, 0), (True, 1), (False, 1)))
    if not (t0 + t1 and c0 + c1):
        share = (t0 + t1 + 0.5) / (t0 + t1 + c0 + c1 + 1)
        return Scorer({}, (), (float(np.log(share / (1 - share))), 0.0, 0.0))
    counts = texts.mapInArrow(_count(shortest, longest), "gram string, p0 long, n0 long, p1 long, n1 long")
    counts = counts.groupBy("gram").agg(*(F.sum(c).alias(c) for c in ("p0", "n0", "p1", "n1")))
    pos, neg = F.col("p0") + F.col("p1"), F.col("n0") + F.col("n1")
    weight = F.log((pos + 0.5) / (t0 + t1 + 1)) - F.log((neg + 0.5) / (c0 + c1 + 1))
    best = counts.filter((pos >= 3) & (weight >= least)).orderBy((F.sqrt(pos) * weight).desc(), "gram").limit(8 * size).collect()
    halves = [Scorer(_weights(best, t1, c1, "p1", "n1", least, size), exceptions, (0, 0, 0)), Scorer(_weights(best, t0, c0, "p0", "n0", least, size), exceptions, (0, 0, 0))]
    figures = texts.mapInArrow(_figures(halves), "toxic int, a double, b double").collect()
    data = np.array([(r["a"], r["b"], r["toxic"] > 0) for r in figures], float)
    curve = _fit(data[:, :2], data[:, 2])
    return Scorer(_weights(best, t0 + t1, c0 + c1, "p0 p1", "n0 n1", least, size), exceptions, curve)


def _figures(halves: list[Scorer]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [x.automaton() for x in halves]
        for batch in batches:
            found = [measure(t.as_py(), automata[h.as_py()]) for t, h in zip(batch["text"], batch["half"])]
            columns = np.array(found, float).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch["toxic"], pa.array(columns[:, 0]), pa.array(columns[:, 1])], names=["toxic", "a", "b"])

    return run


def _score(scorer: Scorer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, w = scorer.automaton(), np.array(scorer.curve)
        for batch in batches:
            found = np.array([measure(t.as_py(), automaton) for t in batch["text"]], float).reshape(-1, 2)
            score = 1 / (1 + np.exp(-np.clip(w[0] + found @ w[1:], -500, 500)))
            others = [batch[i] for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*others, pa.array(score)], names=[*batch.schema.names[:-1], "score"])

    return run


def score_texts(docs: DataFrame, scorer: Scorer, carry: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns ``carry`` of each row and its ``score`` from 0 to 1. Whole texts are matched;
    null counts as empty, and an empty text gets the curve's lowest score. No shuffle."""
    kinds = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carry))
    rows = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(carry)), F.col(text).alias("text"))
    out = rows.mapInArrow(_score(scorer), f"{kinds}, score double")
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(carry)), "score")


def _keep(scorer: Scorer, text: str, limit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, w = scorer.automaton(), np.array(scorer.curve)
        for batch in batches:
            found = np.array([measure(t.as_py(), automaton) for t in batch[text]], float).reshape(-1, 2)
            yield batch.filter(pa.array(w[0] + found @ w[1:] < limit))

    return run


def drop_toxic(docs: DataFrame, scorer: Scorer, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, all their columns as they are. Texts
    go through once and nothing is shuffled."""
    limit = float(np.log(threshold / (1 - threshold)))
    return docs.mapInArrow(_keep(scorer, text, limit), docs.schema)


def training_rows(labels: DataFrame, modulus: int = 5, doc_id: str = "doc_id") -> DataFrame:
    """The labelled rows that may be learned from: those whose id isn't held out."""
    return labels.filter(remainder(F.col(doc_id), modulus) != 0)


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scorer = learn(docs, training_rows(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    out = score_texts(docs, scorer)
    held = remainder(F.col("doc_id"), 5) == 0
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
