"""Secrets in texts: three known forms, and strings in a sensitive place that nothing helps to compress."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from math import log2

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from civicspark.llm.columns import floor_of_most, whole
from civicspark.session import materialize

# The known forms; upper and lower case count as one in the words of the first.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "novel")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
HEX = re.compile(f"[0-9a-f]{{{LEAST_HEX},}}")  # only a whole run can be long enough

#: Words that make a place sensitive, and how many characters before a string they may stand.
SENSITIVE = re.compile(r"pass(?:word|wd|phrase|code)|pwd|secret|token|key|auth|credential|bearer|private|signature|cookie|session", re.ASCII | re.IGNORECASE)
NEAR = 64
#: What may be a secret of no known form, unless it is part of an address.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.~=@-])[A-Za-z0-9+/_.~=-]{16,}+(?!@)", re.ASCII)
#: Texts without any of these have neither spans nor candidates: most never become Python strings.
ANY = r"(?i)pass(word|wd|phrase|code)|pwd|secret|token|key|auth|credential|bearer|private|signature|cookie|session|AKIA[A-Z0-9]|[0-9a-f]{16}"
#: Code points of surrounding text on either side that a candidate is measured against.
AROUND = 256
#: Entries of the identifier dictionary, and the longest with and without a digit: what is longer and
#: has digits may be somebody's secret, copied often.
ENTRIES, LONGEST_PLAIN, LONGEST_MIXED = 8192, 24, 10
#: Bits that a candidate must add to be reported, as a share of those of a random string of its alphabet.
#: Random strings measure 1.13 and more, as they come out whole; identifiers and paths 0.92 and less.
NOVEL = 1.05
LEVEL = 12

SPANS = "array<struct<kind: string, start: int, end: int, text: string, novelty: double>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the known forms, leftmost and not overlapping within a kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Long strings of letters and digits in a sensitive place that touch no known form."""
    places = [m.start() for m in SENSITIVE.finditer(text)]
    out = []
    if not places:
        return out
    free_from, spans = 0, iter(taken)
    ahead = next(spans, None)
    for m in CANDIDATE.finditer(text):
        start, end = m.start(), m.end()
        while end > start and text[end - 1] in ".-~":
            end -= 1
        while ahead is not None and ahead[0] < end:
            free_from, ahead = max(free_from, ahead[2]), next(spans, None)
        if start < free_from or end - start < 16:
            continue
        at = bisect_left(places, start - NEAR)
        if at == len(places) or places[at] >= end or text[max(start - 3, 0) : start] == "://":
            continue
        word = text[start:end]
        if any(c.isdigit() for c in word) and any(c.isalpha() for c in word):
            out.append((start, end))
    return out


class Novelty:
    """How many bytes a string adds to the text around it, compressed after the dictionary."""

    def __init__(self, entries: list[str]):
        # the likeliest entries last: what is near costs least to point at
        content = " ".join(reversed(entries)).encode()
        primed = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(content) >= 8 else None
        if primed:
            primed.precompute_compress(level=LEVEL)
        self.zip = zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_checksum=False, write_content_size=False, write_dict_id=False)

    def size(self, text: str) -> int:
        return len(self.zip.compress(text.encode()))

    def measure(self, text: str, start: int, end: int) -> float:
        """The bits that ``text[start:end]`` adds, as a share of those of a random string of its
        length over the letters and digits of its kinds."""
        word, before, after = text[start:end], text[max(0, start - AROUND) : start], text[end : end + AROUND]
        added = self.size(before + word + after) - self.size(before + after)
        low, lower, upper = all(c in "0123456789abcdef-_" for c in word), any("a" <= c <= "z" for c in word), any("A" <= c <= "Z" for c in word)
        letters = 16 if low else 10 + 26 * lower + 26 * upper
        return 8 * added / (len(word) * log2(letters))


def identifiers(docs: DataFrame, text: str = "text", entries: int = ENTRIES) -> list[str]:
    """The commonest words and identifiers of all texts, those that occur once left out: words of
    letters, and short ones with digits. Counted where they are read before they are shuffled; only
    those above a count that at most ``entries`` reach leave the cluster, the commonest first."""
    words = docs.select(F.explode(F.split(whole(text), r"[^\p{L}\p{N}]+")).alias("w"))
    fit = F.length("w").between(4, LONGEST_PLAIN) & (F.col("w").rlike(r"^\p{L}+$") | (F.length("w") <= LONGEST_MIXED) & F.col("w").rlike(r"^\p{L}"))
    counts = materialize(words.groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").filter(fit), "identifiers")
    rows = counts.filter(F.col("n") >= floor_of_most(counts, entries)).collect()
    return [r["w"] for r in sorted(rows, key=lambda r: (-r["n"], r["w"]))]


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", entries: list[str] | None = None, novel: float = NOVEL) -> DataFrame:
    """One row per row of ``docs``: its id and ``spans``, by start and then kind, each with its kind,
    its code points (end exclusive), its text, and for those the method adds their novelty.

    The known forms are found by their patterns in the whole text. Beyond them, a long string of
    letters and digits near a sensitive word is reported if it adds nearly as many compressed bytes as
    a random one would, zstandard being primed with the identifiers of all documents (``entries``) and
    given the code around it. Null and empty texts have no spans; repeated rows each get theirs; ids
    of any type pass through, null ones too; other columns are ignored; an empty table gives an empty
    result.
    """
    entries = identifiers(docs, text) if entries is None else entries
    kind = StructType.fromDDL(f"spans {SPANS}")["spans"]
    schema = StructType([StructField("doc_id", docs.schema[doc_id].dataType), kind])

    def spans_of(body: str, novelty: Novelty) -> list[dict]:
        found = base_spans(body)
        rows = [(s, k, e, None) for s, k, e in found]
        for s, e in candidates(body, found):
            if (share := novelty.measure(body, s, e)) >= novel:
                rows.append((s, 3, e, share))
        return [{"kind": KINDS[k], "start": s, "end": e, "text": body[s:e], "novelty": x} for s, k, e, x in sorted(rows, key=lambda r: r[:2])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(entries)
        inner = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("text", pa.string()), ("novelty", pa.float64())]))
        for batch in batches:
            maybe = pc.match_substring_regex(batch["text"], ANY).to_pylist()
            spans = [spans_of(batch["text"][i].as_py(), novelty) if hit else [] for i, hit in enumerate(maybe)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(spans, inner)], names=["doc_id", "spans"])

    return docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text")).mapInArrow(run, schema)


def _number(kind: str) -> Column:
    return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))


def op11_secrets(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = _joined(F.filter("spans", lambda x: x["kind"] != KINDS[-1]))
    return found.select(
        "doc_id", *map(_number, KINDS), F.sha2(base.cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans")
    )
