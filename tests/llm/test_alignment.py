import hashlib
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from civicspark.llm import alignment as A

from .conftest import documents


def byte_value(c):
    """The inverse of the byte-level alphabet, worked out the long way."""
    n = 0
    for b in range(256):
        shown = chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b else chr(256 + n)
        n += shown != chr(b)
        if shown == c:
            return b
    raise KeyError(c)


def brute(rows):
    """Every text tokenised whole, all token pairs whose byte ranges end together."""
    a_model, b_model = Tokenizer.from_file(A.BYTES_MODEL), sentencepiece.SentencePieceProcessor(model_file=A.PIECES_MODEL)
    a_model.encode_special_tokens = True
    out, links = [], []
    for _, text in rows:
        a = a_model.encode(" " + text, add_special_tokens=False) if text else None
        b = b_model.encode(text) if text else []
        a_ids = a.ids if a else []
        a_bytes = [bytes(map(byte_value, t)) for t in (a.tokens if a else [])]
        b_bytes = [bytes([int(p[3:-1], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [b_model.id_to_piece(i)]]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            out.append((0, 0, 0, ""))
            links.append([])
            continue
        ends = [[sum(map(len, x[: i + 1])) for i in range(len(x))] for x in (a_bytes, b_bytes)]
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, lo = [], 0
        for hi in common:
            inside = [",".join(str(i) for i, e in zip(ids, es, strict=True) if lo < e <= hi) for ids, es in zip((a_ids, b), ends, strict=True)]
            groups.append("|".join(inside))
            lo = hi
        out.append((len(a_ids), len(b), len(common), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.append([(x, y) for x, e in zip(a_ids, ends[0], strict=True) for y, f in zip(b, ends[1], strict=True) if e == f])
    counts = Counter(p for x in links for p in x)
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return Counter(
        (r[0], n_a, n_b, n_groups, len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x), digest)
        for r, (n_a, n_b, n_groups, digest), x in zip(rows, out, links, strict=True)
    )


ODD = [
    (1, "The quick brown fox jumps over the lazy dog."),
    (2, "The quick brown fox jumps over the lazy dog."),
    (3, None),
    (4, ""),
    (5, "   leading, trailing   "),
    (6, "a  b   c\n\n d\t e  f  g"),
    (7, "<|endoftext|> <s> </s> <unk> <0x41> ▁ ▁▁x"),
    (8, "naïve café 日本語 \U0001f600\U0001f469‍\U0001f680 Ⅷ ﬁ"),
    (9, " "),
    (10, "\n"),
    (11, "x" * 3000 + " " + "ab " * 500),
    (None, "a null id"),
    (12, "repeated row"),
    (12, "repeated row"),
    (13, "nul \x00 and \x7f don't we'll I'M"),
    (14, "un deux\x1ctrois\x85quatre  cinq"),
    (15, "combining é å x ​﻿ y"),
]


def test_odd_texts_equal_brute_force(spark):
    got = Counter(map(tuple, A.align_documents(documents(spark, ODD)).collect()))
    assert got == brute(ODD)
    assert sum(1 for r in got if r[0] == 7 and r[1] == 0) == 1  # the space sign itself doesn't come back


@pytest.mark.parametrize("front", [0, 64, A.FRONT])
def test_the_given_documents_equal_brute_force(spark, sf_docs, front):
    rows = [(r["doc_id"], r["text"]) for r in sf_docs.filter("length(text) < 4000").collect()]
    got = A.align_documents(sf_docs.filter("length(text) < 4000"), front=front)
    assert Counter(map(tuple, got.collect())) == brute(rows)


def test_the_query_covers_every_document(spark, sf, sf_docs):
    out = A.op12_alignment(spark, sf)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(r["doc_id"] for r in sf_docs.collect())


def test_forgetting_changes_nothing(spark, sf_docs, monkeypatch):
    rows = [r["text"] for r in sf_docs.limit(60).collect()]
    import pyarrow as pa

    def batches(size):
        aligner = A.Aligner(open(A.BYTES_MODEL, encoding="utf-8").read(), open(A.PIECES_MODEL, "rb").read())
        out = []
        for i in range(0, len(rows), size):
            part = rows[i : i + size]
            out += aligner.batch(pa.RecordBatch.from_pydict({"text": part, "digest": [b""] * len(part), "copies": [1] * len(part)})).to_pylist()
        return out

    want = batches(60)
    monkeypatch.setattr(A, "KEPT", 10)
    assert batches(7) == want


def test_empty(empty):
    assert A.align_documents(empty).collect() == []
