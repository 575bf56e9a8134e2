import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from civicspark.llm import words as W
from civicspark.llm.columns import likely_among

from .conftest import words

TEXT = st.text(alphabet=st.sampled_from("aAbZé \t\n\x0b\x1f\xa0ß"), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_words_are_told_apart_like_text(texts):
    hashes, first, _ = W.hash_words(*W.text_bytes(pa.array(texts, pa.string())))
    want = [words(t) for t in texts]
    assert np.diff(first).tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))


def test_a_text_longer_than_a_chunk_hashes_like_a_short_one(monkeypatch):
    text = " ".join(f"word{i % 97}" for i in range(500)) + " " + "x" * 3000 + " End"
    want, at, last = W.hash_words(*W.text_bytes(pa.array(["a b", text, None, "c"])))
    monkeypatch.setattr(W, "CHUNK", 64)
    monkeypatch.setattr(W, "_POWERS", {})
    got, at2, last2 = W.hash_words(*W.text_bytes(pa.array(["a b", text, None, "c"])))
    assert (want == got).all() and (at == at2).all() and (last == last2).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXT, max_size=6), st.integers(1, 5))
def test_shingles(texts, width):
    hashes, first, _ = W.hash_words(*W.text_bytes(pa.array(texts, pa.string())))
    got, at = W.shingles(hashes, first, width)
    names = {}
    for i, t in enumerate(texts):
        w = words(t)
        want = [tuple(w[j : j + width]) for j in range(len(w) - width + 1)] or ([tuple(w)] if w else [])
        own = got[at[i] : at[i + 1]].tolist()
        assert len(own) == len(want)
        for name, value in zip(want, own):
            assert names.setdefault(name, value) == value
    assert len(set(names.values())) == len(names)


def test_slices_keep_every_row():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "b" * 50, "", "c"])], names=["text"])
    parts = list(W.slices(batch, "text", 20))
    assert sum((p["text"].to_pylist() for p in parts), []) == batch["text"].to_pylist() and len(parts) > 1


def test_the_filter_keeps_every_wanted_row(spark):
    rows = spark.createDataFrame([(i if i % 7 else None, f"t{i}") for i in range(3000)], "id long, text string")
    ids = rows.filter("id % 11 = 0 OR id IS NULL").select("id").distinct()
    out = likely_among(rows, F.col("id"), ids, "id")
    assert out.columns == rows.columns
    want = {r["text"] for r in rows.filter("id % 11 = 0 OR id IS NULL").collect()}
    got = {r["text"] for r in out.collect()}
    assert want <= got and len(got) < len(want) + 20
