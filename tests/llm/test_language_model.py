import math
import zlib
from collections import Counter

import numpy as np
import pytest

from civicspark.llm import language_model as L

from .conftest import documents, words


def base(rows):
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    tokens = [(d, held(d), [*words(t), None]) for d, t in rows]
    c = Counter(w for _, h, ws in tokens if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return sorted(
        ((d, h, len(ws), sum(w in c for w in ws), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for d, h, ws in tokens), key=repr
    )


def check(out, want):
    got = sorted((tuple(r) for r in out), key=repr)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: (repr(r[0]), r[2], r[5])), sorted(want, key=lambda r: (repr(r[0]), r[2], r[5]))):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9) and g[6] < 0


@pytest.mark.parametrize("front", [1 << 16, 300])
def test_base_equals_brute_force_whatever_the_front(spark, sf_docs, front, monkeypatch):
    monkeypatch.setattr(L, "FRONT", front)
    rows = [(r["doc_id"], r["text"]) for r in sf_docs.collect()]
    check(L.score_texts(sf_docs).collect(), base(rows))


def test_the_model_beats_the_base_on_held_out_texts(spark, sf):
    docs = spark.read.parquet(sf.replace("sf0.001", "sf0.01") + "/documents.parquet")
    held = L.score_texts(docs).filter("held_out").collect()
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b a"), (4, "a b a"), (None, "a"), (5, "never " * 70000), (31, "x y z")]
    check(L.score_texts(documents(spark, rows)).collect(), base(rows))


def test_nothing_to_learn_from(spark, empty):
    assert L.score_texts(empty).count() == 0
    rows = [(None, "a b"), (None, None)]  # a null id is held out
    out = L.score_texts(documents(spark, rows)).collect()
    assert all(r["held_out"] and r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in out)


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(3)
    model = L.Model(*(rng.standard_normal(s).astype(np.float32) for s in ((L.KINDS,), (L.ROWS, L.KINDS), (L.CLASSES, L.MEMBERS), (L.INSIDE, L.CLASSES, L.MEMBERS))))
    codes = np.arange(L.MODEL + L.OTHERS).astype(np.uint16)
    rows = np.repeat(np.array([[5], [L.ONE + 9], [L.ONE + L.PAIR + 3], [2 * L.ONE + L.PAIR + 1]]), len(codes), axis=1)
    kind, common, word = L._forward(model, codes, rows)
    own = kind[np.arange(len(codes)), L._kinds(codes)].astype(float)
    own[common] *= word[np.arange(len(common)), codes[common] % L.MEMBERS]
    assert own.sum() == pytest.approx(1, abs=1e-5)


def test_updates_move_to_the_observed_counts(spark, sf_docs):
    """A second round makes training texts likelier than the first."""
    one, two = (sum(r["score"] for r in L.score_texts(sf_docs, rounds=n).filter("NOT held_out").collect()) for n in (1, 2))
    assert two > one
