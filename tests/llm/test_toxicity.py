import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicspark.llm import toxicity as T
from civicspark.llm.columns import remainder

from .conftest import documents


def corpus(n=600):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        own = ["w" + "".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(rng.randrange(20, 120))]
        bad = i % 6 == 0
        if bad:
            own[rng.randrange(len(own))] = rng.choice(("scum", "loser", "Ekelhart", "ekelnis"))
            own[rng.randrange(len(own))] = rng.choice(("moron", "idiot"))
        rows.append((i, " ".join(own)))
        labels.append((i, int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def learned(spark):
    rows, labels = corpus()
    return T.learn(documents(spark, rows), T.training_rows(spark.createDataFrame(labels, "doc_id long, toxic int")))


def test_held_out_labels_are_met(spark, learned):
    rows, labels = corpus()
    truth = dict(labels)
    out = T.score_texts(documents(spark, rows), learned).withColumn("held", remainder(F.col("doc_id"), 5) == 0).filter("held").collect()
    assert len(out) > 80 and sum((r["score"] >= 0.5) == bool(truth[r["doc_id"]]) for r in out) >= 0.97 * len(out)


def test_disguises_and_exceptions(spark, learned):
    clean = "wabc wbcd wcde " * 10
    rows = [(1, clean + "1d10t sсum"), (2, clean + "ÍDÏOT and ѕcum"), (3, clean + "ｉｄｉｏｔ mo​ron"), (4, clean + "pond scum in the pond"), (5, clean), (6, clean + "idiotic scumbag")]
    s = {r["doc_id"]: r["score"] for r in T.score_texts(documents(spark, rows), learned).collect()}
    assert min(s[1], s[2], s[3]) > 0.5 > max(s[4], s[5])


def test_odd_texts(spark, learned):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "idiot"), (4, "idiot"), (4, "idiot"), (5, "x " * 200000)]
    out = T.score_texts(documents(spark, rows), learned, carry=("doc_id", "score", "key")).collect()
    assert len(out) == 7 and all(0 <= r[-1] <= 1 for r in out)
    assert len({r[-1] for r in out if r["doc_id"] in (1, 2, 3, 5)}) == 1


def test_labels_are_only_learned_from_the_given_rows(spark):
    rows, labels = corpus(120)
    odd = labels + [(None, 1), (5, None), (99999, 1), (0, 1)]
    a, b = (T.learn(documents(spark, rows), spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, odd))
    assert a == b


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(1, 1), (2, 1)]])
def test_one_kind_of_label_gives_a_constant(spark, labels):
    scorer = T.learn(documents(spark, [(1, "a"), (2, "b")]), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert len({r["score"] for r in T.score_texts(documents(spark, [(1, "idiot"), (2, None)]), scorer).collect()}) == 1


def test_empty_tables(spark, empty, learned):
    assert T.score_texts(empty, learned).count() == 0 and T.drop_toxic(empty, learned).count() == 0
    assert T.learn(empty, spark.createDataFrame([(1, 1)], "doc_id long, toxic int")).weights == {}


def test_the_filter_keeps_columns_and_clean_rows(spark, learned):
    rows, labels = corpus(120)
    docs = documents(spark, rows)
    out = T.drop_toxic(docs, learned)
    scores = T.score_texts(docs, learned).filter("score < 0.5")
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in scores.collect()}


def test_matches_are_those_of_a_search_at_every_place():
    rng = random.Random(12)
    scorer = T.Scorer({" ab": 3.5, " abba ": 4.0, " caab ": 5.0, " bac": 3.1, " cé ": 6.0}, ("abba cab", "bac b"), (0.0, 0.0, 0.0))
    automaton = scorer.automaton()
    for _ in range(1500):
        text = " ".join("".join(rng.choice("aàbBcé4") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(0, 14)))
        folded, best, spared = T.fold(text), {}, set()
        for form in {folded, T.fold(text, T.ACCENTED)}:
            for i in range(len(form)):
                for pattern, weight in scorer.weights.items():
                    if form.startswith(pattern, i):
                        best[i] = max(best.get(i, 0.0), weight)
                for phrase in scorer.exceptions:
                    if form.startswith(T.fold(phrase), i):
                        spared |= set(range(i, i + len(T.fold(phrase)) - 1))
        total = sum(w for i, w in best.items() if i not in spared)
        assert T.measure(text, automaton) == pytest.approx((np.log1p(total), np.log1p(100 * total / max(1, len(folded.split())))))
