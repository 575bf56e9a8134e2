import math
import random
import re
from collections import Counter

import pytest

from civicspark.llm import search as S

from .conftest import documents


def terms(text):
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", low)


def brute(rows, items, top=10):
    """Every item against every document."""
    held = [(d, Counter(terms(t)), len(terms(t))) for d, t in rows]
    n_docs, words = sum(n > 0 for *_, n in held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c, n in held:
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * (100 - 75 + (75 * n * n_docs) // words)))
            if score > 0:
                found.append((-score, d is None, d, score))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, k + 1, d, s) for k, (_, _, d, s) in enumerate(found[:top])]
    return Counter(out)


ITEMS = "item_id long, text string, doc_id long, term string, rank int, item long"


def asked(spark, items):
    return spark.createDataFrame([(i, t, 7, "x", 7, 7) for i, t in items], ITEMS)


def random_rows(n, seed):
    draw = random.Random(seed)
    pool = [f"w{i}" for i in range(60)] + ["É", "été", "42", "Don't", "a_b", "日本"]
    return [(i, " ".join(draw.choices(pool, k=draw.randint(0, 40)))) for i in range(n)]


@pytest.mark.parametrize("block", [S.BLOCK, 90])
def test_equals_brute_force(spark, block):
    rows = random_rows(150, 1) + [(1000 + i, "w1 w2 w3 w1") for i in range(40)]
    items = random_rows(25, 2) + [(90, "w1 w2 w3"), (91, "w1 w1 w1 w2"), (92, None), (93, "nowhere"), (94, "")]
    got = S.rank_documents(documents(spark, rows), asked(spark, items), block=block)
    assert Counter(map(tuple, got.collect())) == brute(rows, items)


def test_odd_rows(spark):
    rows = [(None, "alpha beta"), (1, "alpha beta"), (1, "alpha beta"), (2, None), (3, ""), (4, " .,;"), (5, "ALPHA\x00beta İ"), (6, "gamma " * 9)]
    items = [(1, "Alpha BETA"), (1, "Alpha BETA"), (None, "gamma i̇ İ"), (3, "alpha alpha gamma")]
    got = S.rank_documents(documents(spark, rows), asked(spark, items))
    assert Counter(map(tuple, got.collect())) == brute(rows, items)


def test_a_very_long_text(monkeypatch):
    data = ("One two " * 5000 + "x" * 9000 + " two").encode()
    want = S.count_terms(data, lambda t: t)
    monkeypatch.setattr(S, "STEP", 100)
    assert S.count_terms(data, lambda t: t) == want == (10002, Counter({b"one": 5000, b"two": 5001, b"x" * 9000: 1}))


def test_sharing_keeps_every_sum():
    draw = random.Random(5)
    items = {i: draw.sample(range(30), draw.randint(1, 12)) for i in range(40)}
    pairs, levels, left = S.share(items, 30)
    assert sum(levels) == len(pairs) > 0

    def spread(node):
        return [node] if node < 30 else spread(pairs[node - 30][0]) + spread(pairs[node - 30][1])

    assert {i: sorted(y for x in s for y in spread(x)) for i, s in left.items()} == {i: sorted(s) for i, s in items.items()}
    assert len(pairs) + sum(map(len, left.values())) < sum(map(len, items.values()))


def test_empty(spark, empty):
    one = asked(spark, [(1, "alpha")])
    assert S.rank_documents(empty, one).collect() == []
    assert S.rank_documents(documents(spark, [(1, "alpha")]), one.limit(0)).collect() == []
    assert S.rank_documents(documents(spark, [(1, None)]), one).collect() == []
