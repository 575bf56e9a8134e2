import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicspark.llm import exact_dedup as E

from .conftest import documents

ROWS = [(1, "Same"), (2, "same"), (3, "SAME"), (4, None), (5, ""), (6, "É"), (7, "é"), (None, "same"), (None, "alone"), (8, "x" * 200000), (9, "X" * 200000), (9, "twice"), (9, "twice")]


def brute(rows):
    norm = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    groups = defaultdict(list)
    for doc, text in rows:
        groups[norm(text)].append(doc)
    out = []
    for doc, text in rows:
        g = groups[norm(text)]
        keep = max((x for x in g if x is not None), default=None)
        out.append((doc, keep, len(g), doc == keep, hashlib.sha256(norm(text).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("history", [None, "doc_id <= 4", "false", "doc_id > 7"])
def test_equals_brute_force_whatever_the_history(spark, history):
    got = E.dedup_exact(documents(spark, ROWS), history and F.expr(history)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(ROWS)


def test_empty_table(spark, empty):
    assert E.dedup_exact(empty).count() == 0


def test_the_hash_is_minimal_and_perfect_and_strangers_are_told_by_their_bytes():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 50, 5000):
        words = rng.integers(0, 2**63, (n, 4), dtype=np.uint64)
        sizes, bits = E.build_table(words)
        slots = E.slots_of(words, sizes, bits)
        assert sorted(slots.tolist()) == list(range(n))
        kept = words[np.argsort(slots)]
        strangers = rng.integers(0, 2**63, (200, 4), dtype=np.uint64)
        found = E.slots_of(strangers, sizes, bits)
        assert not ((found >= 0) & (kept[np.maximum(found, 0)] == strangers).all(axis=1)).any()
    assert E.build_table(np.zeros((0, 4), np.uint64))[0] == []
