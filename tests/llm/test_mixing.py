import math
import random

import pytest
from pyspark.sql import functions as F

from civicspark.llm import mixing as M

from .conftest import documents, words


def corpus(seed=3):
    rng = random.Random(seed)
    rows = [(i, "w " * rng.randrange(1, 60), "big") for i in range(900)]
    rows += [(1000 + i, "w " * rng.randrange(1, 30), s) for i, s in enumerate(["mid"] * 150 + ["é"] * 40 + ["A"] * 3 + [None] * 25)]
    return rows + [(5000, None, "void"), (5001, " \n", "void"), (None, "a b c", "mid"), (1000, "w " * 9, "mid"), (1001, "same", "mid"), (1001, "same", "mid")]


def targets(sizes, weights, most):
    total, capped = sum(sizes.values()), set()
    while True:
        rest = [s for s in sizes if s not in capped]
        level = (total - sum(most * sizes[s] for s in capped)) / sum(weights[s] for s in rest)
        over = {s for s in rest if weights[s] * level >= most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else weights[s] * level for s in sizes}
        capped |= over


def test_targets_and_words_taken(spark):
    rows = corpus()
    out = M.plan_mix(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    want = targets(sizes, {s: i % 3 + 1 for i, s in enumerate(order)}, 3)
    taken, largest = {}, {}
    for r in out:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        largest[r["source"]] = max(largest.get(r["source"], 0), r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6


def test_reruns_agree_whatever_the_partitions(spark):
    docs = documents(spark, corpus())
    one, two = (sorted((tuple(r) for r in M.plan_mix(d).collect()), key=repr) for d in (docs.repartition(1), docs.repartition(7)))
    assert one == two


def test_the_schedule_is_inverted(spark):
    for start, end in ((1.0, 1.0), (2.0, 1.0), (1.0, 3.0), (0.0, 1.0), (1.0, 0.0)):
        rows = spark.range(0, 101).select((F.col("id") / 100).alias("q"))
        for r in rows.select("q", M.when_due(F.col("q"), F.lit(start), F.lit(end)).alias("t")).collect():
            used = (start * r["t"] + (end - start) * r["t"] ** 2 / 2) / ((start + end) / 2)
            assert 0 <= r["t"] <= 1 and math.isclose(used, r["q"], abs_tol=1e-9)


def test_the_order_holds_every_copy_once(spark):
    rows = [r for r in corpus() if r[0] is not None and r[0] not in (1000, 1001)]
    docs = documents(spark, rows)
    plan = {r["id"]: r["copies"] for r in M.plan_mix(docs).collect()}
    got = [r["doc_id"] for r in M.mix(docs).collect()]
    assert {i: got.count(i) for i in plan} == plan and M.mix(docs).columns == docs.columns


def test_a_late_source_comes_late(spark):
    rows = [(i, "w w", "a" if i % 2 else "b") for i in range(400)]
    plan = M.plan_mix(documents(spark, rows), weights=(1,), schedules=((1.0, 0.0), (0.0, 1.0)))
    mean = {r["source"]: r["m"] for r in M.positions(plan).join(plan.select("id", "source"), "id").groupBy("source").agg(F.avg("position").alias("m")).collect()}
    assert mean["a"] < 0.4 < 0.6 < mean["b"]


def test_rows_that_repeat_in_full(spark):
    rows = [(1, "a b", "s"), (1, "a b", "s"), (None, "c", "s"), (2, "d e f", None)]
    docs = documents(spark, rows)
    copies = sum(r["copies"] for r in M.plan_mix(docs).collect())
    assert M.mix(docs).count() == copies


def test_empty_tables(spark, empty):
    assert M.plan_mix(empty).count() == 0 and M.mix(empty).count() == 0
    void = documents(spark, [(1, None, "s"), (2, "", None)])
    assert [(r["taken"], r["target"]) for r in M.plan_mix(void).collect()] == [(0, 0.0)] * 2 and M.mix(void).count() == 0
