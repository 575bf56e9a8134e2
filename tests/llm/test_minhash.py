import random
import tracemalloc

import pytest
from pyspark.sql import functions as F

from civicspark.llm import minhash as M

from .conftest import documents, words


def brute(rows, width, percent=80):
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    out = []
    for i, (doc, _) in enumerate(rows):
        least = min((x for x in groups[find(i)] if x is not None), default=None) if sets[i] else doc
        out.append((doc, len(sets[i]), least, doc == least))
    return sorted(out, key=repr)


def result(frame):
    return sorted(((r["id"], r["n_shingles"], r["component_id"], r["kept"]) for r in frame.collect()), key=repr)


def family(seed, n=240, base=120):
    """Many copies of one text, each with a few words changed: a chain of near copies in hot bands."""
    rng = random.Random(seed)
    text = [f"w{rng.randrange(400)}" for _ in range(base)]
    rows = []
    for i in range(n):
        own = list(text)
        for _ in range(rng.randrange(0, 7)):
            own[rng.randrange(base)] = f"z{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize("width", [2, 5])
def test_equals_brute_force_on_documents(spark, sf_docs, width):
    rows = [(r["doc_id"], r["text"]) for r in sf_docs.collect()]
    assert result(M.near_duplicates(sf_docs, width)) == brute(rows, width)


@pytest.mark.parametrize("block", [None, 3000])
def test_a_large_group_of_near_copies_and_odd_rows(spark, block, monkeypatch):
    if block:  # members left apart meet over many blocks
        monkeypatch.setattr(M, "BLOCK", block)
        monkeypatch.setattr(M, "HUBS", 1)
    rows = family(1) + [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "one"), (1004, "ONE"), (1005, "one two"), (None, "one"), (None, None), (1006, "one")]
    rows += [(2000, rows[0][1] + " tail"), (2001, "many words " * 20000), (2002, "many words " * 20000 + "more")]
    assert result(M.near_duplicates(documents(spark, rows), 2)) == brute(rows, 2)


def test_one_row_of_each_group_stays_with_all_columns(spark):
    rows = family(2, 40) + [(7000, "alone here"), (7000, "alone here"), (None, None)]
    docs = documents(spark, rows)
    out = M.drop_near_duplicates(docs, width=2)
    kept = {d for d, _, _, k in brute(rows, 2) if k}
    assert out.columns == docs.columns and sorted((r["doc_id"] for r in out.collect()), key=repr) == sorted(kept, key=repr)


def test_empty_table(spark, empty):
    assert M.near_duplicates(empty).count() == 0 and M.drop_near_duplicates(empty).count() == 0


def test_the_estimate_is_corrected_for_chance(spark):
    rng = random.Random(9)
    errors = []
    pairs = []
    for i in range(60):
        text = [f"a{rng.randrange(10**6)}" for _ in range(300)]
        other = [w if rng.random() > i / 120 else f"b{rng.randrange(10**6)}" for w in text]
        pairs += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(other))]
    docs = spark.createDataFrame(pairs, "id long, text string").withColumn("body", F.lit(0).cast("long"))
    marks = docs.mapInArrow(M._features(1), "id long, body long, n long, k1 long, k2 long, signature array<long>, bands array<long>")
    a = marks.filter("id % 2 = 0").select((F.col("id") / 2).cast("int").alias("p"), F.col("signature").alias("x"))
    b = marks.filter("id % 2 = 1").select(((F.col("id") - 1) / 2).cast("int").alias("p"), F.col("signature").alias("y"))
    for r in a.join(b, "p").select("p", M.estimate(F.col("x"), F.col("y")).alias("e")).collect():
        x, y = set(words(pairs[2 * r["p"]][1])), set(words(pairs[2 * r["p"] + 1][1]))
        errors.append(r["e"] - len(x & y) / len(x | y))
    assert abs(sum(errors) / len(errors)) < 0.03 and max(map(abs, errors)) < M.SLACK


def test_the_arrays_beside_a_batch_stay_small():
    """Words are looked at in runs of about a megabyte of text, whatever the batch."""
    rng = random.Random(4)
    text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(2_000))
    n = 600  # some nine megabytes
    batch = M.pa.RecordBatch.from_arrays([M.pa.array(range(n)), M.pa.array([0] * n), M.pa.array([text] * n)], names=["id", "body", "text"])
    for run in (M._features(5), M._full_sets(5)):
        tracemalloc.start()
        rows = sum(b.num_rows for b in run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows == n and peak < 40e6, peak


def test_rows_pass_to_python_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    def sizes(batches):
        for batch in batches:
            yield M.pa.RecordBatch.from_arrays([M.pa.array([batch.num_rows])], names=["n"])

    with M.arrow_rows(spark, M.BATCH):
        rows = M.materialize(spark.range(0, 5_000, 1, 1).mapInArrow(sizes, "n long"), "sizes")
    assert sorted(r["n"] for r in rows.collect()) == [M.BATCH] * 5 and spark.conf.get(key) == before
