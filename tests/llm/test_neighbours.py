import numpy as np

from civicspark.llm import neighbours as N


def brute(rows, threshold=0.95):
    dims = max((len(v) for _, v in rows if v is not None), default=0)
    ok = []
    for i, (_, v) in enumerate(rows):
        if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v):
            ok.append((i, np.pad(np.array(v, float), (0, dims - len(v)))))
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    if ok:
        u = np.array([v / np.abs(v).max() for _, v in ok])
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        for a, b in np.argwhere(np.triu(u @ u.T >= threshold, 1)):
            i, j = ok[a][0], ok[b][0]
            links[i] += 1
            links[j] += 1
            root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    out = []
    for i, (vec, _) in enumerate(rows):
        least = min((x for x in groups[find(i)] if x is not None), default=None)
        out.append((vec, links[i], least, vec == least))
    return sorted(out, key=repr)


def result(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, raw string, cid int")


def test_groups_larger_than_lists_and_blocks_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows, n = [], 0

    def add(x):
        nonlocal n
        rows.append((n, None if x is None else [None if c is None else float(c) for c in x]))
        n += 1

    for size, spread in ((N.BLOCK + 120, 0.02), (40, 0.03), (12, 0.01), (3, 0.02)):
        centre = rng.standard_normal(24)
        centre /= np.linalg.norm(centre)
        for _ in range(size):
            add((centre + spread * rng.standard_normal(24)) * rng.uniform(0.1, 50))
    for _ in range(200):
        add(rng.standard_normal(24))
    for _ in range(3):
        add(rows[-1][1])
    for x in (None, [], [0.0] * 24, [None] * 24, [1.0] * 23 + [None], [float("nan")] * 24, [float("inf")] + [1.0] * 23, [1.0], [2.0], [1e300] * 24, [3e300] * 24):
        add(x)
    rows += [(None, rows[0][1]), (0, rows[0][1]), (None, None)]
    assert result(N.near_vectors(vectors(spark, rows))) == brute(rows)


def test_empty_table_and_no_usable_vector(spark):
    assert N.near_vectors(vectors(spark, [])).count() == 0
    rows = [(1, None), (2, [0.0, 0.0])]
    assert result(N.near_vectors(vectors(spark, rows))) == brute(rows)


def test_the_audit_sees_lost_links(spark):
    rng = np.random.default_rng(1)
    raw = [(i, np.ones(4).tobytes() if i < 10 else rng.standard_normal(4).tobytes(), 1) for i in range(30)]
    classes = spark.createDataFrame([(i, bytearray(r), n) for i, r, n in raw], "cid long, raw binary, n long")
    found = spark.createDataFrame([(i, 4) for i in range(10)], "cid long, links long")
    assert N.audit(classes, found, 0.999) == 40 / 90


def clumps(rng, sizes, dims=32, inside=0.999, across=0.96):
    """Vectors in clumps: cosine about ``inside`` within one, about ``across`` between any two."""
    centre = np.zeros(dims)
    centre[0] = 1.0
    rows = []
    for k, size in enumerate(sizes):
        middle = centre * np.sqrt(across) + np.eye(dims)[1 + k] * np.sqrt(1 - across)
        for _ in range(size):
            noise = rng.standard_normal(dims)
            noise -= middle * (noise @ middle)
            rows.append(middle + noise / np.linalg.norm(noise) * np.sqrt(1 / inside - 1))
    return rows


def test_clumps_longer_than_lists_find_each_other(spark):
    rng = np.random.default_rng(5)
    for sizes in ((60, 60), (300, 280, 90)):
        rows = list(enumerate([v.tolist() for v in clumps(rng, sizes)] + rng.standard_normal((80, 32)).tolist()))
        want = brute(rows)
        assert len({r[2] for r in want[: sum(sizes)]}) == 1 or max(r[1] for r in want) > max(sizes)
        assert result(N.near_vectors(vectors(spark, rows))) == want


def test_a_failed_audit_ends_in_a_full_comparison(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = list(enumerate([v.tolist() for v in clumps(rng, (40, 45))] + rng.standard_normal((60, 32)).tolist()))
    monkeypatch.setattr(N, "audit", lambda *a, **k: 0.0)
    monkeypatch.setattr(N, "_between_clumps", lambda *a, **k: None)
    monkeypatch.setattr(N, "CHUNK", 50)
    assert result(N.near_vectors(vectors(spark, rows), tries=1)) == brute(rows)


def test_a_large_group_hides_no_small_one(spark):
    raw = [(i, np.ones(4).tobytes(), 1) for i in range(60)] + [(60 + i, (np.eye(4)[i // 2] * (1 + i % 2)).tobytes(), 1) for i in range(8)]
    classes = spark.createDataFrame([(i, bytearray(r), n) for i, r, n in raw], "cid long, raw binary, n long")
    found = spark.createDataFrame([(i, 59) for i in range(60)], "cid long, links long")
    assert N.audit(classes, found, 0.999) == 0.0
