import random

from civicspark.llm.graph import components


def test_components_equal_a_union_find(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    links += [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2001 + i) for i in range(60)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for a, b in links for x in (a, b) if a != b}
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == want


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
