import random

from sparkmill.llm.components import components


def test_random_graph_and_chain(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(500, 501 + i) for i in range(30)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    linked = {x for u, v in edges if u != v for x in (u, v)}
    assert got == {x: find(x) for x in linked}


def test_no_links(spark):
    assert components(spark.createDataFrame([(1, 1)], "u long, v long")).count() == 0
