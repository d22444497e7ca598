"""Components against union-find: chains, hubs at either end, random graphs, loops, repeats and nothing."""

import random

import pytest

from rivulet.llm.graph import connected_components


def plain(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return sorted((x, find(x)) for x in list(root))


R = random.Random(7)
GRAPHS = {
    "chain": [(i, i + 1) for i in range(200)],
    "chain of shuffled ids": (lambda o: list(zip(o, o[1:])))(R.sample(range(500), 300)),
    "hub with the smallest id": [(0, i) for i in range(1, 400)],
    "hub with the largest id": [(1000, i) for i in range(400)],
    "two hubs and a bridge": [(500, i) for i in range(200)] + [(501, i) for i in range(600, 800)] + [(500, 501)],
    "random": [(R.randrange(600), R.randrange(600)) for _ in range(350)],
    "loops and repeats": [(3, 3), (1, 2), (2, 1), (1, 2), (-5, 2), (9, 8)],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, name):
    edges = GRAPHS[name]
    out = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted((r["node"], r["component"]) for r in out.collect()) == plain(edges)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
