"""Connected components against a union-find, and the number of rounds on a chain."""

import random

import mortarline.functions.graph as graph


def union_find(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


def test_random_graph(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(900, 900), (5, 5)]
    found = graph.connected_components(spark.createDataFrame([*pairs, *pairs[:9]], "a long, b long"))
    assert {r["node"]: r["label"] for r in found.collect()} == union_find(pairs)


def test_long_chain_settles_in_few_rounds(spark, monkeypatch):
    ids = list(range(2000))
    random.Random(1).shuffle(ids)
    written = []
    monkeypatch.setattr(graph, "cut_lineage", lambda df, f=graph.cut_lineage: written.append(1) or f(df))
    found = graph.connected_components(spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long"))
    assert {r["label"] for r in found.collect()} == {0} and found.count() == 2000
    assert len(written) < 20


def test_empty_and_null(spark):
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert graph.connected_components(spark.createDataFrame([(None, 1), (2, None)], "a long, b long")).count() == 0
