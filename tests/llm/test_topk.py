"""Top-k against all scores, with ties, repeats, clusters, few candidates and several blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import mortarline.llm.topk as topk


def brute(rows, k, every):
    known = [(i, v) for i, v in rows if i is not None and v is not None and None not in v]
    out = set()
    for i, v in known:
        if i % every == 0:
            found = []
            for j, w in known:
                if j != i:
                    n = min(len(v), len(w))
                    found.append((-sum(a * b for a, b in zip(v[:n], w[:n], strict=True)), j))
            for r, (s, j) in enumerate(sorted(found)[:k], 1):
                out.add((i, r, j, -s))
    return out


def vectors(rng, n):
    centres = rng.integers(-300, 300, (6, 8))
    rows = [(i, (centres[i % 6] + rng.integers(-9, 10, 8)).tolist()) for i in range(n)]
    rows += [(n + i, [5] * 8) for i in range(40)]  # equal vectors: ties
    rows += [(None, [1] * 8), (n + 50, None), (n + 51, [1, None, 2]), (n + 52, [7, 8]), (n + 53, [])]
    return rows


@pytest.mark.parametrize("blocks", [(4096, 16384), (7, 30)])
def test_equals_all_scores(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "DATA_BLOCK", blocks[1])
    monkeypatch.setattr(topk, "PIVOTS", 8)
    rows = vectors(np.random.default_rng(3), 260)
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, vector array<long>, score string").repartition(4)
    found = topk.top_k(table, F.col("vec_id") % 5 == 0, k=4).collect()
    assert len(found) == len(set(found))
    assert {tuple(r) for r in found} == brute(rows, 4, 5)


def test_few_candidates_repeats_and_empty(spark):
    rows = [(0, [1, 2]), (0, [1, 2]), (1, [3, 4]), (1, [3, 4]), (2, [0, 0])]
    table = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    found = sorted(tuple(r) for r in topk.top_k(table, F.col("vec_id") == 0, k=5).collect())
    assert found == [(0, 1, 1, 11), (0, 2, 1, 11), (0, 3, 2, 0)]
    assert topk.top_k(table, F.lit(False)).count() == 0
    assert topk.top_k(table.where("false"), F.lit(True)).count() == 0


def test_traversal_prunes():
    rng = np.random.default_rng(5)
    x = np.concatenate([c + rng.normal(0, 1, (400, 4)) for c in rng.normal(0, 300, (20, 4))]).round()
    trees = topk.Tree(x, np.arange(len(x)))
    met, stack = 0, [trees]
    while stack:
        t = stack.pop()
        assert (np.sqrt(((x[t.rows] - t.centre) ** 2).sum(1)) <= t.radius).all()
        assert not t.children or sorted(np.concatenate([c.rows for c in t.children])) == sorted(t.rows)
        stack += t.children
        met += 1
    assert met > 20
    scores, places = topk.dual_search(x[:50], np.arange(50), x, np.arange(len(x)), 3, np.full(50, -np.inf))
    own = x[:50] @ x.T
    own[np.arange(50), np.arange(50)] = -np.inf
    assert (scores == -np.sort(-own, 1)[:, :3]).all()
