"""Density clusters against a plain computation over all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mortarline.operators.density import density_clusters, ladder


def brute(rows, radius, min_points, size, rungs, resolution=0.0):
    """{key: (component, cluster)} from all pairs, one recursion over the tree of components."""
    place = lambda v: np.floor(v / resolution) * resolution + resolution / 2 if resolution else v
    points = {}
    for key, *x in rows:
        points.setdefault(tuple(place(np.array(x, float))), []).append(key)
    x, keys = np.array(list(points)), list(points.values())
    ids, w = [min(k) for k in keys], np.array([len(k) for k in keys])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    core = np.full(len(x), np.inf)
    for i in range(len(x)):
        order = np.argsort(d[i])
        enough = np.flatnonzero(np.cumsum(w[order]) >= min_points)
        if len(enough):
            core[i] = d[i][order[enough[0]]]
    reach = np.maximum(d, np.maximum(core[:, None], core[None]))
    radii = ladder(radius, rungs)

    def parts(members, r):
        left, out = {i for i in members if core[i] <= r}, []
        while left:
            group, todo = set(), [left.pop()]
            while todo:
                i = todo.pop()
                group.add(i)
                near = {j for j in left if reach[i, j] <= r}
                left -= near
                todo += near
            out.append(group)
        return out

    def big(groups):
        return [g for g in groups if w[list(g)].sum() >= size]

    def best(group, level):
        """(own stability, best choice below, groups of that choice) of a group that begins at ``level``."""
        own = 0.0
        while True:
            own += w[list(group)].sum() * (1 / radii[level] - 1 / radii[level + 1] if level + 1 < rungs else 0.0)
            inner = big(parts(group, radii[level - 1])) if level else []
            if len(inner) == 1:
                group, level = inner[0], level - 1
                continue
            below = [best(g, level - 1) + (g,) for g in inner]
            total = sum(round(max(s, k), 9) for s, k, _, _ in below)
            chosen = [c for s, k, inside, g in below for c in ([g] if round(s, 9) >= round(k, 9) else inside)]
            return own, total, chosen

    out = {k: [-1, -1] for ks in keys for k in ks}
    for g in big(parts(range(len(x)), radius)):
        own, total, chosen = best(g, rungs - 1)
        for i in g:
            for k in keys[i]:
                out[k][0] = min(ids[j] for j in g)
        for c in [g] if round(own, 9) >= round(total, 9) else chosen:
            for i in c:
                for k in keys[i]:
                    out[k][1] = min(ids[j] for j in c)
    return {k: tuple(v) for k, v in out.items()}


def blobs(rng, n):
    centres = [(0, 0, 0.15), (1.1, 0, 0.15), (5, 5, 0.4), (5, 6.6, 0.1), (9, 0, 0.9)]
    rows = []
    for i in range(n):
        a, b, s = centres[i % 5] if i % 9 else (*rng.uniform(-2, 12, 2), 0)
        rows.append((i, float(a + rng.normal(0, s or 1e-9)), float(b + rng.normal(0, s or 1e-9))))
    return rows + [(n + i, 3.0, -3.0) for i in range(6)]  # copies in one place


@pytest.mark.parametrize("resolution", [0.0, 0.25])
def test_equals_all_pairs(spark, resolution):
    rows = blobs(np.random.default_rng(8), 494)
    df = spark.createDataFrame([(*r, "z") for r in rows], "k long, a double, b double, component string").repartition(5).drop("component")
    got = density_clusters(df, "k", ["a", "b"], 1.0, min_points=4, min_cluster_size=6, rungs=5, resolution=resolution).collect()
    assert {r["k"]: (r["component"], r["cluster"]) for r in got} == brute(rows, 1.0, 4, 6, 5, resolution)
    assert len({r["cluster"] for r in got}) > len({r["component"] for r in got}) > 3


def test_group_over_a_cell_corner_and_rows_apart(spark):
    corner = [(i, 1.0 + dx, 1.0 + dy) for i, (dx, dy) in enumerate([(a, b) for a in (-0.1, -0.05, 0.05, 0.1) for b in (-0.1, 0.1)])]
    apart = [(20 + i, 10.05, 10.05) for i in range(4)] + [(30 + i, 11.95, 10.05) for i in range(4)]  # adjoining cells, 1.9 apart
    df = spark.createDataFrame(corner + apart, "k long, a double, b double")
    got = {r["k"]: r["component"] for r in density_clusters(df, "k", ["a", "b"], 1.0, rungs=1).collect()}
    assert {got[k] for k in range(8)} == {0}
    assert {got[20 + i] for i in range(4)} == {20} and {got[30 + i] for i in range(4)} == {30}


def test_nulls_copies_and_empty(spark):
    rows = [(1, 0.0, 0.0), (2, 0.0, -0.0), (3, 0.0, 0.0), (4, None, 0.0), (5, float("nan"), 0.0), (6, 50.0, 0.0), (None, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "k long, a double, b double")
    got = sorted(((r["k"], r["cluster"]) for r in density_clusters(df, "k", ["a", "b"], 1.0).collect()), key=str)
    assert got == [(1, 1), (2, 1), (3, 1), (4, -1), (5, -1), (6, -1), (None, -1)]
    assert density_clusters(df.where("false"), "k", ["a"], 1.0).count() == 0
    thousand = spark.range(3000).select(F.col("id").alias("k"), F.lit(2.0).alias("a"))
    assert [tuple(r) for r in density_clusters(thousand, "k", ["a"], 1.0).groupBy("cluster").count().collect()] == [(0, 3000)]
