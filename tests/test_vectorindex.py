"""Index search against all cosines; index tables reread; recall of limited probing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mortarline.operators import vectorindex as V
from mortarline.session import scratch_path


def brute(docs, queries, k):
    unit = lambda v: np.array(v) / (np.linalg.norm(v) or 1)
    out = set()
    for q, v in queries:
        scores = sorted((-round(float(unit(v) @ unit(w)), 6) + 0.0, d) for d, w in docs)
        out |= {(q, d, r, -s + 0.0) for r, (s, d) in enumerate(scores[:k], 1)}
    return out


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1, (12, 16))
    docs = [(i, (centres[i % 12] + rng.normal(0, 0.3, 16)).tolist()) for i in range(600)]
    docs += [(600 + i, centres[0].tolist()) for i in range(30)] + [(700, [0.0] * 16)]
    queries = [(i, (centres[i % 12] + rng.normal(0, 0.3, 16)).tolist()) for i in range(40)] + [(99, [0.0] * 16)]
    path = scratch_path(spark, "test-index")
    frame = spark.createDataFrame([*docs, (None, [1.0] * 16), (800, None)], "doc_id long, vector array<double>")
    V.build_index(frame, path, rows_per_list=50)
    return docs, queries, path


def test_exact_search_equals_all_pairs(spark, tables, monkeypatch):
    docs, queries, path = tables
    asked = spark.createDataFrame([*queries, (None, [1.0] * 16)], "query_id long, vector array<double>")
    want = brute(docs, queries, 5)
    for rows, block in ((20_000, 2_048), (20, 7)):
        monkeypatch.setattr(V, "LIST_ROWS", rows)
        monkeypatch.setattr(V, "QUERY_ROWS", block)
        got = {(r["query_id"], r["doc_id"], r["rank"], r["score"] + 0.0) for r in V.search_index(spark, path, asked, 5).collect()}
        assert got == want


def test_every_row_is_indexed_and_bounds_hold(spark, tables):
    docs, _, path = tables
    rows = V.index_rows(spark, path).toPandas()
    assert sorted(rows["doc_id"]) == sorted(d for d, _ in docs)
    lists = spark.read.parquet(f"{path}/lists").toPandas().set_index("list")
    assert lists["n"].sum() == len(docs) and len(lists) > 8
    q = np.random.default_rng(1).normal(0, 1, 16)
    q /= np.linalg.norm(q)
    for r in rows.itertuples():
        assert q @ r.vector <= q @ lists.loc[r.list, "centre"] + lists.loc[r.list, "radius"] + 1e-9


def test_limited_probing_and_recall(spark, tables):
    _, queries, path = tables
    asked = spark.createDataFrame(queries[:40], "query_id long, vector array<double>")
    exact = V.search_index(spark, path, asked, 5)
    few = V.recall(V.search_index(spark, path, asked, 5, probes=3), exact).agg(F.avg("recall")).first()[0]
    assert 0.95 <= few <= 1
    assert V.recall(exact.where("rank > 5"), exact).agg(F.max("recall")).first()[0] == 0


def test_empty(spark):
    path = scratch_path(spark, "test-index")
    none = spark.createDataFrame([], "doc_id long, vector array<double>")
    V.build_index(none, path)
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, vector array<double>")
    assert V.search_index(spark, path, asked, 3).count() == 0
