"""Measured retrieval on tables small enough to reason about, odd rows, and the resampling."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mortarline.operators import experiments as G
from mortarline.operators import tuning as T

AXES = {"chunk_size": [4, 9], "overlap": [0, 2], "search_mode": list(T.MODES), "top_k": [1, 3]}


def chunks_of(text, size, overlap):
    t = text.split()
    return [t[s : s + size] for s in range(0, max(0, len(t) - overlap - 1) + 1, size - overlap)] if t else []


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    words = [f"word{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choice(words, rng.integers(1, 40)))) for i in range(80)]
    docs[5] = (5, "alpha beta gamma delta epsilon zeta eta theta iota kappa")
    return [*docs, (90, ""), (91, None), (92, " \n "), (93, "... !!! ---")]


def test_counts_follow_plain_chunking(spark, texts, monkeypatch):
    monkeypatch.setattr(T, "SLICE_TERMS", 50)
    chunkings = [(4, 0), (4, 2), (9, 3), (100, 1)]
    postings = T.posting_table(spark.createDataFrame([*texts, (None, "word1")], "doc_id long, text string"))
    want = [[c for i, t in texts for c in chunks_of(t or "", *g)] for g in chunkings]
    assert T.chunk_totals(postings, chunkings) == [(len(c), sum(map(len, c))) for c in want]
    got = {r["term"]: tuple(r)[1:] for r in T.chunk_frequencies(postings, chunkings).collect()}
    assert got["word7"] == tuple(sum("word7" in c for c in cs) for cs in want)
    assert got["delta"] == tuple(sum("delta" in c for c in cs) for cs in want)


def test_every_configuration_meets_every_case(spark, texts, monkeypatch):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    cases = spark.createDataFrame(
        [(1, "beta gamma  delta"), (2, "gamma delta epsilon zeta eta theta"), (3, "nowhere"), (4, None), (5, ""), (None, "alpha")], "case_id long, text string"
    )
    once = sorted(T.rag_runs(docs, cases, AXES, depth=5).collect())
    assert len(once) == 24 * 5 and len({(r["combo_no"], r["case_id"]) for r in once}) == 120
    hit = {(r["chunk_size"], r["overlap"], r["search_mode"], r["case_id"]): r["hit"] for r in once if r["top_k"] == 3}
    # the passage lies in one chunk of four tokens, the longer one only where chunks are long enough
    assert hit[4, 0, "keyword_semantic", 1] == 1 and hit[4, 0, "keyword_semantic", 2] == 0 and hit[9, 0, "keyword_semantic", 2] == 1
    assert all(r["hit"] == r["coverage"] == 0 for r in once if r["case_id"] in (3, 4, 5))
    assert all(r["reciprocal_rank"] <= r["hit"] <= 1 and 0 <= r["coverage"] <= 1 for r in once)
    monkeypatch.setattr(T, "BLOCK_TERMS", 400)
    monkeypatch.setattr(T, "SLICE_TERMS", 60)
    monkeypatch.setattr(T, "BLOCK_CASES", 2)
    monkeypatch.setattr(T, "BROADCAST_ROWS", 0)
    assert sorted(T.rag_runs(docs.repartition(3), cases, AXES, depth=5).collect()) == once
    assert T.rag_runs(docs.where("false"), cases, AXES).agg(F.sum("hit")).first()[0] == 0
    assert T.rag_runs(docs, cases.where("false"), AXES).count() == 0


def test_resampling_finds_the_better_one(spark):
    rng = np.random.default_rng(1)
    base = rng.uniform(0, 1, 300)
    runs = [(c, i, float(b + c * 0.05 + rng.normal(0, 0.05))) for i, b in enumerate(base) for c in range(3)] + [(0, 999, 5.0)]
    df = spark.createDataFrame(runs, "combo_no int, case_id long, score double")
    got = {r["combo_no"]: r for r in G.resampled(df, range(3), "score").collect()}
    assert got[2]["is_winner"] and got[2]["win_share"] > 0.99 and got[2]["n_cases"] == 300
    assert got[0]["low"] < got[0]["mean"] < got[0]["high"]
    # paired: the difference is far tighter than the means
    assert 0.03 < got[1]["behind_low"] < got[1]["behind"] < got[1]["behind_high"] < 0.08 and got[1]["behind_high"] - got[1]["behind_low"] < (got[1]["high"] - got[1]["low"]) / 3
    assert got == {r["combo_no"]: r for r in G.resampled(df.repartition(5), range(3), "score").collect()}
    assert G.resampled(df.where("false"), range(3), "score").count() == 0


def test_weights_are_poisson(spark):
    w = spark.range(4000).select(F.explode(G.poisson_weights(F.col("id"), F.lit(3))).alias("w"))
    mean, var, zero = w.agg(F.avg("w"), F.var_pop("w"), F.avg((F.col("w") == 0).cast("double"))).first()
    assert mean == pytest.approx(1, abs=0.03) and var == pytest.approx(1, abs=0.05) and zero == pytest.approx(np.exp(-1), abs=0.01)


def test_prompts_are_held_against_the_window(spark):
    cases = spark.createDataFrame([(1, "red roof", "the roof is red and very large"), (2, None, None), (3, "blue", "")], "case_id long, prompt string, context string")
    runs = G.prompt_runs(cases, {"s": "Be brief."}, {"first": "{{ context }} ? {{ prompt }}", "last": "{{prompt}} : {{ context }}"}, window=6).collect()
    got = {(r["rag_template"], r["case_id"]): (r["request_kept"], round(r["context_kept"], 4), r["coverage"], r["input_tokens"]) for r in runs}
    assert got["first", 1] == (0.0, round(4 / 7, 4), 1.0, 6)
    assert got["last", 1] == (1.0, round(1 / 7, 4), 0.0, 6)
    assert got["first", 2] == (1.0, 1.0, 1.0, 3) and got["last", 3] == (1.0, 1.0, 0.0, 4)


def test_documents_of_one_file_reach_many_tasks(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    plan = T.posting_table(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [doc_id" in plan


def test_scores_are_measured_once_for_the_front(spark, monkeypatch):
    from mortarline.plans import experiments as P

    reads = spark.sparkContext.accumulator(0)
    rows = [(i, 4, 0, "vector", 1, 1, float(i % 2), 0.5, 0.5, 10 * i, 3) for i in range(4)]
    schema = "combo_no int, chunk_size int, overlap int, search_mode string, top_k int, case_id long, hit double, coverage double, reciprocal_rank double, context_tokens long, chunks_scored long"

    def counted(batches):
        reads.add(1)
        yield from batches

    runs = spark.createDataFrame(rows, schema).coalesce(1).mapInPandas(counted, schema)
    monkeypatch.setattr(P, "_measured", lambda spark, sf: runs)
    assert P.rag_tuning(spark, "").count() > 0
    assert reads.value == 1
