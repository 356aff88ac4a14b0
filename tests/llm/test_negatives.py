"""Mined negatives against all scores, and the intervals against true products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import mortarline.llm.negatives as neg


def brute(rows, every, positives=5, negatives=3):
    known = [(i, lab, v) for i, lab, v in rows if i is not None and lab is not None and v is not None and None not in v]
    dot = lambda v, w: sum(a * b for a, b in zip(v, w, strict=False))
    out, done = [], set()
    for i, lab, v in known:
        if i % every or (i, lab, tuple(v)) in done:
            continue
        done.add((i, lab, tuple(v)))
        scores = [(-dot(v, w), j, other == lab) for j, other, w in known if j != i]
        for p, pid, _ in sorted(x for x in scores if x[2])[:positives]:
            fit = sorted((s, j) for s, j, same in scores if not same and 50 * -p <= 100 * -s <= 95 * -p)
            out += [(i, pid, r, j, -p, -s) for r, (s, j) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def table(rng, n, width=10):
    centres = rng.integers(-200, 200, (7, width))
    rows = [(i, f"l{i % 3}", (centres[i % 7] + rng.integers(-60, 61, width)).tolist()) for i in range(n)]
    rows += [(n + i, "l0", [40] * width) for i in range(30)]  # equal vectors: ties
    rows += [(n + 30 + i, "l1", [30] * width) for i in range(30)]
    rows += [(None, "l0", [1] * width), (n + 70, None, [1] * width), (n + 71, "l1", None), (n + 72, "l1", [1, None]), (n + 73, "l2", [7, 8]), (n + 74, "l2", [])]
    return rows


@pytest.mark.parametrize("limits", [(4096, 16384, 1 << 19), (9, 40, 64)])
def test_equals_all_scores(spark, monkeypatch, limits):
    for name, value in zip(("ANCHOR_BLOCK", "DATA_BLOCK", "PAIRS"), limits, strict=True):
        monkeypatch.setattr(neg, name, value)
    rows = table(np.random.default_rng(5), 280)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label string, vector array<long>, score int, part string").repartition(4)
    got = sorted(tuple(r) for r in neg.mine_negatives(df, F.col("vec_id") % 5 == 0).collect())
    assert got == brute(rows, 5)
    assert got


def test_repeats_few_candidates_and_empty(spark):
    rows = [(0, "a", [9, 9]), (0, "a", [9, 9]), (1, "a", [9, 8]), (1, "a", [9, 8]), (2, "b", [6, 6]), (2, "b", [6, 6]), (3, "b", [-9, 1]), (5, "c", [1, 1])]
    df = spark.createDataFrame(rows, "vec_id long, label string, vector array<long>")
    got = sorted(tuple(r) for r in neg.mine_negatives(df, F.col("vec_id") % 5 == 0).collect())
    assert got == brute(rows, 5)
    assert neg.mine_negatives(df, F.lit(False)).count() == 0
    assert neg.mine_negatives(df.where("false"), F.lit(True)).count() == 0
    assert neg.mine_negatives(df.where("label = 'c'"), F.lit(True)).count() == 0


def test_rotation_keeps_products_and_codes_add_up():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 100, (50, 70))
    y = neg.rotated(x)
    assert y.shape == (50, 128)
    assert np.allclose(y @ y.T, x @ x.T)
    words, aligned, left = neg.codes_of(y)
    assert words.shape == (50, neg.CODES, 2)
    assert np.allclose((aligned**2).sum(1) + left[:, -1] ** 2, (y * y).sum(1))
    assert (np.diff(left, axis=1) <= 1e-9).all()


@pytest.mark.parametrize("stages", [1, 3])
def test_intervals_never_lose_a_pair_and_do_drop_others(monkeypatch, stages):
    monkeypatch.setattr(neg, "CODES", stages)
    rng = np.random.default_rng(2)
    x = rng.integers(-100, 101, (400, 64)).astype(float)
    x[:40] = x[0] + rng.integers(-9, 10, (40, 64))
    q, centre = x[:60], x.mean(0)
    words, aligned, left = neg.codes_of(neg.rotated(x - centre))
    part = neg.Part(x, words, aligned, left, ((x - centre) * centre).sum(1))
    true = q @ x.T
    least, most = np.full(60, 0.35 * np.sqrt((x * x).sum(1)).mean() ** 2), np.full(60, 1e9)
    found = []
    for dense in (0.0, 1.0):  # pair by pair as late, and as early as possible
        monkeypatch.setattr(neg, "DENSE", dense)
        i, j = neg.survivors(neg.Anchors(q, centre), part, slice(None), least, most, np.ones((60, 400), bool))
        kept = np.zeros((60, 400), bool)
        kept[i, j] = True
        assert not ((true >= least[:, None]) & ~kept).any()
        assert kept.mean() < (1.0 if stages == 1 else 0.4)
        found.append(kept)
    assert (found[0] == found[1]).all()
