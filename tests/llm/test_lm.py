"""Counts against a dictionary, gradients against differences, probabilities that add up, held-out gain."""

import math
import random
from collections import Counter

import numpy as np
import pytest

import mortarline.llm.lm as lm

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus():
    rng = random.Random(6)
    follow = {w: rng.sample([f"w{i}" for i in range(40)], 2) for w in (f"w{i}" for i in range(40))}
    rows = []
    for i in range(500):
        w, text = rng.choice(list(follow)), []
        for _ in range(rng.randrange(5, 150)):
            text.append(w if rng.random() > 0.05 else f"Rare{rng.randrange(10**6)}")
            w = rng.choice(follow[w])
        rows.append((i, " ".join(text), i % 7 != 2))
    return rows + [(900, None, True), (901, "", False), (None, "w1 W2 É é", True), (3, rows[3][1], True), (902, "w3 " * 30000, False), (903, "x", None)]


def test_scores(spark):
    rows = corpus()
    table = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, train boolean, score int").repartition(6)
    got = lm.score_documents(table).collect()
    assert len(got) == len(rows)
    tokens = lambda t: [*(t or "").translate(LOW).encode().split(), None]
    count = Counter(w for _, t, train in rows if train for w in tokens(t))
    n, v = sum(count.values()), len(count)
    want = Counter()
    for i, t, train in rows:
        own = tokens(t)
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own)
        want[str(i), bool(train), len(own), sum(count[w] > 0 for w in own), n, f"{base:.6f}"] += 1
    found = Counter((str(r["id"]), r["train"], r["n_tokens"], r["n_known"], r["train_tokens"], f"{r['base_score']:.6f}") for r in got)
    assert found == want
    held = [r for r in got if not r["train"] and r["n_tokens"] < 200]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    same = [r["score"] for r in got if r["id"] == 3]
    assert len(same) == 2 and same[0] == pytest.approx(same[1], rel=1e-4)
    assert lm.score_documents(table.where("false")).count() == 0
    assert all(r["n_known"] == 0 for r in lm.score_documents(table.where("doc_id = 901 OR doc_id = 5").withColumn("train", table["train"] & False)).collect())


HEAD = 640


def test_gradients_and_probabilities():
    rng = np.random.default_rng(1)
    p = lm.initial(rng.integers(1, 50, HEAD), 40000)
    p = {k: (v + rng.normal(0, 0.2, v.shape)).astype(np.float64) for k, v in p.items()}
    x, y = rng.integers(0, lm.tail_of(p) + 1, (2, 6, 3))
    fresh, h = rng.random((6, 3)) < 0.3, rng.normal(0, 0.3, (3, lm.HIDDEN))

    def loss(q):
        return -lm.window_pass(q, x, y, fresh, h, False)[0].mean()

    _, _, g = lm.window_pass(p, x, y, fresh, h, True)
    for k in p:
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        sides = []
        for step in (1e-3, -1e-3):
            q = {a: b.copy() for a, b in p.items()}
            q[k][at] += step
            sides.append(loss(q))
        assert g[k][at] == pytest.approx((sides[0] - sides[1]) / 2e-3, rel=0.02)
    every = np.arange(lm.tail_of(p) + 1)
    logs, _, _ = lm.window_pass(p, np.zeros((1, lm.tail_of(p) + 1), int), every[None], np.ones((1, lm.tail_of(p) + 1), bool), np.zeros((lm.tail_of(p) + 1, lm.HIDDEN)), False)
    assert np.exp(logs).sum() == pytest.approx(1.0, abs=1e-3)


def test_state_is_carried_over_windows(monkeypatch):
    rng = np.random.default_rng(2)
    p = lm.initial(rng.integers(1, 50, HEAD), 40000)
    docs = [rng.integers(0, lm.tail_of(p) + 1, n) for n in (300, 5, 1, 90, 700)]
    whole = lm.score_of(p, docs)
    monkeypatch.setattr(lm, "WINDOW", 10_000)
    monkeypatch.setattr(lm, "LANES", 2)
    assert lm.score_of(p, docs) == pytest.approx(whole, rel=1e-4)


def test_a_table_with_itself_counts_every_row_once(spark):
    rows = [(i, f"w{i} w1 w2 w1", True) for i in range(12)]
    table = spark.createDataFrame(rows, "doc_id long, text string, train boolean").coalesce(1)
    got = lm.score_documents(table.union(table)).collect()
    count = Counter(w for _, t, _ in rows * 2 for w in [*t.split(), None])
    n, v = sum(count.values()), len(count)
    assert len(got) == 24 and all(r["n_known"] == r["n_tokens"] == 5 for r in got)
    want = {i: sum(math.log10((count[w] + 1) / (n + v + 1)) for w in [*t.split(), None]) for i, t, _ in rows}
    assert all(r["base_score"] == pytest.approx(want[r["id"]]) for r in got)


def test_one_long_document_does_not_spoil_the_model(spark):
    rng = np.random.default_rng(6)
    follows = rng.integers(0, 40, (40, 2))

    def text(n, noise):
        out, w = [], int(rng.integers(40))
        for _ in range(n):
            out.append(f"w{w}")
            w = int(rng.integers(40)) if rng.random() < noise else int(follows[w, rng.integers(2)])
        return " ".join(out)

    rows = [(i, text(60, 0.1), i % 7 != 2) for i in range(900)] + [(9000, text(20_000, 0.6), True)]
    got = lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(2)).where("NOT train").collect()
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_equal_rows_in_batches_of_their_own_stay_single(spark):
    rng = np.random.default_rng(3)
    words = [f"x{i}" for i in rng.integers(0, 5000, 3000)]
    table = spark.createDataFrame([(1, " ".join(words), True), (2, "a b c", True)], "doc_id long, text string, train boolean")
    many = table
    for _ in range(4):
        many = many.union(table)
    got = lm.score_documents(many).collect()
    assert len(got) == 10 and len({(r["id"], r["base_score"]) for r in got}) == 2


def test_the_head_grows_with_the_corpus(spark):
    sizes = [lm.head_size(10**k) for k in range(3, 14)]
    assert all(2 < b / a < 3 for a, b in zip(sizes, sizes[1:], strict=False)) and sizes[-1] < 1_000_000
    for words in (1, 2, 3, 640, 7152):
        classes, slots = lm.shape_of(words)
        assert classes * slots >= words and max(classes, slots) <= math.isqrt(words) + 1
    rng = random.Random(5)
    words = {f"v{i}": 1 + rng.randrange(40) for i in range(900)}
    table = spark.createDataFrame([(rng.getrandbits(60), n) for n in words.values()], "h long, c long").repartition(3)
    want = sorted(((-r["c"], r["h"]) for r in table.collect()))
    for size in (1, 37, 500, 2000):
        got = lm._head(table, size)
        assert list(zip(-got["c"], got["h"], strict=True)) == want[:size]


def test_the_model_tells_apart_more_words_of_a_larger_corpus(spark):
    # rows over two thousand words, each followed by one of two: a model of a few hundred words would know few of them
    rng = np.random.default_rng(4)
    follow = rng.integers(0, 1200, (1200, 2))

    def text():
        w, out = int(rng.integers(1200)), []
        for _ in range(100):
            out.append(f"w{w}")
            w = int(follow[w, rng.integers(2)])
        return " ".join(out)

    rows = [(i, text(), i % 7 != 2) for i in range(2000)]
    assert lm.head_size(170_000) < 1200
    got = lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(2)).where("NOT train").collect()
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_scoring_takes_more_lanes_than_training(monkeypatch):
    rng = np.random.default_rng(9)
    p = lm.initial(np.array([50, 40, 30, 20, 10]), 200)
    p["c"][:], p["d"][:] = rng.normal(0, 1, p["c"].shape), rng.normal(0, 1, p["d"].shape)
    docs = [np.append(rng.integers(0, 6, n), lm.END) for n in rng.integers(1, 90, 700)]
    wide, widths = lm.score_of(p, docs), []
    once = lm.window_pass
    monkeypatch.setattr(lm, "window_pass", lambda p, x, *rest, **more: widths.append(x.shape[1]) or once(p, x, *rest, **more))
    monkeypatch.setattr(lm, "BLOCK", 7)
    assert np.allclose(lm.score_of(p, docs), wide, rtol=1e-6)
    assert max(widths) == len(docs) > lm.LANES  # a step costs calls, not lanes, so few windows are cheaper
    assert np.allclose([lm.score_of(p, [d])[0] for d in docs[:20]], wide[:20], rtol=1e-6)


def test_frequent_words_are_in_small_classes():
    for words in (1, 2, 3, 10, 640, 7152, 500_000):
        bounds = lm.class_bounds(words)
        sizes = np.diff(bounds)
        assert bounds[0] == 0 and bounds[-1] == words and sizes.min() > 0 and len(sizes) <= math.isqrt(words) // 2 + 1
        assert sizes.max() <= 4 * math.sqrt(words) + 4
    counts = 1 / np.arange(3.0, 7155)
    sizes = np.diff(lm.class_bounds(len(counts)))
    outputs = len(sizes) + 1 + (np.add.reduceat(counts, np.cumsum(sizes) - sizes) * sizes).sum() / counts.sum()
    assert outputs < 0.75 * 2 * math.sqrt(len(counts))
    p = lm.initial(np.round(1e6 * counts), int(3e6 * counts.sum()))
    logs, _, _ = lm.window_pass(p, np.zeros((1, 7153), int), np.arange(7153)[None], np.ones((1, 7153), bool), np.zeros((7153, lm.HIDDEN)), False)
    assert np.exp(logs).sum() == pytest.approx(1.0, abs=1e-3)


def test_few_lanes_are_scored_in_long_windows(monkeypatch):
    rng = np.random.default_rng(8)
    p = lm.initial(rng.integers(1, 50, HEAD), 40000)
    p["c"][:], p["d"][:] = rng.normal(0, 1, p["c"].shape), rng.normal(0, 1, p["d"].shape)
    docs = [rng.integers(0, lm.tail_of(p) + 1, n) for n in (3000, 2900, 40)]
    assert [len(x) for x, *_ in lm.lanes_of(docs, 8)] == [lm.WINDOW] * 93 + [24]
    once, steps = lm.window_pass, []
    monkeypatch.setattr(lm, "window_pass", lambda p, x, *rest, **more: steps.append(len(x)) or once(p, x, *rest, **more))
    scores = lm.score_of(p, docs)
    assert len(steps) == 1
    monkeypatch.setattr(lm, "SCORE_PLACES", 0)
    assert np.allclose(lm.score_of(p, docs), scores, rtol=1e-5) and len(steps) == 95


def test_values_that_could_overflow_are_bounded():
    p = lm.initial(np.array([50, 40, 30]), 200)
    p["cb"][:] = 500
    args = np.zeros((1, 4), int), np.arange(4)[None], np.ones((1, 4), bool), np.zeros((4, lm.HIDDEN))
    assert np.isfinite(lm.window_pass(p, *args, False)[0]).all()
    assert all(np.isfinite(g).all() for g in lm.window_pass(p, *args, True)[2].values())
