"""Classes against brute-force weighted Jaccard over all pairs; samples against the similarity."""

import itertools
import random

import numpy as np
import pytest

from mortarline.llm.neardup import (
    BANDS, FLOOR, ROWS, THRESHOLD, Sampler, Weights, frequent_shingles, near_duplicates, shingles, similarity,
)


def made(rng, n):
    return [rng.choice("abcdefgh") + str(rng.randrange(300)) for _ in range(n)]


def edited(rng, words, share):
    return [w if rng.random() > share else "new" + str(rng.randrange(10**6)) for w in words]


def corpus():
    rng = random.Random(8)
    texts = [made(rng, rng.randrange(1, 200)) for _ in range(150)]
    for base, copies in ((0, 40), (1, 12), (2, 3)):
        texts[base] = made(rng, 220)
        texts += [edited(rng, texts[base], rng.choice([0.0, 0.01, 0.02, 0.04])) for _ in range(copies)]
    passage = made(rng, 60)
    texts += [passage + made(rng, 90) for _ in range(50)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "One two"), (904, "one\ttwo "), (905, "one two three"), (None, rows[0][1]), (0, rows[0][1])]
    return rows


def brute(rows):
    count = {}
    known = [(i, t or "") for i, t in rows if i is not None]
    own = [shingles(t.encode()) for _, t in known]
    for h, _ in own:
        for x in h.tolist():
            count[x] = count.get(x, 0) + 1
    often = {h: n for h, n in count.items() if n >= FLOOR * len(known)}
    w = Weights(np.array(list(often), np.uint64), np.array(list(often.values())), len(known))
    weighed = [(h, w.of(h, n)) for h, n in own]
    root = {i: i for i, _ in known}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in itertools.combinations(list(zip([i for i, _ in known], weighed, strict=True)), 2):
        if similarity(a, b) >= THRESHOLD - 1e-12:
            root[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in root}, often


def test_classes_equal_brute_force(spark):
    rows = corpus()
    table = spark.createDataFrame([(*r, "q") for r in rows], "doc_id long, text string, id string").repartition(5)
    want, often = brute(rows)
    found = near_duplicates(table).collect()
    assert len(found) == len(rows)
    assert {r["id"]: r["class_id"] for r in found} == want | {None: None}
    hashes, counts, n = frequent_shingles(table.where("doc_id IS NOT NULL").select("text"))
    assert dict(zip(hashes.tolist(), counts.tolist(), strict=True)) == often and n == len(rows) - 1


def test_samples_agree_as_often_as_the_similarity():
    rng = np.random.default_rng(4)
    h = np.unique(rng.integers(0, 2**63, 60000).astype(np.uint64))
    w = rng.integers(1, 3, len(h)) * rng.uniform(1, 2, len(h))
    agree, total, draw = 0.0, 0.0, Sampler().draw
    for at in range(0, 50000, 1000):
        a, b = (h[at : at + 800], w[at : at + 800]), (h[at + 150 : at + 1000], w[at + 150 : at + 1000])
        agree += (draw(*a) == draw(*b)).mean()
        total += similarity(a, b)
    assert agree / 50 == pytest.approx(total / 50, abs=0.03)
    assert BANDS * ROWS == len(draw(h[:1], w[:1]))


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_texts_of_documents_without_company_are_dropped_before_a_shuffle(spark):
    from mortarline.llm.suspects import PART, likely_among

    rows = spark.createDataFrame([(i, f"text {i}") for i in range(20_000)] + [(None, "no id"), (40, None)], "id long, text string")
    keys = spark.createDataFrame([(i,) for i in range(0, 20_000, 40)] + [(40,), (None,)], "id long")
    found = likely_among(rows, keys, "id")
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    got = found.collect()
    ids = {r["id"] for r in got}
    assert ids >= set(range(0, 20_000, 40)) and (40, None) in [tuple(r) for r in got]
    assert len(got) < 1_500 and PART > 500
    assert likely_among(rows, keys.where("id < 0"), "id").count() < 50
    names = rows.select("text", "id")
    several = likely_among(names, names.where("id % 10 = 0").select("text"), "text").select("text").collect()
    assert len(several) < 3_500 and {r["text"] for r in several} >= {f"text {i}" for i in range(0, 20_000, 10)}
