"""Folded random forests, against Spark's learner and on tiny tables."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier

from mortarline.operators import forest as T
from mortarline.operators import ml as M


def test_large_forests_grow_from_cells(spark, monkeypatch):
    rows = spark.range(3000).selectExpr("id", "cast(id % 97 as double) x", "id % 2 y", "cast(id % 97 >= 50 as int) label", "id % 3 = 0 is_test")
    monkeypatch.setattr(M, "FOREST_FOLD", 1000)
    monkeypatch.setattr(M, "RandomForestClassifier", None)  # no learner goes over the rows
    train, test = rows.where("not is_test"), rows.where("is_test")
    out = M.forest_scores(train, test, ["x", "y"], trees=9)
    assert out.columns == [*rows.columns, "prediction", "confidence"]
    got = out.collect()
    assert len(got) == 1000 and all(r["prediction"] == r["label"] and r["confidence"] > 0.5 for r in got if abs(r["x"] - 49.5) > 3)
    cut = T.feature_cuts(train, ["x", "y"])
    assert [len(c) for c in cut] == [31, 1]
    code, label, n = T.folded(train, ["x", "y"], "label", cut, 2)
    assert n.sum() == 2000 and len(code) <= 32 * 2 * 2 and len(set(zip(code, label))) == len(code)
    assert sorted(map(tuple, M.forest_scores(train, test, ["x", "y"], trees=9).collect())) == sorted(map(tuple, got))
    odd = test.union(test.limit(1).selectExpr("id", "null", "y", "label", "is_test"))
    with pytest.raises(Exception, match="null or NaN"):
        M.forest_scores(train, odd, ["x", "y"], trees=2).collect()


def test_cell_trees_are_those_of_the_learner(spark):
    rng = np.random.default_rng(1)
    x = np.stack([rng.normal(size=4000), np.round(rng.exponential(3.0, 4000), 1), rng.integers(0, 5, 4000)], axis=1)
    y = (x[:, 0] + x[:, 1] * rng.random(4000) > x[:, 2]).astype(int) + (x[:, 1] > 6)
    names = ["a", "b", "c"]
    rows = spark.createDataFrame([(*map(float, r), int(k)) for r, k in zip(x, y)], "a double, b double, c double, label int")
    cut = T.feature_cuts(rows, names)
    code, label, n = T.folded(rows, names, "label", cut, 3)
    tree = T.grown(T._apart(code, cut), label, n, 3, 4, 3, rng)
    data = M._assembled(rows, names)
    model = DecisionTreeClassifier(maxDepth=4, featuresCol="_features", labelCol="label").fit(data)
    want = np.array([r["probability"].toArray() for r in model.transform(data).collect()])
    got = T.shares(T._apart(T._bins(list(x.T), cut), cut), tree)
    assert np.allclose(got, want) and len(tree[0]) == model.numNodes


def test_cuts_of_many_values(spark, monkeypatch):
    rows = spark.range(20_000).selectExpr("cast(id * id as double) x", "cast(if(id < 19000, 0, id) as double) y")
    whole = T.feature_cuts(rows, ["x", "y"])
    monkeypatch.setattr(T, "FINE", 20_001)
    assert [len(c) for c in T.feature_cuts(rows, ["x", "y"])] == [len(c) for c in whole] == [31, 31]
    monkeypatch.setattr(T, "FINE", 320)
    near = T.feature_cuts(rows, ["x", "y"])
    assert np.allclose(near[0], whole[0], rtol=0.02) and len(near[1]) >= 15 and (np.diff(near[1]) > 0).all()
