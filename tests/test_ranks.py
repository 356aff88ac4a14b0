import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mortarline.functions.ranks import exact_quantiles, ordered_bin, running_totals

PROBS = {"p1": 0.01, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p99": 0.99}


def frame(spark, values, key="g"):
    return spark.createDataFrame([(key, float(v)) for v in values], "k string, v double")


@settings(max_examples=12, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False).map(lambda v: round(v, 2)), min_size=1, max_size=60))
def test_linear_is_numpy(spark, values):
    row = exact_quantiles(frame(spark, values), ["k"], "v", PROBS).collect()[0]
    for name, p in PROBS.items():
        assert row[name] == pytest.approx(np.percentile(values, p * 100), rel=1e-12, abs=1e-9)
    assert row["n"] == len(values)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=80))
def test_nearest_is_index(spark, values):
    row = exact_quantiles(frame(spark, values), ["k"], "v", PROBS, method="nearest").collect()[0]
    ordered = sorted(values)
    for name, p in PROBS.items():
        assert row[name] == ordered[min(int(len(ordered) * round(p * 100) / 100), len(ordered) - 1)]


def test_bins_keep_order(spark):
    rng = np.random.default_rng(7)
    values = np.unique(np.concatenate([
        rng.normal(size=500) * 10.0 ** rng.integers(-300, 300, 500), 2.0 ** np.arange(-60, 60),
        np.nextafter(2.0 ** np.arange(-60, 60), 0), [0.0, -0.0, 5e-324, 1.7e308, float("inf"), float("-inf")],
    ]))
    df = spark.createDataFrame([(float(v),) for v in values], "v double").select("v", ordered_bin(F.col("v")).alias("b"))
    bins = [r["b"] for r in sorted(df.collect(), key=lambda r: r["v"])]
    assert bins == sorted(bins)


def test_null_keys_and_nan(spark):
    rows = [(None, 1.0), (None, 3.0), ("a", float("nan")), ("a", None), ("a", 5.0), ("b", None)]
    out = exact_quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", {"m": 0.5})
    assert {r["k"]: (r["n"], r["m"]) for r in out.collect()} == {None: (2, 2.0), "a": (1, 5.0)}


def test_running_totals(spark):
    rng = np.random.default_rng(3)
    values = np.unique(rng.normal(size=400).round(3))
    counts = rng.integers(0, 5, len(values))
    df = spark.createDataFrame([("f", float(v), int(c)) for v, c in zip(values, counts)], "f string, v double, n long")
    got = {r["v"]: (r["cum_n"], r["all_n"]) for r in running_totals(df, ["f"], "v", ["n"]).collect()}
    assert got == {float(v): (int(c), int(counts.sum())) for v, c in zip(values, np.cumsum(counts))}
