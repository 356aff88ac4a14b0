from itertools import combinations

import numpy as np
import pytest

from mortarline.operators import drift as X
from mortarline.operators import profile as P


def table(spark, values, name="f"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


def hist(spark, base, values, overflow=False):
    b = table(spark, base)
    edges = P.bin_edges(P.numeric_summary(b, ["f"]))
    out = P.histogram(table(spark, values), edges, ["f"], overflow=overflow)
    return [r["n"] for r in sorted(out.collect(), key=lambda r: r["bin"])]


@pytest.mark.parametrize("seed", range(3))
def test_histogram_is_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    base, inf = rng.normal(size=300).round(1), (rng.normal(size=200) * 1.5).round(1)
    counts, edges = np.histogram(base, bins=10)
    assert hist(spark, base, base) == counts.tolist()
    assert hist(spark, base, [*inf, base.max(), base.min()]) == np.histogram([*inf, base.max(), base.min()], bins=edges)[0].tolist()


def test_histogram_edges(spark):
    assert hist(spark, [3.0] * 5, [3.0] * 5) == np.histogram([3.0] * 5, bins=10)[0].tolist()
    assert hist(spark, [0, 10], [-1, 0, 10, 11], overflow=True) == [1, 1, 0, 0, 0, 0, 0, 0, 0, 0, 1, 1]


def test_profile_ignores_missing(spark):
    rows = P.numeric_profile(table(spark, [1, None, float("nan"), 2, 9]), ["f", "absent"]).collect()
    assert len(rows) == 1
    assert (rows[0]["count"], rows[0]["null_count"]) == (3, 2)
    assert rows[0]["std"] == pytest.approx(np.std([1, 2, 9], ddof=1))


def divergence(spark, base, inf):
    rows = [("f", i, int(b), int(q)) for i, (b, q) in enumerate(zip(base, inf))]
    return X.divergence(spark.createDataFrame(rows, "feature string, bin int, base long, inf long")).collect()[0]


def test_psi_js(spark):
    p, q = np.array([5, 0, 5, 10.0]), np.array([0, 5, 5, 10.0])
    assert divergence(spark, p, p)["psi"] == pytest.approx(0, abs=1e-12)
    one, two = divergence(spark, p, q), divergence(spark, q, p)
    assert one["js_divergence"] == pytest.approx(two["js_divergence"])
    a, b = (np.clip(x / (x.sum() + 1e-10), 1e-10, None) for x in (p, q))
    assert one["psi"] == pytest.approx(((b - a) * np.log(b / a)).sum())
    m = (a + b) / 2
    assert one["js_divergence"] == pytest.approx(0.5 * (a * np.log(a / m)).sum() + 0.5 * (b * np.log(b / m)).sum())


@pytest.mark.parametrize("a,b,want", [([1, 2, 3], [1, 2, 3], 0.0), ([1, 2], [5, 6, 7], 1.0), ([1, 1, 2, 3], [1, 2, 2, 4], 0.25)])
def test_ks(spark, a, b, want):
    row = X.ks_two_sample(table(spark, a), table(spark, b), ["f"]).collect()[0]
    assert row["ks_statistic"] == pytest.approx(want)
    assert 0 <= row["ks_pvalue"] <= 1


def test_ks_random(spark, monkeypatch):
    monkeypatch.setattr(X, "EXACT_CELLS", 0)  # the series is used
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=400).round(2), rng.normal(0.3, 1.2, size=300).round(2)
    grid = np.union1d(a, b)
    cdf = lambda x: np.searchsorted(np.sort(x), grid, side="right") / len(x)
    row = X.ks_two_sample(table(spark, a), table(spark, b), ["f"]).collect()[0]
    assert row["ks_statistic"] == pytest.approx(np.abs(cdf(a) - cdf(b)).max())
    x = row["ks_statistic"] * np.sqrt(400 * 300 / 700)
    series = 2 * sum((-1) ** (j - 1) * np.exp(-2 * j * j * x * x) for j in range(1, 101))
    assert row["ks_pvalue"] == pytest.approx(min(max(series, 0), 1), abs=1e-9)


def test_few_rows_are_skipped(spark):
    base = table(spark, range(50))
    short = X.drift_by_feature(base, table(spark, range(9)), ["f"]).collect()[0]
    assert short["skipped"] and short["reason"] == "insufficient_data" and short["psi"] is None
    full = X.drift_by_feature(base, table(spark, range(10)), ["f"], mode="uniform")
    assert not full.collect()[0]["skipped"]
    run = X.run_rollup(full).collect()[0]
    assert run["severity"] == "critical" and run["drifted_features"] == ["f"]
    assert X.alert_record(X.run_rollup(full), model="m").count() == 1


def test_hot_value(spark):
    base = table(spark, [7.0] * 400 + list(range(200)))
    assert X.ks_two_sample(base, base, ["f"]).collect()[0]["ks_statistic"] == 0.0


def test_exact_p_value_counts_all_orders(spark):
    for n, m in ((3, 4), (5, 5), (2, 7), (1, 1)):
        seen = []
        for places in combinations(range(n + m), n):
            side = np.zeros(n + m)
            side[list(places)] = 1
            seen.append(np.abs(np.cumsum(side) / n - np.cumsum(1 - side) / m).max())
        for d in sorted(set(seen)):
            assert X.exact_tail(d, n, m) == pytest.approx(np.mean([s >= d - 1e-12 for s in seen]), abs=1e-12)
    # the series comes near it for larger samples
    rng = np.random.default_rng(3)
    base, inf = rng.normal(size=900), rng.normal(0.06, 1, size=800)
    row = X.ks_two_sample(table(spark, base), table(spark, inf), ["f"]).first()
    x2 = row["ks_statistic"] ** 2 * 900 * 800 / 1700
    assert row["ks_pvalue"] == pytest.approx(sum(2 * (-1) ** (j - 1) * np.exp(-2 * j * j * x2) for j in range(1, 40)), abs=0.02)
    assert X.exact_tail(0.0, 5, 5) == 1.0
