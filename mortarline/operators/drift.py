"""Distribution drift between a baseline and an inference table."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from mortarline.dims import DriftLimits
from mortarline.functions.ranks import running_totals
from mortarline.operators import profile as P

# Fixed values.
EPSILON = 1e-10
MIN_ROWS = 10


def _share(n: str) -> Column:
    total = F.sum(n).over(Window.partitionBy("feature"))
    return F.greatest(F.col(n) / (total + EPSILON), F.lit(EPSILON))


def divergence(counts: DataFrame) -> DataFrame:
    """PSI and Jensen-Shannon divergence from (feature, bin, base, inf) count rows."""
    p, q = F.col("p"), F.col("q")
    m = (p + q) * 0.5
    return (
        counts.select("feature", _share("base").alias("p"), _share("inf").alias("q"))
        .groupBy("feature")
        .agg(
            F.sum((q - p) * F.ln(q / p)).alias("psi"),
            (0.5 * F.sum(p * F.ln(p / m)) + 0.5 * F.sum(q * F.ln(q / m))).alias("js_divergence"),
        )
    )


def paired_histogram(
    base: DataFrame, inf: DataFrame, features: Sequence[str], overflow: bool = False
) -> DataFrame:
    """(feature, bin, base, inf): both sides on the baseline's edges."""
    edges = P.bin_edges(P.numeric_summary(base, features))
    left = P.histogram(base, edges, features, overflow=overflow).withColumnRenamed("n", "base")
    right = P.histogram(inf, edges, features, overflow=overflow).withColumnRenamed("n", "inf")
    return left.join(right, ["feature", "bin"])


def ks_pvalue(d: Column, n: Column, m: Column, terms: int = 40) -> Column:
    """Asymptotic two-sided p-value: 2 * sum (-1)^(j-1) exp(-2 j^2 x^2).

    Below x = 0.2 the series needs many terms and the value is 1 to 12 digits.
    """
    x2 = d * d * n * m / (n + m)
    total = F.lit(0.0)
    for j in range(1, terms + 1):
        total = total + F.lit(2.0 if j % 2 else -2.0) * F.exp(F.lit(-2.0 * j * j) * x2)
    return F.when(x2 < 0.04, 1.0).otherwise(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))


#: Cells of the lattice up to which p-values are exact; the series is right to a few digits long before.
EXACT_CELLS = 4_000_000


def exact_tail(d: float, n: int, m: int) -> float:
    """Chance that two samples of ``n`` and ``m`` rows without ties are at least ``d`` apart, counted over lattice paths.

    A path from (0, 0) to (n, m) is an order of the rows.  The share of paths to a point that stay in the band |i/n - j/m| < d
    follows from its two predecessors, weighted by the shares of paths that come from them; diagonals are taken as a whole.
    """
    if not n or not m:
        return float("nan")
    reach = round(d * n * m) - 0.5  # in units of 1 / (n m) the band ends between two whole numbers
    inside = np.zeros(n + 1)
    inside[0] = 1.0
    for step in range(1, n + m + 1):
        i = np.arange(max(0, step - m), min(n, step) + 1)
        j = step - i
        from_left = np.where(i > 0, inside[np.maximum(i - 1, 0)], 0.0) * i
        from_below = np.where(j > 0, inside[i], 0.0) * j
        new = (from_left + from_below) / step
        new[np.abs(i * m - j * n) > reach] = 0.0
        inside = np.zeros(n + 1)
        inside[i] = new
    return float(min(1.0, max(0.0, 1.0 - inside[n])))


@F.pandas_udf(DoubleType())
def _exact(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series([exact_tail(x, int(a), int(b)) if a * b <= EXACT_CELLS else None for x, a, b in zip(d, n, m, strict=True)], dtype="float64")


def ks_two_sample(base: DataFrame, inf: DataFrame, features: Sequence[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic and p-value per feature, exact up to EXACT_CELLS (rows times rows).

    Values are pre-aggregated to one row per (feature, value) before any ordering,
    and the running sums are split by value bin, so no feature is sorted in one task.
    """
    sides = (
        P.long_numeric(base, features)
        .select("feature", "v", F.lit(1).alias("a"), F.lit(0).alias("b"))
        .unionByName(P.long_numeric(inf, features).select("feature", "v", F.lit(0).alias("a"), F.lit(1).alias("b")))
        .groupBy("feature", "v")
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    )
    steps = running_totals(sides, ["feature"], "v", ["a", "b"])
    gap = F.abs(F.col("cum_a") / F.nullif("all_a", F.lit(0)) - F.col("cum_b") / F.nullif("all_b", F.lit(0)))
    out = steps.groupBy("feature").agg(
        F.max(gap).alias("ks_statistic"), F.first("all_a").alias("n"), F.first("all_b").alias("m")
    )
    # one row per feature from here on
    n, m = F.col("n").cast("double"), F.col("m").cast("double")
    return out.withColumn("_exact", _exact(F.coalesce("ks_statistic", F.lit(0.0)), F.coalesce(n, F.lit(0.0)), F.coalesce(m, F.lit(0.0)))).select(
        "feature", "ks_statistic", F.when(n * m <= EXACT_CELLS, F.nanvl("_exact", F.lit(None))).otherwise(ks_pvalue(F.col("ks_statistic"), n, m)).alias("ks_pvalue"),
    )


def ks_uniform(base_summary: DataFrame, inf: DataFrame, features: Sequence[str], draws: int = 1000) -> DataFrame:
    """KS of the inference values against the uniform distribution on [min, max] of the baseline.

    This is the limit of comparing with random draws from an even grid over the
    baseline range; ``draws`` only enters the p-value.
    """
    values = P.long_numeric(inf, features).groupBy("feature", "v").agg(F.count(F.lit(1)).alias("b"))
    bounds = base_summary.select("feature", "min", "max")
    steps = running_totals(values, ["feature"], "v", ["b"]).join(F.broadcast(bounds), "feature")
    flat = F.when(F.col("v") >= F.col("min"), 1.0).otherwise(0.0)
    cdf = F.when(F.col("max") == F.col("min"), flat).otherwise(
        F.greatest(
            F.lit(0.0), F.least(F.lit(1.0), (F.col("v") - F.col("min")) / F.nullif(F.col("max") - F.col("min"), F.lit(0.0)))
        )
    )
    at = F.abs(F.col("cum_b") / F.col("all_b") - cdf)
    just_below = F.abs((F.col("cum_b") - F.col("b")) / F.col("all_b") - cdf)
    out = steps.groupBy("feature").agg(
        F.max(F.greatest(at, F.when(F.col("max") > F.col("min"), just_below).otherwise(0.0))).alias("ks_statistic"),
        F.first("all_b").alias("m"),
    )
    return out.select(
        "feature",
        "ks_statistic",
        ks_pvalue(F.col("ks_statistic"), F.lit(float(draws)), F.col("m").cast("double")).alias("ks_pvalue"),
    )


def drift_by_feature(
    base: DataFrame,
    inf: DataFrame,
    features: Sequence[str],
    mode: str = "sample",
    overflow: bool = False,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """One drift record per numeric feature both tables have.

    ``mode='sample'`` compares real baseline rows for KS, ``'uniform'`` the baseline's
    value range.  Features with fewer than ``min_rows`` inference values are skipped.
    """
    features = [f for f in P.present(base, features) if f in inf.columns]
    base_stats = P.numeric_summary(base, features)
    inf_stats = P.numeric_summary(inf, features).select(
        "feature",
        F.col("count").alias("inference_count"),
        F.col("mean").alias("inference_mean"),
        F.col("std_pop").alias("inference_std"),
    )
    div = divergence(paired_histogram(base, inf, features, overflow))
    ks = ks_two_sample(base, inf, features) if mode == "sample" else ks_uniform(base_stats, inf, features)
    joined = (
        inf_stats.join(
            base_stats.select("feature", F.col("mean").alias("baseline_mean"), F.col("std").alias("baseline_std")),
            "feature",
        )
        .join(div, "feature", "left")
        .join(ks, "feature", "left")
    )
    skipped = F.col("inference_count") < min_rows
    figures = [
        "psi", "ks_statistic", "ks_pvalue", "js_divergence",
        "inference_mean", "inference_std", "baseline_mean", "baseline_std",
    ]
    return joined.select(
        "feature",
        skipped.alias("skipped"),
        F.when(skipped, F.lit("insufficient_data")).alias("reason"),
        *[F.when(~skipped, F.col(c)).alias(c) for c in figures],
        "inference_count",
    )


def run_rollup(drift: DataFrame, limits: DriftLimits = DriftLimits()) -> DataFrame:
    """One row: worst PSI, drifted features and the severity PSI alone implies."""
    drifted = ~F.col("skipped") & (F.col("psi") > limits.psi_warning)
    worst = F.coalesce(F.max(F.when(~F.col("skipped"), F.greatest("psi", F.lit(0.0)))), F.lit(0.0))
    return drift.agg(
        worst.alias("max_psi"),
        F.count_if(drifted).alias("drifted_feature_count"),
        F.sort_array(F.collect_list(F.when(drifted, F.col("feature")))).alias("drifted_features"),
    ).withColumn(
        "severity",
        F.when(F.col("max_psi") > limits.psi_critical, "critical")
        .when(F.col("max_psi") > limits.psi_warning, "warning")
        .otherwise("none"),
    )


def classify(drift: DataFrame, limits: DriftLimits = DriftLimits()) -> DataFrame:
    """Severity per feature from PSI, KS and JS together."""
    pairs = [("psi", "psi"), ("ks_statistic", "ks"), ("js_divergence", "js")]

    def over(level: str) -> Column:
        hit = F.lit(False)
        for c, prefix in pairs:
            hit = hit | (F.coalesce(F.col(c), F.lit(0.0)) > getattr(limits, f"{prefix}_{level}"))
        return hit

    return drift.withColumn(
        "severity", F.when(over("critical"), "critical").when(over("warning"), "warning").otherwise("none")
    )


def categorical_drift(base: DataFrame, inf: DataFrame, features: Sequence[str]) -> DataFrame:
    """PSI and JS over category counts; a value missing on one side counts as empty."""
    left = P.category_counts(base, features).withColumnRenamed("n", "base")
    right = P.category_counts(inf, features).withColumnRenamed("n", "inf")
    both = left.join(right, ["feature", "value"], "full").select(
        "feature", "value", F.coalesce("base", F.lit(0)).alias("base"), F.coalesce("inf", F.lit(0)).alias("inf")
    )
    return divergence(both)


def accuracy_alert(scored: DataFrame, limits: DriftLimits = DriftLimits(), label: str = "label", pred: str = "prediction") -> DataFrame:
    """Holdout accuracy and alert level; too few rows give ``insufficient_data``."""
    acc = F.avg(F.when(F.col(label) == F.col(pred), 1.0).otherwise(0.0))
    return scored.agg(F.count(F.lit(1)).alias("n"), acc.alias("accuracy")).withColumn(
        "level",
        F.when(F.col("n") < limits.min_inference_samples, "insufficient_data")
        .when(F.col("accuracy") < limits.accuracy_critical, "critical")
        .when(F.col("accuracy") < limits.accuracy_warning, "warning")
        .otherwise("none"),
    )


def alert_record(run: DataFrame, **context: str) -> DataFrame:
    """Alert row and retrain payload for runs at warning level or above."""
    payload = F.to_json(
        F.struct(
            F.lit("data_drift").alias("trigger_reason"),
            "max_psi",
            "drifted_features",
            *[F.lit(v).alias(k) for k, v in sorted(context.items())],
        )
    )
    return run.where(F.col("severity").isin("warning", "critical")).select(
        "severity",
        "max_psi",
        F.to_json("drifted_features").alias("drifted_features"),
        F.size("drifted_features").alias("feature_count"),
        payload.alias("retrain_payload"),
    )


def window_counts(
    captured: DataFrame, edges: DataFrame, features: Sequence[str], ts: str = "ts", width: str = "1 week"
) -> DataFrame:
    """(window_start, feature, bin, n) of captured rows; also an aggregate over a stream."""
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), P.clean(f).alias("v")) for f in features])
    return (
        captured.select(F.window(ts, width).alias("w"), F.explode(cells).alias("c"))
        .select("w", "c.feature", "c.v")
        .where(F.col("v").isNotNull())
        .join(F.broadcast(edges), "feature")
        .select("w", "feature", P.bin_index(F.col("v")).alias("bin"))
        .groupBy("w", "feature", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), "feature", "bin", "n")
    )


def baseline_bins(base: DataFrame, features: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Edges of each feature (one row each) and the baseline's counts (feature, bin, base)."""
    edges = P.bin_edges(P.numeric_summary(base, features))
    return edges, P.histogram(base, edges, features).withColumnRenamed("n", "base")


def counts_drift(counted: DataFrame, reference: DataFrame) -> DataFrame:
    """PSI and JS per (window, feature) from ``window_counts``."""
    full = (
        P.fill_bins(counted, ["window_start", "feature"], 1, P.BINS)
        .withColumnRenamed("n", "inf")
        .join(F.broadcast(reference), ["feature", "bin"])
        .select(F.struct("window_start", "feature").alias("feature"), "bin", "base", "inf")
    )
    return divergence(full).select("feature.window_start", "feature.feature", "psi", "js_divergence")


def window_drift(
    captured: DataFrame, base: DataFrame, features: Sequence[str], ts: str = "ts", width: str = "1 week"
) -> DataFrame:
    """PSI and JS of each time window of captured inference rows against the baseline.

    One pass over the capture log: bins are counted per (window, feature, bin).
    """
    edges, reference = baseline_bins(base, features)
    return counts_drift(window_counts(captured, edges, features, ts, width), reference)
