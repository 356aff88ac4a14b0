"""Feature profiles: summary statistics, percentiles, histograms, category shares."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mortarline.functions.ranks import exact_quantiles

# The nine profile percentiles and the histogram width.
PERCENTILES = {"p1": 0.01, "p5": 0.05, "p10": 0.10, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90, "p95": 0.95, "p99": 0.99}
BINS = 10


def present(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted columns this table has, in the asked order."""
    return [c for c in wanted if c in df.columns]


def clean(c: str) -> Column:
    """Double with NaN read as NULL."""
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


def long_numeric(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, v) rows without NULL or NaN."""
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), clean(f).alias("v")) for f in features])
    return df.select(F.explode(cells).alias("c")).select("c.feature", "c.v").where(F.col("v").isNotNull())


def numeric_summary(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Count, nulls, mean, sample and population deviation, min, max: one pass, one row per feature."""
    aggs = []
    for f in features:
        v = clean(f)
        aggs.append(
            F.struct(
                F.lit(f).alias("feature"),
                F.count(v).alias("count"),
                F.count_if(v.isNull()).alias("null_count"),
                F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"),
                F.stddev_pop(v).alias("std_pop"),
                F.min(v).alias("min"),
                F.max(v).alias("max"),
            )
        )
    return df.agg(F.array(*aggs).alias("s")).select(F.inline("s"))


def numeric_profile(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Summary plus the nine exact percentiles, one row per present feature."""
    features = present(df, features)
    tails = exact_quantiles(long_numeric(df, features), ["feature"], "v", PERCENTILES)
    return (
        numeric_summary(df, features)
        .drop("std_pop")
        .join(F.broadcast(tails.drop("n", "mean")), "feature", "left")
    )


def bin_edges(summary: DataFrame, bins: int = BINS) -> DataFrame:
    """(feature, lo, hi, step): equal-width bins from min to max; a constant feature gets +-0.5."""
    flat = F.col("min") == F.col("max")
    lo = F.when(flat, F.col("min") - 0.5).otherwise(F.col("min"))
    hi = F.when(flat, F.col("max") + 0.5).otherwise(F.col("max"))
    return (
        summary.where(F.col("count") > 0)
        .select("feature", lo.alias("lo"), hi.alias("hi"))
        .withColumn("step", (F.col("hi") - F.col("lo")) / F.lit(float(bins)))
    )


def edge_list(bins: int = BINS) -> Column:
    """The ``bins + 1`` edges as an array."""
    return F.array(*[F.col("lo") + F.lit(float(i)) * F.col("step") for i in range(bins)], F.col("hi"))


def bin_index(v: Column, bins: int = BINS) -> Column:
    """1-based bin, last bin closed on the right, 0 below and ``bins + 1`` above the edges.

    The arithmetic guess is corrected against the two edges around it, so the result
    is what comparing with every edge would give.
    """
    lo, hi, step = F.col("lo"), F.col("hi"), F.col("step")
    guess = F.greatest(F.lit(0.0), F.least(F.lit(bins - 1.0), F.floor((v - lo) / step).cast("double")))
    low, high = lo + guess * step, F.when(guess == bins - 1.0, hi).otherwise(lo + (guess + 1.0) * step)
    inner = guess + 1.0 - F.when(v < low, 1.0).otherwise(0.0) + F.when((v >= high) & (v < hi), 1.0).otherwise(0.0)
    placed = F.when(v < lo, 0.0).when(v > hi, bins + 1.0).when(v == hi, F.lit(float(bins))).otherwise(inner)
    # never NULL, so no null test of the whole expression is pushed below a join
    return F.coalesce(placed.cast("int"), F.lit(-1))


def fill_bins(counted: DataFrame, keys: Sequence[str], first: int, last: int) -> DataFrame:
    """(keys, bin, n) with a zero row for every bin that did not occur."""
    per_key = counted.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"))
    return per_key.select(
        *keys, "m", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("bin")
    ).select(*keys, "bin", F.coalesce(F.try_element_at("m", F.col("bin")), F.lit(0)).cast("long").alias("n"))


def histogram(df: DataFrame, edges: DataFrame, features: Sequence[str], bins: int = BINS, overflow: bool = False) -> DataFrame:
    """(feature, bin, n) for every bin, empty ones included.

    Values outside the edges are dropped, or with ``overflow`` counted in bins 0 and
    ``bins + 1``.  ``edges`` has one row per column, so it is broadcast.
    """
    counted = (
        long_numeric(df, features)
        .join(F.broadcast(edges), "feature")
        .select("feature", bin_index(F.col("v"), bins).alias("bin"))
        .groupBy("feature", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return fill_bins(counted, ["feature"], 0 if overflow else 1, bins + 1 if overflow else bins)


def category_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, value, n) over the non-null values of several columns."""
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")) for f in features])
    return (
        df.select(F.explode(cells).alias("c"))
        .select("c.feature", "c.value")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def categorical_profile(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, value, count, proportion, n_unique) with the feature's null count."""
    features = present(df, features)
    by_feature = Window.partitionBy("feature")
    nulls = df.agg(
        F.array(
            *[
                F.struct(F.lit(f).alias("feature"), F.count_if(F.col(f).isNull()).alias("null_count"))
                for f in features
            ]
        ).alias("s")
    ).select(F.inline("s"))
    return (
        category_counts(df, features)
        .select(
            "feature",
            "value",
            "n",
            (F.col("n") / F.sum("n").over(by_feature)).alias("proportion"),
            F.count(F.lit(1)).over(by_feature).alias("n_unique"),
        )
        .join(F.broadcast(nulls), "feature")
    )


def baseline_profile(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """One row per feature with the whole profile, ready for a JSON sink."""
    numeric = present(df, numeric)
    edges = bin_edges(numeric_summary(df, numeric))
    counts = (
        histogram(df, edges, numeric)
        .groupBy("feature")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("bin", "n"))), lambda s: s["n"]).alias("counts"))
    )
    numbers = (
        numeric_profile(df, numeric)
        .join(edges, "feature", "left")
        .join(counts, "feature", "left")
        .select(
            "feature",
            F.lit("numeric").alias("type"),
            "count",
            "null_count",
            "mean",
            "std",
            "min",
            "max",
            F.create_map(*[x for p in PERCENTILES for x in (F.lit(p), F.col(p))]).alias("percentiles"),
            "counts",
            edge_list().alias("bin_edges"),
        )
    )
    shares = (
        categorical_profile(df, categorical)
        .groupBy("feature")
        .agg(
            F.lit("categorical").alias("type"),
            F.sum("n").alias("count"),
            F.first("null_count").alias("null_count"),
            F.first("n_unique").alias("n_unique"),
            F.map_from_entries(
                F.transform(
                    F.reverse(F.array_sort(F.collect_list(F.struct("proportion", "value")))),
                    lambda s: F.struct(s["value"], s["proportion"]),
                )
            ).alias("value_proportions"),
        )
    )
    return numbers.unionByName(shares, allowMissingColumns=True)
