"""Exact order statistics and running sums that no single task has to hold.

Spark's ``percentile`` keeps every distinct value of a group in one buffer, and a
window ordered over a whole group sorts it in one task.  Both break when one group
holds a third of a very large table.  The functions here split each group by a
deterministic, order-preserving bin of the value: a first pass counts rows per bin
(partial aggregation, a few thousand rows per group), running sums over those counts
say which bins hold the wanted ranks, and only the values of those bins are looked at
again.  Equal values are counted before the first shuffle, so a frequent value is one row per task.  Every bin is an independent shuffle key, so a hot group is spread.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BIN_STEPS = 1024


def ordered_bin(v: Column, steps: int = BIN_STEPS) -> Column:
    """Long bin number that never decreases as ``v`` grows; ``steps`` bins per power of two."""
    a = F.abs(v)
    exponent = F.floor(F.log2(a)).cast("double")
    position = F.floor((exponent + a / F.pow(F.lit(2.0), exponent) + F.lit(1100.0)) * F.lit(float(steps)))
    position = F.when(a == F.lit(float("inf")), F.lit(2**53)).otherwise(position)
    return F.when(v == 0, F.lit(0)).when(v > 0, position).otherwise(-position).cast("long")


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    conditions = [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names]
    return reduce(lambda a, b: a & b, conditions)


def _targets(n: Column, probs: Sequence[float], method: str) -> Column:
    """Array of (slot, rank, frac): which 0-based ranks each probability needs.

    Slot ``2i`` is the lower row of probability ``i`` and ``2i + 1`` the upper one.
    """
    entries = []
    for i, p in enumerate(probs):
        if method == "nearest":
            # index floor(n * p), capped at the last row; p is a percentage share
            rank = F.least(F.floor(n * F.lit(p * 100.0) / F.lit(100.0)), n - 1).cast("long")
            entries.append((2 * i, rank, F.lit(0.0)))
        else:
            h = F.lit(float(p)) * (n - 1)
            low = F.floor(h).cast("long")
            entries.append((2 * i, low, h - low))
            entries.append((2 * i + 1, F.least(low + 1, n - 1), h - low))
    return F.array(
        *[
            F.struct(F.lit(slot).alias("slot"), rank.cast("long").alias("rank"), frac.alias("frac"))
            for slot, rank, frac in entries
        ]
    )


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    method: str = "linear",
    steps: int = BIN_STEPS,
) -> DataFrame:
    """Exact quantiles of ``value`` per ``keys``: columns keys, ``n``, ``mean``, one per prob.

    ``linear`` interpolates between closest ranks, ``nearest`` takes the row at index
    ``floor(n * p)``.  NULL and NaN are ignored; groups without values give no row.
    """
    keys = list(keys)
    names, shares = list(probs), list(probs.values())
    rows = (
        df.select(*keys, F.col(value).cast("double").alias("_v"))
        .where(F.col("_v").isNotNull() & ~F.isnan("_v"))
        .withColumn("_bin", ordered_bin(F.col("_v"), steps))
    )
    # equal values are one row from here on, counted before they are shuffled
    values = rows.groupBy(*keys, "_bin", "_v").agg(F.count(F.lit(1)).alias("_c"))
    bins = values.groupBy(*keys, "_bin").agg(F.sum("_c").alias("_c"), F.sum(F.col("_v") * F.col("_c")).alias("_s"))
    by_group = Window.partitionBy(*keys)
    running = by_group.orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        bins.withColumn("_hi", F.sum("_c").over(running))
        .withColumn("n", F.sum("_c").over(by_group))
        .withColumn("_total", F.sum("_s").over(by_group))
        .withColumn("_lo", F.col("_hi") - F.col("_c"))
        .withColumn("_all", _targets(F.col("n"), shares, method))
        .withColumn("_want", F.filter("_all", lambda t: (t["rank"] >= F.col("_lo")) & (t["rank"] < F.col("_hi"))))
        .where(F.size("_want") > 0)
        .select(*keys, "_bin", "_lo", "n", (F.col("_total") / F.col("n")).alias("mean"), "_want")
    )
    inside = (
        values.alias("r")
        .join(placed.alias("p"), _same("r", "p", [*keys, "_bin"]))
        .select(*[F.col(f"p.{k}").alias(k) for k in keys], F.col("p._bin").alias("_bin"), "_v", "_c", "_lo", "n", "mean", "_want")
    )
    in_bin = (
        Window.partitionBy(*keys, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    picked = (
        inside.withColumn("_top", F.col("_lo") + F.sum("_c").over(in_bin))
        .withColumn(
            "_t",
            F.explode(
                F.filter(
                    "_want",
                    lambda t: (t["rank"] >= F.col("_top") - F.col("_c")) & (t["rank"] < F.col("_top")),
                )
            ),
        )
    )
    slots = []
    for i, name in enumerate(names):
        low, high = (F.max(F.when(F.col("_t.slot") == 2 * i + part, F.col("_v"))) for part in (0, 1))
        frac = F.max(F.when(F.col("_t.slot") == 2 * i, F.col("_t.frac")))
        slots.append((low if method == "nearest" else low + (high - low) * frac).alias(name))
    return picked.groupBy(*keys).agg(F.first("n").alias("n"), F.first("mean").alias("mean"), *slots)


def running_totals(
    df: DataFrame, keys: Sequence[str], value: str, sums: Sequence[str], steps: int = BIN_STEPS
) -> DataFrame:
    """Rows (keys, value, sums) plus ``cum_<s>`` and ``all_<s>``, in order of ``value``.

    Two-level prefix sum: totals per ordered bin give each bin its offset, and the
    running window is confined to one bin.  ``df`` should hold one row per (keys, value).
    """
    keys = list(keys)
    rows = df.withColumn("_bin", ordered_bin(F.col(value), steps))
    bins = rows.groupBy(*keys, "_bin").agg(*[F.sum(s).alias(f"_b_{s}") for s in sums])
    group = Window.partitionBy(*keys)
    before = group.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bins.select(
        *keys,
        "_bin",
        *[F.coalesce(F.sum(f"_b_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in sums],
        *[F.sum(f"_b_{s}").over(group).alias(f"all_{s}") for s in sums],
    )
    in_bin = Window.partitionBy(*[f"r.{k}" for k in keys], "r._bin").orderBy(f"r.{value}")
    in_bin = in_bin.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = rows.alias("r").join(offsets.alias("o"), _same("r", "o", [*keys, "_bin"]))
    return joined.select(
        *[F.col(f"r.{k}").alias(k) for k in keys],
        F.col(f"r.{value}").alias(value),
        *[F.col(f"r.{s}").alias(s) for s in sums],
        *[(F.col(f"o._o_{s}") + F.sum(f"r.{s}").over(in_bin)).alias(f"cum_{s}") for s in sums],
        *[F.col(f"o.all_{s}").alias(f"all_{s}") for s in sums],
    )
