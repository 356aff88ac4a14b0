"""Traffic split arithmetic, archival rules and rollout verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def promote(traffic: DataFrame, targets: DataFrame) -> DataFrame:
    """New split after giving each endpoint's target its share.

    ``traffic`` (endpoint, position, deployment, percent), ``targets`` (endpoint,
    deployment, share).  The others divide the rest in proportion, rounded down, the
    last one taking what is left; with nothing to go by they split evenly.  The window
    covers the deployments of one endpoint.
    """
    wanted = targets.select("endpoint", F.col("deployment").alias("target"), "share")
    others = traffic.join(wanted, "endpoint").where(F.col("deployment") != F.col("target"))
    by_endpoint = Window.partitionBy("endpoint")
    order = by_endpoint.orderBy("position")
    rest = F.lit(100) - F.col("share")
    part = F.when(F.col("_total") > 0, F.floor(rest * F.col("percent") / F.col("_total"))).otherwise(
        F.floor(rest / F.col("_n"))
    )
    split = (
        others.withColumns(
            {
                "_total": F.sum("percent").over(by_endpoint),
                "_n": F.count(F.lit(1)).over(by_endpoint),
                "_i": F.row_number().over(order),
            }
        )
        .withColumn("_part", part)
        .withColumn("_given", F.coalesce(F.sum("_part").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select(
            "endpoint",
            "deployment",
            F.when(F.col("_i") == F.col("_n"), rest - F.col("_given")).otherwise(F.col("_part")).cast("int").alias("percent"),
        )
    )
    target_rows = wanted.select("endpoint", F.col("target").alias("deployment"), F.col("share").cast("int").alias("percent"))
    return split.unionByName(target_rows)


def rollback(traffic: DataFrame, targets: DataFrame) -> DataFrame:
    """All traffic back to the target deployment of each endpoint, zero elsewhere."""
    wanted = targets.select("endpoint", F.col("deployment").alias("target"))
    kept = traffic.join(wanted, "endpoint")
    return kept.select(
        "endpoint", "deployment", F.when(F.col("deployment") == F.col("target"), 100).otherwise(0).alias("percent")
    )


def archive_models(versions: DataFrame, newer: int = 3) -> DataFrame:
    """Versions with at least ``newer`` newer ones and no active deployment.

    Only the newest ``newer + 1`` rows per name are ranked (the rank filter runs before
    the shuffle); the oldest of them is the cut.
    """
    order = Window.partitionBy("name").orderBy(F.desc("version"))
    cut = (
        versions.select("name", "version")
        .withColumn("_r", F.row_number().over(order))
        .where(F.col("_r") <= newer + 1)
        .groupBy("name")
        .agg(F.max(F.when(F.col("_r") == newer + 1, F.col("version"))).alias("_cut"))
        .where(F.col("_cut").isNotNull())
    )
    old = versions.join(cut, "name").where(F.col("version") <= F.col("_cut"))
    return old.where(~F.coalesce("in_use", F.lit(False))).drop("_cut")


def archive_data(versions: DataFrame, references: DataFrame, now: str, days: int = 90) -> DataFrame:
    """Data versions superseded for ``days`` and not named in any training metadata.

    ``versions`` (name, version, created_at), ``references`` (name, version).  A version
    counts as superseded once a newer one exists that is itself old enough.
    """
    cutoff = F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")
    newest_old = (
        versions.where(F.col("created_at") <= cutoff).groupBy("name").agg(F.max("version").alias("_newest_old"))
    )
    stale = versions.join(newest_old, "name").where(F.col("version") < F.col("_newest_old")).drop("_newest_old")
    return stale.join(references.select("name", "version"), ["name", "version"], "left_anti")


def canary_verdict(windows: DataFrame, max_p95: float = 2000.0, min_success: float = 0.99) -> DataFrame:
    """promote or rollback from ``p95_ms`` and ``success_rate``."""
    healthy = (F.col("p95_ms") < max_p95) & (F.col("success_rate") > min_success)
    return windows.withColumn("verdict", F.when(healthy, "promote").otherwise("rollback"))
