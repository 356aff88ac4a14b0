"""Dashboard operators over request, exception and metric logs.

Inputs carry ``ts``, ``name``, ``duration`` or ``value`` and a ``dims`` map of string
dimensions.  Look-back filters compare the raw ``ts`` column with a literal so they
reach the scan; grouping happens before any join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mortarline import dims as D
from mortarline.functions.ranks import exact_quantiles


def dimension(key: str, bag: str = "dims") -> Column:
    """String dimension, empty when the key is missing."""
    return F.coalesce(F.col(bag)[key], F.lit(""))


def not_empty(c: Column) -> Column:
    return F.length(F.coalesce(c, F.lit(""))) > 0


def first_not_empty(*cs: Column) -> Column:
    return F.coalesce(*[F.when(c != "", c) for c in cs])


def starts_with_any(c: Column, prefixes: Sequence[str]) -> Column:
    """Case-insensitive prefix test."""
    low = F.lower(c)
    hit = F.lit(False)
    for p in prefixes:
        hit = hit | low.startswith(p.lower())
    return hit


def day_of(c: str | Column) -> Column:
    return F.date_trunc("day", c if isinstance(c, Column) else F.col(c)).cast("timestamp_ntz")


def look_back(df: DataFrame, now: str | None, days: int, col: str = "ts") -> DataFrame:
    """Rows strictly newer than ``now - days``; ``now`` defaults to the current time."""
    at = F.lit(now).cast("timestamp_ntz") if now else F.localtimestamp()
    return df.where(F.col(col) > at - F.expr(f"INTERVAL {int(days)} DAYS"))


def latency_by_version(requests: DataFrame, prefixes: Sequence[str], now: str | None = None, days: int = 30) -> DataFrame:
    """Daily average and exact p50/p95/p99 duration per prompt version."""
    rows = (
        look_back(requests, now, days)
        .where(starts_with_any(F.col("name"), prefixes))
        .where(not_empty(dimension("prompt_version")))
        .select(day_of("ts").alias("day"), dimension("prompt_version").alias("prompt_version"), "duration")
    )
    counts = rows.groupBy("day", "prompt_version").agg(F.count(F.lit(1)).alias("request_count"))
    stats = exact_quantiles(rows, ["day", "prompt_version"], "duration", {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    return counts.join(stats, ["day", "prompt_version"], "left").select(
        "day",
        "prompt_version",
        F.round("mean", 1).alias("avg_duration_ms"),
        F.round("p50", 1).alias("p50_duration_ms"),
        F.round("p95", 1).alias("p95_duration_ms"),
        F.round("p99", 1).alias("p99_duration_ms"),
        "request_count",
    )


def error_rate_by_day(requests: DataFrame, exceptions: DataFrame, now: str | None = None, days: int = 30) -> DataFrame:
    """Errors per type, day and version against all requests of the day."""
    totals = look_back(requests, now, days).groupBy(day_of("ts").alias("day")).agg(F.count(F.lit(1)).alias("total"))
    errors = (
        look_back(exceptions, now, days)
        .select(
            day_of("ts").alias("day"),
            F.coalesce(F.when(F.col("type") != "", F.col("type")), F.lit("UnknownError")).alias("error_type"),
            dimension("prompt_version").alias("prompt_version"),
        )
        .groupBy("day", "error_type", "prompt_version")
        .agg(F.count(F.lit(1)).alias("error_count"))
    )
    total = F.coalesce(F.col("total"), F.lit(1))
    return errors.join(totals, "day", "left").select(
        "day",
        "error_type",
        "prompt_version",
        "error_count",
        F.coalesce("total", F.lit(0)).alias("total_requests"),
        F.round(F.lit(100.0) * F.col("error_count") / total, 2).alias("error_rate_pct"),
    )


def quality_pass_rate(
    metrics: DataFrame, gates: Mapping[str, float] = D.DASHBOARD_GATES, now: str | None = None, days: int = 30
) -> DataFrame:
    """Daily share of metric values at or above their gate."""
    passed = F.lit(False)
    for name, gate in gates.items():
        passed = passed | ((F.col("name") == name) & (F.col("value") >= gate))
    return (
        look_back(metrics, now, days)
        .where(F.col("name").isin(list(gates)))
        .select(
            day_of("ts").alias("day"),
            F.col("name").alias("metric"),
            dimension("prompt_version").alias("prompt_version"),
            "value",
            F.when(passed, 1).otherwise(0).alias("passed"),
        )
        .groupBy("day", "metric", "prompt_version")
        .agg(
            F.round(F.lit(100.0) * F.sum("passed") / F.count(F.lit(1)), 1).alias("pass_rate"),
            F.round(F.avg("value"), 3).alias("avg_score"),
            F.sum("passed").alias("passed_count"),
            F.count(F.lit(1)).alias("total_evals"),
        )
    )


def token_cost_by_day(metrics: DataFrame, now: str | None = None, days: int = 30) -> DataFrame:
    """Daily token and cost sums per version and model, one column per metric."""
    names = ["input_tokens", "output_tokens", "estimated_cost_usd"]
    wide = (
        look_back(metrics, now, days)
        .where(F.col("name").isin(names))
        .select(
            day_of("ts").alias("day"),
            dimension("prompt_version").alias("prompt_version"),
            dimension("model_version").alias("model_version"),
            "name",
            "value",
        )
        .groupBy("day", "prompt_version", "model_version")
        .agg(*[F.sum(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names])
    )
    spent = {n: F.coalesce(F.col(n), F.lit(0.0)) for n in names}
    return wide.select(
        "day",
        "prompt_version",
        "model_version",
        spent["input_tokens"].alias("input_tokens"),
        spent["output_tokens"].alias("output_tokens"),
        (spent["input_tokens"] + spent["output_tokens"]).alias("total_tokens"),
        F.round(spent["estimated_cost_usd"], 4).alias("estimated_cost_usd"),
    )


def top_failure_modes(
    metrics: DataFrame, names: Sequence[str] = ("drift_alert", "evaluation_failure"), k: int = 10,
    now: str | None = None, days: int = 30,
) -> DataFrame:
    """The ``k`` most frequent failure categories with last occurrence and versions.

    Rows are first reduced to one per (category, version); ties at rank ``k`` are
    broken by category name.
    """
    category, reason = dimension("failure_category"), dimension("failure_reason")
    per_version = (
        look_back(metrics, now, days)
        .where(F.col("name").isin(list(names)))
        .where(not_empty(reason) | not_empty(category))
        .select(
            F.coalesce(first_not_empty(category, reason), F.lit("unspecified")).alias("failure_category"),
            dimension("prompt_version").alias("version"),
            "ts",
        )
        .groupBy("failure_category", "version")
        .agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("ts"))
    )
    top = (
        per_version.groupBy("failure_category")
        .agg(F.sum("n").alias("occurrence_count"), F.max("ts").alias("last_seen"))
        .orderBy(F.desc("occurrence_count"), "failure_category")
        .limit(k)
    )
    versions = (
        per_version.join(F.broadcast(top.select("failure_category")), "failure_category", "left_semi")  # k rows
        .groupBy("failure_category")
        .agg(F.sort_array(F.collect_list("version")).alias("versions"))
    )
    top = top.join(versions, "failure_category")
    order = Window.orderBy(F.desc("occurrence_count"), "failure_category")
    return top.select(
        F.row_number().over(order).alias("rank"),
        "failure_category",
        "occurrence_count",
        "last_seen",
        F.array_join("versions", ",").alias("affected_prompt_versions"),
    )


def stamp_dimensions(df: DataFrame, base: Mapping[str, str | None], bag: str = "dims") -> DataFrame:
    """Add base dimensions to every row; a row's own keys win, values become strings."""
    base_map = F.create_map(
        *[x for key, value in base.items() for x in (F.lit(key), F.lit(str(value) if value else "unknown"))]
    )
    own = F.coalesce(F.col(bag), F.create_map().cast("map<string,string>"))
    kept = F.map_filter(base_map, lambda k, _: ~F.map_contains_key(own, k))
    return df.withColumn(bag, F.map_concat(kept, own))


def metric_long_form(drift: DataFrame, run: DataFrame) -> DataFrame:
    """Drift results as (name, value, dims) rows for an append-only metric table.

    Skipped features give no rows; an alert row appears only when the run is at
    least at warning level.
    """
    per_feature = drift.where(~F.col("skipped")).select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.concat("feature", F.lit(suffix)).alias("name"),
                        F.col(c).alias("value"),
                        F.create_map(F.lit("feature"), F.col("feature")).alias("dims"),
                    )
                    for suffix, c in [("_psi", "psi"), ("_ks_stat", "ks_statistic"), ("_js_div", "js_divergence")]
                ]
            )
        ).alias("m")
    ).select("m.*")
    whole_run = run.select(
        F.explode(
            F.filter(
                F.array(
                    F.struct(
                        F.lit("max_psi").alias("name"),
                        F.col("max_psi").alias("value"),
                        F.create_map().cast("map<string,string>").alias("dims"),
                    ),
                    F.struct(
                        F.lit("drifted_feature_count").alias("name"),
                        F.col("drifted_feature_count").cast("double").alias("value"),
                        F.create_map().cast("map<string,string>").alias("dims"),
                    ),
                    F.struct(
                        F.when(F.col("severity").isin("warning", "critical"), F.lit("drift_alert")).alias("name"),
                        F.lit(1.0).alias("value"),
                        F.create_map(
                            F.lit("severity"),
                            F.col("severity"),
                            F.lit("drifted_features"),
                            F.to_json("drifted_features"),
                        ).alias("dims"),
                    ),
                ),
                lambda m: m["name"].isNotNull(),
            )
        ).alias("m")
    ).select("m.*")
    return per_feature.unionByName(whole_run)
