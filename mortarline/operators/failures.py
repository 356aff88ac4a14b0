"""Why evaluations fail: extraction from free-form log entries, taxonomy, trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mortarline import dims as D

# Metrics with a threshold field in log entries.
LOG_METRICS = ["groundedness", "relevance", "coherence", "fluency", "buildability"]

_ENTRY = (
    "id string, timestamp string, prompt_version string, passed boolean, success boolean, "
    "failure_reason string, failure_reasons array<string>, errors array<string>, "
    + ", ".join(f"{m} double, {m}_threshold double" for m in LOG_METRICS)
)


def categorize(reason: Column, taxonomy: Sequence[tuple[str, Sequence[str]]] = D.FAILURE_TAXONOMY) -> Column:
    """First category, in declared order, one of whose keywords is in the reason; else ``other``."""
    low = F.lower(reason)
    out = None
    for category, keywords in taxonomy:
        hit = F.lit(False)
        for k in keywords:
            hit = hit | F.contains(low, F.lit(k))
        out = F.when(hit, category) if out is None else out.when(hit, category)
    return out.otherwise("other")


def recent_entries(log: DataFrame, cutoff: str | None, entry: str = "entry") -> DataFrame:
    """Drop entries whose zoned timestamp is before ``cutoff``; anything else is kept."""
    if not cutoff:
        return log
    ts = F.get_json_object(entry, "$.timestamp")
    zoned = ts.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    old = zoned & (F.try_to_timestamp(ts) < F.to_timestamp(F.lit(cutoff)))
    return log.where(~F.coalesce(old, F.lit(False)))


def extract_failures(log: DataFrame, entry: str = "entry") -> DataFrame:
    """Failed entries with their reasons.

    An entry fails when ``passed`` or ``success`` is false, a metric is under its
    threshold, or a reason field is present at all, even null or empty.
    """
    parsed = log.withColumns(
        {"_e": F.from_json(entry, _ENTRY), "_keys": F.json_object_keys(entry)}
    )
    e = F.col("_e")

    def has(key: str) -> Column:
        return F.array_contains("_keys", key)

    below = [
        F.when(e[m] < e[f"{m}_threshold"], F.lit(f"{m}_failure")) for m in LOG_METRICS
    ]
    none = F.array().cast("array<string>")
    reasons = F.concat(
        F.filter(F.array(*below), lambda r: r.isNotNull()),
        F.when(has("failure_reason"), F.array(e["failure_reason"])).otherwise(none),
        F.coalesce(F.when(has("failure_reasons"), e["failure_reasons"]), none),
        F.coalesce(F.when(has("errors"), e["errors"]), none),
    )
    failed = (
        F.coalesce(e["passed"] == False, F.lit(False))  # noqa: E712 - column comparison
        | F.coalesce(e["success"] == False, F.lit(False))  # noqa: E712
        | (F.size("_reasons") > 0)
        | has("failure_reason")
        | has("failure_reasons")
        | has("errors")
    )
    return (
        parsed.withColumn("_reasons", reasons)
        .where(failed)
        .select(
            *[c for c in log.columns if c != entry],
            F.coalesce(e["id"], F.lit("unknown")).alias("id"),
            F.coalesce(e["timestamp"], F.lit("")).alias("timestamp"),
            F.coalesce(e["prompt_version"], F.lit("unknown")).alias("prompt_version"),
            F.when(F.size("_reasons") > 0, F.col("_reasons"))
            .otherwise(F.array(F.lit("unspecified")))
            .alias("failure_reasons"),
            F.map_filter(
                F.create_map(*[x for m in LOG_METRICS for x in (F.lit(m), e[m])]), lambda _, v: v.isNotNull()
            ).alias("metrics"),
        )
    )


def explode_reasons(failures: DataFrame) -> DataFrame:
    """One row per reason with its position and category."""
    return failures.select(
        *[c for c in failures.columns if c != "failure_reasons"],
        F.posexplode("failure_reasons").alias("reason_pos", "reason"),
    ).withColumn("category", categorize(F.col("reason")))


def category_counts(reasons: DataFrame) -> DataFrame:
    """Count, share of all reasons in percent, and description per category."""
    described = F.create_map(*[F.lit(x) for kv in D.FAILURE_DESCRIPTIONS.items() for x in kv])
    counted = reasons.groupBy("category").agg(F.count(F.lit(1)).alias("count"))
    # at most one row per taxonomy category reaches this window
    return counted.select(
        "category",
        F.coalesce(F.try_element_at(described, F.col("category")), F.lit("")).alias("description"),
        "count",
        (F.col("count") / F.sum("count").over(Window.partitionBy()) * 100).alias("percentage"),
    )


def by_version(reasons: DataFrame) -> DataFrame:
    return reasons.groupBy("prompt_version", "category").agg(F.count(F.lit(1)).alias("count"))


def failure_summary(log: DataFrame, failures: DataFrame, reasons: DataFrame) -> DataFrame:
    """Totals, failure rate and number of distinct categories, one row."""
    counts = (
        log.select(F.lit("entry").alias("kind"), F.lit(None).cast("string").alias("category"))
        .unionByName(failures.select(F.lit("failure").alias("kind"), F.lit(None).cast("string").alias("category")))
        .unionByName(reasons.select(F.lit("reason").alias("kind"), "category"))
        .groupBy("kind", "category")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = F.coalesce(F.sum(F.when(F.col("kind") == "entry", F.col("n"))), F.lit(0))
    failed = F.coalesce(F.sum(F.when(F.col("kind") == "failure", F.col("n"))), F.lit(0))
    return counts.agg(
        total.alias("total_evaluations"),
        failed.alias("total_failures"),
        (failed / F.greatest(total, F.lit(1))).alias("failure_rate"),
        F.count_if(F.col("kind") == "reason").alias("unique_categories"),
    )


def examples(reasons: DataFrame, order: Sequence[str], k: int = 3) -> DataFrame:
    """First ``k`` reasons per category in encounter order.

    The rank filter is applied per task before the shuffle, so a hot category moves
    only ``k`` rows per task.
    """
    w = Window.partitionBy("category").orderBy(*order, "reason_pos")
    return reasons.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
