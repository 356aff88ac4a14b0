"""Trace, smoke-test and monitor-signal operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mortarline import dims as D
from mortarline.functions.ranks import exact_quantiles


def is_error(status: str = "status", result_code: str = "result_code") -> Column:
    """4xx/5xx codes or the words error/failed; a blank status falls back to the code."""
    shown = F.coalesce(F.nullif(F.col(status), F.lit("")), F.col(result_code), F.lit(""))
    return shown.rlike("^[45]") | F.lower(shown).isin("error", "failed")


def trace_duration(primary: str = "duration_ms", fallback: str = "duration") -> Column:
    """Duration with zero treated as missing."""
    return F.coalesce(F.nullif(F.col(primary), F.lit(0.0)), F.col(fallback), F.lit(0.0))


def newest_first(traces: DataFrame, now: str, hours: int) -> DataFrame:
    """Traces that started within the last ``hours``; order them only where shown."""
    at = F.lit(now).cast("timestamp_ntz")
    return traces.where(F.col("start_time") >= at - F.expr(f"INTERVAL {int(hours)} HOURS"))


def trace_metrics(traces: DataFrame) -> DataFrame:
    """One row of volume, latency, token and error figures; zeros when there is no trace."""
    rows = traces.select(
        trace_duration().alias("d"),
        is_error().alias("bad"),
        *[
            F.try_element_at("properties", F.lit(k)).try_cast("int").alias(k)
            for k in ("prompt_tokens", "completion_tokens", "total_tokens")
        ],
    )
    totals = rows.agg(
        F.count(F.lit(1)).alias("total_requests"),
        *[
            F.coalesce(F.avg(k), F.lit(0.0)).alias(f"avg_{k}")
            for k in ("prompt_tokens", "completion_tokens", "total_tokens")
        ],
        F.count_if("bad").alias("error_count"),
    )
    lat = exact_quantiles(rows, [], "d", {"p50": 0.5, "p95": 0.95, "p99": 0.99}, method="nearest")
    n = F.col("total_requests")
    zero = F.lit(0.0)
    return totals.join(F.broadcast(lat), F.lit(True), "left").select(
        "total_requests",
        F.coalesce("mean", zero).alias("avg_latency_ms"),
        *[F.coalesce(p, zero).alias(f"{p}_latency_ms") for p in ("p50", "p95", "p99")],
        "avg_prompt_tokens",
        "avg_completion_tokens",
        "avg_total_tokens",
        "error_count",
        F.when(n > 0, F.col("error_count") / n).otherwise(zero).alias("error_rate"),
        (n - F.col("error_count")).alias("success_count"),
    )


def trace_failure_modes(traces: DataFrame, top_n: int = 5) -> DataFrame:
    """Most frequent error messages, first 200 characters, ties by message."""
    props = F.col("properties")
    message = F.coalesce(
        F.nullif(F.try_element_at(props, F.lit("error_message")), F.lit("")),
        F.nullif(F.try_element_at(props, F.lit("error")), F.lit("")),
        F.col("error_message"),
        F.lit("Unknown error"),
    )
    return (
        traces.where(is_error())
        .select(F.substring(message, 1, 200).alias("error"))
        .groupBy("error")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "error")
        .limit(top_n)
    )


def response_fields(body: Column) -> Column:
    """Top-level keys of a JSON response, unwrapping one level of string encoding."""
    unwrapped = F.coalesce(F.get_json_object(F.concat(F.lit('{"v":'), body, F.lit("}")), "$.v"), body)
    return F.json_object_keys(unwrapped)


def smoke_stats(
    calls: DataFrame,
    keys: Sequence[str],
    required: Sequence[str] = ("prediction",),
    min_success: float = D.SMOKE_SUCCESS_RATE,
    max_p95: float = D.SMOKE_P95_SECONDS,
) -> DataFrame:
    """Success rate, mean and nearest-rank p95 per endpoint with a PASS/FAIL verdict."""
    keys = list(keys)
    fields = response_fields(F.col("response"))
    missing = F.array_except(F.array(*[F.lit(r) for r in required]), fields)
    rows = calls.select(*keys, "seconds", F.coalesce(F.size(missing) == 0, F.lit(False)).alias("ok"))
    counts = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), F.count_if("ok").alias("successes")
    )
    lat = exact_quantiles(rows, keys, "seconds", {"p95": 0.95}, method="nearest")
    rate = F.when(F.col("total") > 0, F.col("successes") / F.col("total")).otherwise(0.0)
    p95 = F.coalesce("p95", F.lit(float("inf")))
    joined = counts.join(lat, keys, "left") if keys else counts.join(F.broadcast(lat), F.lit(True), "left")
    return joined.select(
        *keys,
        "total",
        "successes",
        (F.col("total") - F.col("successes")).alias("failures"),
        rate.alias("success_rate"),
        F.coalesce("mean", F.lit(float("inf"))).alias("avg_latency"),
        p95.alias("p95_latency"),
        F.when((rate >= min_success) & (p95 <= max_p95), "PASS").otherwise("FAIL").alias("verdict"),
    )


def monitor_signals(
    calls: DataFrame,
    signals: Mapping[str, tuple[str, float, str]] = D.MONITOR_SIGNALS,
    columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Hourly value of each monitored signal against its limit.

    ``columns`` maps a signal to its input column (defaults to the same name).  p95
    uses exact interpolated percentiles, ``average`` the mean of non-null values.
    """
    columns = columns or {s: s for s in signals}
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")
    long = calls.select(
        hour,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(s).alias("signal"), F.col(columns[s]).cast("double").alias("v"))
                    for s in signals
                ]
            )
        ).alias("s"),
    ).select("hour", "s.signal", "s.v")
    pooled = [s for s, (how, _, _) in signals.items() if how == "p95"]
    means = long.where(~F.col("signal").isin(pooled)).groupBy("hour", "signal").agg(F.avg("v").alias("value"))
    tails = exact_quantiles(long.where(F.col("signal").isin(pooled)), ["hour", "signal"], "v", {"value": 0.95}).select(
        "hour", "signal", "value"
    )
    limit, above = F.lit(None).cast("double"), F.lit(None).cast("boolean")
    for s, (_, bound, direction) in signals.items():
        limit = F.when(F.col("signal") == s, bound).otherwise(limit)
        above = F.when(F.col("signal") == s, direction == "greater_than").otherwise(above)
    return (
        means.unionByName(tails)
        .where(F.col("value").isNotNull())
        .withColumn("threshold", limit)
        .withColumn("alert", F.when(above, F.col("value") > limit).otherwise(F.col("value") < limit))
    )
