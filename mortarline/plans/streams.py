"""Streaming queries; each runs over the events or lineitem file as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline.operators import traces as R
from mortarline.plans.adapters import ADAPTERS, _tables, ctes, table, view
from mortarline.plans.drift import NUMERIC, rounded
from mortarline.plans.registry import check_of, register
from mortarline.plans.telemetry import _BAD, with_dims
from mortarline.session import scratch_path
from mortarline.streaming import monitors as S
from mortarline.streaming.canary import run_canary


def _stream(spark: SparkSession, sf: str, adapter: str) -> DataFrame:
    """Adapter over streaming input."""
    body = ADAPTERS[adapter].replace("\\", "\\\\")
    sources = {t: S.read_files(spark, sf, f"{t}.parquet", table(spark, sf, t).schema) for t in _tables(body)}
    return spark.sql(body, **sources)


def _event_time(df: DataFrame, column: str = "ts") -> DataFrame:
    return df.withColumn("ts", F.col(column).cast("timestamp"))


def _naive(df: DataFrame) -> DataFrame:
    return df.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def _bucket(width: str) -> str:
    return f"time_bucket(INTERVAL {width}, ts, TIMESTAMP '1970-01-01')"


def _rate_sql(width: str, limit: str) -> str:
    return f"""{ctes('requests')}, w AS (SELECT {_bucket(width)} AS window_start, count(*) AS requests, count(*) FILTER (NOT success) AS errors FROM requests GROUP BY 1)
    SELECT *, round(errors / requests, 6) AS error_rate, errors / requests >= {limit} AS alert FROM w"""


@register("stream_error_rate", _rate_sql("5 MINUTES", "5e-2"))
def stream_error_rate(spark: SparkSession, sf: str) -> DataFrame:
    rates = S.error_rate_windows(_event_time(_stream(spark, sf, "requests")))
    return rounded(_naive(S.run_available(rates, ["window_start"])), "error_rate")


@register("stream_error_rate_1m", _rate_sql("1 MINUTE", "1e-1"))
def stream_error_rate_1m(spark: SparkSession, sf: str) -> DataFrame:
    rates = S.error_rate_windows(_event_time(_stream(spark, sf, "requests")), "1 minute", 0.10)
    return rounded(_naive(S.run_available(rates, ["window_start"])), "error_rate")


@register(
    "stream_monitor",
    f"""{ctes('traces')}, c AS (SELECT date_trunc('hour', start_time) AS window_start, duration AS latency, CASE WHEN {_BAD} THEN 1e0 ELSE 0e0 END AS e,
        CAST(total_tokens AS DOUBLE) AS t, CAST(event_id % 101 AS DOUBLE) / 100 AS g FROM traces),
    a AS (SELECT window_start, quantile_disc(latency, 0.95) AS latency, avg(e) AS error_rate, quantile_disc(t, 0.95) AS token_usage, avg(g) AS groundedness FROM c GROUP BY 1)
    SELECT window_start, round(latency, 6) AS latency, round(error_rate, 6) AS error_rate, token_usage, round(groundedness, 6) AS groundedness,
      latency > 5000 AS latency_alert, error_rate > 5e-2 AS error_rate_alert, token_usage > 4000 AS token_usage_alert, groundedness < 7e-1 AS groundedness_alert FROM a""",
)
def stream_monitor(spark: SparkSession, sf: str) -> DataFrame:
    calls = _event_time(_stream(spark, sf, "traces"), "start_time").select(
        "ts",
        F.col("duration").alias("latency"),
        F.when(R.is_error(), 1.0).otherwise(0.0).alias("error_rate"),
        F.col("total_tokens").try_cast("double").alias("token_usage"),
        ((F.col("event_id") % 101).cast("double") / 100).alias("groundedness"),
    )
    out = _naive(S.run_available(S.hourly_signals(calls), ["window_start"]))
    return rounded(out, "latency", "error_rate", "groundedness")


@register(
    "stream_canary",
    f"""{ctes('requests')}, w AS (SELECT {_bucket('5 MINUTES')} AS window_start, deployment, count(*) AS requests, quantile_disc(duration, 0.95) AS p95_ms,
      avg(CASE WHEN success THEN 1e0 ELSE 0e0 END) AS success_rate FROM requests GROUP BY 1, 2)
    SELECT window_start, deployment, requests, round(p95_ms, 6) AS p95_ms, round(success_rate, 6) AS success_rate,
      CASE WHEN p95_ms < 2000 AND success_rate > 99e-2 THEN 'promote' ELSE 'rollback' END AS verdict FROM w""",
)
def stream_canary(spark: SparkSession, sf: str) -> DataFrame:
    health = S.canary_windows(_event_time(_stream(spark, sf, "requests")))
    return rounded(_naive(S.run_available(health, ["window_start", "deployment"])), "p95_ms", "success_rate")


@register(
    "stream_rollout",
    f"""{ctes('requests')}, w AS (SELECT {_bucket('5 MINUTES')} AS s, deployment, coalesce(quantile_disc(duration, 0.95) < 2000
        AND avg(CASE WHEN success THEN 1e0 ELSE 0e0 END) > 99e-2, false) AS healthy FROM requests GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY deployment ORDER BY s) AS i FROM w),
    f AS (SELECT deployment, coalesce(min(i) FILTER (NOT healthy), 4) AS bad FROM r GROUP BY 1)
    SELECT r.deployment, CASE WHEN bad <= 3 THEN 'rollback' ELSE 'promote' END AS verdict,
      CASE WHEN bad <= 3 THEN 'bad window' ELSE 'healthy windows' END AS reason, s + INTERVAL 5 MINUTES AS decided_at, i AS windows
    FROM r JOIN f ON r.deployment = f.deployment AND i = least(bad, 3)""",
)
def stream_rollout(spark: SparkSession, sf: str) -> DataFrame:
    verdicts = run_canary(_event_time(_stream(spark, sf, "requests")), scratch_path(spark, "rollout"), needed=3)
    return verdicts.withColumn("decided_at", F.col("decided_at").cast("timestamp_ntz"))


@register(
    "stream_daily_latency",
    f"""{ctes('requests')} SELECT date_trunc('day', ts) AS window_start, prompt_version, count(*) AS request_count, round(avg(duration), 6) AS avg_duration_ms,
      round(quantile_disc(duration, 0.5), 6) AS p50_duration_ms, round(quantile_disc(duration, 0.95), 6) AS p95_duration_ms,
      round(quantile_disc(duration, 0.99), 6) AS p99_duration_ms FROM requests
    WHERE (lower(name) LIKE 'generate_spec%' OR lower(name) LIKE 'rag_pipeline%') AND coalesce(prompt_version, '') <> '' GROUP BY 1, 2""",
)
def stream_daily_latency(spark: SparkSession, sf: str) -> DataFrame:
    requests = with_dims(_event_time(_stream(spark, sf, "requests")), "prompt_version")
    daily = S.daily_latency(requests, ["generate_spec", "rag_pipeline"])
    out = _naive(S.run_available(daily, ["window_start", "prompt_version"]))
    return rounded(out, "avg_duration_ms", "p50_duration_ms", "p95_duration_ms", "p99_duration_ms")


@register(
    "stream_daily_pass_rate",
    f"""{ctes('quality_metrics')}, g(metric, gate) AS (VALUES ('groundedness', 7e-1), ('relevance', 75e-2), ('coherence', 8e-1), ('fluency', 85e-2), ('buildability', 7e-1))
    SELECT date_trunc('day', ts) AS window_start, metric, coalesce(prompt_version, '') AS prompt_version, count(*) AS total_evals,
      count(*) FILTER (value >= gate) AS passed_count, round(100e0 * count(*) FILTER (value >= gate) / count(*), 1) AS pass_rate, round(avg(value), 3) AS avg_score
    FROM quality_metrics JOIN g ON name = metric GROUP BY 1, 2, 3""",
)
def stream_daily_pass_rate(spark: SparkSession, sf: str) -> DataFrame:
    daily = S.daily_pass_rate(with_dims(_event_time(_stream(spark, sf, "quality_metrics")), "prompt_version"))
    return _naive(S.run_available(daily, ["window_start", "metric", "prompt_version"]))


@register(
    "stream_daily_errors",
    f"""{ctes('requests', 'exceptions')}, t AS (SELECT date_trunc('day', ts) AS d, count(*) AS total FROM requests GROUP BY 1),
    e AS (SELECT date_trunc('day', ts) AS window_start, coalesce(nullif(type, ''), 'UnknownError') AS error_type, coalesce(prompt_version, '') AS prompt_version,
      count(*) AS error_count FROM exceptions GROUP BY 1, 2, 3)
    SELECT e.*, coalesce(total, 0) AS total_requests, round(100e0 * error_count / coalesce(total, 1), 2) AS error_rate_pct FROM e LEFT JOIN t ON d = window_start""",
)
def stream_daily_errors(spark: SparkSession, sf: str) -> DataFrame:
    daily = S.daily_errors(with_dims(_event_time(_stream(spark, sf, "exceptions")), "prompt_version"))
    errors = S.run_available(daily, ["window_start", "error_type", "prompt_version"])
    totals = S.run_available(S.daily_totals(_event_time(_stream(spark, sf, "requests"))), ["window_start"])
    return _naive(S.error_rates(errors, totals))


@register(
    "stream_daily_tokens",
    f"""{ctes('token_metrics')}, s AS (SELECT date_trunc('day', ts) AS window_start, coalesce(prompt_version, '') AS prompt_version, model_version,
      coalesce(sum(value) FILTER (name = 'input_tokens'), 0) AS input_tokens, coalesce(sum(value) FILTER (name = 'output_tokens'), 0) AS output_tokens,
      round(coalesce(sum(value) FILTER (name = 'estimated_cost_usd'), 0), 6) AS estimated_cost_usd FROM token_metrics WHERE name <> 'queue_depth' GROUP BY 1, 2, 3)
    SELECT *, input_tokens + output_tokens AS total_tokens FROM s""",
)
def stream_daily_tokens(spark: SparkSession, sf: str) -> DataFrame:
    daily = S.daily_tokens(with_dims(_event_time(_stream(spark, sf, "token_metrics")), "prompt_version", "model_version"))
    return rounded(_naive(S.run_available(daily, ["window_start", "prompt_version", "model_version"])), "estimated_cost_usd")


@register("stream_dedup", "SELECT event_id, event_type, value FROM events")
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    events = S.read_files(spark, sf, "events.parquet", table(spark, sf, "events").schema)
    twice = _event_time(events).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2))))
    unique = S.drop_repeats(twice)
    return S.run_available(unique.select("event_id", "event_type", "value"), mode="append")


_FILES = 3


@register(
    "stream_late",
    f"""WITH f AS (SELECT event_id % {_FILES} AS b, event_type, ts FROM events), m AS (SELECT b, max(ts) AS newest FROM f GROUP BY 1),
    l AS (SELECT f.*, (SELECT max(newest) FROM m WHERE m.b < f.b) - INTERVAL 7 DAYS AS least FROM f)
    SELECT date_trunc('day', ts) AS window_start, event_type, count(*) FILTER (coalesce(ts >= least, true)) AS kept,
      count(*) FILTER (ts < least) AS late, count(*) AS corrected FROM l GROUP BY 1, 2""",
)
def stream_late(spark: SparkSession, sf: str) -> DataFrame:
    """Events that arrive in three files, each over the whole time, of which a week back is in time."""
    home = scratch_path(spark, "late")
    events = table(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    for part in range(_FILES):
        # one after the other, as a stream takes files by their age
        events.where(F.col("event_id") % _FILES == part).coalesce(1).write.mode("append").parquet(f"{home}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{home}/in")
    windows, _ = S.count_with_late(stream, home, width="1 day", lateness="7 days", keys=["event_type"])
    return _naive(windows)


@register("stream_drift", check_of("weekly_drift"))
def stream_drift(spark: SparkSession, sf: str) -> DataFrame:
    lines = S.read_files(spark, sf, "lineitem.parquet", table(spark, sf, "lineitem").schema)
    captured = lines.select(
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
    )
    # one file may hold its rows in any order, so none counts as late here
    out = S.drift_stream(captured, view(spark, sf, "features_base"), NUMERIC, width="7 days", late="100 years")
    return rounded(out, "psi", "js_divergence").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
