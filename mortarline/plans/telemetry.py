"""Telemetry, trace and monitoring queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline.operators import telemetry as T
from mortarline.operators import traces as R
from mortarline.plans.adapters import NOW, ctes, view
from mortarline.plans.registry import register


def with_dims(df: DataFrame, *keys: str) -> DataFrame:
    bag = F.create_map(*[x for k in keys for x in (F.lit(k), F.col(k))])
    return df.withColumn("dims", bag).drop(*keys)


_SINCE = f"ts > TIMESTAMP '{NOW}' - INTERVAL 30 DAYS"


@register(
    "error_rate_trend",
    f"""{ctes('requests', 'exceptions')},
    totals AS (SELECT date_trunc('day', ts) AS day, count(*) AS total FROM requests WHERE {_SINCE} GROUP BY 1),
    errs AS (SELECT date_trunc('day', ts) AS day, coalesce(nullif(type, ''), 'UnknownError') AS error_type,
        coalesce(prompt_version, '') AS prompt_version, count(*) AS error_count
      FROM exceptions WHERE {_SINCE} GROUP BY 1, 2, 3)
    SELECT e.day, error_type, prompt_version, error_count, coalesce(total, 0) AS total_requests,
      round(100e0 * error_count / coalesce(total, 1), 2) AS error_rate_pct
    FROM errs e LEFT JOIN totals t ON e.day = t.day""",
)
def error_rate_trend(spark: SparkSession, sf: str) -> DataFrame:
    return T.error_rate_by_day(
        with_dims(view(spark, sf, "requests"), "prompt_version"),
        with_dims(view(spark, sf, "exceptions"), "prompt_version"),
        NOW,
    )


@register(
    "latency_by_prompt",
    f"""{ctes('requests')}
    SELECT date_trunc('day', ts) AS day, prompt_version, round(avg(duration), 1) AS avg_duration_ms,
      round(quantile_cont(duration, 0.5), 1) AS p50_duration_ms, round(quantile_cont(duration, 0.95), 1) AS p95_duration_ms,
      round(quantile_cont(duration, 0.99), 1) AS p99_duration_ms, count(*) AS request_count
    FROM requests
    WHERE {_SINCE} AND (lower(name) LIKE 'generate_spec%' OR lower(name) LIKE 'rag_pipeline%')
      AND coalesce(prompt_version, '') <> ''
    GROUP BY 1, 2""",
)
def latency_by_prompt(spark: SparkSession, sf: str) -> DataFrame:
    requests = with_dims(view(spark, sf, "requests"), "prompt_version")
    return T.latency_by_version(requests, ["generate_spec", "rag_pipeline"], NOW)


@register(
    "quality_pass_rate",
    f"""{ctes('quality_metrics')}, gates(metric, gate) AS (VALUES ('groundedness', 7e-1), ('relevance', 75e-2),
      ('coherence', 8e-1), ('fluency', 85e-2), ('buildability', 7e-1)),
    rows_ AS (SELECT date_trunc('day', ts) AS day, metric, coalesce(prompt_version, '') AS prompt_version, value,
        CASE WHEN value >= gate THEN 1 ELSE 0 END AS passed
      FROM quality_metrics JOIN gates ON name = metric WHERE {_SINCE})
    SELECT day, metric, prompt_version, round(100e0 * sum(passed) / count(*), 1) AS pass_rate,
      round(avg(value), 3) AS avg_score, CAST(sum(passed) AS BIGINT) AS passed_count, count(*) AS total_evals
    FROM rows_ GROUP BY 1, 2, 3""",
)
def quality_pass_rate(spark: SparkSession, sf: str) -> DataFrame:
    return T.quality_pass_rate(with_dims(view(spark, sf, "quality_metrics"), "prompt_version"), now=NOW)


@register(
    "token_cost_by_day",
    f"""{ctes('token_metrics')},
    sums AS (SELECT date_trunc('day', ts) AS day, coalesce(prompt_version, '') AS prompt_version, model_version,
        coalesce(sum(value) FILTER (name = 'input_tokens'), 0) AS i,
        coalesce(sum(value) FILTER (name = 'output_tokens'), 0) AS o,
        coalesce(sum(value) FILTER (name = 'estimated_cost_usd'), 0) AS c
      FROM token_metrics
      WHERE {_SINCE} AND name IN ('input_tokens', 'output_tokens', 'estimated_cost_usd') GROUP BY 1, 2, 3)
    SELECT day, prompt_version, model_version, i AS input_tokens, o AS output_tokens, i + o AS total_tokens,
      round(c, 4) AS estimated_cost_usd FROM sums""",
)
def token_cost_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return T.token_cost_by_day(with_dims(view(spark, sf, "token_metrics"), "prompt_version", "model_version"), NOW)


@register(
    "top_failure_modes",
    f"""{ctes('failure_metrics')},
    rows_ AS (SELECT coalesce(nullif(failure_category, ''), nullif(failure_reason, ''), 'unspecified') AS failure_category,
        coalesce(prompt_version, '') AS version, ts
      FROM failure_metrics WHERE {_SINCE} AND name IN ('drift_alert', 'evaluation_failure')
        AND (coalesce(failure_reason, '') <> '' OR coalesce(failure_category, '') <> ''))
    SELECT row_number() OVER (ORDER BY count(*) DESC, failure_category) AS rank, failure_category,
      count(*) AS occurrence_count, max(ts) AS last_seen,
      array_to_string(list_sort(list(DISTINCT version)), ',') AS affected_prompt_versions
    FROM rows_ GROUP BY failure_category ORDER BY occurrence_count DESC, failure_category LIMIT 10""",
)
def top_failure_modes(spark: SparkSession, sf: str) -> DataFrame:
    bag = ("failure_category", "failure_reason", "prompt_version")
    return T.top_failure_modes(with_dims(view(spark, sf, "failure_metrics"), *bag), now=NOW)


@register(
    "telemetry_stamped",
    f"""{ctes('token_metrics')}
    SELECT event_id, name, value, coalesce(prompt_version, 'unknown') AS prompt_version, model_version,
      'unknown' AS trace_id, 'spec-service' AS service
    FROM token_metrics""",
)
def telemetry_stamped(spark: SparkSession, sf: str) -> DataFrame:
    raw = with_dims(view(spark, sf, "token_metrics"), "prompt_version", "model_version")
    raw = raw.withColumn("dims", F.map_filter("dims", lambda _, v: v.isNotNull()))
    base = {"prompt_version": None, "model_version": None, "trace_id": None, "service": "spec-service"}
    out = T.stamp_dimensions(raw, base)
    keys = ["prompt_version", "model_version", "trace_id", "service"]
    return out.select("event_id", "name", "value", *[F.col("dims")[k].alias(k) for k in keys])


def _traces(spark: SparkSession, sf: str) -> DataFrame:
    t = view(spark, sf, "traces")
    tokens = ["prompt_tokens", "completion_tokens", "total_tokens"]
    bag = F.create_map(
        *[x for k in tokens for x in (F.lit(k), F.col(k))],
        F.lit("error_message"), F.col("prop_error_message"), F.lit("error"), F.col("prop_error"),
    )
    return t.withColumn("properties", bag)


_BAD = """(regexp_matches(coalesce(nullif(status, ''), result_code, ''), '^[45]')
      OR lower(coalesce(nullif(status, ''), result_code, '')) IN ('error', 'failed'))"""


@register(
    "trace_metrics",
    f"""{ctes('traces')},
    r AS (SELECT coalesce(nullif(duration_ms, 0), duration, 0) AS d, {_BAD} AS bad, CAST(prompt_tokens AS INT) AS pt,
        CAST(completion_tokens AS INT) AS ct, CAST(total_tokens AS INT) AS tt FROM traces),
    o AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS i, count(*) OVER () AS n FROM r)
    SELECT (SELECT count(*) FROM r) AS total_requests, round((SELECT avg(d) FROM r), 6) AS avg_latency_ms,
      (SELECT max(d) FROM o WHERE i = least(n * 50 // 100, n - 1)) AS p50_latency_ms,
      (SELECT max(d) FROM o WHERE i = least(n * 95 // 100, n - 1)) AS p95_latency_ms,
      (SELECT max(d) FROM o WHERE i = least(n * 99 // 100, n - 1)) AS p99_latency_ms,
      round((SELECT avg(pt) FROM r), 6) AS avg_prompt_tokens, round((SELECT avg(ct) FROM r), 6) AS avg_completion_tokens,
      round((SELECT avg(tt) FROM r), 6) AS avg_total_tokens, (SELECT count(*) FROM r WHERE bad) AS error_count,
      round((SELECT count(*) FILTER (bad) / count(*) FROM r), 6) AS error_rate,
      (SELECT count(*) FROM r WHERE NOT bad) AS success_count""",
)
def trace_metrics(spark: SparkSession, sf: str) -> DataFrame:
    out = R.trace_metrics(_traces(spark, sf))
    soft = ["avg_latency_ms", "avg_prompt_tokens", "avg_completion_tokens", "avg_total_tokens", "error_rate"]
    return out.select(*[F.round(c, 6).alias(c) if c in soft else F.col(c) for c in out.columns])


@register(
    "trace_recent",
    f"""{ctes('traces')}
    SELECT event_id, start_time, coalesce(nullif(duration_ms, 0), duration, 0) AS shown_duration, {_BAD} AS is_error
    FROM traces WHERE start_time >= TIMESTAMP '{NOW}' - INTERVAL 240 HOURS""",
)
def trace_recent(spark: SparkSession, sf: str) -> DataFrame:
    recent = R.newest_first(_traces(spark, sf), NOW, 240)
    return recent.select(
        "event_id", "start_time", R.trace_duration().alias("shown_duration"), R.is_error().alias("is_error")
    )


@register(
    "trace_failure_modes",
    f"""{ctes('traces')},
    m AS (SELECT substring(coalesce(nullif(prop_error_message, ''), nullif(prop_error, ''), error_message,
        'Unknown error'), 1, 200) AS error FROM traces WHERE {_BAD})
    SELECT error, count(*) AS count FROM m GROUP BY error ORDER BY count(*) DESC, error LIMIT 5""",
)
def trace_failure_modes(spark: SparkSession, sf: str) -> DataFrame:
    return R.trace_failure_modes(_traces(spark, sf))


@register(
    "smoke_stats",
    f"""{ctes('smoke')},
    r AS (SELECT endpoint, seconds, coalesce(response IS NOT NULL AND response LIKE '%prediction%', false) AS ok FROM smoke),
    o AS (SELECT endpoint, seconds, row_number() OVER (PARTITION BY endpoint ORDER BY seconds) - 1 AS i,
        count(*) OVER (PARTITION BY endpoint) AS n FROM r),
    p AS (SELECT endpoint, max(seconds) AS p95 FROM o WHERE i = least(n * 95 // 100, n - 1) GROUP BY 1),
    s AS (SELECT endpoint, count(*) AS total, count(*) FILTER (ok) AS good, avg(seconds) AS m FROM r GROUP BY 1)
    SELECT s.endpoint, total, good AS successes, total - good AS failures, round(good / total, 6) AS success_rate,
      round(m, 6) AS avg_latency, p95 AS p95_latency,
      CASE WHEN good / total >= 99e-2 AND p95 <= 2 THEN 'PASS' ELSE 'FAIL' END AS verdict
    FROM s JOIN p ON s.endpoint = p.endpoint""",
)
def smoke_stats(spark: SparkSession, sf: str) -> DataFrame:
    out = R.smoke_stats(view(spark, sf, "smoke"), ["endpoint"])
    return out.withColumns({c: F.round(c, 6) for c in ("success_rate", "avg_latency")})


@register(
    "response_schema_check",
    f"""{ctes('smoke')}
    SELECT event_id, coalesce(response LIKE '%prediction%', false) AS has_required FROM smoke""",
)
def response_schema_check(spark: SparkSession, sf: str) -> DataFrame:
    fields = R.response_fields(F.col("response"))
    return view(spark, sf, "smoke").select(
        "event_id", F.coalesce(F.array_contains(fields, "prediction"), F.lit(False)).alias("has_required")
    )


@register(
    "monitor_signals_hourly",
    f"""{ctes('traces')},
    c AS (SELECT date_trunc('hour', start_time) AS hour, duration AS latency, CASE WHEN {_BAD} THEN 1e0 ELSE 0e0 END AS e,
        CAST(total_tokens AS DOUBLE) AS t, CAST(event_id % 101 AS DOUBLE) / 100 AS g FROM traces),
    v AS (
      SELECT hour, 'latency' AS signal, quantile_cont(latency, 0.95) AS value, 5000e0 AS threshold FROM c GROUP BY 1
      UNION ALL SELECT hour, 'error_rate', avg(e), 5e-2 FROM c GROUP BY 1
      UNION ALL SELECT hour, 'token_usage', quantile_cont(t, 0.95), 4000e0 FROM c GROUP BY 1
      UNION ALL SELECT hour, 'groundedness', avg(g), 7e-1 FROM c GROUP BY 1)
    SELECT hour, signal, round(value, 6) AS value, threshold,
      CASE WHEN signal = 'groundedness' THEN value < threshold ELSE value > threshold END AS alert
    FROM v WHERE value IS NOT NULL""",
)
def monitor_signals_hourly(spark: SparkSession, sf: str) -> DataFrame:
    calls = view(spark, sf, "traces").select(
        F.col("start_time").alias("ts"),
        F.col("duration").alias("latency"),
        F.when(R.is_error(), 1.0).otherwise(0.0).alias("error_rate"),
        F.col("total_tokens").try_cast("double").alias("token_usage"),
        ((F.col("event_id") % 101).cast("double") / 100).alias("groundedness"),
    )
    return R.monitor_signals(calls).withColumn("value", F.round("value", 6))
