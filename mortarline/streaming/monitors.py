"""Streaming monitors over telemetry with event time ``ts``.

Every function takes a streaming (or batch) DataFrame and returns the windowed
aggregate; ``run_available`` drives one to a table.  State is bounded by the watermark:
a window's counters, or an event id, leave the state store once they are too old.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mortarline import dims as D
from mortarline.operators import drift as X
from mortarline.operators.telemetry import dimension, not_empty, starts_with_any
from mortarline.operators.rollout import canary_verdict
from mortarline.session import scratch_path

LATENESS = "10 minutes"


def read_files(spark: SparkSession, folder: str, name: str, schema: StructType) -> DataFrame:
    """File stream over the parquet files of ``folder`` that match ``name``."""
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def _windowed(df: DataFrame, width: str, *keys: str | Column, lateness: str = LATENESS):
    marked = df.withWatermark("ts", lateness) if df.isStreaming else df
    return marked.groupBy(F.window("ts", width), *keys)


def _start() -> Column:
    return F.col("window.start").alias("window_start")


def error_rate_windows(requests: DataFrame, width: str = "5 minutes", limit: float = 0.05) -> DataFrame:
    """Error share per window; ``alert`` once it reaches the limit."""
    counts = _windowed(requests, width).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(~F.col("success")).alias("errors")
    )
    rate = F.col("errors") / F.col("requests")
    return counts.select(_start(), "requests", "errors", rate.alias("error_rate"), (rate >= limit).alias("alert"))


def hourly_signals(calls: DataFrame, accuracy: int = 10000) -> DataFrame:
    """The four monitor signals per hour in one row; percentiles are approximate, state stays small."""
    out = _windowed(calls, "1 hour").agg(
        F.percentile_approx("latency", 0.95, accuracy).alias("latency"),
        F.avg("error_rate").alias("error_rate"),
        F.percentile_approx("token_usage", 0.95, accuracy).alias("token_usage"),
        F.avg("groundedness").alias("groundedness"),
    )
    alerts = []
    for signal, (_, limit, direction) in D.MONITOR_SIGNALS.items():
        c = F.col(signal)
        alerts.append((c > limit if direction == "greater_than" else c < limit).alias(f"{signal}_alert"))
    return out.select(_start(), *D.MONITOR_SIGNALS, *alerts)


def canary_windows(requests: DataFrame, width: str = "5 minutes", accuracy: int = 10000) -> DataFrame:
    """Health of each deployment per window with a promote/rollback verdict."""
    out = _windowed(requests, width, "deployment").agg(
        F.count(F.lit(1)).alias("requests"),
        F.percentile_approx("duration", 0.95, accuracy).alias("p95_ms"),
        F.avg(F.col("success").cast("double")).alias("success_rate"),
    )
    return canary_verdict(out.select(_start(), "deployment", "requests", "p95_ms", "success_rate"))


def daily_latency(requests: DataFrame, prefixes: Sequence[str], accuracy: int = 10000) -> DataFrame:
    """Incremental form of the latency dashboard; percentiles are approximate, with a rank error of a row in ``accuracy``."""
    rows = requests.where(starts_with_any(F.col("name"), prefixes)).where(not_empty(dimension("prompt_version")))
    rows = rows.withColumn("prompt_version", dimension("prompt_version"))
    return (
        _windowed(rows, "1 day", "prompt_version")
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            F.avg("duration").alias("avg_duration_ms"),
            F.percentile_approx("duration", [0.5, 0.95, 0.99], accuracy).alias("p"),
        )
        .select(
            _start(), "prompt_version", "request_count", "avg_duration_ms",
            *[F.element_at("p", i + 1).alias(f"p{n}_duration_ms") for i, n in enumerate((50, 95, 99))],
        )
    )


def daily_pass_rate(metrics: DataFrame, gates: Mapping[str, float] = D.DASHBOARD_GATES) -> DataFrame:
    """Incremental form of the quality dashboard: evaluations, passes, their rate and the mean per metric, version and day."""
    passed = F.lit(False)
    for name, gate in gates.items():
        passed = passed | ((F.col("name") == name) & (F.col("value") >= gate))
    return (
        _windowed(metrics.where(F.col("name").isin(list(gates))), "1 day", "name", dimension("prompt_version").alias("prompt_version"))
        .agg(F.count(F.lit(1)).alias("total_evals"), F.count_if(passed).alias("passed_count"), F.avg("value").alias("avg_score"))
        .select(
            _start(), F.col("name").alias("metric"), "prompt_version", "total_evals", "passed_count",
            F.round(F.lit(100.0) * F.col("passed_count") / F.col("total_evals"), 1).alias("pass_rate"), F.round("avg_score", 3).alias("avg_score"),
        )
    )


def daily_errors(exceptions: DataFrame) -> DataFrame:
    """Incremental form of the error dashboard: errors per type, version and day; ``error_rates`` sets them against ``daily_totals``."""
    kind = F.coalesce(F.when(F.col("type") != "", F.col("type")), F.lit("UnknownError"))
    return (
        _windowed(exceptions.withColumn("error_type", kind), "1 day", "error_type", dimension("prompt_version").alias("prompt_version"))
        .agg(F.count(F.lit(1)).alias("error_count"))
        .select(_start(), "error_type", "prompt_version", "error_count")
    )


def daily_totals(requests: DataFrame) -> DataFrame:
    """Requests per day, the other side of the error dashboard."""
    return _windowed(requests, "1 day").agg(F.count(F.lit(1)).alias("total_requests")).select(_start(), "total_requests")


def error_rates(errors: DataFrame, totals: DataFrame) -> DataFrame:
    """The error dashboard from the current tables of its two streams; days without requests count one."""
    total = F.coalesce("total_requests", F.lit(1))
    return errors.join(totals, "window_start", "left").select(
        "window_start", "error_type", "prompt_version", "error_count", F.coalesce("total_requests", F.lit(0)).alias("total_requests"),
        F.round(F.lit(100.0) * F.col("error_count") / total, 2).alias("error_rate_pct"),
    )


def daily_tokens(metrics: DataFrame) -> DataFrame:
    """Incremental form of the token dashboard, per prompt and model version."""
    names = ["input_tokens", "output_tokens", "estimated_cost_usd"]
    return (
        _windowed(metrics.where(F.col("name").isin(names)), "1 day", *[dimension(k).alias(k) for k in ("prompt_version", "model_version")])
        .agg(*[F.coalesce(F.sum(F.when(F.col("name") == n, F.col("value"))), F.lit(0.0)).alias(n) for n in names])
        .select(_start(), "prompt_version", "model_version", *names, (F.col(names[0]) + F.col(names[1])).alias("total_tokens"))
    )


def drop_repeats(events: DataFrame, key: str = "event_id", lateness: str = LATENESS) -> DataFrame:
    """First delivery of every event; ids are remembered for the lateness only."""
    if not events.isStreaming:
        return events.dropDuplicates([key])
    return events.withWatermark("ts", lateness).dropDuplicatesWithinWatermark([key])


def run_available(
    df: DataFrame,
    keys: Sequence[str] = (),
    mode: str = "update",
    each: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Process everything available now and return the resulting table.

    Each micro-batch overwrites its own folder, so a batch repeated after a failure
    leaves no double rows.  With ``keys`` the newest batch wins per key, which turns
    update output into the current state.
    """
    spark = df.sparkSession
    home = scratch_path(spark, "stream")

    def write(batch: DataFrame, batch_id: int) -> None:
        out = each(batch) if each else batch
        out.write.mode("overwrite").parquet(f"{home}/data/batch={batch_id}")

    query = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{home}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    written = spark.read.parquet(f"{home}/data")
    if not keys:
        return written.drop("batch")
    rest = [c for c in written.columns if c not in (*keys, "batch")]
    return written.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*keys, "r.*")


def drift_stream(
    captured: DataFrame, base: DataFrame, features: Sequence[str], width: str = "1 week", late: str = "1 day"
) -> DataFrame:
    """Scheduled drift check of a capture stream, window by window.

    The counts per (window, feature, bin) are the stream's state, so a window that arrives in
    several micro-batches is compared as a whole.  Rows later than ``late`` after the newest are dropped.
    """
    edges, reference = X.baseline_bins(base, features)
    counts = X.window_counts(captured.withWatermark("ts", late), edges, features, width=width)
    return X.counts_drift(run_available(counts, ["window_start", "feature", "bin"]), reference)


def count_with_late(
    events: DataFrame, home: str, width: str = "1 day", lateness: str = LATENESS, keys: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(windows, late rows) of a stream whose late rows are kept aside instead of vanishing.

    A row is late if its ``ts`` is more than ``lateness`` before the newest of all earlier micro-batches, which is what a watermark
    drops.  Every micro-batch writes, below ``home`` in a folder of its own that a repeated batch overwrites, the counts of
    its timely rows per window and ``keys``, its late rows, and its newest ``ts``.  The windows are (window_start, keys, kept, late, corrected):
    what the stream counted in time, what came late, and the sum, which a correction pass may publish.  Called again with the same
    ``home``, the stream goes on where it stopped.  Rows without ``ts`` belong to no window and are late.
    """
    spark = events.sparkSession
    rows = StructType(events.schema.fields)
    groups = [F.window("ts", width).getField("start").alias("window_start"), *keys]
    counted = StructType.fromDDL(", ".join(["window_start timestamp", *[f"`{k}` {rows[k].dataType.simpleString()}" for k in keys], "n bigint", "batch bigint"]))

    def stored(name: str, schema: StructType) -> DataFrame:
        return spark.read.schema(schema).option("ignoreMissingFiles", True).parquet(f"{home}/{name}")

    seen_schema = StructType.fromDDL("newest timestamp, batch bigint")

    def write(batch: DataFrame, batch_id: int) -> None:
        put = lambda df, name: df.write.mode("overwrite").parquet(f"{home}/{name}/batch={batch_id}")
        newest = stored("seen", seen_schema).where(F.col("batch") < batch_id).agg(F.max("newest")).first()[0] if batch_id else None
        limit = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {lateness}")
        late = F.col("ts").isNull() | F.coalesce(F.col("ts") < limit, F.lit(False))
        put(batch.where(late), "late")
        put(batch.where(~late).groupBy(*groups).agg(F.count(F.lit(1)).alias("n")), "kept")
        # written last: a batch that failed before has told later ones nothing
        put(batch.agg(F.max("ts").alias("newest")), "seen")

    query = (
        events.writeStream.option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True).foreachBatch(write).start()
    )
    query.awaitTermination()
    late = stored("late", StructType([*rows.fields, *StructType.fromDDL("batch bigint").fields]))
    names = ["window_start", *keys]
    kept = stored("kept", counted).select(*names, F.col("n").alias("kept"), F.lit(0).cast("long").alias("late"))
    missed = late.where("ts IS NOT NULL").groupBy(*groups).agg(F.count(F.lit(1)).alias("late"))
    both = kept.unionByName(missed.select(*names, F.lit(0).cast("long").alias("kept"), "late"))
    windows = both.groupBy(*names).agg(F.sum("kept").alias("kept"), F.sum("late").alias("late"))
    return windows.withColumn("corrected", F.col("kept") + F.col("late")), late
