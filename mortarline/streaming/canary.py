"""Canary rollouts as a state machine over a request stream.

Requests are counted per deployment and window; once the watermark closes a window, its health goes to the deployment's
state.  So many healthy windows in a row promote the canary, one bad window rolls it back, and a deployment that falls silent
is rolled back by a timer on event time.  Each deployment gets its verdict once; what comes after is ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The state store that timers and several state variables need.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
VERDICT = "deployment string, verdict string, reason string, decided_at timestamp, windows long"


def window_health(
    requests: DataFrame, width: str = "5 minutes", lateness: str = "10 minutes", max_p95: float = 2000.0, min_success: float = 0.99, accuracy: int = 10000
) -> DataFrame:
    """Rows (deployment, at, closes, healthy) of closed windows; ``at`` is the event time of a window."""
    marked = requests.withWatermark("ts", lateness).groupBy(F.window("ts", width), "deployment")
    counts = marked.agg(F.percentile_approx("duration", 0.95, accuracy).alias("p95"), F.avg(F.col("success").cast("double")).alias("rate"))
    healthy = F.coalesce((F.col("p95") < max_p95) & (F.col("rate") > min_success), F.lit(False))
    return counts.select("deployment", F.window_time("window").alias("at"), F.col("window.end").alias("closes"), healthy.alias("healthy"))


class Rollout(StatefulProcessor):
    """State of one deployment: healthy windows in a row, windows seen, newest window, whether it is decided."""

    def __init__(self, needed: int, patience_ms: int):
        self.needed, self.patience = needed, patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("rollout", "streak long, seen long, newest long, decided boolean")

    def _verdict(self, key, verdict: str, reason: str, at_ms: int, seen: int) -> pd.DataFrame:
        return pd.DataFrame({
            "deployment": [key[0]], "verdict": [verdict], "reason": [reason], "decided_at": [pd.Timestamp(at_ms, unit="ms")], "windows": [seen],
        })

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        streak, seen, newest, decided = self.state.get() if self.state.exists() else (0, 0, 0, False)
        if not decided:
            windows = pd.concat(list(rows)).sort_values("closes")
            for closes, healthy in zip(windows["closes"], windows["healthy"], strict=True):
                at = int(closes.timestamp() * 1000)
                seen, newest, streak = seen + 1, max(newest, at), streak + 1 if healthy else 0
                if not healthy or streak >= self.needed:
                    decided = True
                    yield self._verdict(key, "promote" if healthy else "rollback", "healthy windows" if healthy else "bad window", at, seen)
                    break
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if not decided:
                self.handle.registerTimer(newest + self.patience)
            self.state.update((streak, seen, newest, decided))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        streak, seen, newest, decided = self.state.get()
        if not decided:
            self.state.update((streak, seen, newest, True))
            yield self._verdict(key, "rollback", "silent", newest + self.patience, seen)

    def close(self) -> None:
        pass


def canary_verdicts(health: DataFrame, needed: int = 3, patience_minutes: int = 30) -> DataFrame:
    """Verdict rows (deployment, verdict, reason, decided_at, windows) of a health stream, one per deployment, in append mode."""
    return health.groupBy("deployment").transformWithStateInPandas(
        Rollout(needed, patience_minutes * 60_000), outputStructType=VERDICT, outputMode="Append", timeMode="EventTime"
    )


def run_canary(requests: DataFrame, home: str, needed: int = 3, patience_minutes: int = 30, **health) -> DataFrame:
    """All verdicts so far, after what is available has been processed; with the same ``home`` the stream goes on where it stopped."""
    spark = requests.sparkSession
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    try:
        verdicts = canary_verdicts(window_health(requests, **health), needed, patience_minutes)
        query = (
            verdicts.writeStream.outputMode("append").option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True)
            .foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(f"{home}/verdicts/batch={number}"))
            .start()
        )
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return spark.read.schema(VERDICT).option("ignoreMissingFiles", True).parquet(f"{home}/verdicts").drop("batch")
