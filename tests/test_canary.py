"""Canary state machine over several micro-batches and a restart."""

import datetime as dt

from mortarline.session import scratch_path
from mortarline.streaming.canary import run_canary


def test_verdicts_once_over_micro_batches_and_a_restart(spark):
    home = scratch_path(spark, "canary-test")
    schema = "deployment string, ts timestamp, duration double, success boolean"

    def put(*rows):
        made = [(d, dt.datetime(2024, 1, 1, 0, m), ms, ok) for d, m, ms, ok in rows]
        spark.createDataFrame(made, schema).coalesce(1).write.mode("append").parquet(f"{home}/in")

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{home}/in")
        found = run_canary(stream, home, needed=3, patience_minutes=20, lateness="1 minute").collect()
        return {r["deployment"]: (r["verdict"], r["reason"], r["windows"]) for r in found}, len(found)

    good, slow, failed = (100.0, True), (5000.0, True), (100.0, False)
    put(("a", 1, *good), ("b", 1, *good), ("c", 1, *good), ("d", 2, *good))
    put(("a", 6, *good), ("b", 6, *slow), ("c", 6, *good))
    first, _ = run()
    assert "a" not in first and "c" not in first
    put(("a", 11, *good), ("b", 11, *good), ("c", 11, *failed), ("e", 12, *good))
    put(("e", 17, *good), ("a", 17, *slow))
    put(("e", 22, *good))
    put(("z", 59, *good))
    second, n = run()
    assert second["a"] == ("promote", "healthy windows", 3)
    assert second["b"] == ("rollback", "bad window", 2)
    assert second["c"] == ("rollback", "bad window", 3)
    assert second["e"] == ("promote", "healthy windows", 3)
    assert second["d"] == ("rollback", "silent", 1)
    again, m = run()
    assert again == second and n == m == 5
