"""Late rows of a stream over two triggers."""

import datetime as dt

from mortarline.session import scratch_path
from mortarline.streaming import monitors as S


def test_rows_in_are_kept_plus_late_over_two_triggers(spark):
    home, at = scratch_path(spark, "late-test"), lambda *x: dt.datetime(2024, 1, *x)
    schema = "id long, kind string, ts timestamp"
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{home}/in")
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{home}/in")
    put([(1, "a", at(1, 10)), (2, "a", at(2, 12)), (3, "b", at(2, 23, 50))])
    windows, late = S.count_with_late(stream(), home, lateness="1 hour", keys=["kind"])
    assert late.count() == 0 and sum(r["kept"] for r in windows.collect()) == 3
    # a second start goes on: two files, rows before and behind the limit of what was seen, one without a time
    put([(4, "a", at(1, 11)), (5, "b", at(2, 22, 50)), (6, "b", at(2, 22, 49)), (7, "a", None), (8, "b", at(5, 0))])
    put([(9, "a", at(4, 22)), (10, "a", at(4, 23)), (11, "c", at(6, 1))])
    windows, late = S.count_with_late(stream(), home, lateness="1 hour", keys=["kind"])
    assert sorted(r["id"] for r in late.collect()) == [4, 6, 7, 9]
    got = {(r["window_start"].day, r["kind"]): (r["kept"], r["late"], r["corrected"]) for r in windows.collect()}
    assert got == {
        (1, "a"): (1, 1, 2), (2, "a"): (1, 0, 1), (2, "b"): (2, 1, 3), (4, "a"): (1, 1, 2), (5, "b"): (1, 0, 1), (6, "c"): (1, 0, 1),
    }
    assert sum(k for k, _, _ in got.values()) + late.count() == 11
    # nothing new: the same tables
    again, _ = S.count_with_late(stream(), home, lateness="1 hour", keys=["kind"])
    assert sum(r["corrected"] for r in again.collect()) == 10
