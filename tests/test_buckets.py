"""Bucketed upserts: results, untouched files, versions and commits."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from mortarline.session import scratch_path
from mortarline.sources.buckets import bucket_of, manifest, read_buckets, upsert_buckets


def test_only_changed_buckets_are_rewritten(spark):
    path, schema = scratch_path(spark, "buckets-test"), "id long, text string, version int"
    base = spark.createDataFrame([(i, f"old {i}", 1) for i in range(200)] + [(None, "no key", 1)], schema)
    assert manifest(spark, path) == (0, {})
    assert upsert_buckets(base, path, "id", "version", buckets=16) == 1
    _, before = manifest(spark, path)
    files = set(read_buckets(spark, path, base).select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
    changes = spark.createDataFrame([(7, "new 7", 2), (7, "stale 7", 0), (500, "new 500", 2)], schema)
    assert upsert_buckets(changes, path, "id", "version", buckets=999) == 2
    _, after = manifest(spark, path)
    touched = {r[0] for r in changes.select(bucket_of("id", 16)).collect()}
    assert {b for b in after if after[b] != before.get(b)} == touched
    now = read_buckets(spark, path, base)
    kept = files & set(now.select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
    assert len(kept) >= len(before) - len(touched)
    got = {r["id"]: r["text"] for r in now.collect()}
    assert got == {**{i: f"old {i}" for i in range(200)}, 7: "new 7", 500: "new 500"} and now.count() == 201


def test_a_version_is_committed_once_and_empty_changes(spark):
    path, schema = scratch_path(spark, "buckets-test"), "id long, version int"
    none = spark.createDataFrame([], schema)
    assert upsert_buckets(none, path, "id", "version", buckets=4) == 1
    assert read_buckets(spark, path, none).count() == 0
    assert upsert_buckets(spark.createDataFrame([(1, 1)], schema), path, "id", "version") == 2
    assert upsert_buckets(none, path, "id", "version") == 3
    assert [tuple(r) for r in read_buckets(spark, path, none).collect()] == [(1, 1)]
    with pytest.raises(AnalysisException):
        none.write.mode("errorifexists").parquet(f"{path}/manifests/version=3")
    # a folder without a manifest is not seen
    spark.createDataFrame([(9, 9)], schema).write.parquet(f"{path}/data/4-lost/bucket=0")
    assert read_buckets(spark, path, none).count() == 1
