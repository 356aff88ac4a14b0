"""Keyed tables in buckets, changed by copy on write.

A row's bucket is a hash of its key.  An upsert reads and rewrites the buckets that hold changed keys into a folder of its own;
all others keep their files.  Which folder holds which bucket is said by a manifest, one small file per version, written last: until
it is there, readers see the table as it was, and a job that dies before leaves nothing but a folder nobody names.
Two writers of one version cannot both commit, as a manifest is never overwritten.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline.operators.retrieval import upsert


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, path: str) -> tuple[int, dict[int, str]]:
    """(version, folder of each bucket that has rows) of the newest manifest; version 0 and none for a table not yet written."""
    try:
        rows = spark.read.schema("bucket int, folder string, buckets int, version int").parquet(f"{path}/manifests")
        newest = rows.agg(F.max("version")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, {}
    # one row per bucket
    return newest or 0, {r["bucket"]: r["folder"] for r in rows.where(F.col("version") == newest).collect()}


def upsert_buckets(changes: DataFrame, path: str, key: str, version: str, buckets: int = 64) -> int:
    """Merge ``changes`` into the table below ``path`` and return the new version; the row of the highest ``version`` wins per key.

    The number of buckets is that of the first call.  Rows without a key are left out; of equal versions of one key any one stays.
    """
    spark = changes.sparkSession
    number, folders = manifest(spark, path)
    if number:
        buckets = spark.read.parquet(f"{path}/manifests").where(F.col("version") == number).agg(F.max("buckets")).first()[0]
    given = changes.where(F.col(key).isNotNull()).withColumn("bucket", bucket_of(key, buckets))
    touched = sorted(r["bucket"] for r in given.select("bucket").distinct().collect())
    home = f"data/{number + 1}-{uuid.uuid4().hex}"
    current = _read(spark, path, {b: folders[b] for b in touched if b in folders}, changes)
    merged = upsert(current, given.drop("bucket"), key, version).withColumn("bucket", bucket_of(key, buckets))
    merged.repartition(len(touched) or 1, "bucket").write.partitionBy("bucket").parquet(f"{path}/{home}")
    folders |= {b: f"{home}/bucket={b}" for b in touched}
    rows = spark.createDataFrame([(b, f, buckets) for b, f in sorted(folders.items())] or [(-1, "", buckets)], "bucket int, folder string, buckets int")
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{path}/manifests/version={number + 1}")
    return number + 1


def _read(spark: SparkSession, path: str, folders: dict[int, str], like: DataFrame) -> DataFrame:
    found = [f"{path}/{f}" for b, f in folders.items() if b >= 0]
    if not found:
        return spark.createDataFrame([], like.schema)
    return spark.read.schema(like.schema).parquet(*found)


def read_buckets(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table as its newest manifest says, with the columns of ``like``."""
    return _read(spark, path, manifest(spark, path)[1], like)
