"""Traffic and archival queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline.operators import rollout as R
from mortarline.plans.adapters import ctes, table, view
from mortarline.plans.registry import register

_TARGET = f"""{ctes('traffic')}, tg AS (SELECT endpoint, arg_min(deployment, position) AS target, 40 AS share FROM traffic GROUP BY 1)"""


def _targets(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    traffic = view(spark, sf, "traffic")
    first = traffic.groupBy("endpoint").agg(F.min_by("deployment", "position").alias("deployment"))
    return traffic, first.withColumn("share", F.lit(40))


@register(
    "traffic_split",
    f"""{_TARGET}, o AS (SELECT t.*, share, sum(percent) OVER w AS total, count(*) OVER w AS n, row_number() OVER (PARTITION BY t.endpoint ORDER BY position) AS i
      FROM traffic t JOIN tg ON t.endpoint = tg.endpoint WHERE deployment <> target WINDOW w AS (PARTITION BY t.endpoint)),
    p AS (SELECT *, CASE WHEN total > 0 THEN (100 - share) * percent // total ELSE (100 - share) // n END AS part FROM o)
    SELECT endpoint, deployment, CAST(CASE WHEN i = n THEN 60 - (sum(part) OVER (PARTITION BY endpoint) - part) ELSE part END AS INT) AS percent FROM p
    UNION ALL SELECT endpoint, target, share FROM tg""",
)
def traffic_split(spark: SparkSession, sf: str) -> DataFrame:
    return R.promote(*_targets(spark, sf))


@register(
    "traffic_rollback",
    f"{_TARGET} SELECT t.endpoint, deployment, CASE WHEN deployment = target THEN 100 ELSE 0 END AS percent FROM traffic t JOIN tg ON t.endpoint = tg.endpoint",
)
def traffic_rollback(spark: SparkSession, sf: str) -> DataFrame:
    return R.rollback(*_targets(spark, sf))


@register(
    "archival_candidates",
    f"""{ctes('asset_versions')} SELECT name, version FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY version DESC) AS r FROM asset_versions) t
    WHERE r > 3 AND NOT in_use""",
)
def archival_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return R.archive_models(view(spark, sf, "asset_versions")).select("name", "version")


@register(
    "data_archival",
    f"""{ctes('asset_versions')} SELECT name, version FROM asset_versions v
    WHERE EXISTS (SELECT 1 FROM asset_versions n WHERE n.name = v.name AND n.version > v.version AND n.created_at <= TIMESTAMP '1999-01-01' - INTERVAL 90 DAYS)
      AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = v.version AND l_returnflag = 'R')""",
)
def data_archival(spark: SparkSession, sf: str) -> DataFrame:
    versions = view(spark, sf, "asset_versions")
    used = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("version"))
    references = used.join(versions.select("name", "version"), "version").distinct()
    return R.archive_data(versions, references, "1999-01-01 00:00:00").select("name", "version")
