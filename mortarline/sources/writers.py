"""Writers. Each is one distributed write; ordering, where a format needs it, is per file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline.operators.modelfiles import line_order


def write_features(df: DataFrame, path: str, columns: Sequence[str], fmt: str = "csv") -> None:
    """Feature table with a fixed column order."""
    writer = df.select(*columns).write.mode("overwrite")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def write_report(df: DataFrame, path: str) -> None:
    """One JSON object per row, nested columns and nulls kept."""
    whole = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    df.select(whole.alias("value")).write.mode("overwrite").text(path)


def write_lines(df: DataFrame, path: str, line: str = "line") -> None:
    """Training examples or other ready-made lines."""
    df.select(F.col(line).alias("value")).write.mode("overwrite").text(path)


def append_metrics(df: DataFrame, path: str, ts: str) -> None:
    """Append (name, value, dims) rows to the metric log, partitioned by day."""
    stamped = df.withColumn("ts", F.lit(ts).cast("timestamp")).withColumn("day", F.to_date("ts"))
    stamped.write.mode("append").partitionBy("day").parquet(path)


def append_captures(scored: DataFrame, path: str, ts: str = "ts") -> None:
    """Append inference rows (features, prediction, confidence, time) to the capture log by month.

    Each call adds files of its own, so services may write side by side; ``drift.window_drift`` reads the log.
    """
    scored.withColumn("month", F.date_format(ts, "yyyy-MM")).write.mode("append").partitionBy("month").parquet(path)


def publish_version(spark: SparkSession, df: DataFrame, path: str) -> int:
    """Write the dataset as its next integer version, in a folder of its own, and return the number.

    A version is claimed by creating a marker file, which one publisher alone can do; whoever
    finds it taken goes on to the next number.
    """
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(path)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    claims = jvm.org.apache.hadoop.fs.Path(base, "_claims")
    fs.mkdirs(claims)
    number = 1 + max((int(f.getPath().getName()) for f in fs.listStatus(claims)), default=0)
    while not fs.createNewFile(jvm.org.apache.hadoop.fs.Path(claims, str(number))):
        number += 1
    df.write.mode("errorifexists").parquet(f"{path}/version={number}")
    return number


def write_models(lines: DataFrame, path: str) -> None:
    """Model text, one folder per model, from ``framed_lines`` rows.

    Rows are range-partitioned on the whole sort key, so a very large model is spread
    over several part files whose name order is the line order.
    """
    order = ["model", *line_order(lines)]
    (
        lines.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("model", "value").write.mode("overwrite").partitionBy("model").text(path)
    )
