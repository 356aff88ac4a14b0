"""Readers. Paths are any Hadoop-readable URI; nothing is copied to a local disk first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mortarline import schemas as S


def read_features(spark: SparkSession, path: str, schema: str | None = S.FEATURES, fmt: str = "csv") -> DataFrame:
    """Feature table; with ``schema=None`` CSV types are inferred, which costs a scan."""
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
    return (reader.schema(schema) if schema else reader).format(fmt).load(path)


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected lines). Blank lines vanish; ``strict`` fails on the first bad line."""
    if strict:
        rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
        return rows, spark.createDataFrame([], "value string")
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.withColumn("_ok", F.try_parse_json("value").isNotNull())
    good = parsed.where("_ok").select(F.from_json("value", schema).alias("r")).select("r.*")
    return good, parsed.where(~F.col("_ok")).select("value")


def read_results(
    spark: SparkSession, path: str, accept_case_results: bool = False, glob: str = "*.json"
) -> tuple[DataFrame, DataFrame]:
    """(entries, rejected files) from result files holding a list, ``{"results": [...]}`` or one object.

    Entries carry ``source_file``, ``entry_pos`` and the entry as JSON text, nulls and all.
    ``accept_case_results`` also opens ``per_case_results``.
    """
    files = (
        spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
        .select(F.col("_metadata.file_name").alias("source_file"), "value")
        .withColumn("_v", F.try_parse_json("value"))
    )
    many = "array<variant>"
    shapes = [F.try_variant_get("_v", "$", many), F.try_variant_get("_v", "$.results", many)]
    if accept_case_results:
        shapes.append(F.try_variant_get("_v", "$.per_case_results", many))
    good = files.where(F.col("_v").isNotNull())
    entries = good.select(
        "source_file", F.posexplode(F.coalesce(*shapes, F.array("_v"))).alias("entry_pos", "_e")
    ).select("source_file", "entry_pos", F.to_json("_e").alias("entry"))
    return entries, files.where(F.col("_v").isNull()).select("source_file")


def read_model_lines(spark: SparkSession, path: str) -> DataFrame:
    """(model, value) for every line of every model file below ``path``; the suffix may be in any case."""
    return (
        spark.read.option("pathGlobFilter", "*.[lL][dD][rR]").option("recursiveFileLookup", True).text(path)
        .select(F.col("_metadata.file_name").alias("model"), "value")
    )


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """(model, label) from a ``filename,label`` CSV."""
    rows = spark.read.schema(S.MODEL_LABELS).option("header", True).csv(path)
    return rows.withColumnRenamed("filename", "model")


def read_thresholds(spark: SparkSession, path: str) -> DataFrame:
    """(metric, threshold) from one JSON object."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "map<string,double>")).alias("metric", "threshold"))


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_documents(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, text): whole files under their own name, for context lookups."""
    return (
        spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    )


def read_telemetry(spark: SparkSession, path: str, table: str, fmt: str = "parquet", stream: bool = False) -> DataFrame:
    """One telemetry table, as a batch or as a file stream."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(S.TELEMETRY[table]).format(fmt).load(path)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """(label, origin, image): label folders of images; unreadable files are dropped."""
    images = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(path)
    parts = F.split("image.origin", "/")
    return images.select(
        F.element_at(parts, -2).alias("label"), F.col("image.origin").alias("origin"), "image"
    )


def _pixels(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """height x width x 3 RGB array of one decoded image (stored blue first)."""
    raw = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    return raw[:, :, [2, 1, 0]] if channels >= 3 else np.repeat(raw[:, :, :1], 3, axis=2)


def _per_image(images: DataFrame, columns: str, measure) -> DataFrame:
    kept = [c for c in images.columns if c != "image"]
    flat = images.select(*kept, "image.height", "image.width", "image.nChannels", "image.data")
    names = [c.name for c in StructType.fromDDL(columns)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in images.select(*kept).schema) + ", " + columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [measure(_pixels(*x)) for x in zip(b["data"], b["height"], b["width"], b["nChannels"])]
            yield pd.concat([b[kept].reset_index(drop=True), pd.DataFrame(rows, columns=names)], axis=1)

    return flat.mapInPandas(run, schema)


def flat_pixels(images: DataFrame, size: int = 64) -> DataFrame:
    """Add ``features``: nearest-neighbour ``size`` x ``size`` RGB, flattened row by row."""

    def measure(p: np.ndarray) -> list:
        rows = (np.arange(size) + 0.5) * p.shape[0] / size
        cols = (np.arange(size) + 0.5) * p.shape[1] / size
        return [p[rows.astype(int)][:, cols.astype(int)].reshape(-1).astype("float64").tolist()]

    return _per_image(images, "features array<double>", measure)


def image_features(images: DataFrame) -> DataFrame:
    """Feature columns of the drift baseline: intensity, size, edge density, channel means."""

    def measure(p: np.ndarray) -> list:
        grey = p.astype("float64") @ np.array([0.299, 0.587, 0.114])
        dy = np.abs(np.diff(grey, axis=0))[:, : max(grey.shape[1] - 1, 0)]
        dx = np.abs(np.diff(grey, axis=1))[: max(grey.shape[0] - 1, 0), :]
        edges = float(((dx + dy) > 32).mean()) if dx.size else 0.0
        channels = p.reshape(-1, 3).mean(axis=0) / 255.0
        return [float(grey.mean()), float(grey.std()), float(p.shape[1]), float(p.shape[0]), edges, *map(float, channels)]

    columns = ", ".join(f"{c.name} double" for c in StructType.fromDDL(S.FEATURES) if c.name != "predicted_class")
    return _per_image(images, columns, measure)
