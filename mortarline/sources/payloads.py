"""Scoring requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MISSING = "Provide 'image_base64' or 'features'"


def decode_payloads(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``kind``, ``image`` bytes, ``features`` and ``error``; an image wins over features."""
    body = F.from_json(payload, "image_base64 string, features array<double>")
    out = df.withColumn("_b", body)
    image, features = F.col("_b.image_base64"), F.col("_b.features")
    kind = F.when(image.isNotNull(), "image").when(features.isNotNull(), "features").otherwise("error")
    return out.withColumns(
        {
            "kind": kind,
            "image": F.unbase64(image),
            "features": F.when(image.isNull(), features),
            "error": F.when(image.isNull() & features.isNull(), MISSING),
        }
    ).drop("_b")
