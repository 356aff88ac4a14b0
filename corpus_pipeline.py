"""A corpus from ``documents`` in five stages, each on all rows that the one before kept.

Every stage but the last takes and returns the columns of ``documents``.  Stages are written as Parquet below
the session's shared folder and read again, so a lost executor costs one stage's work at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline.llm.lines import dedup_lines
from mortarline.llm.mixing import cycled_weights, mix
from mortarline.llm.neardup import near_duplicates
from mortarline.llm.pieces import encode_texts
from mortarline.llm.quality import quality_rules
from mortarline.session import cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie within their group's robust bound.

    A verdict belongs to a row, named by its id, language, source and text, so rows without an id or of one id are
    judged each on their own; rows equal in all of these share it.
    """
    text = F.struct(F.length("text"), F.xxhash64("text"), F.md5(F.col("text").cast("binary")))
    rows = docs.select(*COLUMNS).withColumn("_row", F.struct("doc_id", "lang", "source", text.alias("text")))
    kept = quality_rules(rows, id_col="_row").where("kept").select(F.col("id").alias("_id")).distinct()
    return rows.join(kept, rows["_row"].eqNullSafe(kept["_id"]), "left_semi").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a later document keeps; n_chars follows the text."""
    return dedup_lines(docs.select(*COLUMNS)).select(
        "doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars")
    )


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each class; rows without an id stay."""
    kept = near_duplicates(docs).where("id IS NULL OR id = class_id").select(F.col("id").alias("_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_id"]), "left_semi").select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix repeats them: weights 5, 2, 1 by source, 150 % of all words, twice at most."""
    plan = mix(docs, cycled_weights(docs, (5, 2, 1)), share=1.5, epochs=2)
    # rows of one id and source are decided together
    times = plan.where("repeats > 0").select(F.col("id").alias("_id"), F.col("source").alias("_source"), "repeats").distinct()
    joined = docs.join(times, docs["doc_id"].eqNullSafe(times["_id"]) & docs["source"].eqNullSafe(times["_source"]))
    return joined.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("repeats")))).select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document and the digest of their decoding."""
    rows = encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"), decode=True)
    return rows.select(
        F.col("id").alias("doc_id"), "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [("quality", quality), ("line_dedup", lines), ("minhash", near), ("mixing", mixing), ("sentencepiece", pieces)]

#: Three of the stages (robust covariance, sampled signatures, subword ids) are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
