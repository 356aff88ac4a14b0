"""Mixing sources to target weights by capped water-filling.

Every source has a size (the words of its documents) and a weight.  A share of all words is
poured over the sources in proportion to their weights; a source that would pass its cap of
``epochs`` times its size is clamped there, and what it cannot take is poured again over the
others, until no source is above its cap.  A source's rate (target / size) is then met by whole
repetitions of all its documents plus one more of some: in the order of a seeded digest of the
document id, documents are taken as long as the middle of the next one lies within what is
missing, which ends at most half a document away from the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mortarline.llm.text import n_words
from mortarline.session import cut_lineage

#: Digits of the seeded digest that name a slice of a source; a source is looked at slice by slice.
SLICE_DIGITS = 3


def water_fill(sources: DataFrame, share: float, epochs: int) -> DataFrame:
    """Add ``target`` (double) to rows (source, size, weight): one row per source.

    ``share`` times the sum of sizes is dealt out by weight under the cap ``epochs * size``.
    Each round clamps all sources whose part of the rest reaches their cap, by aggregates of one
    row; sources that are full stay so, since the level only rises.  A source of size 0 gets 0,
    and so do weights that are null, negative or 0.  If all are full the rest stays undealt.
    """
    rows = sources.withColumn("weight", F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0)))
    cap = F.lit(epochs) * F.col("size")
    total = float((rows.agg(F.sum("size")).first()[0] or 0) * share)
    level, clamped = 0.0, -1
    while True:
        full = (F.lit(level) * F.col("weight") >= cap) & (F.col("weight") > 0)
        full_n, full_words, open_weight = rows.agg(
            F.count(F.when(full, 1)), F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if full_n == clamped or not open_weight:
            break
        clamped, level = full_n, max(level, (total - float(full_words or 0)) / open_weight)
    return rows.withColumn("target", F.least(F.lit(level) * F.col("weight"), cap.cast("double")))


def mix(
    docs: DataFrame,
    weights: DataFrame,
    share: float = 1.5,
    epochs: int = 2,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Rows (id, source, size, source_size, target, rate, repeats, taken), one per document.

    ``weights`` has (source, weight), one row per source; sources missing there weigh nothing.
    Null sources form a source of their own.  Null and empty texts have size 0 and are repeated
    like the others.  Rows that share an id (null ids too) are decided together, so repeated rows
    get the same answer and the order of rows never matters.  Empty tables give empty results.
    """
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    sized = cut_lineage(
        docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), key.alias("key"))
    )
    by_source = sized.groupBy("source").agg(F.sum("size").alias("size"))
    weighed = by_source.join(weights.select(F.col("source").alias("_w"), "weight"), F.col("source").eqNullSafe(F.col("_w")), "left")
    plan = water_fill(cut_lineage(weighed.select("source", "size", "weight")), share, epochs)
    rate = F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(F.lit(0.0))
    plan = cut_lineage(
        plan.withColumn("rate", rate)
        .withColumn("whole", F.floor("rate"))
        .withColumn("missing", F.col("target") - F.floor("rate") * F.col("size"))
        .select(F.col("source").alias("_s"), F.col("size").alias("source_size"), "target", "rate", "whole", "missing")
    )
    return _taken(sized, plan)


def _taken(sized: DataFrame, plan: DataFrame) -> DataFrame:
    piece = F.substring("key", 1, SLICE_DIGITS)
    slices = sized.groupBy("source", piece.alias("slice")).agg(F.sum("size").alias("n"))
    running = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = slices.withColumn("end", F.sum("n").over(running)).join(plan, F.col("source").eqNullSafe(F.col("_s")))
    # the slice in which what is missing runs out; before it all is taken, after it nothing
    cut = (
        upto.where(F.col("end") > F.col("missing")).groupBy("_s")
        .agg(F.min(F.struct("slice", (F.col("end") - F.col("n")).alias("before"))).alias("cut"))
        .select(F.col("_s").alias("_c"), F.col("cut.slice").alias("cut"), F.col("cut.before").alias("before"))
    )
    plan = plan.join(cut, F.col("_s").eqNullSafe(F.col("_c")), "left").drop("_c")
    rows = sized.join(plan, F.col("source").eqNullSafe(F.col("_s"))).withColumn("slice", piece)
    clear = rows.where("cut IS NULL OR slice <> cut").withColumn(
        "extra", (F.col("missing") > 0) & (F.col("cut").isNull() | (F.col("slice") < F.col("cut")))
    )
    inside = Window.partitionBy("source").orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    tied = Window.partitionBy("source", "key")
    middle = F.col("before") + F.sum("size").over(inside) - F.sum("size").over(tied) / 2
    edge = rows.where("slice = cut").withColumn("extra", (F.col("missing") > 0) & (middle <= F.col("missing")))
    names = ["id", "source", "size", "source_size", "target", "rate"]
    repeats: Column = (F.col("whole") + F.col("extra").cast("long")).cast("long")
    return (
        clear.select(*names, "whole", "extra").unionByName(edge.select(*names, "whole", "extra"))
        .withColumn("repeats", repeats)
        .withColumn("taken", F.col("repeats") * F.col("size"))
        .drop("whole", "extra")
    )


def cycled_weights(docs: DataFrame, weights: tuple[float, ...], source_col: str = "source") -> DataFrame:
    """(source, weight): the given weights in turn, by code point of the source, null last.

    Ranks come from counts: each source counts the sources before it within its first two
    characters, and those counts are summed over the prefixes, so no task orders all sources.
    """
    names = docs.select(F.col(source_col).alias("source")).distinct().withColumn("p", F.substring("source", 1, 2))
    prefixes = names.groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    order = Window.orderBy(F.col("p").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    starts = prefixes.select(F.col("p").alias("_p"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("start"))
    within = Window.partitionBy("p").orderBy("source")
    rank = F.col("start") + F.row_number().over(within) - 1
    table = F.array(*[F.lit(float(w)) for w in weights])
    return (
        names.join(starts, F.col("p").eqNullSafe(F.col("_p")))
        .select("source", F.element_at(table, (rank % len(weights) + 1).cast("int")).alias("weight"))
    )
