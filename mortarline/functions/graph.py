"""Connected components in a logarithmic number of rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mortarline.session import cut_lineage


def _toward_smallest(pairs: DataFrame, keep_larger_only: bool) -> DataFrame:
    """Hook the neighbours of every node ``u`` to the smallest node around it.

    The minimum is a combinable aggregate and the join that carries it back may be split
    by adaptive execution, so a node with very many neighbours needs no single task.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    hooked = pairs.join(least, "u")
    if keep_larger_only:
        return hooked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return hooked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(own)


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, label) for every node of ``edges``; label is the smallest node it reaches.

    Alternates two rewrites of the edge list until it no longer changes (large-star and
    small-star, Kiveris et al. 2014): first all larger neighbours of a node are hooked to
    its smallest neighbour, then all smaller ones.  Chains shrink by a constant factor per
    round, so a path of n nodes settles in O(log n) rounds; there is no cap on rounds.
    Each round's edges are written to the shared folder.  Rows with a null end, repeated
    rows and self-edges are allowed; a node known from a self-edge alone labels itself.
    """
    given = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).dropna()
    nodes = given.select("u").union(given.select("v")).distinct()
    current = cut_lineage(
        given.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    before = None
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_smallest(both, keep_larger_only=True).where("u <> v").distinct()
        small = _toward_smallest(large, keep_larger_only=False).where("u <> v").distinct()
        current = cut_lineage(small)
        after = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before is not None and tuple(after) == tuple(before):
            break
        before = after
    labels = current.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label"))
    return (
        nodes.withColumnRenamed("u", "node").join(labels, "node", "left")
        .select("node", F.coalesce("label", "node").alias("label"))
    )
