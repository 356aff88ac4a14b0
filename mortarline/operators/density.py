"""Density clusters with noise: core distances, mutual reachability, a hierarchy over a ladder of radii.

Rows that fall into one tiny cell are folded into a weighted point first, so a dense place has a bounded number of
points per radius and needs no pairs of its rows.  Points within the largest radius are found over a grid of cells of that side; a point's
core distance is where its neighbours (its own rows included) reach ``min_points``, and an edge weighs the largest of its
length and both core distances.

The hierarchy comes from contraction: rung by rung, from the smallest radius to the largest, edges up to the rung's radius
join components, and of the edges between two components only the lightest is kept.  So the edges left shrink with every
rung, and what is known of the tree are tables of components.  Clusters are chosen by stability as in hierarchical
density clustering: the rows of a component, times how far its inverse radius reaches, against the sum of its parts.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mortarline.functions.graph import connected_components
from mortarline.session import cut_lineage

#: Features that the grid of cells uses; the others only enter distances.
GRID_FEATURES = 3


def folded(df: DataFrame, key: str, features: Sequence[str], resolution: float) -> DataFrame:
    """Rows (id, x, weight): one point per cell of side ``resolution``, at its middle; 0 folds equal rows only."""
    x = [F.col(f).cast("double") for f in features]
    if resolution > 0:
        x = [F.floor(c / resolution) * F.lit(resolution) + F.lit(resolution / 2) for c in x]
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.array(*x).alias("x"))
    whole = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.where(whole).select("id", F.transform("x", lambda v: v + F.lit(0.0)).alias("x"))


def neighbour_pairs(points: DataFrame, features: int, radius: float) -> DataFrame:
    """Rows (a, b, d, wa, wb), a < b: points (id, x, weight) at most ``radius`` apart."""
    grid = min(features, GRID_FEATURES)
    cell = [F.floor(F.element_at("x", i + 1) / radius).cast("long") for i in range(grid)]
    placed = points.select("*", *[c.alias(f"c{i}") for i, c in enumerate(cell)])
    # half of the neighbouring cells, and the own one, so that no pair is met twice
    steps = [s for s in product((-1, 0, 1), repeat=grid) if s >= (0,) * grid]
    near = F.array(*[F.struct(*[(F.col(f"c{i}") + v).alias(f"c{i}") for i, v in enumerate(s)], F.lit(s == (0,) * grid).alias("own")) for s in steps])
    left = placed.select(F.col("id").alias("a"), F.col("x").alias("xa"), F.col("weight").alias("wa"), F.inline(near))
    right = placed.select(*[f"c{i}" for i in range(grid)], F.col("id").alias("b"), F.col("x").alias("xb"), F.col("weight").alias("wb"))
    met = left.join(right, [f"c{i}" for i in range(grid)]).where("(NOT own AND a <> b) OR a < b")
    d2 = F.aggregate(F.zip_with("xa", "xb", lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, v: s + v)
    met = met.withColumn("d", F.sqrt(d2)).where(F.col("d") <= radius)
    swap = lambda small, big: F.when(F.col("a") < F.col("b"), F.col(small)).otherwise(F.col(big))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "d", swap("wa", "wb").alias("wa"), swap("wb", "wa").alias("wb"))


def core_distances(points: DataFrame, pairs: DataFrame, min_points: int) -> DataFrame:
    """Rows (id, core): distance at which a point and its neighbours hold ``min_points`` rows; points that lack them are left out."""
    both = pairs.select(F.col("a").alias("id"), "d", F.col("wb").alias("w")).union(pairs.select(F.col("b").alias("id"), "d", F.col("wa").alias("w")))
    own = points.select("id", F.lit(0.0).alias("d"), F.col("weight").alias("w"))
    # neighbours at one distance count together, and a distance is reached once it holds enough
    rings = both.union(own).groupBy("id", "d").agg(F.sum("w").alias("w"))
    upto = F.sum("w").over(Window.partitionBy("id").orderBy("d"))
    return rings.withColumn("n", upto).where(F.col("n") >= min_points).groupBy("id").agg(F.min("d").alias("core"))


def _contract(links: DataFrame, names: DataFrame) -> DataFrame:
    """Lightest edge between each two components, after renaming both ends by ``names`` (node, label)."""
    a, b = names.select(F.col("node").alias("a"), F.col("label").alias("la")), names.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    moved = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("la", "a").alias("p"), F.coalesce("lb", "b").alias("q"), "w")
    apart = moved.where("p <> q").groupBy(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))
    return apart.agg(F.min("w").alias("w"))


def ladder(radius: float, rungs: int) -> list[float]:
    """Radii from radius / 2**(rungs - 1) up to ``radius``, each twice the one before."""
    return [radius / 2 ** (rungs - 1 - i) for i in range(rungs)]


def density_clusters(
    df: DataFrame, key: str, features: Sequence[str], radius: float, min_points: int = 3, min_cluster_size: int = 3, rungs: int = 6,
    resolution: float = 0.0,
) -> DataFrame:
    """The input with ``component`` and ``cluster``, both named by the smallest core row's key, -1 for noise.

    ``component``: rows whose mutual reachability chains them within ``radius``.  ``cluster``: the parts of a component that are chosen by stability
    over ``rungs`` radii, each half the next; of a part and its own parts the part wins ties.  Groups of fewer than ``min_cluster_size`` rows are noise,
    and so are rows without a core distance up to ``radius``, with a null or non-finite feature, or without a key.  ``key`` is a whole number that
    names a row; repeated keys with equal features count as several rows.  Distances are those of the folded points, at most
    ``resolution`` times the root of the number of features off.
    """
    if not rungs >= 1 or radius <= 0:
        raise ValueError("radius and rungs must be positive")
    rows = cut_lineage(folded(df, key, features, resolution))
    points = cut_lineage(rows.groupBy("x").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight")))
    pairs = cut_lineage(neighbour_pairs(points, len(features), radius))
    core = cut_lineage(core_distances(points, pairs, min_points).where(F.col("core") <= radius).join(points.select("id", "weight"), "id"))
    ends = [core.select(F.col("id").alias(c), F.col("core").alias(f"core_{c}")) for c in "ab"]
    edges = pairs.join(ends[0], "a").join(ends[1], "b").select("a", "b", F.greatest("d", "core_a", "core_b").alias("w"))
    edges = cut_lineage(edges)
    radii = ladder(radius, rungs)

    # levels[i]: (node, comp, n, live); node is a component of the rung before, or a point that is in none yet
    levels: list[DataFrame] = []
    alive = core.select(F.col("id").alias("node"), F.col("weight").alias("n"), "core")
    for r in radii:
        here = edges.where(F.col("w") <= r).select("a", "b")
        names = cut_lineage(connected_components(here))
        moved = alive.join(names, "node", "left").withColumn("comp", F.coalesce("label", "node"))
        # a single point is there from its core distance on
        levels.append(cut_lineage(moved.select("node", "comp", "n", (F.col("core") <= r).alias("live"))))
        grown = moved.groupBy(F.col("comp").alias("node")).agg(F.sum("n").alias("n"), F.min("core").alias("core"))
        alive = cut_lineage(grown)
        edges = cut_lineage(_contract(edges.where(F.col("w") > r), names))

    # from the finest rung up: value of a component as one cluster, and of the best choice among its parts
    inverse = [1.0 / r for r in radii]
    nodes: list[DataFrame] = []
    below = None
    for i, level in enumerate(levels):
        reach = inverse[i] - inverse[i + 1] if i + 1 < rungs else 0.0
        size = level.where("live").groupBy("comp").agg(F.sum("n").alias("size")).where(F.col("size") >= min_cluster_size)
        if below is None:
            node = size.select("comp", "size", F.lit(0).alias("parts"), F.lit(0.0).alias("s"), F.lit(0.0).alias("k"), F.lit(None).cast("long").alias("only"))
        else:
            up = level.select("node", "comp").join(below.select(F.col("comp").alias("node"), F.col("s").alias("cs"), F.col("k").alias("ck")), "node")
            sums = up.groupBy("comp").agg(
                F.count(F.lit(1)).alias("parts"), F.sum(F.round(F.greatest("cs", "ck"), 9)).alias("best"), F.max("cs").alias("cs"), F.max("ck").alias("ck"),
                F.max("node").alias("only"),
            )
            one = F.col("parts") == 1
            node = size.join(sums, "comp", "left").select(
                "comp", "size", F.coalesce("parts", F.lit(0)).alias("parts"), F.when(one, F.col("cs")).otherwise(0.0).alias("s"),
                F.when(one, F.col("ck")).otherwise(F.coalesce("best", F.lit(0.0))).alias("k"), F.when(one, F.col("only")).alias("only"),
            )
        below = cut_lineage(node.withColumn("s", F.round(F.col("s") + F.col("size") * reach, 9)))
        nodes.append(below)

    # and down again: a component is taken whole, or handed on to its parts; what falls out of an open one is noise
    state = nodes[-1].select("comp", F.when(F.col("s") >= F.col("k"), F.col("comp")).alias("cluster"), F.col("comp").alias("component"))
    for i in range(rungs - 1, 0, -1):
        inner = nodes[i - 1].select(F.col("comp").alias("node"), F.col("s").alias("cs"), F.col("k").alias("ck"))
        outer = state.join(nodes[i].select("comp", "parts"), "comp", "left")
        handed = levels[i].select("node", "comp").join(outer, "comp").join(inner, "node", "left")
        fresh = F.when((F.col("parts") > 1) & (F.col("cs") >= F.col("ck")), F.col("node"))
        lost = F.col("cs").isNull()
        chosen = F.when(F.col("cluster").isNotNull(), F.col("cluster")).when(lost, F.lit(-1).cast("long")).otherwise(fresh)
        state = cut_lineage(handed.select(F.col("node").alias("comp"), chosen.alias("cluster"), "component"))
    ids = levels[0].select("node", "comp")
    first = core.select(F.col("id").alias("node")).join(ids, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    labels = first.join(state, "comp").select(F.col("node").alias("id"), "component", F.coalesce("cluster", F.lit(-1).cast("long")).alias("cluster"))
    named = labels.join(points.select("id", "x"), "id").select("x", "component", "cluster")
    found = rows.join(named, "x").select(F.col("id").alias("_id"), "component", "cluster").distinct()
    noise = lambda c: F.coalesce(c, F.lit(-1).cast("long")).alias(c)
    return df.join(found, F.col(key).cast("long") == F.col("_id"), "left").select(*[df[c] for c in df.columns], noise("component"), noise("cluster"))
