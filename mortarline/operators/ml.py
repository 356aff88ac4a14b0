"""Splits, scaling, classification reports, clustering and anomaly flags."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from math import ceil, prod
from operator import or_

import numpy as np
import pandas as pd
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mortarline.functions.graph import connected_components
from mortarline.functions.ranks import exact_quantiles
from mortarline.operators.forest import CELLS, feature_cuts, folded_forest, forest_votes
from mortarline.session import cut_lineage

EULER = 0.5772156649015329
#: Training rows of one task of a random forest.
FOREST_ROWS = 20_000
#: Training rows up to which a random forest goes over the rows as they are.
FOREST_FOLD = 20_000


def unit_hash(key: Column, seed: int) -> Column:
    """Reproducible number in [0, 2^52) from a key and a seed."""
    digest = F.md5(F.concat_ws("-", key.cast("string"), F.lit(str(seed))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")


def stratified_split(df: DataFrame, key: str, label: str, share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test``: exactly ``floor(share * n)`` rows of each class, chosen by hash.

    The cut per class is an order statistic of the hash, so no class is sorted in one task.
    """
    # the one-element explode keeps the hash from being evaluated again per use
    hashed = df.withColumn("_u", F.explode(F.array(unit_hash(F.col(key), seed))))
    cuts = exact_quantiles(hashed, [label], "_u", {"_cut": share}, method="nearest").select(label, "_cut")
    return hashed.join(cuts, label, "left").withColumn("is_test", F.col("_u") < F.col("_cut")).drop("_u", "_cut")


def plain_split(df: DataFrame, key: str, share: float = 0.2, seed: int = 42) -> DataFrame:
    """Like ``stratified_split`` with a single class."""
    return stratified_split(df.withColumn("_class", F.lit(1)), key, "_class", share, seed).drop("_class")


def standardize(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Zero mean and unit population deviation; a constant feature keeps scale 1."""
    stats = df.agg(
        F.struct(
            *[F.avg(f).alias(f"{f}_m") for f in features], *[F.stddev_pop(f).alias(f"{f}_s") for f in features]
        ).alias("s")
    ).select("s")
    s = stats.scalar()
    return df.withColumns(
        {f: (F.col(f) - s[f"{f}_m"]) / F.when(s[f"{f}_s"] > 0, s[f"{f}_s"]).otherwise(1.0) for f in features}
    )


def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="_features").transform(df)


def kmeans(
    df: DataFrame, features: Sequence[str], k: int = 5, seed: int = 42, restarts: int = 10, parallel: int = 5
) -> DataFrame:
    """Best of several k-means runs on standardised features, as a ``cluster`` column.

    ``df`` is computed once, for its means, the runs and the result, which is written before the copy is released.
    The runs go over a copy of the features alone.
    """
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    scaled = standardize(df.withColumns({f"_z_{f}": F.col(f).cast("double") for f in features}), [f"_z_{f}" for f in features])
    data = _assembled(scaled, [f"_z_{f}" for f in features])
    points = data.select("_features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        def run(i: int) -> KMeansModel:
            return KMeans(k=k, seed=seed + i, featuresCol="_features", predictionCol="cluster").fit(points)

        # restarts are independent jobs; a few at a time keep the executors busy
        with ThreadPoolExecutor(parallel) as pool:
            runs = list(pool.map(inheritable_thread_target(points.sparkSession)(run), range(restarts)))
        best = min(runs, key=lambda m: m.summary.trainingCost)
        return cut_lineage(best.transform(data).drop("_features", *[f"_z_{f}" for f in features]))
    finally:
        points.unpersist()
        df.unpersist()


def forest_scores(
    train: DataFrame, test: DataFrame, features: Sequence[str], label: str = "label", trees: int = 100, seed: int = 42,
    depth: int = 15,
) -> DataFrame:
    """Random-forest predictions and the probability of the predicted class for ``test``.

    Classes are 0, 1 and so on.  Over ``FOREST_FOLD`` training rows are folded into cells of equal bins and label, where
    the bins allow no more than a task holds, and every tree is grown from the cells.  Else Spark's learner goes over
    all rows on every level of every tree, so they are dealt over tasks by their number and not by the size of the
    file that holds them.
    """
    y = F.col(label).cast("double")
    bad = [F.col(f).isNull() | F.isnan(F.col(f).cast("double")) for f in features] + [y.isNull() | F.isnan(y) | (y < 0) | (y != F.floor(y))]
    rows, top, wrong = train.agg(F.count(F.lit(1)), F.max(y), F.count_if(reduce(or_, bad))).first()
    if rows > FOREST_FOLD and not wrong:
        cut, classes = feature_cuts(train, features), int(top) + 1
        if prod(len(c) + 1 for c in cut) * classes <= CELLS:
            forest = folded_forest(train, features, label, classes, cut, trees, seed, depth)
            return forest_votes(test, features, cut, forest, classes)
    tasks = ceil(rows / FOREST_ROWS)
    if tasks > 1:
        train = train.select(*features, label).repartition(tasks)
    model = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, featuresCol="_features", labelCol=label, predictionCol="prediction"
    ).fit(_assembled(train, features))
    scored = model.transform(_assembled(test, features))
    return scored.withColumn("confidence", F.array_max(vector_to_array("probability"))).drop(
        "_features", "rawPrediction", "probability"
    )


def classification_report(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, plus accuracy, macro and weighted rows.

    Only the confusion counts, one row per (label, prediction), are looked at after the
    first aggregation.
    """
    confusion = scored.groupBy(
        F.col(label).cast("string").alias("l"), F.col(prediction).cast("string").alias("p")
    ).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("long")
    sides = confusion.select(
        F.inline(
            F.array(
                F.struct(F.col("l").alias("c"), F.col("n").alias("s"), zero.alias("g"), F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(zero).alias("tp")),
                F.struct(F.col("p").alias("c"), zero.alias("s"), F.col("n").alias("g"), zero.alias("tp")),
            )
        )
    )
    classes = (
        sides.groupBy(F.col("c").alias("class"))
        .agg(F.sum("s").alias("support"), F.sum("g").alias("predicted"), F.sum("tp").alias("tp"))
        .withColumns(
            {
                "precision": F.coalesce(F.try_divide("tp", "predicted"), F.lit(0.0)),
                "recall": F.coalesce(F.try_divide("tp", "support"), F.lit(0.0)),
            }
        )
        .withColumn(
            "f1",
            F.coalesce(
                F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)
            ),
        )
    )
    parts = ["precision", "recall", "f1"]
    n = F.sum("support")
    totals = classes.agg(
        n.alias("support"),
        (F.sum("tp") / n).alias("acc"),
        *[F.avg(c).alias(f"m_{c}") for c in parts],
        *[(F.sum(F.col(c) * F.col("support")) / n).alias(f"w_{c}") for c in parts],
    ).select(
        F.inline(
            F.array(
                F.struct(F.lit("accuracy").alias("class"), *[F.col("acc").alias(c) for c in parts], "support"),
                F.struct(F.lit("macro avg").alias("class"), *[F.col(f"m_{c}").alias(c) for c in parts], "support"),
                F.struct(F.lit("weighted avg").alias("class"), *[F.col(f"w_{c}").alias(c) for c in parts], "support"),
            )
        )
    )
    return classes.select("class", *parts, "support").unionByName(totals)


def model_gate(report: DataFrame, minimum: float = 0.85) -> DataFrame:
    return report.where(F.col("class") == "accuracy").select(
        F.col("f1").alias("accuracy"), F.lit(minimum).alias("threshold"), (F.col("f1") >= minimum).alias("passed")
    )


def cluster_sizes(assigned: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Rows per cluster, noise (-1) included, with the number of real clusters."""
    sizes = assigned.groupBy(F.col(cluster).alias("cluster")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.withColumn("n_clusters", F.count_if(F.col("cluster") != -1).over(Window.partitionBy()))


def silhouette(df: DataFrame, vector: str, cluster: str) -> DataFrame:
    """Mean squared-Euclidean silhouette of the clustered rows, one row.

    Distances to a whole cluster follow from its count, vector sum and sum of squared
    norms, so the pass is linear; the table of clusters is one small array.  Noise (-1)
    is left out; NULL when there are not more rows than clusters or only one cluster.
    """
    rows = df.where(F.col(cluster) != -1).select(
        F.col(cluster).alias("c"), F.transform(vector, lambda v: v.cast("double")).alias("v")
    ).withColumn("sq", F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x))
    sums = (
        rows.select("c", F.posexplode("v").alias("pos", "x"))
        .groupBy("c", "pos").agg(F.sum("x").alias("x"))
        .groupBy("c")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"]).alias("s"))
    )
    facts = rows.groupBy("c").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("sq").alias("psi")).join(sums, "c")
    table = facts.agg(F.collect_list(F.struct("c", "n", "psi", "s")).alias("t")).scalar()

    def total(v: Column, sq: Column, f: Column) -> Column:
        dot = F.aggregate(F.zip_with(v, f["s"], lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
        return f["n"] * sq + f["psi"] - 2.0 * dot

    placed = rows.withColumn("_facts", table).withColumn(
        "d",
        F.transform(
            "_facts",
            lambda f: F.struct(f["c"].alias("c"), f["n"].alias("n"), total(F.col("v"), F.col("sq"), f).alias("t")),
        ),
    )
    own = F.filter("d", lambda f: f["c"] == F.col("c"))[0]
    other = F.array_min(F.transform(F.filter("d", lambda f: f["c"] != F.col("c")), lambda f: f["t"] / f["n"]))
    score = placed.select("c", own.alias("own"), other.alias("b")).select(
        "c",
        F.col("own.n").alias("n"),
        (F.col("own.t") / F.nullif(F.col("own.n") - 1, F.lit(0.0))).alias("a"),
        "b",
    )
    s = F.when(F.col("n") == 1, 0.0).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    )
    return score.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("c").alias("clusters"), F.avg(s).alias("_s")
    ).select(
        "rows",
        "clusters",
        F.when((F.col("clusters") > 1) & (F.col("rows") > F.col("clusters")), F.col("_s")).alias("silhouette"),
    )


def _grow(x: np.ndarray, rng: np.random.Generator) -> list[tuple[int, float, int, int, int]]:
    """Isolation tree as node rows (feature, cut, left, right, size); feature -1 is a leaf."""
    nodes: list[tuple[int, float, int, int, int]] = []
    limit = int(np.ceil(np.log2(max(len(x), 2))))
    queue = [(x, 0, -1, 0)]
    while queue:
        part, depth, parent, side = queue.pop()
        me = len(nodes)
        spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(part) > 1 else np.array([], int)
        if depth >= limit or not len(spread):
            nodes.append((-1, 0.0, -1, -1, len(part)))
        else:
            f = int(rng.choice(spread))
            cut = float(rng.uniform(part[:, f].min(), part[:, f].max()))
            nodes.append((f, cut, -1, -1, len(part)))
            below = part[:, f] <= cut
            queue += [(part[below], depth + 1, me, 2), (part[~below], depth + 1, me, 3)]
        if parent >= 0:
            up = list(nodes[parent])
            up[side] = me
            nodes[parent] = tuple(up)
    return nodes


def _path(n: np.ndarray) -> np.ndarray:
    """Expected path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype="float64")
    out = np.where(n == 2, 1.0, 0.0)
    big = n > 2
    out[big] = 2 * (np.log(n[big] - 1) + EULER) - 2 * (n[big] - 1) / n[big]
    return out


def _dealt(data: DataFrame, key: str, features: Sequence[str], trees: int, sample: int, seed: int) -> DataFrame:
    """(features, _o, tree): for every tree the ``sample`` rows of smallest hash of (row, tree), at every size.

    A task sends at most ``sample`` rows for a tree on.
    """
    features = list(features)

    def smallest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [(np.empty(0, np.uint64), np.empty((0, len(features)))) for _ in range(trees)]
        for b in batches:
            x, u = b[features].to_numpy(dtype="float64"), b["_u"].to_numpy(dtype="uint64")
            for t, (o, rows) in enumerate(held):
                h = (u + np.uint64(t + 1)) * np.uint64(0x9E3779B97F4A7C15)
                for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                    h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
                h = (h ^ (h >> np.uint64(31))) >> np.uint64(1)
                new = np.flatnonzero(h < o.max()) if len(o) == sample else np.arange(len(h))
                o, rows = np.concatenate([o, h[new]]), np.concatenate([rows, x[new]])
                if len(o) > sample:
                    least = np.argpartition(o, sample - 1)[:sample]
                    o, rows = o[least], rows[least]
                held[t] = o, rows
        for t, (o, rows) in enumerate(held):
            if len(o):
                yield pd.DataFrame(rows, columns=features).assign(_o=o.astype("int64"), tree=t)

    schema = ", ".join([*[f"`{f}` double" for f in features], "_o long", "tree int"])
    lists = data.select(*features, F.xxhash64(unit_hash(F.col(key), seed), F.lit(seed)).alias("_u"))
    lists = lists.withColumn("_u", F.col("_u").bitwiseAND(F.lit(2**63 - 1))).mapInPandas(smallest, schema)
    order = Window.partitionBy("tree").orderBy("_o", *features)
    return lists.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= sample).drop("_r")


def isolation_scores(
    df: DataFrame, key: str, features: Sequence[str], trees: int = 100, sample: int = 256, seed: int = 42
) -> DataFrame:
    """Add ``anomaly_score`` in (0, 1]; higher is easier to isolate.

    Each tree is grown by one task from the ``sample`` rows of smallest hash (all, if there are fewer), which
    is part of the method.  All rows are then scored in Arrow batches against the trees
    (a few hundred nodes each, shipped with the function).
    """
    features = list(features)
    data = cut_lineage(df.withColumns({f: F.col(f).cast("double") for f in features}).dropna(subset=features))
    if data.isEmpty():
        return data.withColumn("anomaly_score", F.lit(None).cast("double"))
    picked = _dealt(data, key, features, trees, sample, seed)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = pdf.sort_values(["_o", *features])[features].to_numpy(dtype="float64")
        nodes = _grow(x, np.random.default_rng([seed, tree]))
        return pd.DataFrame(nodes, columns=["feature", "cut", "left", "right", "size"]).assign(
            tree=tree, node=range(len(nodes)), rows=len(x)
        )

    schema = "feature int, cut double, left int, right int, size int, tree int, node int, rows int"
    # at most ``trees`` times twice the sample size rows come back
    grown = picked.groupBy("tree").applyInPandas(grow, schema).toPandas().sort_values(["tree", "node"])
    forest = [
        (g["feature"].to_numpy(), g["cut"].to_numpy(), g["left"].to_numpy(), g["right"].to_numpy(), g["size"].to_numpy(), int(g["rows"].iloc[0]))
        for _, g in grown.groupby("tree")
    ]
    scale = float(_path(np.array([np.mean([t[5] for t in forest])]))[0]) or 1.0
    out_schema = data.withColumn("anomaly_score", F.lit(0.0)).schema

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = b[features].to_numpy(dtype="float64")
            depth = np.zeros(len(x))
            for feature, cut, left, right, size, _ in forest:
                at = np.zeros(len(x), dtype="int64")
                live = np.flatnonzero(feature[at] >= 0)
                while len(live):
                    node = at[live]
                    depth[live] += 1
                    at[live] = np.where(x[live, feature[node]] <= cut[node], left[node], right[node])
                    live = live[feature[at[live]] >= 0]
                depth += _path(size[at])
            yield b.assign(anomaly_score=np.power(2.0, -depth / len(forest) / scale))

    return data.mapInPandas(score, out_schema)


def isolation_flags(
    df: DataFrame, key: str, features: Sequence[str], contamination: float = 0.1, trees: int = 100, seed: int = 42
) -> DataFrame:
    """Scores with ``prediction`` -1 for the most isolated share of rows, else 1."""
    scored = cut_lineage(isolation_scores(df, key, features, trees=trees, seed=seed))
    cut = exact_quantiles(scored.select((-F.col("anomaly_score")).alias("s")), [], "s", {"cut": contamination})
    return scored.withColumn(
        "prediction", F.when(-F.col("anomaly_score") < cut.select("cut").scalar(), -1).otherwise(1)
    )


def label_predictions(df: DataFrame, meaning: Mapping[int, str], prediction: str = "prediction") -> DataFrame:
    """Readable result per model family, e.g. {-1: 'fail', 1: 'pass'} for anomaly flags."""
    names = F.create_map(*[F.lit(x) for kv in meaning.items() for x in kv])
    return df.withColumn("result", F.try_element_at(names, F.col(prediction).cast("int")))
