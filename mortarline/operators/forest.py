"""Random forests over folded rows.

A learner that cuts features into bins sees of a row its bins and its label only, so rows that share them are one
cell with a count, and a cell's draws with replacement are one Poisson number of that mean.  There are at most as
many cells as combinations of bins and classes, at any number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import prod

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from mortarline.functions.ranks import running_totals
from mortarline.session import cut_lineage

#: Bins of a feature, as many as Spark's learners have unless told otherwise; a bin is one byte.
BINS = 32
#: Cells that one task holds; four features and two classes have no more.
CELLS = BINS**4 * 2
#: Values, or stretches of values with as many rows each, that the cuts of a feature are looked for in.
FINE = 4096

#: (feature or -1 in a leaf, highest bin on the left, left child or number of the leaf, class shares of the leaves)
Tree = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def cuts(low: np.ndarray, high: np.ndarray, count: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Thresholds between ordered stretches of values, chosen as Spark's learners choose them between values.

    All of them where there are no more than ``bins`` stretches; else the ones that bring the rows so far nearest
    to the next multiple of a bin's share.
    """
    middle = (high[:-1] + low[1:]) / 2
    if len(low) <= bins:
        return middle
    share = count.sum() / bins
    found, target, so_far = [], share, count[0]
    for i in range(1, len(low)):
        before, so_far = so_far, so_far + count[i]
        if abs(before - target) < abs(so_far - target):
            found.append(middle[i - 1])
            target += share
    return np.array(found)


def feature_cuts(df: DataFrame, features: Sequence[str]) -> list[np.ndarray]:
    """Thresholds of every feature, from all rows; a feature's values are one row each after the first aggregation.

    Of a feature with over ``FINE`` values, values next to each other that make up a share of 1 in ``FINE`` of the
    rows are looked at as one stretch.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).cast("double").alias("v")) for i, c in enumerate(features)])
    values = cut_lineage(df.select(F.inline(pairs)).groupBy("f", "v").agg(F.count(F.lit(1)).alias("n")))
    many = [r["f"] for r in values.groupBy("f").count().where(F.col("count") > FINE).collect()]
    columns = ["f", F.col("v").alias("low"), F.col("v").alias("high"), "n"]
    found = [values.where(~F.col("f").isin(many)).select(*columns)]
    if many:
        totals = running_totals(values.where(F.col("f").isin(many)), ["f"], "v", ["n"])
        stretch = F.floor((F.col("cum_n") - F.col("n")) * FINE / F.col("all_n"))
        found.append(
            totals.groupBy("f", stretch.alias("_s")).agg(F.min("v").alias("low"), F.max("v").alias("high"), F.sum("n").alias("n")).drop("_s")
        )
    # at most FINE rows a feature
    got = pd.concat([part.toPandas() for part in found]).sort_values(["f", "low"])
    by_feature = [got[got["f"] == i] for i in range(len(features))]
    return [cuts(*(g[c].to_numpy(dtype="float64") for c in ("low", "high", "n"))) for g in by_feature]


def _bins(columns: Sequence[np.ndarray], cut: Sequence[np.ndarray]) -> np.ndarray:
    """Number of the combination of bins of each row; a value that equals a threshold lies below it."""
    code = np.zeros(len(columns[0]), np.int64)
    for x, c in zip(columns, cut, strict=True):
        code = code * (len(c) + 1) + np.searchsorted(c, x)
    return code


def _apart(code: np.ndarray, cut: Sequence[np.ndarray]) -> np.ndarray:
    """Bins of each feature, from the number of their combination."""
    return np.stack([b.astype(np.uint8) for b in np.unravel_index(code, [len(c) + 1 for c in cut])], axis=1)


def _doubles(batch: pa.RecordBatch, names: Sequence[str]) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False).astype("float64") for n in names]


def folded(df: DataFrame, features: Sequence[str], label: str, cut: Sequence[np.ndarray], classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(combination of bins, class, rows) of every cell, in order; a task sends a cell on once."""
    features, size = list(features), prod(len(c) + 1 for c in cut) * classes

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for b in batches:
            *columns, y = _doubles(b, [*features, label])
            cell, n = np.unique(_bins(columns, cut) * classes + y.astype(np.int64), return_counts=True)
            held[cell] += n
        cell = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(held[cell])], names=["cell", "n"])

    cells = df.select(*features, label).mapInArrow(fold, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    cells = cells.sort_values("cell")
    cell = cells["cell"].to_numpy()
    return cell // classes, cell % classes, cells["n"].to_numpy()


def _impurity(stats: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Gini impurity over the last axis."""
    return 1.0 - ((stats / np.maximum(total, 1)[..., None]) ** 2).sum(axis=-1)


def grown(
    bins: np.ndarray, label: np.ndarray, weight: np.ndarray, classes: int, depth: int, tried: int, rng: np.random.Generator
) -> Tree:
    """Classification tree of the weighted cells, level by level.

    Every node tries ``tried`` features drawn for it and takes the split with the largest gain in Gini impurity, if
    there is one.  Two leaves of one class are merged into their parent.
    """
    kept = weight > 0
    bins, label, weight = bins[kept], label[kept], weight[kept]
    width = int(bins.max(initial=0)) + 1
    node, n, first = np.zeros(len(label), np.int64), 1, 0
    levels = []
    for level in range(depth + 1):
        stats = np.bincount(node * classes + label, weight, n * classes).reshape(n, classes)
        total = stats.sum(axis=1)
        impurity = _impurity(stats, total)
        best, feature, cut = np.zeros(n), np.full(n, -1), np.zeros(n, np.int64)
        picks = rng.random((n, bins.shape[1])).argsort(axis=1)[:, :tried]
        for f in range(bins.shape[1]) if level < depth else ():
            nodes = np.flatnonzero((picks == f).any(axis=1) & (impurity > 0))
            place = np.full(n, -1)
            place[nodes] = np.arange(len(nodes))
            rows = np.flatnonzero(place[node] >= 0)
            if not len(rows) or width == 1:
                continue
            at = (place[node[rows]] * width + bins[rows, f]) * classes + label[rows]
            hist = np.bincount(at, weight[rows], len(nodes) * width * classes).reshape(len(nodes), width, classes)
            left = hist.cumsum(axis=1)[:, :-1]
            right = stats[nodes, None] - left
            lefts, rights = left.sum(axis=2), right.sum(axis=2)
            whole = total[nodes, None]
            gain = impurity[nodes, None] - lefts / whole * _impurity(left, lefts) - rights / whole * _impurity(right, rights)
            gain[(lefts == 0) | (rights == 0)] = 0.0
            split = gain.argmax(axis=1)
            gain = gain[np.arange(len(nodes)), split]
            better = gain > best[nodes]
            best[nodes[better]], feature[nodes[better]], cut[nodes[better]] = gain[better], f, split[better]
        inner = feature >= 0
        child = np.cumsum(inner) * 2 - 2
        levels.append((feature, cut, np.where(inner, first + n + child, -1), stats))
        rows = inner[node]
        bins, label, weight, node = bins[rows], label[rows], weight[rows], node[rows]
        node = child[node] + (bins[np.arange(len(node)), feature[node]] > cut[node])
        first, n = first + n, 2 * int(inner.sum())
        if not n:
            break
    feature, cut, left, stats = (np.concatenate([x[i] for x in levels]) for i in range(4))
    ends = np.cumsum([len(x[0]) for x in levels])
    says = stats.argmax(axis=1)
    for start, end in zip([0, *ends[:-1]][::-1], ends[::-1], strict=True):
        up = np.arange(start, end)[feature[start:end] >= 0]
        down = left[up]
        same = (feature[down] < 0) & (feature[down + 1] < 0) & (says[down] == says[down + 1])
        feature[up[same]] = -1
    return _packed(feature, cut, left, stats)


def _packed(feature: np.ndarray, cut: np.ndarray, left: np.ndarray, stats: np.ndarray) -> Tree:
    """The nodes that can be reached from the root, children of one node side by side."""
    order, level = [], np.array([0])
    while len(level):
        order.append(level)
        inner = level[feature[level] >= 0]
        level = np.stack([left[inner], left[inner] + 1], axis=1).ravel()
    order = np.concatenate(order)
    place = np.zeros(len(feature), np.int64)
    place[order] = np.arange(len(order))
    leaf = feature[order] < 0
    leaves = stats[order][leaf]
    to = np.where(leaf, np.cumsum(leaf) - 1, place[np.where(leaf, 0, left[order])])
    shares = leaves / np.maximum(leaves.sum(axis=1, keepdims=True), 1)
    return feature[order].astype(np.int16), cut[order].astype(np.int16), to.astype(np.int32), shares


def shares(bins: np.ndarray, tree: Tree) -> np.ndarray:
    """Class shares of the leaf that each row ends in."""
    feature, cut, to, share = tree
    at, live = np.zeros(len(bins), np.int64), np.arange(len(bins))
    while len(live := live[feature[at[live]] >= 0]):
        a = at[live]
        at[live] = to[a] + (bins[live, feature[a]] > cut[a])
    return share[to[at]]


def folded_forest(
    train: DataFrame, features: Sequence[str], label: str, classes: int, cut: Sequence[np.ndarray], trees: int, seed: int, depth: int
) -> list[Tree]:
    """Trees, each grown by one task from all cells, a cell drawn as often as its rows would be.

    Cells go out with the function, at most ``CELLS``; the trees come back, at most twice 2 ** depth nodes each.
    """
    code, y, n = folded(train, features, label, cut, classes)
    tried = int(np.ceil(np.sqrt(len(features))))

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = _apart(code, cut)
        for tree in (t for b in batches for t in b.column(0).to_pylist()):
            rng = np.random.default_rng([seed, tree])
            parts = grown(bins, y, rng.poisson(n), classes, depth, tried, rng)
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree]), *[pa.array([p.tobytes()], pa.binary()) for p in parts]], names=["tree", "feature", "cut", "to", "share"]
            )

    schema = "tree long, feature binary, cut binary, to binary, share binary"
    rows = sorted(train.sparkSession.range(0, trees, 1, trees).mapInArrow(grow, schema).collect())
    return [
        (np.frombuffer(r["feature"], np.int16), np.frombuffer(r["cut"], np.int16), np.frombuffer(r["to"], np.int32), np.frombuffer(r["share"]).reshape(-1, classes))
        for r in rows
    ]


def forest_votes(test: DataFrame, features: Sequence[str], cut: Sequence[np.ndarray], forest: list[Tree], classes: int) -> DataFrame:
    """Add ``prediction``, the class with the largest mean share, and ``confidence``, that share.

    Rows of a batch that share their bins are looked up once.
    """
    features = list(features)
    schema = StructType([*test.schema.fields, StructField("prediction", DoubleType()), StructField("confidence", DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = _doubles(b, features)
            if any(np.isnan(x).any() for x in columns):
                raise ValueError("a feature is null or NaN")
            code, back = np.unique(_bins(columns, cut), return_inverse=True)
            bins, votes = _apart(code, cut), np.zeros((len(code), classes))
            for tree in forest:
                votes += shares(bins, tree)
            votes /= len(forest)
            new = [pa.array(votes.argmax(axis=1)[back].astype("float64")), pa.array(votes.max(axis=1)[back])]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=schema.names)

    return test.mapInArrow(score, schema)
