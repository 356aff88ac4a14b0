"""Exact top-k by inner product with cover trees over queries and data together.

Pivots come from a cover tree over a bounded sample: a fine net of them splits the data, the coarser
net of their parents the queries.  All rows are assigned to pivots, and every part knows its covering
radius.  For a query group with centre ``c`` and radius ``s`` and a data part with centre ``p`` and radius ``r`` no score exceeds
``c.p + s |p| + r |c| + s r``.  A first round searches each group's own parts, which gives it a worst k-th
score; a second one searches just the parts whose bound reaches it.  In a task a group and a block
of a part are searched by a dual traversal of two trees of the same kind, pruned by the same bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mortarline.session import cut_lineage

#: Rows of the sample that pivots are fitted on, and most pivots; both bound what the driver holds.
SAMPLE, PIVOTS = 2048, 48
#: Most rows of a query group's or data part's block in one task.
QUERY_BLOCK, DATA_BLOCK = 4096, 16384
#: Children of a tree node, and rows of a leaf.
ARITY, LEAF = 12, 96


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * (x @ y.T)
    return np.sqrt(np.maximum(d, 0.0))


def greedy_net(x: np.ndarray, most: int) -> np.ndarray:
    """Indices of centres, each the farthest from those before it; the first is the row nearest the mean."""
    first = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    picked, far = [first], _distances(x, x[first : first + 1])[:, 0]
    while len(picked) < min(most, len(x)) and far.max() > 0:
        picked.append(int(far.argmax()))
        far = np.minimum(far, _distances(x, x[picked[-1] :][:1])[:, 0])
    return np.array(picked)


class Tree:
    """Cover tree: greedy nets of nets, every node with its centre, covering radius and rows."""

    def __init__(self, x: np.ndarray, rows: np.ndarray):
        own = x[rows]
        self.centre = own[((own - own.mean(0)) ** 2).sum(1).argmin()]
        self.norm = float(np.sqrt((self.centre**2).sum()))
        self.radius = float(_distances(own, self.centre[None])[:, 0].max()) * (1 + 1e-9) + 1e-6
        self.rows, self.children = rows, []
        if len(rows) > LEAF and self.radius > 1e-3:
            net = greedy_net(own, ARITY)
            near = _distances(own, own[net]).argmin(1)
            if len(net) > 1:
                self.children = [Tree(x, rows[near == i]) for i in range(len(net)) if (near == i).any()]


def bound(a: Tree, b: Tree) -> float:
    top = float(a.centre @ b.centre) + a.radius * b.norm + b.radius * a.norm + a.radius * b.radius
    return top + 1e-9 * abs(top) + 1e-3


def dual_search(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scores, positions) of the k best rows of ``x`` per query, ties to the smaller id.

    ``x_ids`` ascend.  Rows of a query's own id are left out; ``floors`` are k-th scores found elsewhere.
    Missing places have position -1.  Scores are exact while products stay below 2**53.
    """
    scores = np.full((len(q), k), -np.inf)
    places = np.full((len(q), k), -1, np.int64)
    if not len(q) or not len(x):
        return scores, places
    stack = [(Tree(q, np.arange(len(q))), Tree(x, np.arange(len(x))))]
    while stack:
        a, b = stack.pop()
        if bound(a, b) < np.maximum(scores[a.rows, -1], floors[a.rows]).min():
            continue
        if a.children and (not b.children or a.radius >= b.radius):
            stack += [(c, b) for c in a.children]
        elif b.children:
            # the most promising part is searched first
            stack += sorted(((a, c) for c in b.children), key=lambda p: bound(*p))
        else:
            found = q[a.rows] @ x[b.rows].T
            found[q_ids[a.rows][:, None] == x_ids[b.rows][None, :]] = -np.inf
            worst = np.maximum(scores[a.rows, -1], floors[a.rows])
            better = ((found >= worst[:, None]) & np.isfinite(found)).any(1)
            if better.any():
                rows = a.rows[better]
                s = np.concatenate([scores[rows], found[better]], 1)
                p = np.concatenate([places[rows], np.broadcast_to(b.rows, (len(rows), len(b.rows)))], 1)
                order = np.lexsort((p, -s), axis=-1)[:, :k]
                scores[rows], places[rows] = np.take_along_axis(s, order, 1), np.take_along_axis(p, order, 1)
    places[~np.isfinite(scores)] = -1
    return scores, places


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "vector") -> DataFrame:
    """Rows (query_id, rank, id, score): the k best rows per query by integer inner product.

    ``vector_col`` holds arrays of whole numbers.  Ids are whole numbers; rows without an id or vector, or with a null in it, take
    no part.  Every row but those of the query's own id is a candidate; ties go to the smaller id, and
    candidates that repeat appear repeatedly.  Queries that repeat count once; different vectors under
    one query id are answered each.  Shorter vectors count as filled up with zeros.  With fewer
    candidates than k all are returned; without queries or rows the result is empty.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<bigint>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = cut_lineage(rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull())))
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    out = "query_id long, print long, id long, score long"
    spark = rows.sparkSession
    sample = rows.orderBy(F.xxhash64("id", "v"), "id").limit(SAMPLE).toPandas()
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    points = _matrix(sample["v"], width)
    fine = points[greedy_net(points, PIVOTS)]
    n_queries = rows.where("q").count()
    coarse = fine[greedy_net(fine, max(1, min(PIVOTS, n_queries // QUERY_BLOCK + 1)))]
    parent = _distances(fine, coarse).argmin(1)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = _matrix(b["v"], width)
            d = _distances(x, fine)
            part = d.argmin(1)
            group = parent[part]
            apart = np.sqrt(((x - coarse[group]) ** 2).sum(1))
            yield b.assign(part=part.astype("int32"), far=d[np.arange(len(b)), part], grp=group.astype("int32"), apart=apart)

    placed = cut_lineage(rows.mapInPandas(assign, "id long, v array<bigint>, q boolean, part int, far double, grp int, apart double"))
    # at most PIVOTS rows each
    parts = {r["part"]: (r["n"], r["far"]) for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()}
    groups = {
        r["grp"]: (r["n"], r["apart"])
        for r in placed.where("q").groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.max("apart").alias("apart")).collect()
    }
    queries = placed.where("q").select("id", "v", "grp").distinct()

    def blocks(n: int, most: int) -> int:
        return -(-n // most)

    def dealt(df: DataFrame, key: str, partners: dict[int, list[tuple]], own: dict[int, int]) -> DataFrame:
        """Each row once per partner block; a row's own block comes from its hash."""
        if not partners:
            return df.where("false").select("*", F.lit("").alias("other"), F.lit(0).alias("own"))
        table = F.create_map(*[F.lit(x) for a, bs in partners.items() for x in (a, bs)])
        sizes = F.create_map(*[F.lit(x) for a in partners for x in (a, own[a])])
        return df.where(F.col(key).isin(list(partners))).select(
            "*", F.explode(F.try_element_at(table, key)).alias("other"),
            F.pmod(F.xxhash64("id", "v"), F.try_element_at(sizes, F.col(key))).cast("int").alias("own"),
        )

    def searched(pairs: set[tuple[int, int]], floors: DataFrame | None) -> DataFrame:
        q_blocks = {g: blocks(n, QUERY_BLOCK) for g, (n, _) in groups.items()}
        d_blocks = {p: blocks(n, DATA_BLOCK) for p, (n, _) in parts.items()}
        to_parts: dict[int, list[str]] = {}
        to_groups: dict[int, list[str]] = {}
        for g, p in sorted(pairs):
            to_parts.setdefault(g, []).extend(f"{p}.{i}" for i in range(d_blocks[p]))
            to_groups.setdefault(p, []).extend(f"{g}.{i}" for i in range(q_blocks[g]))
        asked = queries.withColumn("print", F.xxhash64("v"))
        if floors is None:
            asked = asked.withColumn("floor", F.lit(None).cast("double"))
        else:
            known = floors.select(F.col("query_id").alias("_q"), F.col("print").alias("_p"), F.col("kth").alias("floor"))
            asked = asked.join(known, (F.col("id") == F.col("_q")) & (F.col("print") == F.col("_p")), "left").drop("_q", "_p")
        left = dealt(asked, "grp", to_parts, q_blocks).select(
            F.concat_ws(".", F.col("grp").cast("string"), F.col("own").cast("string")).alias("qb"), F.col("other").alias("db"),
            F.col("id").alias("q_id"), F.col("v").alias("q_v"), "print", "floor",
        )
        right = dealt(placed.select("id", "v", "part"), "part", to_groups, d_blocks).select(
            F.col("other").alias("qb"), F.concat_ws(".", F.col("part").cast("string"), F.col("own").cast("string")).alias("db"),
            F.col("id").alias("x_id"), F.col("v").alias("x"),
        )

        def search(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
            x = x.sort_values("x_id", kind="stable")
            ids = x["x_id"].to_numpy()
            floor = q["floor"].fillna(-np.inf).to_numpy()
            scores, places = dual_search(_matrix(q["q_v"], width), q["q_id"].to_numpy(), _matrix(x["x"], width), ids, k, floor)
            r, c = np.nonzero(places >= 0)
            return pd.DataFrame({
                "query_id": q["q_id"].to_numpy()[r], "print": q["print"].to_numpy()[r], "id": ids[places[r, c]], "score": scores[r, c].astype("int64"),
            })

        return left.groupBy("qb", "db").cogroup(right.groupBy("qb", "db")).applyInPandas(search, out)

    def best(df: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id", "print").orderBy(F.col("score").desc(), "id")
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    home = {(g, p) for g in groups for p in parts if parent[p] == g}
    first = cut_lineage(best(searched(home, None)))
    kth = first.where(F.col("rank") == k).select("query_id", "print", F.col("score").cast("double").alias("kth"))
    asked = queries.select(F.col("id").alias("query_id"), F.xxhash64("v").alias("print"), "grp").join(kth, ["query_id", "print"], "left")
    worst = {r["grp"]: r["kth"] for r in asked.groupBy("grp").agg(F.min(F.coalesce("kth", F.lit(float("-inf")))).alias("kth")).collect()}
    norms = np.sqrt((fine**2).sum(1)), np.sqrt((coarse**2).sum(1))
    rest = set()
    for g, (_, s) in groups.items():
        for p, (_, r) in parts.items():
            top = coarse[g] @ fine[p] + s * norms[0][p] + r * norms[1][g] + s * r
            if (g, p) not in home and top + 1e-6 * abs(top) + 1e-3 >= worst[g]:
                rest.add((g, p))
    both = first.drop("rank").unionByName(searched(rest, kth)) if rest else first.drop("rank")
    return best(both).select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
