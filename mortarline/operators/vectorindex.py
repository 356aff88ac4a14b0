"""Inverted-list vector index with product-quantised residuals: built once, kept as tables, searched by later jobs.

Vectors are scaled to length 1 and put into the list of the nearest centre; what is left is coded, one small codebook per
group of dimensions.  A row keeps its code, how far the decoded vector is off, and the vector itself for reranking.  Three
tables make an index: ``rows`` (partitioned by list), ``lists`` (centre, radius, rows) and ``books``.

Two bounds hold for every query q and follow from Cauchy-Schwarz: no row of a list with centre c and radius r scores above
``q.c + r``, and no row above the score of its decoded vector plus its error.  The first says which lists may be skipped once k
scores are known, the second which rows need no reranking.  ``probes`` limits the lists and makes the search approximate.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline.operators.retrieval import DIGITS, top_per_query
from mortarline.session import cut_lineage

#: Rows that centres and codebooks are fitted on (picked by hash), most lists, entries of a codebook, dimensions it covers.
SAMPLE, LISTS, ENTRIES, GROUP = 4096, 64, 64, 4
#: Rows of a list, and queries, that meet in one task.
LIST_ROWS, QUERY_ROWS = 20_000, 2_048


def _matrix(values: pd.Series) -> np.ndarray:
    m = np.stack(values.to_numpy()).astype("float64") if len(values) else np.zeros((0, 1))
    norm = np.sqrt((m * m).sum(1, keepdims=True))
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1)[None, :] - 2.0 * x @ centres.T).argmin(1)


def _fit(x: np.ndarray, k: int, seed: int, rounds: int = 10) -> np.ndarray:
    """Centres by Lloyd's rounds from rows picked by a seeded permutation."""
    centres = x[np.random.default_rng(seed).permutation(len(x))[: min(k, len(x))]].copy()
    for _ in range(rounds):
        near = _nearest(x, centres)
        for c in range(len(centres)):
            own = x[near == c]
            if len(own):
                centres[c] = own.mean(0)
    return centres


def build_index(docs: DataFrame, path: str, rows_per_list: int = 2_000) -> None:
    """Write the index of ``docs`` (doc_id, vector) below ``path``; every row with a vector is indexed.

    Vectors have one length and no nulls; rows without id or vector are left out.  An empty table gives an empty index.
    """
    spark = docs.sparkSession
    plain = cut_lineage(docs.where("doc_id IS NOT NULL AND vector IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("vector").cast("array<double>").alias("vector")))
    n = plain.count()
    sample = _matrix(plain.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).toPandas()["vector"])
    centres = _fit(sample, max(1, min(LISTS, ceil(n / rows_per_list), len(sample))), 1) if len(sample) else np.zeros((1, 1))
    width = centres.shape[1]
    cuts = [slice(i, min(i + GROUP, width)) for i in range(0, width, GROUP)]
    rest = sample - centres[_nearest(sample, centres)] if len(sample) else np.zeros((1, width))
    books = [_fit(rest[:, c], ENTRIES, 2 + i) for i, c in enumerate(cuts)]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            x = _matrix(b["vector"])
            at = _nearest(x, centres)
            left = x - centres[at]
            codes = np.stack([_nearest(left[:, c], book) for c, book in zip(cuts, books, strict=True)], 1)
            near = np.concatenate([book[codes[:, i]] for i, book in enumerate(books)], 1)
            yield pd.DataFrame({
                "doc_id": b["doc_id"], "list": at.astype("int32"), "code": [r.tobytes() for r in codes.astype("uint8")],
                "off": np.sqrt(((left - near) ** 2).sum(1)), "far": np.sqrt((left * left).sum(1)), "vector": list(x),
            })

    placed = plain.mapInPandas(place, "doc_id long, list int, code binary, off double, far double, vector array<double>")
    placed.write.partitionBy("list").parquet(f"{path}/rows")
    known = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "list int, centre array<double>")
    rows = spark.read.schema("doc_id long, code binary, off double, far double, vector array<double>, list int").parquet(f"{path}/rows")
    sizes = rows.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius"))
    known.join(sizes, "list").write.parquet(f"{path}/lists")
    entries = [(i, j, e.tolist()) for i, book in enumerate(books) for j, e in enumerate(book)]
    spark.createDataFrame(entries, "grp int, entry int, value array<double>").write.parquet(f"{path}/books")


def index_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_id long, code binary, off double, far double, vector array<double>, list int").parquet(f"{path}/rows")


def _scan(q: np.ndarray, q_ids: np.ndarray, floors: np.ndarray, centre: np.ndarray, books: list[np.ndarray], rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best rows per query by exact score; only rows whose decoded score plus error reaches the floor are scored."""
    x = np.stack(rows["vector"].to_numpy())
    codes = np.frombuffer(b"".join(rows["code"]), np.uint8).reshape(len(rows), -1)
    ids, off = rows["doc_id"].to_numpy(), rows["off"].to_numpy()
    # one table look-up per group of dimensions
    near = np.repeat((q @ centre)[:, None], len(rows), 1)
    at = 0
    for i, book in enumerate(books):
        part = q[:, at : at + book.shape[1]] @ book.T
        near += part[:, codes[:, i]]
        at += book.shape[1]
    top, low = near + off[None, :] + 1e-9, near - off[None, :] - 1e-9
    if len(rows) > k:
        # k rows surely reach this
        floors = np.maximum(floors, np.partition(low, len(rows) - k, axis=1)[:, len(rows) - k])
    i, j = np.nonzero(top >= floors[:, None] - 10.0**-DIGITS)
    score = np.round(np.einsum("ij,ij->i", q[i], x[j]), DIGITS)
    order = np.lexsort((ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    kept = np.arange(len(i)) - np.searchsorted(i, i) < k
    return pd.DataFrame({"query_id": q_ids[i[kept]], "doc_id": ids[j[kept]], "score": score[kept], "scored": np.bincount(i, minlength=len(q))[i[kept]]})


def search_index(spark: SparkSession, path: str, queries: DataFrame, k: int, probes: int | None = None) -> DataFrame:
    """Rows (query_id, doc_id, score, rank) of the ``k`` best cosines, ties by document, from the index below ``path``.

    ``queries`` (query_id, vector).  Without ``probes`` results are exact: the list of the nearest centre is searched first, then all
    lists that the bound leaves; with it the best ``probes`` lists are searched, and no more.  Scores are rounded to six digits.
    """
    lists = spark.read.parquet(f"{path}/lists").orderBy("list").toPandas()  # at most LISTS rows
    given = queries.where("query_id IS NOT NULL AND vector IS NOT NULL").select(F.col("query_id").cast("long").alias("query_id"), F.col("vector").cast("array<double>").alias("vector"))
    if not len(lists):
        return spark.createDataFrame([], "query_id long, doc_id long, score double, rank int")
    entries = spark.read.parquet(f"{path}/books").toPandas().sort_values(["grp", "entry"])  # ENTRIES per group
    books = [np.stack(g["value"].to_numpy()) for _, g in entries.groupby("grp")]
    centres, radius = np.stack(lists["centre"].to_numpy()), lists["radius"].to_numpy()
    numbers, blocks = lists["list"].to_numpy(), [ceil(n / LIST_ROWS) for n in lists["n"]]
    place = {int(v): i for i, v in enumerate(numbers)}
    rows = index_rows(spark, path)
    q_blocks = max(1, ceil(given.count() / QUERY_ROWS))

    def routed(first: bool, limit: int | None):
        """One row per query and list that it is to search, with the score it has to reach."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if not len(b):
                    continue
                q = _matrix(b["vector"])
                top = q @ centres.T + radius[None, :] + 1e-9
                order = np.argsort(-(q @ centres.T), axis=1)
                rank = np.argsort(order, axis=1)
                if limit is not None:
                    wanted = rank < limit
                elif first:
                    wanted = rank < 1
                else:
                    wanted = (rank >= 1) & (top >= b["floor"].to_numpy()[:, None] - 10.0**-DIGITS)
                i, j = np.nonzero(wanted)
                yield pd.DataFrame({"query_id": b["query_id"].to_numpy()[i], "vector": pd.Series(list(q[i]), dtype=object), "floor": b["floor"].to_numpy()[i], "list": numbers[j]})

        return run

    def searched(asked: DataFrame, first: bool, limit: int | None) -> DataFrame:
        sent = asked.mapInPandas(routed(first, limit), "query_id long, vector array<double>, floor double, list int")
        n_blocks = F.element_at(F.array(*[F.lit(b) for b in blocks]), F.element_at(F.map_from_arrays(F.array(*[F.lit(int(v)) for v in numbers]), F.array(*[F.lit(i + 1) for i in range(len(numbers))])), F.col("list")))
        left = sent.select("*", F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)).cast("int").alias("q"), F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("d"))
        right = rows.select("*", F.pmod(F.xxhash64("doc_id"), n_blocks).cast("int").alias("d"), F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q"))

        def run(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
            if not len(q) or not len(x):
                return pd.DataFrame({"query_id": [], "doc_id": [], "score": [], "scored": []}).astype({"query_id": "int64", "doc_id": "int64", "score": "float64", "scored": "int64"})
            centre, out = centres[place[int(x["list"].iloc[0])]], []
            vectors = np.stack(q["vector"].to_numpy())
            for low in range(0, len(q), 64):
                s = slice(low, low + 64)
                out.append(_scan(vectors[s], q["query_id"].to_numpy()[s], q["floor"].to_numpy()[s], centre, books, x, k))
            return pd.concat(out, ignore_index=True)

        keys = ["list", "q", "d"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, "query_id long, doc_id long, score double, scored long")

    asked = given.withColumn("floor", F.lit(-2.0))
    if probes is not None:
        return top_per_query(searched(asked, True, probes).drop("scored"), k)
    first = cut_lineage(top_per_query(searched(asked, True, None).drop("scored"), k))
    floors = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    more = given.join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(-2.0))).select("query_id", "vector", "floor")
    return top_per_query(first.drop("rank").unionByName(searched(more, False, None).drop("scored")), k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Rows (query_id, recall): the share of the exact results (query_id, doc_id) that were found."""
    hits = exact.select("query_id", "doc_id").join(found.select("query_id", "doc_id", F.lit(1).alias("hit")), ["query_id", "doc_id"], "left")
    return hits.groupBy("query_id").agg((F.count("hit") / F.count(F.lit(1))).alias("recall"))
