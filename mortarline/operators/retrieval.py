"""Chunking, keyword, vector and hybrid retrieval, context and training-example assembly.

Vector search cuts documents and queries into blocks of bounded size at every scale; a
pair of blocks is a matrix product of which only the k best rows per query leave the task.
Keyword search joins the counts of query terms with the queries that have them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mortarline.functions.scalars import context_block, message_json, words
from mortarline.session import cut_lineage

DIGITS = 6
#: Query terms of a keyword search that are broadcast; more are joined by a shuffle.
BROADCAST_TERMS = 500_000
#: (query, document) pairs whose scores one task of a keyword search holds at once.
TASK_PAIRS = 200_000


def chunk(docs: DataFrame, key: str, size: int, overlap: int, text: str = "text") -> DataFrame:
    """Fixed-size chunks of whitespace words with overlap; a tail the previous chunk already
    holds is dropped."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be in [0, size)")
    step = size - overlap
    tokens = F.filter(F.split(F.col(text), r"\s+"), lambda w: w != "")
    split = docs.select(key, F.explode(F.array(tokens)).alias("_t")).where(F.size("_t") > 0)
    last = F.greatest(F.lit(0), F.size("_t") - overlap - 1)
    starts = F.sequence(F.lit(0), last, F.lit(step))
    return split.select(
        key, F.posexplode(F.transform(starts, lambda s: F.slice("_t", s + 1, size))).alias("chunk_no", "_c")
    ).select(key, "chunk_no", F.size("_c").alias("n_tokens"), F.array_join("_c", " ").alias("chunk"))


def top_per_query(scored: DataFrame, k: int, query: str = "query_id", doc: str = "doc_id") -> DataFrame:
    """Best ``k`` rows per query, ties by document; pre-limited per task by the rank filter."""
    w = Window.partitionBy(query).orderBy(F.desc("score"), doc)
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _best(scores: np.ndarray, ids: np.ndarray, query_ids: np.ndarray, k: int) -> pd.DataFrame:
    """Long frame of the k best rows per column of ``scores``, ties by id."""
    scores = np.round(scores, DIGITS)
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k, axis=0)[len(scores) - k]
        row, col = np.nonzero(scores >= cut)
    else:
        row, col = map(np.ravel, np.indices(scores.shape))
    order = np.lexsort((ids[row], -scores[row, col], col))
    row, col = row[order], col[order]
    first = np.searchsorted(col, col)
    keep = np.arange(len(col)) - first < k
    row, col = row[keep], col[keep]
    return pd.DataFrame({"query_id": query_ids[col], "doc_id": ids[row], "score": scores[row, col]})


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


_SCORED = "query_id long, doc_id long, score double"


def vector_topk(
    docs: DataFrame, queries: DataFrame, k: int, block_rows: int = 20_000, query_rows: int = 4_096
) -> DataFrame:
    """Exact cosine top-k: ``docs`` (doc_id, vector), ``queries`` (query_id, vector).

    Both sides are cut into blocks by hash, and each pair of blocks is one group of bounded
    size, whose k best rows per query go on.
    """
    d_blocks = ceil(docs.count() / block_rows) or 1
    q_blocks = ceil(queries.count() / query_rows) or 1

    def blocks(df: DataFrame, key: str, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return df.select(
            key,
            "vector",
            F.pmod(F.xxhash64(key), F.lit(n_own)).cast("long").alias(own),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_other - 1).cast("long"))).alias(other),
        ).groupBy("d", "q")

    def pair(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "doc_id": [], "score": []})
        a, b = (_unit(np.stack(f["vector"].to_numpy()).astype("float64")) for f in (left, right))
        ids, out = left["doc_id"].to_numpy(), []
        for lo in range(0, len(b), 256):
            part = right["query_id"].to_numpy()[lo : lo + 256]
            out.append(_best(a @ b[lo : lo + 256].T, ids, part, k))
        return pd.concat(out, ignore_index=True)

    left = blocks(docs, "doc_id", "d", d_blocks, "q", q_blocks)
    right = blocks(queries, "query_id", "q", q_blocks, "d", d_blocks)
    return top_per_query(left.cogroup(right).applyInPandas(pair, _SCORED), k)


def _idf(n: Column, df: Column) -> Column:
    return F.ln(1.0 + (n - df + 0.5) / (df + 0.5))


def keyword_topk(docs: DataFrame, queries: DataFrame, k: int = 3, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """BM25 top-k: ``docs`` (doc_id, text), ``queries`` (query_id, text).

    One pass over the documents collects the document frequency of query terms and the
    average length, a second one deals the texts by document.  The counts of query terms and the sums per
    (query, document) are then made where they lie, and only each task's best rows of a query are shuffled again.
    The number of those tasks follows the documents times the queries, so what one holds does not grow with the tables.
    """
    tokens = docs.select("doc_id", F.explode(F.array(words(F.col("text")))).alias("t"))
    wanted = queries.select("query_id", F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    shape = tokens.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("t")).alias("avg")).collect()[0]
    n_docs, avg_len = shape["n"], shape["avg"] or 1.0
    # words that no query has are dropped where they are read, as long as the queries' words fit into a broadcast
    wanted = cut_lineage(wanted)
    vocabulary = cut_lineage(wanted.select("term").distinct())

    def sized(table: DataFrame, rows: int) -> DataFrame:
        return F.broadcast(table) if rows <= BROADCAST_TERMS else table

    n_terms, n_wanted = vocabulary.count(), wanted.count()
    n_queries = wanted.agg(F.count_distinct("query_id")).first()[0]
    tasks = ceil(n_docs * n_queries / TASK_PAIRS) or 1
    vocabulary, wanted = sized(vocabulary, n_terms), sized(wanted, n_wanted)
    terms = tokens.select(F.explode(F.array_distinct("t")).alias("term"))
    known = terms.join(vocabulary, "term", "left_semi")
    idf = known.groupBy("term").agg(_idf(F.lit(float(n_docs)), F.count(F.lit(1))).alias("idf"))
    # texts are dealt, not their words, which would fill a task's memory on the way to many others
    dealt = docs.select("doc_id", "text").repartition(tasks, "doc_id").select("doc_id", F.explode(F.array(words(F.col("text")))).alias("t"))
    found = dealt.select("doc_id", F.size("t").alias("len"), F.explode("t").alias("term")).join(vocabulary, "term", "left_semi")
    if n_terms > BROADCAST_TERMS:
        found = found.repartition(tasks, "doc_id")
    tf = (
        found.groupBy("doc_id", "term")
        .agg(F.count(F.lit(1)).alias("tf"), F.first("len").alias("len"))
        .join(sized(idf, n_terms), "term")
    )
    norm = F.lit(k1) * (F.lit(1 - b) + F.lit(b) * F.col("len") / F.lit(avg_len))
    gain = F.col("idf") * F.col("tf") * F.lit(k1 + 1) / (F.col("tf") + norm)
    scored = (
        tf.withColumn("gain", gain)
        .join(wanted, "term")
        .groupBy("query_id", "doc_id")
        .agg(F.round(F.sum("gain"), DIGITS).alias("score"))
    )
    return top_per_query(scored, k)


def hybrid_topk(rankings: Sequence[DataFrame], k: int, constant: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of several (query_id, doc_id, rank) tables."""
    merged = rankings[0].select("query_id", "doc_id", "rank")
    for r in rankings[1:]:
        merged = merged.unionByName(r.select("query_id", "doc_id", "rank"))
    fused = merged.groupBy("query_id", "doc_id").agg(
        F.round(F.sum(F.lit(1.0) / (F.lit(constant) + F.col("rank"))), 9).alias("score")
    )
    return top_per_query(fused, k)


def assemble_context(
    ranked: DataFrame, passages: DataFrame, queries: DataFrame, floor: float = 0.0, k: int = 3,
    separator: str = "\n---\n", empty: str = "No relevant specs found.",
) -> DataFrame:
    """Formatted context per query from its ranked passages; at most ``k`` passages each.

    Passages (doc_id, title, style, content); a missing score counts as 1.
    """
    kept = ranked.where((F.coalesce("score", F.lit(1.0)) >= floor) & (F.col("rank") <= k))
    blocks = kept.join(passages, "doc_id").select(
        "query_id",
        F.struct("rank", context_block(F.col("title"), F.col("style"), F.col("content")).alias("text")).alias("b"),
    )
    joined = blocks.groupBy("query_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("b")), lambda x: x["text"]), separator).alias("context")
    )
    return queries.select("query_id").join(joined, "query_id", "left").select(
        "query_id", F.coalesce("context", F.lit(empty)).alias("context")
    )


def turn_examples(turns: DataFrame, system: str) -> DataFrame:
    """One (system, user, assistant) training line per user turn answered by the next turn.

    Joined on (conv_id, turn), so one long conversation spreads over many tasks.
    """
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("user"))
    answered = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("assistant")
    )
    return asked.join(answered, ["conv_id", "turn"]).select(
        "conv_id", "turn", message_json(F.lit(system), F.col("user"), F.col("assistant")).alias("line")
    )


def spec_examples(specs: DataFrame, system: str, prompt: str = "prompt", spec: str = "spec") -> DataFrame:
    """Training lines whose assistant turn is the nested spec as a JSON string."""
    others = [c for c in specs.columns if c not in (prompt, spec)]
    return specs.select(*others, message_json(F.lit(system), F.col(prompt), F.to_json(spec)).alias("line"))


def upsert(current: DataFrame, changes: DataFrame, key: str, version: str) -> DataFrame:
    """Latest row per key; ``max_by`` combines map-side, so a hot key does not pile up."""
    both = current.unionByName(changes)
    rest = [c for c in both.columns if c != key]
    return both.groupBy(key).agg(F.max_by(F.struct(*rest), version).alias("r")).select(key, "r.*")
