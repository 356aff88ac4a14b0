"""Near duplicates by consistent weighted sampling over TF-IDF shingles.

Shingles are windows of five words (a shorter text is one shingle).  A shingle weighs its count in the
text times ``1 + ln(N / df) / ln(1 / floor)``, where document frequencies under ``floor * N`` count as that;
so rare shingles weigh 2, one found in all documents 1.  Only shingles at or above the floor need a
table, which has at most (mean shingles of a document) / floor entries at any size of the corpus.  They
are found exactly: a batch names those that reach half the floor within it, those whose named counts
reach half the floor of all documents are candidates, and a second pass counts them everywhere.

Improved consistent weighted sampling (Ioffe 2010) draws ``BANDS * ROWS`` samples per text, whose agreement
estimates the weighted Jaccard similarity.  Texts that agree in a whole band are candidates.  Pairs are
verified on the texts with the exact similarity.  To avoid all pairs of a bucket, members are first held
against one of them; links join texts into components, and afterwards the candidate pairs that
lie across two components are verified as well, inside tasks that return links only, but for those that
their distances to that one rule out.  So components are the same as over all candidate pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mortarline.functions.graph import connected_components
from mortarline.llm.suspects import likely_among
from mortarline.llm.text import by_batch, bytes_of, mixed, word_digests
from mortarline.session import cut_lineage

WORDS, THRESHOLD, FLOOR = 5, 0.8, 0.01
BANDS, ROWS = 14, 4
#: Pairs whose samples agree less are not verified; at similarity 0.8 that is 4 standard deviations off.
LEAST_AGREEING = 0.58
#: Shingles whose samples are drawn at once, and texts of one side of a block.
BLOCK, BLOCK_TEXTS = 2048, 400

_RNG = np.random.default_rng(20240101)
_FACTORS = _RNG.integers(0, 2**63, (2, BANDS * ROWS)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = 1 << 16


def _gamma_quantiles() -> np.ndarray:
    """Quantiles of the gamma distribution of shape 2 at the middles of _STEPS equal shares."""
    p = (np.arange(_STEPS) + 0.5) / _STEPS
    x = np.sqrt(2 * p) + p
    for _ in range(60):
        x = np.clip(x + (p - (1 - (1 + x) * np.exp(-x))) / np.maximum(x * np.exp(-x), 1e-12), 1e-6, 40)
    return x.astype(np.float32)


_MIX = _RNG.integers(0, 2**63, WORDS).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle digests (uint64, ascending) and their counts."""
    h = word_digests(text)
    if not len(h):
        return h, np.array([], np.int64)
    n = max(1, len(h) - WORDS + 1)
    out = np.full(n, len(h) if len(h) < WORDS else 0, np.uint64)
    for k in range(min(WORDS, len(h))):
        out += h[k : k + n] * _MIX[k]
    return np.unique(mixed(out), return_counts=True)


class Weights:
    """TF-IDF weights from the table of frequent shingles."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, documents: int):
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        rarity = np.log(max(documents, 1) / np.maximum(counts[order], 1)) / math.log(1 / FLOOR)
        self.rarity = np.clip(rarity, 0.0, 1.0)

    def of(self, h: np.ndarray, n: np.ndarray) -> np.ndarray:
        rarity = np.ones(len(h))
        if len(self.hashes) and len(h):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            rarity = np.where(self.hashes[at] == h, self.rarity[at], 1.0)
        return n * (1.0 + rarity)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of (digests, weights), digests ascending; 1 for two empty texts."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = np.minimum(a[1][i], b[1][j]).sum() if len(both) else 0.0
    total = a[1].sum() + b[1].sum() - low
    return float(low / total) if total else 1.0


class Sampler:
    def __init__(self):
        gamma = _gamma_quantiles()
        self.r, self.log_c = gamma, np.log(gamma)

    def draw(self, h: np.ndarray, w: np.ndarray) -> np.ndarray:
        """One int32 per sample: a digest of the drawn (shingle, level)."""
        k = BANDS * ROWS
        if not len(h):
            return np.zeros(k, np.int32)
        best = np.full(k, np.inf, np.float32)
        out = np.zeros(k, np.uint64)
        for at in range(0, len(h), BLOCK):
            e, log_w = h[at : at + BLOCK, None], np.log(w[at : at + BLOCK, None]).astype(np.float32)
            u = e * _FACTORS[0]
            u ^= u >> np.uint64(32)
            u *= _FACTORS[1]
            r = self.r[(u & np.uint64(0xFFFF)).astype(np.uint16)]
            log_c = self.log_c[((u >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.uint16)]
            beta = (u >> np.uint64(32)).astype(np.float32) * np.float32(2.0**-32)
            t = np.floor(log_w / r + beta)
            a = log_c - r * (t - beta + 1)
            i = a.argmin(axis=0)
            cols = np.arange(k)
            value = a[i, cols]
            better = value < best
            best = np.where(better, value, best)
            drawn = mixed(e[i, 0] + t[i, cols].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            out = np.where(better, drawn, out)
        return (out & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)


def frequent_shingles(texts: DataFrame, floor: float = FLOOR) -> tuple[np.ndarray, np.ndarray, int]:
    """(digests, document frequencies, documents): all shingles in at least ``floor`` of the documents.

    The table that reaches the driver is bounded by 2 * (mean shingles of a document) / floor rows.
    """

    def name(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = [shingles(t)[0] for t in bytes_of(batch.column("text"))]
        h, n = np.unique(np.concatenate(own), return_counts=True)
        keep = n >= floor / 2 * len(own)
        return pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)), pa.array(n[keep])], ["h", "n"])

    documents = texts.count()
    named = texts.select("text").mapInArrow(by_batch(name), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    found = named.where(F.col("n") >= floor / 2 * documents).select("h").toPandas()["h"].to_numpy()
    candidates = np.sort(found.astype(np.int64).view(np.uint64))
    if not len(candidates):
        return candidates, np.array([], np.int64), documents

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(candidates), np.int64)
        for batch in batches:
            for t in bytes_of(batch.column("text")):
                h = shingles(t)[0]
                if len(h):
                    at = np.minimum(np.searchsorted(candidates, h), len(candidates) - 1)
                    total[at[candidates[at] == h]] += 1
        hit = total > 0
        yield pa.RecordBatch.from_arrays([pa.array(candidates[hit].view(np.int64)), pa.array(total[hit])], ["h", "n"])

    exact = texts.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    table = exact.where(F.col("n") >= floor * documents).toPandas()
    return table["h"].to_numpy().astype(np.int64).view(np.uint64), table["n"].to_numpy().astype(np.int64), documents


def _compared(pairs: DataFrame, texts: DataFrame, weights: Weights, id_type: str) -> DataFrame:
    """Rows (a, b, similarity): the exact weighted Jaccard similarity of the pairs' texts."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def weighed(t):
            h, n = shingles(t)
            return h, weights.of(h, n)

        for batch in batches:
            last, other, found = None, None, []
            for ta, tb in zip(bytes_of(batch.column("ta")), bytes_of(batch.column("tb")), strict=True):
                if tb != last:  # rows of one smallest id often follow each other
                    last, other = tb, weighed(tb)
                found.append(similarity(weighed(ta), other))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], ["a", "b", "similarity"])

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    return joined.mapInArrow(verify, f"a {id_type}, b {id_type}, similarity double")


def _across(group: DataFrame, far: DataFrame, signs: DataFrame, texts: DataFrame, weights: Weights, id_type: str) -> DataFrame:
    """Links (a, b) between texts of one ``group`` (head, rep, label) that lie in different components.

    Texts outside a head's largest component meet all others of that head, block by block.  A block
    only returns links: pairs are tried by falling agreement of their samples, and not at all if they agree in
    too few, if links already join them, or if their distances to the head (``far``, where known) differ by more than a link
    allows, since one minus the similarity is a metric.
    """
    spread = group.groupBy("head").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("head")
    open_ = cut_lineage(group.join(spread, "head"))
    largest = (
        open_.groupBy("head", "label").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("head").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("all"))
        .withColumn("outer", F.ceil((F.col("all") - F.col("most")) / BLOCK_TEXTS).cast("int"))
        .withColumn("inner", F.ceil(F.col("all") / BLOCK_TEXTS).cast("int"))
        .select("head", "main", "outer", "inner")
    )
    known = open_.join(largest, "head").join(far, ["head", "rep"], "left").join(signs, "rep").join(texts, "rep")
    known = known.withColumn("far", F.when(F.col("rep") == F.col("head"), 0.0).otherwise(F.col("far")))

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        block = F.pmod(F.xxhash64("rep"), F.col(own)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return df.select("head", block.alias(own), copies.alias(other), "rep", "label", "far", "sign", "text", "main")

    left, right = dealt(known.where("label <> main"), "outer", "inner"), dealt(known, "inner", "outer")
    right = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns])
    plain = [c.removeprefix("r_") for c in right.columns]

    def search(outer: pd.DataFrame, inner: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(outer) and len(inner):
            found = _block_links(outer, inner.set_axis(plain, axis=1), weights)
        return pd.DataFrame(found, columns=["a", "b"])

    keys = ["head", "outer", "inner"]
    return left.groupBy(*keys).cogroup(right.groupBy(*[f"r_{k}" for k in keys])).applyInPandas(search, f"a {id_type}, b {id_type}").distinct()


def _block_links(outer: pd.DataFrame, inner: pd.DataFrame, weights: Weights) -> list[tuple]:
    left, right = np.stack(outer["sign"].to_numpy()), np.stack(inner["sign"].to_numpy())
    agree = np.stack([(row == right).sum(1) for row in left])
    la, lb, main = outer["label"].to_numpy(), inner["label"].to_numpy(), outer["main"].to_numpy()[0]
    a, b = outer["rep"].to_numpy(), inner["rep"].to_numpy()
    # two texts that are both outside the largest component meet twice, and are tried once
    wanted = (la[:, None] != lb[None, :]) & ((lb == main)[None, :] | (a[:, None] > b[None, :]))
    apart = np.abs(outer["far"].to_numpy(np.float64)[:, None] - inner["far"].to_numpy(np.float64)[None, :])
    wanted &= ~(apart > 1 - THRESHOLD + 1e-9) & (agree >= math.ceil(LEAST_AGREEING * BANDS * ROWS))
    i, j = np.nonzero(wanted)
    order = np.argsort(-agree[i, j], kind="stable")
    root: dict = {}

    def top(x):
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    weighed: tuple[dict, dict] = ({}, {})

    def of(side: int, k: int):
        if k not in weighed[side]:
            h, n = shingles(((outer, inner)[side]["text"].iloc[k] or "").encode())
            weighed[side][k] = h, weights.of(h, n)
        return weighed[side][k]

    found = []
    for x, y in zip(i[order].tolist(), j[order].tolist(), strict=True):
        p, q = top(la[x]), top(lb[y])
        if p != q and similarity(of(0, x), of(1, y)) >= THRESHOLD - 1e-12:
            root[p] = q
            found.append((a[x], b[y]))
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, class_id), one per document; ``class_id`` is the smallest id of its class.

    Texts with the same words in the same order (A-Z lower-cased, ASCII white space apart) are one text;
    texts without words, null ones too, are alike.  Different texts are linked at a weighted Jaccard
    similarity of 0.8 or more, and classes are the components of links.  Rows without an id have a null class and take
    no part.  An id names one text; where its rows differ, the smallest text is compared exactly, and the id joins the
    classes of all of them.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    known = rows.where(F.col("id").isNotNull())
    hashes, counts, documents = frequent_shingles(known)
    weights = Weights(hashes, counts, documents)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for batch in batches:
            prints, signs = [], []
            for t in bytes_of(batch.column("text")):
                prints.append(xxhash.xxh3_128_digest(b" ".join(t.lower().split())))
                h, n = shingles(t)
                signs.append(sampler.draw(h, weights.of(h, n)))
            flat = pa.array(np.concatenate(signs), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(signs) + 1) * BANDS * ROWS, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints, pa.binary()), lists], ["id", "print", "sign"])

    signed = cut_lineage(known.mapInArrow(sign, f"id {id_type}, print binary, sign array<int>"))
    alike = signed.groupBy("print").agg(F.min("id").alias("rep"), F.first("sign").alias("sign"))
    alike = cut_lineage(alike)
    keys = F.array(*[F.xxhash64(F.lit(b), *[F.col("sign")[b * ROWS + i] for i in range(ROWS)]) for b in range(BANDS)])
    banded = alike.select("rep", F.explode(keys).alias("key"))
    # a bucket is held first against the text that has most company over all its bands, likely the one
    # that the others were made from
    counts = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    crowd = cut_lineage(banded.join(counts, "key"))
    company = crowd.groupBy(F.col("rep").alias("_r")).agg(F.sum("n").alias("company"))
    ranked = cut_lineage(crowd.join(company, F.col("rep") == F.col("_r")).select("key", "rep", "company"))
    heads = ranked.groupBy("key").agg(F.min_by("rep", F.struct(-F.col("company"), "rep")).alias("head"))
    members = cut_lineage(ranked.join(heads, "key").select("key", "rep", "head"))

    agreeing = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda x: x)) >= math.ceil(LEAST_AGREEING * BANDS * ROWS)

    def promising(pairs: DataFrame) -> DataFrame:
        sa = alike.select(F.col("rep").alias("a"), F.col("sign").alias("sa"))
        sb = alike.select(F.col("rep").alias("b"), F.col("sign").alias("sb"))
        return cut_lineage(pairs.distinct().join(sa, "a").join(sb, "b").where(agreeing).select("a", "b"))

    # texts of the documents that stand for several rows are read once and serve both rounds; the others
    # are dropped where they are read, not after a shuffle of all texts
    wanted = members.select(F.col("rep").alias("id")).distinct()
    texts = cut_lineage(likely_among(known, wanted, "id").join(wanted, "id").groupBy("id").agg(F.min("text").alias("text")))

    first = promising(members.where("rep <> head").select(F.col("rep").alias("a"), F.col("head").alias("b")))
    tested = cut_lineage(_compared(first, texts, weights, id_type))
    linked = F.col("similarity") >= THRESHOLD - 1e-12
    links = tested.where(linked).select("a", "b")
    parts = cut_lineage(connected_components(links.union(members.select("rep", "rep").distinct())))
    group = members.select("head", "rep").distinct().join(parts, F.col("rep") == F.col("node")).select("head", "rep", "label")
    far = tested.select(F.col("a").alias("rep"), F.col("b").alias("head"), (1 - F.col("similarity")).alias("far"))
    more = _across(group, far, alike.select("rep", "sign"), texts.select(F.col("id").alias("rep"), "text"), weights, id_type)
    # a document whose rows have several texts links them
    stands = signed.join(alike.select("print", "rep"), "print").select("id", "rep")
    own = stands.where("id <> rep")
    # written once, as the components read it several times
    ends = cut_lineage(links.union(more).unionByName(own.select(F.col("id").alias("a"), F.col("rep").alias("b"))))
    labels = cut_lineage(connected_components(ends))
    found = rows.select("id").join(labels, F.col("id") == F.col("node"), "left")
    return found.select("id", F.coalesce("label", "id").alias("class_id"))
