"""Hard-negative mining with rotated one-bit codes and deterministic intervals.

A vector is taken relative to the centroid of its part, rotated (random signs and Hadamard transforms) and coded by
signs; what is left over is coded by signs again, a few times.  With each code its alignment is stored, the
inner product of the rest with the unit vector of the signs, and finally the norm of what is left.  For an anchor, quantised to a few
bit planes, popcounts of code and plane give the inner product with each sign vector up to a known error.
The rest is orthogonal to that vector, so by Cauchy-Schwarz its product with the anchor is at most the product of the two
norms orthogonal to it: an interval that holds without exception.  Pairs whose interval misses the wanted scores are dropped,
code by code; those that survive are scored in whole numbers.

Parts come from a bounded sample, and blocks of anchors meet blocks of a part only where centres and radii leave a
wanted score possible.  First an anchor's positives are found, then the negatives in the windows that they set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mortarline.llm.topk import greedy_net
from mortarline.session import cut_lineage

#: Rows of the sample that centroids are fitted on, most centroids, and rounds of fitting; they bound what the driver holds.
SAMPLE, PARTS, FITTING = 2048, 24, 8
#: One-bit codes per vector, bit planes of an anchor, and rounds of the rotation.
CODES, PLANES, ROUNDS, SEED = 3, 6, 3, 17
#: Most rows of a block of anchors and of a part in one task, and of pairs looked at together there.
ANCHOR_BLOCK, DATA_BLOCK, PAIRS = 4096, 16384, 1 << 19
#: Share of surviving pairs beyond which a product of matrices scores them all.
DENSE = 0.2


def rotated(x: np.ndarray) -> np.ndarray:
    """Rows turned by one fixed orthonormal map, after filling up to a power of two of at least 64."""
    n, width = len(x), max(64, 1 << max(0, x.shape[1] - 1).bit_length())
    out = np.zeros((n, width))
    out[:, : x.shape[1]] = x
    signs = np.random.default_rng(SEED).integers(0, 2, (ROUNDS, width)) * 2.0 - 1.0
    for s in signs:
        out *= s
        h = 1
        while h < width:
            pairs = out.reshape(n, width // (2 * h), 2, h)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, width)
            h *= 2
        out /= np.sqrt(width)
    return out


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    return np.packbits(bits, axis=1).view(np.uint64)


def codes_of(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each code [n, CODES, words], alignments, norms left after each code) of rotated rows."""
    words, aligned, left = [], [], []
    rest = z.copy()
    for _ in range(CODES):
        up = rest >= 0
        a = np.abs(rest).sum(1) / np.sqrt(z.shape[1])
        rest -= np.where(up, 1.0, -1.0) * (a / np.sqrt(z.shape[1]))[:, None]
        words.append(packed(up))
        aligned.append(a)
        left.append(np.sqrt((rest * rest).sum(1)))
    return np.stack(words, 1), np.stack(aligned, 1), np.stack(left, 1)


class Anchors:
    """Anchors of a block relative to one centroid: bit planes and what bounds their error."""

    def __init__(self, q: np.ndarray, centre: np.ndarray):
        w = rotated(q - centre)
        self.width = w.shape[1]
        self.low = w.min(1)
        self.unit = np.maximum(w.max(1) - self.low, 1e-12) / ((1 << PLANES) - 1)
        levels = np.rint((w - self.low[:, None]) / self.unit[:, None])
        near = self.low[:, None] + self.unit[:, None] * levels
        self.total = near.sum(1)
        self.off = np.abs(w - near).sum(1) / np.sqrt(self.width)
        levels = levels.astype(np.int64)
        self.planes = np.stack([packed(((levels >> b) & 1).astype(bool)) for b in range(PLANES)], 1)
        self.norm2 = (w * w).sum(1)
        self.shift = q @ centre
        self.size = np.sqrt((q * q).sum(1))

    def along(self, i: np.ndarray | slice, words: np.ndarray, dense: bool) -> np.ndarray:
        """Inner products of anchors with the unit vectors of sign words, right within ``off``; all pairs or place by place."""
        shape = (slice(None), None) if dense else (slice(None),)
        total = 0
        for b in range(PLANES):
            plane = self.planes[i, b][shape]
            total = total + (np.bitwise_count(plane & words).sum(-1, dtype=np.int64) << b)
        ones = np.bitwise_count(words).sum(-1, dtype=np.int64)
        low, unit, whole = (v[i][shape] for v in (self.low, self.unit, self.total))
        return (2 * (low * ones + unit * total) - whole) / np.sqrt(self.width)


class Part:
    """Coded rows of one part in a task."""

    def __init__(self, x: np.ndarray, words: np.ndarray, aligned: np.ndarray, left: np.ndarray, turned: np.ndarray):
        self.x, self.words, self.aligned, self.left = x, words, aligned, left
        #: product of row - centroid with the centroid
        self.turned = turned


def survivors(q: Anchors, part: Part, rows: slice, least: np.ndarray, most: np.ndarray, fit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor places, row places within ``rows``) of pairs with ``fit`` whose score may lie in [least, most]."""
    words, aligned, left, turned = part.words[rows], part.aligned[rows], part.left[rows], part.turned[rows]
    norm = np.sqrt((part.x[rows] ** 2).sum(1))

    def judged(i, j, known, stage, dense):
        shape = (slice(None), None) if dense else (slice(None),)
        t = q.along(i, words[j, stage][None] if dense else words[j, stage], dense)
        off, norm2, size = (v[i][shape] for v in (q.off, q.norm2, q.size))
        across = np.sqrt(np.maximum(norm2 - np.maximum(np.abs(t) - off, 0.0) ** 2, 0.0))
        known = known + aligned[j, stage] * t
        # what codes before this one may be off by is carried with it
        wide = left[j, stage] * across + aligned[j, : stage + 1].sum(-1) * off + 1e-9 * norm[j] * size + 1e-3
        return known, (known + wide >= least[i][shape]) & (known - wide <= most[i][shape])

    # all pairs of the block together until few are left, then pair by pair
    i = j = slice(None)
    known, dense = q.shift[:, None] + turned[None, :], True
    for stage in range(CODES):
        known, may = judged(i, j, known, stage, dense)
        if dense:
            fit = fit & may
            if fit.sum() <= DENSE * fit.size:
                dense, (i, j) = False, np.nonzero(fit)
                known = known[i, j]
        else:
            i, j, known = i[may], j[may], known[may]
    if dense:
        i, j = np.nonzero(fit)
    return i, j


def scored(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of pairs in whole numbers (exact below 2**53)."""
    if len(i) > DENSE * len(q) * len(x):
        return (q @ x.T)[i, j]
    out = np.empty(len(i))
    for a in range(0, len(i), 1 << 16):
        s = slice(a, a + (1 << 16))
        out[s] = np.einsum("ij,ij->i", q[i[s]], x[j[s]])
    return out


class Best:
    """The k best (score, id) per slot so far, ties to the smaller id."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot, self.id, self.score = np.array([], np.int64), np.array([], np.int64), np.array([], np.float64)
        self.kth = np.full(slots, -np.inf)

    def add(self, slot: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        slot, ids, score = (np.concatenate(p) for p in ((self.slot, slot), (self.id, ids), (self.score, score)))
        order = np.lexsort((ids, -score, slot))
        slot, ids, score = slot[order], ids[order], score[order]
        first = np.searchsorted(slot, slot)
        rank = np.arange(len(slot)) - first
        kept = rank < self.k
        self.slot, self.id, self.score = slot[kept], ids[kept], score[kept]
        full = rank[kept] == self.k - 1
        self.kth[self.slot[full]] = self.score[full]


def search(q: np.ndarray, q_ids: np.ndarray, q_labels: np.ndarray, windows: np.ndarray | None, floors: np.ndarray, part: Part,
           x_ids: np.ndarray, x_labels: np.ndarray, centre: np.ndarray, k: int) -> Best:
    """The k best rows per anchor, of its label, or of other labels per window; slot = anchor * windows + window.

    ``windows`` is [anchors, n, 2] with least and most score (least > most: none), or null for positives.
    """
    n_windows = 1 if windows is None else windows.shape[1]
    best = Best(len(q) * n_windows, k)
    anchors = Anchors(q, centre)
    step = max(1, PAIRS // max(1, len(q)))
    for a in range(0, len(part.x), step):
        rows = slice(a, a + step)
        kth = best.kth.reshape(len(q), n_windows)
        same = q_labels[:, None] == x_labels[rows][None, :]
        fit = (same if windows is None else ~same) & (q_ids[:, None] != x_ids[rows][None, :])
        if windows is None:
            least, most = np.maximum(kth[:, 0], floors), np.full(len(q), np.inf)
        else:
            open_ = windows[:, :, 0] <= windows[:, :, 1]
            low = np.where(open_, np.maximum(windows[:, :, 0], kth), np.inf)
            least, most = low.min(1), np.where(open_, windows[:, :, 1], -np.inf).max(1)
        i, j = survivors(anchors, part, rows, least, most, fit)
        s = scored(q, part.x[rows], i, j)
        ids = x_ids[rows][j]
        for w in range(n_windows):
            if windows is None:
                good = s >= least[i]
            else:
                good = (s >= low[i, w]) & (s <= windows[i, w, 1])
            if good.any():
                best.add(i[good] * n_windows + w, ids[good], s[good])
    return best


def _matrix(values: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(values), width))
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out


def _centroids(points: np.ndarray, most: int) -> np.ndarray:
    centres = points[greedy_net(points, most)]
    for _ in range(FITTING):
        near = ((centres * centres).sum(1)[None, :] - 2 * points @ centres.T).argmin(1)
        centres = np.stack([points[near == c].mean(0) if (near == c).any() else centres[c] for c in range(len(centres))])
    return centres


def mine_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    id_col: str = "vec_id", label_col: str = "label", vector_col: str = "vector",
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vector_col`` holds arrays of whole numbers, scores are inner products.  An anchor's positives are its best other rows of
    the same label; of the rows of other labels with ``low * p <= 100 * s <= high * p`` for a positive's score p the first ``negatives`` are
    returned.  Higher scores come first, ties go to the smaller id, and results are exact.  Rows without id, label or vector, or with
    a null in it, take no part.  Rows of an anchor's own id are no candidates; candidates that repeat appear repeatedly, anchors
    that repeat count once, and different rows under one anchor id are answered each.  Shorter vectors count as filled up with zeros.
    Fewer candidates give fewer rows, and an empty table none.  Other columns are not read.
    """
    spark = rows.sparkSession
    plain = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<bigint>").alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("q"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND forall(v, c -> c IS NOT NULL)")
    plain = cut_lineage(plain)
    facts = plain.agg(F.max(F.size("v")).alias("width"), F.count(F.lit(1)).alias("n"), F.count_if("q").alias("anchors")).first()
    final = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not facts["anchors"]:
        return spark.createDataFrame([], final)
    width = max(1, facts["width"])
    sample = plain.select("v").orderBy(F.xxhash64("id", "label", "v")).limit(SAMPLE).toPandas()
    points = _matrix(sample["v"], width)
    centres = _centroids(points, max(1, min(PARTS, facts["n"] // DATA_BLOCK + 1)))
    coarse = centres[greedy_net(centres, max(1, min(PARTS, facts["anchors"] // ANCHOR_BLOCK + 1)))]
    parent = ((coarse * coarse).sum(1)[None, :] - 2 * centres @ coarse.T).argmin(1)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = TaskContext.get().partitionId() << 40
        for b in batches:
            x = _matrix(b["v"], width)
            part = ((centres * centres).sum(1)[None, :] - 2 * x @ centres.T).argmin(1)
            z = x - centres[part]
            words, aligned, left = codes_of(rotated(z))
            group = parent[part]
            yield b.assign(
                spot=np.arange(at, at + len(b)), part=part.astype("int32"), far=np.sqrt((z * z).sum(1)), grp=group.astype("int32"),
                apart=np.sqrt(((x - coarse[group]) ** 2).sum(1)), words=list(words.reshape(len(b), -1).view(np.int64)), aligned=list(aligned), rests=list(left),
                turned=(z * centres[part]).sum(1),
            )
            at += len(b)

    placed = cut_lineage(plain.mapInPandas(
        index,
        "id long, label string, v array<bigint>, q boolean, spot long, part int, far double, grp int, apart double,"
        " words array<bigint>, aligned array<double>, rests array<double>, turned double",
    ))
    # at most PARTS rows each
    parts = {r["part"]: (r["n"], r["far"]) for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()}
    groups = {
        r["grp"]: (r["n"], r["apart"])
        for r in placed.where("q").groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.max("apart").alias("apart")).collect()
    }
    anchors = placed.where("q").groupBy("id", "label", "v").agg(F.min("grp").alias("grp")).withColumn("print", F.xxhash64("label", "v"))

    def met(pairs: set[tuple[int, int]]) -> DataFrame:
        """Rows (grp, part, q_blocks, d_blocks), at most PARTS squared."""
        rows = [(g, p, -(-groups[g][0] // ANCHOR_BLOCK), -(-parts[p][0] // DATA_BLOCK)) for g, p in sorted(pairs)]
        return F.broadcast(spark.createDataFrame(rows, "m_grp int, m_part int, q_blocks int, d_blocks int"))

    def searched(asked: DataFrame, pairs: set[tuple[int, int]], k: int) -> DataFrame:
        """Rows (id, print, window, found, score): candidates of ``asked`` (id, label, v, grp, print, floor, wants) in the parts they meet."""
        own = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
        left = asked.join(met(pairs), F.col("grp") == F.col("m_grp")).select(
            "m_grp", "m_part", own(F.struct("id", "print"), "q_blocks").alias("qb"), F.explode(F.sequence(F.lit(0), F.col("d_blocks") - 1)).alias("db"),
            "id", "label", "v", "print", "floor", "wants",
        )
        right = placed.join(met(pairs), F.col("part") == F.col("m_part")).select(
            "m_grp", "m_part", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)).alias("qb"), own("spot", "d_blocks").alias("db"),
            F.col("id").alias("x_id"), F.col("label").alias("x_label"), F.col("v").alias("x"), "words", "aligned", "rests", "turned",
        )

        def run(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
            if not len(q) or not len(x):
                return pd.DataFrame({"id": [], "print": [], "window": [], "found": [], "score": []}).astype("int64")
            block = Part(
                _matrix(x["x"], width), np.stack(x["words"].to_numpy()).view(np.uint64).reshape(len(x), CODES, -1), np.stack(x["aligned"].to_numpy()),
                np.stack(x["rests"].to_numpy()), x["turned"].to_numpy(),
            )
            windows = None
            if q["wants"].iloc[0] is not None:
                scores = q["wants"].to_list()
                windows = np.full((len(q), max(map(len, scores)), 2), [1.0, 0.0])
                for i, s in enumerate(scores):
                    s = np.asarray(s, np.int64)
                    windows[i, : len(s), 0], windows[i, : len(s), 1] = -(-(low * s) // 100), high * s // 100
            names, labels = np.unique(np.concatenate([q["label"].to_numpy(str), x["x_label"].to_numpy(str)]), return_inverse=True)
            floor = q["floor"].fillna(-np.inf).to_numpy()
            best = search(
                _matrix(q["v"], width), q["id"].to_numpy(), labels[: len(q)], windows, floor, block, x["x_id"].to_numpy(), labels[len(q) :],
                centres[x["m_part"].iloc[0]], k,
            )
            per = 1 if windows is None else windows.shape[1]
            return pd.DataFrame({
                "id": q["id"].to_numpy()[best.slot // per], "print": q["print"].to_numpy()[best.slot // per], "window": best.slot % per,
                "found": best.id, "score": best.score.astype("int64"),
            })

        keys = ["m_grp", "m_part", "qb", "db"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, "id long, print long, window long, found long, score long")

    def best(df: DataFrame, k: int, *slot: str) -> DataFrame:
        order = Window.partitionBy(*slot).orderBy(F.col("score").desc(), "found")
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    norms = np.sqrt((centres**2).sum(1)), np.sqrt((coarse**2).sum(1))

    def reachable(floors: DataFrame) -> set[tuple[int, int]]:
        """(group, part) where a score may reach the least of the group's floors."""
        worst = {r["grp"]: r["floor"] for r in floors.groupBy("grp").agg(F.min("floor").alias("floor")).collect()}
        out = set()
        for g, floor in worst.items():
            for p, (_, r) in parts.items():
                s = groups[g][1]
                top = coarse[g] @ centres[p] + s * norms[0][p] + r * norms[1][g] + s * r
                if top + 1e-6 * abs(top) + 1e-3 >= floor:
                    out.add((g, p))
        return out

    # positives: an anchor's own parts set a floor for the others
    home = {(g, p) for g in groups for p in parts if parent[p] == g}
    nothing = F.lit(None).cast("array<bigint>").alias("wants")
    first = cut_lineage(best(searched(anchors.select("*", F.lit(None).cast("double").alias("floor"), nothing), home, positives), positives, "id", "print"))
    kth = first.where(F.col("rank") == positives).select("id", "print", F.col("score").cast("double").alias("floor"))
    asked = anchors.join(kth, ["id", "print"], "left")
    rest = reachable(asked.withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))) - home
    if rest:
        more = searched(asked.select("*", nothing), rest, positives)
        first = cut_lineage(best(first.drop("rank").unionByName(more), positives, "id", "print"))
    # negatives: one window for each different score of a positive
    wanted = first.groupBy("id", "print").agg(F.array_sort(F.collect_set("score")).alias("wants"))
    wanted = wanted.withColumn("wants", F.filter("wants", lambda s: F.ceil(s * low / 100) <= F.floor(s * high / 100))).where(F.size("wants") > 0)
    asked = cut_lineage(anchors.join(wanted, ["id", "print"]).withColumn("floor", F.array_min("wants") * low / 100))
    pairs = reachable(asked)
    if not pairs:
        return spark.createDataFrame([], final)
    found = best(searched(asked, pairs, negatives), negatives, "id", "print", "window")
    scores = asked.select("id", "print", F.posexplode("wants").alias("window", "p_score")).withColumn("window", F.col("window").cast("long"))
    answers = found.join(scores, ["id", "print", "window"]).select("id", "print", "p_score", F.col("rank"), F.col("found").alias("negative_id"), F.col("score").alias("n_score"))
    owners = first.select("id", "print", F.col("found").alias("positive_id"), F.col("score").alias("p_score"))
    return owners.join(answers, ["id", "print", "p_score"]).select(
        F.col("id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
        F.col("p_score").alias("positive_score"), F.col("n_score").alias("negative_score"),
    )
