"""Gated recurrent language model: counts over the whole corpus, training by rounds, document scores.

Word counts.  Every batch sends the digests of its words to segments, with who holds them how often.  A segment
adds up the counts of training words and returns each document's part of the unigram score,
so no vocabulary is held in one place.  Words are then counted by bins of their counts, and only the head, the
most frequent ones, reaches the driver.

Growth.  The head of a corpus of N tokens has ``HEAD_SHARE * N ** HEAD_POWER`` words, all of them if it has fewer:
about 7,000 for 135 million tokens, under a million for 2.6e13.  The vocabulary of a text grows faster than that, so
a word of the head is always met often enough to be learned.  A head of W words has about sqrt(W) / 2 classes, the first
of few frequent words and the last of 4 * sqrt(W) rare ones, so that a token costs under 2 * sqrt(W) outputs in the mean (103 on
135 million tokens), and all parameters together take about 100 * W bytes in a task.

Model.  A gated recurrent unit reads words; its output goes through a softmax over classes and one over the
words of a class, both by frequency.  Rarer and unknown words are the last class and
share it by their smoothed counts, so the probabilities of all words add up to one.  Backpropagation is cut
after ``WINDOW`` tokens while the state is carried on to the end of a document, in training and in scoring.

Training.  A round takes a share of the training documents; every task trains on its own whole ones from
the common parameters, and the results are averaged by tokens.  After all rounds each training document
has been used once.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mortarline.llm.text import bytes_of, mixed, word_digests
from mortarline.session import cut_lineage

HIDDEN = 12
HEAD_SHARE, HEAD_POWER = 4.0, 0.4
LANES, WINDOW, ROUNDS, RATE = 256, 32, 2, 0.01
#: Targets of a window whose outputs are made at once, so that they stay in a core's cache.
BLOCK = 2048
#: Lanes in scoring, where they only share the cost of a step: the state of a document is its own.
SCORE_LANES = 1024
#: Places of a window in scoring, where the state is carried on, so that few lanes take more steps.
SCORE_PLACES = 1 << 15
#: Tasks' parameters are added up in so many tasks before they reach the driver.
SUMMERS = 8


# ---- counts ----

_SENT = (
    "kind int, seg int, batch long, hashes binary, trained binary, at binary, doc binary, n binary, ids array<{id}>, prints array<bigint>"
)


def _blank(rows: int, id_type: pa.DataType, **given) -> pa.RecordBatch:
    kinds = {"kind": pa.int32(), "seg": pa.int32(), "batch": pa.int64(), "hashes": pa.binary(), "trained": pa.binary(), "at": pa.binary(),
             "doc": pa.binary(), "n": pa.binary(), "ids": pa.list_(id_type), "prints": pa.list_(pa.int64())}
    return pa.RecordBatch.from_arrays(
        [pa.array(given[c], t) if c in given else pa.nulls(rows, t) for c, t in kinds.items()], list(kinds)
    )


def _send(batch: pa.RecordBatch, segments: int, name: int) -> Iterator[pa.RecordBatch]:
    """Rows for segments (kind 0), and the batch's documents (kind 1); no other batch has the ``name``."""
    texts = bytes_of(batch.column("text"))
    train = np.asarray(batch.column("train"))
    prints = np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64).view(np.int64)
    own = [np.unique(word_digests(t), return_counts=True) for t in texts]
    id_type = batch.column("id").type
    yield _blank(1, id_type, kind=[1], seg=[name % segments], batch=[name], ids=[batch.column("id").to_pylist()], prints=[prints.tolist()])
    sizes = np.fromiter((len(h) for h, _ in own), np.int64, len(own))
    if not sizes.sum():
        return
    doc = np.repeat(np.arange(len(own), dtype=np.int32), sizes)
    n = np.concatenate([c for _, c in own]).astype(np.int32)
    distinct, at = np.unique(np.concatenate([h for h, _ in own]), return_inverse=True)
    trained = np.bincount(at, weights=n * train[doc], minlength=len(distinct)).astype(np.int64)
    seg = (mixed(distinct) % np.uint64(segments)).astype(np.int64)
    order = np.argsort(seg, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    first = np.searchsorted(seg[order], np.arange(segments + 1))
    entry = np.argsort(seg[at], kind="stable")
    cuts = np.searchsorted(seg[at][entry], np.arange(segments + 1))
    local = (place[at] - first[seg[at]]).astype(np.int32)
    rows = []
    for s in np.unique(seg):
        w, e = order[first[s] : first[s + 1]], entry[cuts[s] : cuts[s + 1]]
        rows.append((int(s), distinct[w].tobytes(), trained[w].tobytes(), local[e].tobytes(), doc[e].tobytes(), n[e].tobytes()))
    s, h, t, a, d, c = zip(*rows, strict=True)
    yield _blank(len(rows), id_type, kind=[0] * len(rows), seg=s, batch=[name] * len(rows), hashes=h, trained=t, at=a, doc=d, n=c)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segment sums: kind 1 passes; kind 2 has a batch's parts, kind 3 the words' counts."""
    kept = []
    id_type = None
    for batch in batches:
        id_type = batch.schema.field("ids").type.value_type
        kinds = np.asarray(batch.column("kind"))
        passing = batch.filter(pa.array(kinds == 1))
        if passing.num_rows:
            yield passing
        kept += batch.filter(pa.array(kinds == 0)).select(["batch", "hashes", "trained", "at", "doc", "n"]).to_pylist()
    if not kept:
        return
    hashes = [np.frombuffer(r["hashes"], np.uint64) for r in kept]
    distinct, at = np.unique(np.concatenate(hashes), return_inverse=True)
    counts = np.zeros(len(distinct), np.int64)
    np.add.at(counts, at, np.concatenate([np.frombuffer(r["trained"], np.int64) for r in kept]))
    logs = np.log10(counts + 1.0)
    begin = 0
    for r, h in zip(kept, hashes, strict=True):
        mine = at[begin : begin + len(h)]
        begin += len(h)
        word = mine[np.frombuffer(r["at"], np.int32)]
        doc, n = np.frombuffer(r["doc"], np.int32), np.frombuffer(r["n"], np.int32)
        docs, place = np.unique(doc, return_inverse=True)
        part = np.bincount(place, weights=logs[word] * n)
        known = np.bincount(place, weights=n * (counts[word] > 0)).astype(np.int32)
        yield _blank(1, id_type, kind=[2], batch=[r["batch"]], doc=[docs.astype(np.int32).tobytes()], at=[part.tobytes()], n=[known.tobytes()])
    top = np.flatnonzero(counts)
    totals = np.array([(counts > 0).sum(), counts.sum()], np.int64)
    yield _blank(1, id_type, kind=[3], hashes=[distinct[top].tobytes()], trained=[counts[top].tobytes()], n=[totals.tobytes()])


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, print, logs, known) per document from a batch's parts; batches share no rows."""
    docs: dict[int, tuple] = {}
    parts: dict[int, list] = {}
    id_type = None
    for batch in batches:
        id_type = batch.schema.field("ids").type.value_type
        for r in batch.to_pylist():
            if r["kind"] == 1:
                docs[r["batch"]] = (r["ids"], r["prints"])
            else:
                parts.setdefault(r["batch"], []).append((r["doc"], r["at"], r["n"]))
    for name, (ids, prints) in docs.items():
        logs, known = np.zeros(len(ids)), np.zeros(len(ids), np.int64)
        for doc, part, n in parts.get(name, []):
            at = np.frombuffer(doc, np.int32)
            logs[at] += np.frombuffer(part, np.float64)
            known[at] += np.frombuffer(n, np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(prints, pa.int64()), pa.array(logs), pa.array(known)], ["id", "print", "logs", "known"])


# ---- model ----


def head_size(tokens: int) -> int:
    """Words that the model tells apart at most after so many training tokens, the end token included."""
    return max(2, math.ceil(HEAD_SHARE * max(tokens, 1) ** HEAD_POWER))


def shape_of(words: int) -> tuple[int, int]:
    """(classes, words of a class) that hold so many words."""
    slots = max(1, math.ceil(math.sqrt(words)))
    return max(1, -(-words // slots)), slots


def class_bounds(words: int) -> np.ndarray:
    """First word of each class, and the end.  Sizes grow with the rank of their words, as frequent ones are met most."""
    classes = -(-shape_of(words)[0] // 2)
    return np.round(words * (np.arange(classes + 1) / classes) ** 2).astype(np.int64)


def initial(counts: np.ndarray, total: int, seed: int = 1) -> dict[str, np.ndarray]:
    """Small random parameters whose biases already give the probabilities of the head's counts."""
    rng = np.random.default_rng(seed)
    f = np.float32
    head = len(counts)
    bounds = class_bounds(head)
    filled = np.asarray(counts, np.float64)
    sums = np.append(np.add.reduceat(filled, bounds[:-1]), max(total - filled.sum(), 0.5))
    share = filled / np.repeat(np.maximum(sums[:-1], 1), np.diff(bounds))
    words = np.where(filled > 0, np.log(np.maximum(share, 1e-12)), -30.0)
    return {
        "e": rng.normal(0, 0.3, (head + 1, HIDDEN)).astype(f), "w": rng.normal(0, 0.25, (HIDDEN, 3 * HIDDEN)).astype(f),
        "u": rng.normal(0, 0.25, (HIDDEN, 3 * HIDDEN)).astype(f), "b": np.zeros(3 * HIDDEN, f),
        "c": np.zeros((len(bounds), HIDDEN), f), "cb": np.where(sums > 0, np.log(np.maximum(sums, 0.5) / sums.sum()), -30.0).astype(f),
        "d": np.zeros((head, HIDDEN), f), "db": words.astype(f),
    }


def tail_of(p: dict) -> int:
    """Id of the words beyond the head: the one after the last word of the last class."""
    return p["db"].size


def _half_sigmoid(x):
    """The sigmoid of twice ``x``, in its place."""
    np.tanh(x, out=x)
    x *= np.float32(0.5)
    x += np.float32(0.5)


def _rows_added(at: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """Sums of the columns of ``values`` by their place ``at``, as rows."""
    out = np.empty((rows, len(values)), np.float32)
    for i, c in enumerate(values):
        out[:, i] = np.bincount(at, weights=c, minlength=rows)
    return out


#: Values up to which exponentials are sure not to overflow.
_SAFE = np.float32(60)


def _bounded(weights: np.ndarray) -> np.ndarray:
    """Whether no state, whose parts lie between -1 and 1, can make a value above ``_SAFE``, for each row of ``weights``."""
    return np.abs(weights[:, :-1]) @ np.ones(weights.shape[1] - 1, np.float32) + weights[:, -1] <= _SAFE


def window_pass(p: dict, x: np.ndarray, y: np.ndarray, fresh: np.ndarray, h: np.ndarray, learn: bool):
    """(natural log probabilities of ``y``, last state, gradients or None) over one window.

    Arrays are (steps, lanes): inputs, targets (-1: none) and where a document begins.  The state ``h`` comes
    from the window before; gradients do not go back beyond this window.  Lanes are the last axis of all that
    a step computes, so that its parts are whole rows.
    """
    steps, lanes = x.shape
    hid = HIDDEN
    # a sigmoid is a hyperbolic tangent of half the value
    half = np.repeat(np.array([0.5, 0.5, 1], np.float32), hid)[:, None]
    w_half, u_half = p["w"].T * half, p["u"].T * half
    emb = p["e"][x]
    gx = np.matmul(w_half, emb.transpose(0, 2, 1))
    gx += p["b"][:, None] * half
    out = np.empty((steps, hid, lanes), np.float32)
    before, gates, ghn, new = (np.empty((steps, n, lanes), np.float32) for n in (hid, 2 * hid, hid, hid)) if learn else [None] * 4
    begins = fresh.any(axis=1).tolist()
    keep = (1.0 - fresh).astype(np.float32)
    h = np.ascontiguousarray(h.T)
    for t in range(steps):
        h0 = h * keep[t] if begins[t] else h
        gh = u_half @ h0
        zr = gx[t, : 2 * hid]
        zr += gh[: 2 * hid]
        _half_sigmoid(zr)
        n = zr[hid:] * gh[2 * hid :]
        n += gx[t, 2 * hid :]
        np.tanh(n, out=n)
        h = np.subtract(h0, n, out=out[t])
        h *= zr[:hid]
        h += n
        if learn:
            before[t], gates[t], ghn[t], new[t] = h0, zr, gh[2 * hid :], n
    h = h.T.copy()
    flat_y = y.ravel()
    at = np.flatnonzero(flat_y >= 0)
    goal = flat_y[at]
    bounds = class_bounds(tail_of(p))
    classes = len(bounds) - 1
    kind = np.repeat(np.arange(classes + 1, dtype=np.int16 if classes < 1 << 15 else np.int32), np.append(np.diff(bounds), 1))[goal]
    slot = goal - bounds[kind]
    # by class, so that the columns of one lie together; a bias is the weight of a row of ones
    order = np.argsort(kind, kind="stable")
    at, kind, slot = at[order], kind[order], slot[order]
    states = np.ones((hid + 1, len(at)), np.float32)
    states[:hid] = out.transpose(1, 0, 2).reshape(hid, -1)[:, at]
    share = np.float32(1.0 / max(1, len(goal)))
    outer = np.concatenate([p["c"], p["cb"][:, None]], axis=1)
    inner = np.concatenate([p["d"], p["db"][:, None]], axis=1)
    # the first row is for classes, the second for words of a class; the words beyond have none
    picked, sums = np.zeros((2, len(goal)), np.float32), np.ones((2, len(goal)), np.float32)
    d_states = np.zeros((hid, len(goal)), np.float32) if learn else None
    d_outer, d_inner = np.zeros_like(outer), np.zeros_like(inner)
    columns, ones = np.arange(BLOCK), np.ones(max(classes + 1, int(np.diff(bounds).max())), np.float32)
    bounded = bool(_bounded(outer).all() and _bounded(inner).all())
    cuts = np.searchsorted(kind, np.arange(classes + 1)).tolist()
    words = [slice(a, b) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    parts = [(0, outer, d_outer, kind, 0, len(goal))]
    parts += [(1, inner[words[k]], d_inner[words[k]], slot, cuts[k], cuts[k + 1]) for k in range(classes) if cuts[k + 1] > cuts[k]]
    for row, weights, total, wanted, begin, end in parts:
        back = weights[:, :hid].T
        for lo in range(begin, end, BLOCK):
            hi = min(lo + BLOCK, end)
            own = states[:, lo:hi]
            exps = weights @ own
            at_goal = wanted[lo:hi], columns[: hi - lo]
            picked[row, lo:hi] = exps[at_goal]
            if not bounded:
                np.minimum(exps, _SAFE, out=exps)
            np.exp(exps, out=exps)
            own_sums = np.matmul(ones[: len(exps)], exps, out=sums[row, lo:hi])
            if learn:
                # gradients are these less the sums at the goals, scaled column by column
                exps[at_goal] -= own_sums
                scale = share / own_sums
                total += exps @ (own * scale).T
                d = back @ exps
                d *= scale
                d_states[:, lo:hi] += d
    found = (picked - np.log(sums)).sum(axis=0, dtype=np.float64)
    result = np.zeros(flat_y.shape)
    result[at] = found
    if not learn:
        return result.reshape(y.shape), h, None
    g = {"c": d_outer[:, :hid], "cb": d_outer[:, hid], "d": d_inner[:, :hid], "db": d_inner[:, hid]}
    d_out = np.zeros((hid, steps * lanes), np.float32)
    d_out[:, at] = d_states
    d_out = np.ascontiguousarray(d_out.reshape(hid, steps, lanes).transpose(1, 0, 2))
    # what the gradient of a state is multiplied by, for all steps at once
    gate = gates * (1 - gates)
    z, r = gates[:, :hid], gates[:, hid:]
    to_z = (before - new) * gate[:, :hid]
    to_r = ghn * gate[:, hid:]
    to_n = (1 - z) * (1 - new * new)
    # the gradients of ``gh``'s last third, of the two gates, and of ``gx``'s last third
    d = np.empty((steps, 4 * hid, lanes), np.float32)
    d_next = np.zeros((hid, lanes), np.float32)
    u_back = np.concatenate([p["u"][:, 2 * hid :], p["u"][:, : 2 * hid]], axis=1)
    for t in range(steps - 1, -1, -1):
        dh, own = d_out[t], d[t]
        dh += d_next
        dn = np.multiply(dh, to_n[t], out=own[3 * hid :])
        np.multiply(dh, to_z[t], out=own[hid : 2 * hid])
        np.multiply(dn, to_r[t], out=own[2 * hid : 3 * hid])
        np.multiply(dn, r[t], out=own[:hid])
        d_next = u_back @ own[: 3 * hid]
        dh *= z[t]
        d_next += dh
        if begins[t]:
            d_next *= keep[t]
    du = np.matmul(before, d[:, : 3 * hid].transpose(0, 2, 1)).sum(axis=0)
    g["u"] = np.concatenate([du[:, hid:], du[:, :hid]], axis=1)
    gx_back = d[:, hid:]
    g["w"], g["b"] = np.matmul(gx_back, emb).sum(axis=0).T, gx_back.sum(axis=(0, 2))
    d_emb = np.matmul(p["w"], gx_back).transpose(1, 0, 2).reshape(hid, -1)
    g["e"] = _rows_added(x.ravel(), d_emb, len(p["e"]))
    return result.reshape(y.shape), h, g


class Adam:
    def __init__(self, p: dict):
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}
        self.t = 0

    def step(self, p: dict, g: dict, share: float = 1.0) -> None:
        self.t += 1
        norm = math.sqrt(sum(float((x * x).sum()) for x in g.values()))
        scale = np.float32(min(1.0, 1.0 / (norm + 1e-9)))
        rate = np.float32(RATE * share * math.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t))
        for k in p:
            x = g[k] * scale
            self.m[k] += np.float32(0.1) * (x - self.m[k])
            self.v[k] += np.float32(0.001) * (x * x - self.v[k])
            p[k] -= rate * self.m[k] / (np.sqrt(self.v[k]) + np.float32(1e-6))


def lanes_of(docs: list[np.ndarray], most: int, full: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Windows (inputs, targets, fresh, document) over whole documents laid end to end in lanes.

    A document is read from the end token on, so its first input is that token with no state.  A window has
    ``WINDOW`` steps, or as many more as its lanes need for ``full`` places.
    """
    lanes = min(most, len(docs))
    lengths = np.fromiter(map(len, docs), np.int64, len(docs))
    held: list[list[int]] = [[] for _ in range(lanes)]
    heap = [(0, i) for i in range(lanes)]
    for d in np.argsort(-lengths, kind="stable"):
        n, i = heapq.heappop(heap)
        held[i].append(int(d))
        heapq.heappush(heap, (n + int(lengths[d]), i))
    loads = np.array([lengths[own].sum() for own in held])
    order = np.argsort(-loads, kind="stable")
    loads, held = loads[order], [held[i] for i in order]
    longest = int(loads[0]) if lanes else 0
    y, doc = np.full((longest, lanes), -1, np.int32), np.zeros((longest, lanes), np.int32)
    x, fresh = np.zeros((longest, lanes), np.int32), np.zeros((longest, lanes), bool)
    for i, own in enumerate(held):
        stream, n = np.concatenate([docs[d] for d in own]), loads[i]
        begins = np.cumsum(lengths[own]) - lengths[own]
        y[:n, i], doc[:n, i] = stream, np.repeat(own, lengths[own])
        x[1:n, i] = stream[:-1]
        x[begins, i], fresh[begins, i] = END, True
    begin = 0
    while begin < longest:
        live = int((loads > begin).sum())  # lanes are in order of length, so the finished ones are the last
        end = begin + max(WINDOW, full // live)
        part = slice(begin, end), slice(0, live)
        yield x[part], y[part], fresh[part], doc[part]
        begin = end


#: The end token is always the first word of the head.
END = 0


def encoded(text: bytes, hashes: np.ndarray, ids: np.ndarray, tail: int) -> np.ndarray:
    """Head ids of a text's words, ``tail`` for others, then the end token."""
    h = word_digests(text)
    out = np.full(len(h) + 1, tail, np.int64)
    if len(h) and len(hashes):
        at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        out[:-1] = np.where(hashes[at] == h, ids[at], tail)
    out[-1] = END
    return out


def train_on(p: dict, docs: list[np.ndarray], adam: Adam) -> float:
    """Train on whole documents; returns the summed natural log probability met on the way."""
    total = 0.0
    h = None
    for x, y, fresh, _ in lanes_of(docs, LANES):
        h = np.zeros((x.shape[1], HIDDEN), np.float32) if h is None else h[: x.shape[1]]
        logs, h, g = window_pass(p, x, y, fresh, h, learn=True)
        # few lanes are left behind the shorter documents: their windows move the parameters by their share
        adam.step(p, g, min(1.0, int((y >= 0).sum()) / (LANES * WINDOW)))
        total += float(logs.sum())
    return total


def score_of(p: dict, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each document's classes and head words, over the whole document."""
    total = np.zeros(len(docs))
    h = None
    for x, y, fresh, doc in lanes_of(docs, SCORE_LANES, SCORE_PLACES):
        h = np.zeros((x.shape[1], HIDDEN), np.float32) if h is None else h[: x.shape[1]]
        logs, h, _ = window_pass(p, x, y, fresh, h, learn=False)
        total += np.bincount(doc.ravel(), weights=logs.ravel(), minlength=len(docs))
    return total


def _pack(p: dict) -> bytes:
    return b"".join(p[k].astype(np.float32).tobytes() for k in sorted(p))


def _unpack(data: np.ndarray, like: dict) -> dict:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = data[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _head(words: DataFrame, size: int) -> pd.DataFrame:
    """The ``size`` most frequent of ``words`` (h, c), ties by digest.

    Bins of a sixteenth of a power of two, a thousand at most, tell which counts may be among them, so only a narrow
    bin more than they need is put in order.
    """
    binned = words.withColumn("bin", F.floor(F.log2("c") * 16))
    sizes = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("bin", ascending=False)
    over = sizes["bin"][sizes["n"].cumsum() >= size]
    if len(over):
        binned = binned.where(F.col("bin") >= int(over.iloc[0]))
    return binned.orderBy(F.col("c").desc(), "h").limit(size).select("h", "c").toPandas()


def score_documents(docs: DataFrame, train: str = "train", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, train, n_tokens, n_known, train_tokens, base_score, score), one per document.

    ``train`` is a boolean column: where true, the text is learned from (null: not).  Scores are base-10 log
    probabilities of the whole text and its end; the base score is that of smoothed counts.  Null and empty
    texts consist of the end alone.  Null and repeated ids are allowed; rows equal in id and text get equal scores.
    Without training texts all words are unknown and the score comes from the untrained model.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), F.coalesce(docs[train], F.lit(False)).alias("train"))
    spark = rows.sparkSession
    id_type = rows.schema["id"].dataType.simpleString()
    segments = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent_schema = _SENT.format(id=id_type)

    # a partition and a number in it: equal batches keep names of their own; tasks run again only give what was lost,
    # as the table below is written once
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            if batch.num_rows:
                yield from _send(batch, segments, part << 32 | number)

    met = cut_lineage(rows.mapInArrow(send, sent_schema).repartition(segments, "seg").mapInArrow(_meet, sent_schema))
    by_doc = met.where("kind IN (1, 2)").select("kind", "batch", "doc", "at", "n", "ids", "prints").repartition("batch")
    # rows equal in id and text may have added their parts in different orders, so their sums differ in the last digit
    unigram = by_doc.mapInArrow(_combine, f"id {id_type}, print long, logs double, known long")
    unigram = unigram.groupBy("id", "print").agg(F.min("logs").alias("logs"), F.min("known").alias("known"))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                totals = np.frombuffer(r["n"], np.int64)
                h, c = np.frombuffer(r["hashes"], np.int64), np.frombuffer(r["trained"], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0, *h]), pa.array([-1, *c]), pa.array([totals[0], *[0] * len(h)]), pa.array([totals[1], *[0] * len(h)])], ["h", "c", "v", "n"]
                )

    words = met.where("kind = 3").select("hashes", "trained", "n").mapInArrow(listed, "h long, c long, v long, n long")
    distinct, tokens = (int(x or 0) for x in words.agg(F.sum("v"), F.sum("n")).first())
    ends = rows.where("train").count()
    top = _head(words.where("c > 0").select("h", "c"), head_size(tokens + ends) - 1)
    counts = np.concatenate([[ends], top["c"].to_numpy(np.int64)])
    head = top["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(head)
    hashes, ids = head[order], order + 1
    n_all, v_all = tokens + ends, distinct + (ends > 0)
    tail_tokens, tail_types = n_all - int(counts.sum()), v_all - int((counts > 0).sum())
    params = initial(counts, n_all)
    unseen = tail_of(params)

    def train_round(number: int, start: dict):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            p, seen = {k: v.copy() for k, v in start.items()}, 0
            adam = Adam(p)
            for batch in batches:
                if batch.num_rows:
                    found = [encoded(t, hashes, ids, unseen) for t in bytes_of(batch.column("text"))]
                    train_on(p, found, adam)
                    seen += sum(map(len, found))
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([_pack(p)], pa.binary()), pa.array([seen], pa.int64())], ["p", "n"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, seen = None, 0
            for batch in batches:
                for data, n in zip(batch.column("p").to_pylist(), batch.column("n").to_pylist(), strict=True):
                    part = np.frombuffer(data, np.float32).astype(np.float64) * n
                    total, seen = part if total is None else total + part, seen + n
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([seen], pa.int64())], ["p", "n"])

        share = rows.where(F.col("train") & (F.pmod(F.xxhash64("id", "text"), F.lit(ROUNDS)) == number)).select("text")
        sums = share.mapInArrow(run, "p binary, n long").repartition(SUMMERS).mapInArrow(add, "p binary, n long").collect()
        if not sums:
            return start
        total = sum(np.frombuffer(r["p"], np.float64) for r in sums) / sum(r["n"] for r in sums)
        return _unpack(total, start)

    for number in range(ROUNDS):
        params = train_round(number, params)
    log_counts = np.zeros(unseen + 1)
    log_counts[: len(counts)] = np.log10(counts + 1.0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = bytes_of(batch.column("text"))
            found = [encoded(t, hashes, ids, unseen) for t in texts]
            model = score_of(params, found) / math.log(10)
            prints = np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("train"), pa.array(prints), pa.array([len(f) for f in found], pa.int64()),
                 pa.array(model), pa.array([float(log_counts[f].sum()) for f in found]), pa.array([int((f == unseen).sum()) for f in found], pa.int64())],
                ["id", "train", "print", "n_tokens", "model", "head_logs", "n_tail"],
            )

    scored = rows.mapInArrow(score, f"id {id_type}, train boolean, print long, n_tokens long, model double, head_logs double, n_tail long")
    u = unigram.select(F.col("id").alias("_id"), F.col("print").alias("_print"), "logs", "known")
    joined = scored.join(u, F.col("id").eqNullSafe(F.col("_id")) & (F.col("print") == F.col("_print")))
    end_log = math.log10(ends + 1.0)
    base = F.col("logs") + end_log - F.col("n_tokens") * math.log10(n_all + v_all + 1.0)
    # what the words of the tail share, by their smoothed counts
    tail = F.col("logs") + end_log - F.col("head_logs") - F.col("n_tail") * math.log10(tail_tokens + tail_types + 1.0)
    return joined.select(
        "id", "train", "n_tokens", (F.col("known") + int(ends > 0)).cast("long").alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"),
        base.alias("base_score"), (F.col("model") + tail).alias("score"),
    )
