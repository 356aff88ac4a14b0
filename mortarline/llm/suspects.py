"""Which 64-bit digests of a document may occur in another one: two Bloom filters per segment.

Digests travel in segments of their value, a few long arrays per batch.  The task that gets a
segment keeps two Bloom filters, one of digests seen once and one of those seen again; what passes the
second is suspected, for all documents that have it.  False positives only mean more to confirm.

A digest that several documents of one batch share is suspected at once: the batch sends a single mark
for it, and its documents go through unsegmented.  So a digest that a third of all documents hold costs
one mark per batch, and no task gathers them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mortarline.llm.text import mixed

FIRST, MARK, KNOWN = 0, 1, 2
#: Bits per digest in each filter, and positions set for it.
BITS, PROBES = 16, 2
#: Digests that go into a packed batch.
PACK = 1 << 20
#: Digests in a part of a filter that the driver hands out, and in all parts before further ones make them fuller instead of more.
PART, MOST = 1 << 20, 1 << 24


class Bloom:
    """Set of 64-bit digests without false negatives, in ``BITS`` bits for each expected one."""

    def __init__(self, expected: int):
        self.size = 1 << max(10, int(expected * BITS - 1).bit_length())
        self.bits = np.zeros(self.size >> 3, np.uint8)

    def _places(self, h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for k in range(PROBES):
            at = mixed(h + np.uint64(0x9E3779B97F4A7C15 * (k + 1) & 0xFFFFFFFFFFFFFFFF)) & np.uint64(self.size - 1)
            yield (at >> np.uint64(3)).astype(np.int64), np.left_shift(1, at & np.uint64(7)).astype(np.uint8)

    def add(self, h: np.ndarray) -> None:
        for byte, bit in self._places(h):
            np.bitwise_or.at(self.bits, byte, bit)

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for byte, bit in self._places(h):
            out &= (self.bits[byte] & bit) != 0
        return out


def _lists(values: pa.Array, lengths: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), values)


def _runs(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values."""
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.array([], np.int64)
    return starts, np.diff(np.append(starts, len(owner)))


def digest_rows(ids: pa.Array, digests: list[np.ndarray], segments: int) -> Iterator[pa.RecordBatch]:
    """Rows (seg, kind, hashes, ids, counts) of one batch; ``digests`` are distinct within a document."""
    lengths = np.fromiter(map(len, digests), np.int64, len(digests))
    if not lengths.sum():
        return
    h = np.concatenate(digests).astype(np.uint64)
    owner = np.repeat(np.arange(len(digests)), lengths)
    order = np.argsort(h, kind="stable")
    starts, sizes = _runs(h[order])
    alone = np.empty(len(h), bool)
    alone[order] = np.repeat(sizes == 1, sizes)
    marks = h[order][starts[sizes > 1]]

    def table(kind, seg, hashes, owners):
        # by segment, in it by document
        order = np.lexsort((owners, seg)) if owners is not None else np.argsort(seg, kind="stable")
        hashes, seg = hashes[order], seg[order]
        begin, n = _runs(seg)
        if owners is None:
            none = pa.array([], ids.type)
            lists = _lists(none, np.zeros(len(n), np.int64)), _lists(pa.array([], pa.int32()), np.zeros(len(n), np.int64))
        else:
            owners = owners[order]
            change = np.concatenate([[True], (owners[1:] != owners[:-1]) | (seg[1:] != seg[:-1])])
            at = np.flatnonzero(change)
            per = np.add.reduceat(change.astype(np.int64), begin)
            counts = np.diff(np.append(at, len(owners)))
            lists = _lists(ids.take(pa.array(owners[at])), per), _lists(pa.array(counts, pa.int32()), per)
        return pa.RecordBatch.from_arrays(
            [pa.array(seg[begin], pa.int32()), pa.array(np.full(len(begin), kind), pa.int32()), _lists(pa.array(hashes.view(np.int64)), n), *lists],
            ["seg", "kind", "hashes", "ids", "counts"],
        )

    def seg_of(x):
        return (mixed(x) % np.uint64(segments)).astype(np.int64)

    if alone.any():
        yield table(FIRST, seg_of(h[alone]), h[alone], owner[alone])
    if len(marks):
        yield table(MARK, seg_of(marks), marks, None)
        known = ~alone
        # no segment needs them, so they are dealt out by document
        yield table(KNOWN, owner[known] * 7919 % segments, h[known], owner[known])


def suspected(docs: DataFrame, digest: Callable[[pa.RecordBatch], list[np.ndarray]], id_col: str) -> DataFrame:
    """Rows (bucket, ids, counts, hashes) for ``per_document``: digests of documents that may occur in another one.

    A row holds what a task found for the documents of a bucket, as a row for each document and segment would be many.
    ``digest`` gives each row of a batch its distinct digests (uint64).  Ids may be null.  Rows that
    share an id count as different documents here; what confirms suspects decides.
    """
    spark = docs.sparkSession
    segments = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_type = docs.schema[id_col].dataType.simpleString()
    bucket = F.pmod(F.xxhash64(id_col), F.lit(segments // 4)).cast("int")
    docs = docs.withColumn(id_col, F.struct(bucket.alias("bucket"), F.col(id_col).alias("id")))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from digest_rows(batch.column(id_col), digest(batch), segments)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, marks, own, size = [], [], [], 0
        for batch in batches:
            kinds = np.asarray(batch.column("kind"))
            for kind, keep in ((FIRST, kept), (MARK, marks)):
                if (kinds == kind).any():
                    keep.append(batch.filter(pa.array(kinds == kind)))
            known = batch.filter(pa.array(kinds == KNOWN))
            if known.num_rows:
                own.append(_by_document(known, None))
                size += len(own[-1][2])
            if size > PACK:
                yield _packed(own)
                own, size = [], 0
        firsts = [np.asarray(b.column("hashes").flatten()).view(np.uint64) for b in kept]
        seen = [np.asarray(b.column("hashes").flatten()).view(np.uint64) for b in marks]
        n = sum(map(len, firsts)) + sum(map(len, seen))
        once, twice = Bloom(n), Bloom(n)
        for h in seen:
            once.add(h)
            twice.add(h)
        for h in firsts:
            # within one array a digest may come from several batches
            h, count = np.unique(h, return_counts=True)
            twice.add(h[once.has(h) | (count > 1)])
            once.add(h)
        for batch in kept:
            own.append(_by_document(batch, twice))
            size += len(own[-1][2])
            if size > PACK:
                yield _packed(own)
                own, size = [], 0
        if size:
            yield _packed(own)

    sent = docs.mapInArrow(send, f"seg int, kind int, hashes array<bigint>, ids array<struct<bucket:int,id:{id_type}>>, counts array<int>")
    return sent.repartition("seg").mapInArrow(meet, f"bucket int, ids array<{id_type}>, counts array<int>, hashes array<bigint>")


def _by_document(batch: pa.RecordBatch, twice: Bloom | None) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(ids, counts, hashes) of the digests that pass the filter."""
    hashes = np.asarray(batch.column("hashes").flatten())
    counts = np.asarray(batch.column("counts").flatten()).astype(np.int64)
    ids = batch.column("ids").flatten()
    run = np.repeat(np.arange(len(counts)), counts)
    if twice is not None:
        keep = twice.has(hashes.view(np.uint64))
        hashes, run = hashes[keep], run[keep]
    starts, n = _runs(run)
    return ids.take(pa.array(run[starts])), n, hashes


def _by_key(key: np.ndarray, counts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order of the runs by key, first run and number of runs of each key, hashes in that order)."""
    order = np.argsort(key, kind="stable")
    begin, n = _runs(key[order])
    c = counts[order]
    at = np.repeat((np.cumsum(counts) - counts)[order] - (np.cumsum(c) - c), c) + np.arange(int(c.sum()))
    return order, begin, n, hashes[at]


def _packed(own: list[tuple[pa.Array, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    ids, counts, hashes = pa.concat_arrays([x[0] for x in own]), np.concatenate([x[1] for x in own]), np.concatenate([x[2] for x in own])
    bucket = ids.field("bucket").to_numpy()
    order, begin, n, hashes = _by_key(bucket, counts, hashes)
    counts = counts[order]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[order][begin], pa.int32()), _lists(ids.field("id").take(pa.array(order)), n),
         _lists(pa.array(counts, pa.int32()), n), _lists(pa.array(hashes), np.add.reduceat(counts, begin))],
        ["bucket", "ids", "counts", "hashes"],
    )


def per_document(found: DataFrame) -> DataFrame:
    """One row (id, hashes) per id, with all digests that are suspected for it."""
    id_type = found.schema["ids"].dataType.elementType.simpleString()

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [
            (b.column("ids").flatten(), np.asarray(b.column("counts").flatten()).astype(np.int64), np.asarray(b.column("hashes").flatten()))
            for b in batches if b.num_rows
        ]
        if not own:
            return
        ids, counts = pa.concat_arrays([x[0] for x in own]), np.concatenate([x[1] for x in own])
        code = pc.dictionary_encode(ids, null_encoding="encode").indices.to_numpy()
        order, begin, _, hashes = _by_key(code, counts, np.concatenate([x[2] for x in own]))
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(order[begin])), _lists(pa.array(hashes), np.add.reduceat(counts[order], begin))], ["id", "hashes"]
        )

    return found.repartition("bucket").mapInArrow(unpack, f"id {id_type}, hashes array<bigint>")


def likely_among(rows: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """The ``rows`` whose column ``name`` is among that of ``keys``, and a few others, without a shuffle of ``rows``.

    One Bloom filter for each ``PART`` keys, made in tasks, is handed out: two bytes a key, and up to ``MOST`` keys.  With
    more keys the filter stays as large and lets more rows through.  None is missed, and a join has to drop the others.
    """
    digests = keys.where(F.col(name).isNotNull()).select(F.xxhash64(name).alias("h"))
    n = digests.count()
    parts = max(1, -(-min(n, MOST) // PART))
    expected = max(1, min(n, MOST) // parts)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, Bloom] = {}
        for batch in batches:
            h, part = batch.column("h").to_numpy().view(np.uint64), batch.column("part").to_numpy()
            for p in np.unique(part).tolist():
                own.setdefault(p, Bloom(expected)).add(h[part == p])
        for p, bloom in own.items():
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([bloom.bits.tobytes()], pa.binary())], ["part", "bits"])

    part = F.pmod("h", F.lit(parts)).cast("int").alias("part")
    made = digests.select("h", part).repartition(parts, "part").mapInArrow(build, "part int, bits binary")
    columns, filters = rows.columns, {}
    for row in made.toLocalIterator():
        filters[row["part"]] = Bloom(expected)
        filters[row["part"]].bits = np.frombuffer(bytes(row["bits"]), np.uint8)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = batch.column("_h").to_numpy()
            hit = np.zeros(len(signed), bool)
            for p, bloom in filters.items():
                at = np.flatnonzero(signed % parts == p)
                hit[at] = bloom.has(signed[at].view(np.uint64))
            if hit.any():
                yield batch.filter(pa.array(hit)).select(columns)

    return rows.select("*", F.xxhash64(name).alias("_h")).mapInArrow(keep, rows.schema)
