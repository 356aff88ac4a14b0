"""Removal of byte strings that an earlier document has, by interval expansion on a Burrows-Wheeler transform.

Every string of ``length`` bytes has one anchor, the window's smallest digest of a shorter gram, so equal
strings have equal anchors.  Anchors that two documents hold are found with Bloom filters (``suspects``);
only the stretches around those are looked at further, and equal ones are folded by their digests first, which settles all
anchors with a single stretch.  The other stretches are shuffled, by anchor.  A task puts
the stretches of its anchors together and derives their common prefixes from the transform: intervals of
suffixes that agree in n bytes are extended backward by one byte, breadth first, which finds the places where
exactly n + 1 bytes agree.  The expansion stops at ``length``; what is still together then is one string, and the
smallest document among its holders keeps it.

An anchor with many different stretches is not put together: its strings are dealt out one by one, each by its own
digest.  They travel packed, as long arrays for each batch and segment of digests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mortarline.llm.suspects import likely_among, per_document, suspected
from mortarline.llm.text import by_batch, cut_and_release, mixed

#: Positions in one stretch at most; a longer run of one anchor is cut into several.
STRETCH = 64
#: Stretches of an anchor beyond which its strings are dealt out one by one.
CROWDED = 256
#: Bytes put together in one transform, whose arrays of numbers should stay in the cache of a core.
BLOCK = 1 << 17

_FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def anchors(data: bytes, length: int) -> np.ndarray:
    """The anchor (uint64) of the string of ``length`` bytes at each position that has one."""
    n = len(data) - length + 1
    if n <= 0:
        return np.array([], np.uint64)
    words = max(1, (length - 2) // 16)
    gram = 8 * words
    eight = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,)).astype(np.uint64)
    count = len(data) - gram + 1
    h = np.zeros(count, np.uint64)
    for k in range(words):
        h ^= eight[8 * k : 8 * k + count] * _FACTORS[k % 3]
        h = (h << np.uint64(23)) | (h >> np.uint64(41))
    h = mixed(h)
    # smallest over the window, by doubling
    window, width = length - gram + 1, 1
    while width * 2 <= window:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    rest = window - width
    return np.minimum(h[:n], h[rest : rest + n]) if rest else h[:n]


def stretches(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first position, positions, anchor) of the runs of one anchor, none over STRETCH positions."""
    a = anchors(data, length)
    if not len(a):
        return np.array([], np.int64), np.array([], np.int64), a
    starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    sizes = np.diff(np.append(starts, len(a)))
    if sizes.max() > STRETCH:
        parts = -(-sizes // STRETCH)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        left = np.repeat(sizes, parts) - nth * STRETCH
        starts, sizes = np.repeat(starts, parts) + nth * STRETCH, np.minimum(left, STRETCH)
    return starts, sizes, a[starts]


def string_digests(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two digests (uint64) of the string of ``length`` bytes, 8 at least, at each position that has one."""
    count = len(data) - length + 1
    eight = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))
    sides = [np.full(count, x, np.uint64) for x in _FACTORS[:2]]
    for k in [*range(0, length - 8, 8), length - 8]:
        word = eight[k : k + count].astype(np.uint64)
        sides = [mixed(h ^ word) * x for h, x in zip(sides, _FACTORS[1:], strict=True)]
    return mixed(sides[0]), mixed(sides[1])


def dealt(batch: pa.RecordBatch, length: int, segments: int) -> pa.RecordBatch:
    """All strings of the stretches (key, piece, s, least, most) with their offsets, a row of arrays for each segment of digests."""
    sizes = pc.binary_length(batch.column("s")).to_numpy().astype(np.int64)
    n = sizes - (length - 1)
    owner = np.repeat(np.arange(len(n)), n)
    lo = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(np.cumsum(sizes) - sizes, n) + lo
    a, b = (h[at] for h in string_digests(b"".join(batch.column("s").to_pylist()), length))
    seg = (a % np.uint64(segments)).astype(np.int32)
    order = np.argsort(seg, kind="stable")
    begin = np.flatnonzero(np.concatenate([[True], np.diff(seg[order]) != 0]))
    ends = pa.array(np.append(begin, len(order)), pa.int32())
    own = pa.array(owner[order])
    columns = [pa.array(a[order].view(np.int64)), pa.array(b[order].view(np.int64)), pa.array(lo[order], pa.int32())]
    columns += [batch.column(c).take(own) for c in ("key", "piece", "least", "most")]
    return pa.RecordBatch.from_arrays(
        [pa.array(seg[order][begin]), *[pa.ListArray.from_arrays(ends, c) for c in columns]], ["seg", "a", "b", "lo", "key", "piece", "least", "most"]
    )


def met(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """(key, piece, lo, hi, holder): the strings of ``dealt`` rows that have a smaller holder than their stretch's largest one."""
    a, b, lo, key, piece, least, most = (
        pa.concat_arrays([x.column(c).flatten() for x in batches]) for c in ("a", "b", "lo", "key", "piece", "least", "most")
    )
    order = np.lexsort((b.to_numpy(), a.to_numpy()))
    x, y = a.to_numpy()[order], b.to_numpy()[order]
    begin = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
    # documents without an id come first
    ranks = pc.rank(pa.concat_arrays([least.field("id"), most.field("id")]), "ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)
    first, last = ranks[: len(order)], ranks[len(order) :]
    smallest = np.minimum.reduceat(first[order], begin)
    group = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(order))))
    hit = smallest[group] < last[order]
    row = pa.array(order[hit])
    _, example = np.unique(first, return_index=True)
    of = np.zeros(int(ranks.max()) + 1, np.int64)
    of[first[example]] = example
    holder = least.take(pa.array(of[smallest[group][hit]]))
    lo = lo.take(row)
    return pa.RecordBatch.from_arrays([key.take(row), piece.take(row), lo, lo, holder], ["key", "piece", "lo", "hi", "holder"])


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Positions by their next ``depth`` symbols or more (0 beyond the end), by prefix doubling."""
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k : k + n].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    sorted_ = key[order]
    known = 8
    while True:
        step = np.concatenate([[0], (sorted_[1:] != sorted_[:-1]).cumsum()])
        rank = np.empty(n, np.int64)
        rank[order] = step
        if known >= depth or step[-1] == n - 1:
            return order
        later = np.zeros(n, np.int64)
        later[: max(0, n - known)] = rank[known:] + 1
        key = rank * (n + 2) + later
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        known *= 2


def common_strings(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix order, group of each place in it): places of one group agree in ``length`` symbols.

    Level by level: the boundaries between groups that agree in n symbols, found at the last level, bound
    intervals; for each symbol before an interval's suffixes, the interval extended by it ends at a
    boundary of the next level.  Only intervals at new boundaries are extended.
    """
    n = len(symbols)
    order = suffix_order(symbols, length + 1)
    before = symbols[order - 1]  # the transform; the text ends with a separator, which precedes its start
    by_symbol = np.argsort(before, kind="stable")
    back = np.empty(n, np.int64)
    back[by_symbol] = np.arange(n)
    # the next place in the transform with the same symbol
    following = np.full(n, n)
    same = before[by_symbol[1:]] == before[by_symbol[:-1]]
    following[by_symbol[:-1][same]] = by_symbol[1:][same]
    bound = np.zeros(n + 1, bool)
    first = symbols[order]
    new = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
    bound[new] = bound[n] = True
    new = new[1:]
    for _ in range(1, length):
        if not len(new):
            break
        edges = np.flatnonzero(bound)
        low = edges[np.searchsorted(edges, new) - 1]
        sizes = new - low
        place = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        last = following[place] >= np.repeat(new, sizes)
        found = back[place[last]] + 1
        new = np.unique(found[~bound[found]])
        bound[new] = True
    return order, bound[:n].cumsum() - 1


def least_holders(texts: list[bytes], least: np.ndarray, most: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(text, from, to, holder): offsets whose string has a smaller holder than the text's largest one.

    ``least`` and ``most`` are ranks of the smallest and largest documents that hold a text.
    """
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    # UTF-8 has no byte 255, so symbols are the bytes plus one, and 0 separates
    symbols = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8) + np.uint8(1)
    owner = np.repeat(np.arange(len(texts)), sizes)
    begin = np.cumsum(sizes) - sizes
    order, group = common_strings(symbols, length)
    smallest = np.minimum.reduceat(least[owner[order]], np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])))
    holder = np.empty(len(symbols), np.int64)
    holder[order] = smallest[group]
    offset = np.arange(len(symbols)) - begin[owner]
    hit = (offset + length < sizes[owner]) & (holder < most[owner])
    at = np.flatnonzero(hit)
    if len(at):
        cut = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (holder[at[1:]] != holder[at[:-1]]) | (owner[at[1:]] != owner[at[:-1]])])
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(at)) - 1
        yield from zip(owner[at[starts]].tolist(), offset[at[starts]].tolist(), offset[at[ends]].tolist(), holder[at[starts]].tolist(), strict=True)


def _rank(doc: Column) -> Column:
    """Order of documents: those without an id first, then by id."""
    return F.struct(doc.isNotNull().alias("known"), doc.alias("id"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """Rows (id, kept, n_bytes, n_removed, n_spans), one per document; ``kept`` is binary.

    Each byte goes that lies in a string of ``length`` bytes that also starts in a document with a smaller
    id.  Strings are judged on the input.  A null text is empty.  Rows that share an id are one
    document, and so are rows without an id, which come before all others.  Other columns are not read.
    """
    rows = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).cast("binary").alias("text"))
    rows = rows.withColumn("print", F.xxhash64("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    ranked = f"struct<known:boolean,id:{id_type}>"

    # whole copies go as one span, and only their first holder is looked at further
    prints = rows.where(F.octet_length("text") >= length).select("id", "print", F.sha2("text", 256).alias("sha"), F.octet_length("text").alias("n"))
    first = prints.groupBy("sha").agg(F.min(_rank(F.col("id"))).alias("least"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    copies = prints.join(first, "sha").where(_rank(F.col("id")) > F.col("least")).select("id", "print", "n").distinct()
    copies = cut_and_release(copies)

    def digest(batch: pa.RecordBatch) -> list[np.ndarray]:
        return [np.unique(stretches(t, length)[2]) for t in batch.column("text").to_pylist()]

    found = cut_and_release(per_document(suspected(rows.select("id", "text"), digest, "id"))).withColumnRenamed("id", "_id")
    whole = copies.groupBy(F.col("id").alias("_c")).agg(F.collect_set("print").alias("copies"))
    held = rows.join(found, rows["id"].eqNullSafe(found["_id"])).join(whole, rows["id"].eqNullSafe(whole["_c"]), "left")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, starts, keys, texts = [], [], [], []
            size = begin = 0
            prints, copied = batch.column("print").to_pylist(), batch.column("copies").to_pylist()

            def out(at, starts, keys, texts, batch=batch):
                where = pa.array(at, pa.int32())
                return pa.RecordBatch.from_arrays(
                    [batch.column("id").take(where), batch.column("print").take(where), pa.array(starts, pa.int32()), pa.array(keys, pa.int64()), pa.array(texts, pa.binary())],
                    ["id", "print", "start", "key", "s"],
                )

            for i, text in enumerate(batch.column("text").to_pylist()):
                if copied[i] and prints[i] in copied[i]:
                    continue
                start, n, key = stretches(text, length)
                mine = np.isin(key, np.asarray(batch.column("hashes")[i].values).view(np.uint64))
                start, n, key = start[mine], n[mine], key[mine]
                at += [i] * len(start)
                starts.append(start)
                keys.append(key.view(np.int64))
                texts += [text[a : a + k + length - 1] for a, k in zip(start.tolist(), n.tolist(), strict=True)]
                size += len(start)
                if size - begin > 40_000:
                    yield out(at, np.concatenate(starts), np.concatenate(keys), texts)
                    at, starts, keys, texts, begin = [], [], [], [], size
            if at:
                yield out(at, np.concatenate(starts), np.concatenate(keys), texts)

    named = held.select("id", "text", "print", "hashes", "copies").mapInArrow(name, f"id {id_type}, print long, start int, key long, s binary")
    named = cut_and_release(named)
    # a stretch is told apart by its anchor and a digest; those of an anchor that has a single one have the same holders
    # at all places, so only the others are looked at as strings
    piece = F.xxhash64("s").alias("piece")
    holders = [F.min(_rank(F.col("id"))).alias("least"), F.max(_rank(F.col("id"))).alias("most")]
    folded = named.groupBy("key", piece).agg(*holders, F.first(F.octet_length("s")).alias("size"))
    counts = folded.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("least") < F.col("most")).alias("held_twice"), *[F.first(c).alias(c) for c in ("piece", "least", "size")]
    )
    counts = cut_and_release(counts.where("n > 1 OR held_twice"))
    one = counts.where("n = 1").select("key", "piece", F.lit(0).alias("lo"), (F.col("size") - length).alias("hi"), F.col("least").alias("holder"))
    several = counts.where("n > 1").select("key", "n")
    usable = cut_and_release(likely_among(named.select("id", "key", "s"), several, "key").groupBy("key", "s").agg(*holders).join(several, "key"))
    alone = usable.where(f"n <= {CROWDED}")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            keys = batch.column("key").to_numpy()
            lengths = pc.binary_length(batch.column("s")).to_numpy()
            begin = 0
            for end in [*np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]:
                if size > BLOCK and (not held or keys[begin] != held[-1].column("key")[-1].as_py()):
                    yield from _expanded(held, length)
                    held, size = [], 0
                held.append(batch.slice(begin, end - begin))
                size += int(lengths[begin:end].sum())
                begin = end
        if held:
            yield from _expanded(held, length)

    runs = cut_and_release(
        alone.select("key", piece, "s", "least", "most").repartition("key").sortWithinPartitions("key")
        .mapInArrow(expand, f"key long, piece long, lo int, hi int, holder {ranked}")
    )
    segments = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = ", ".join(f"{c} array<{t}>" for c, t in (("a", "bigint"), ("b", "bigint"), ("lo", "int"), ("key", "bigint"), ("piece", "bigint"), ("least", ranked), ("most", ranked)))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if held:
            yield met(held)

    strings = usable.where(f"n > {CROWDED}").select("key", piece, "s", "least", "most").repartition("key", "piece")
    strings = strings.mapInArrow(by_batch(lambda batch: dealt(batch, length, segments)), f"seg int, {lists}")
    single = cut_and_release(strings.repartition("seg").mapInArrow(meet, f"key long, piece long, lo int, hi int, holder {ranked}"))
    # the runs of a stretch meet its places as one row
    run = F.struct("holder", "lo", "hi").alias("run")
    all_runs = one.unionByName(runs).unionByName(single).groupBy("key", "piece").agg(F.min("holder").alias("first"), F.collect_list(run).alias("runs"))

    places = named.select("id", "print", "start", "key", piece).join(all_runs, ["key", "piece"]).where(_rank(F.col("id")) > F.col("first"))
    mine = F.filter("runs", lambda r: r["holder"] < _rank(F.col("id")))
    cuts = places.select("id", F.transform(mine, lambda r: F.struct("print", (F.col("start") + r["lo"]).alias("a"), (F.col("start") + r["hi"] + length).alias("b"))).alias("c"))
    cuts = cuts.unionByName(copies.select("id", F.array(F.struct("print", F.lit(0).alias("a"), F.col("n").alias("b"))).alias("c")))
    cuts = cut_and_release(cuts.groupBy(F.col("id").alias("_id")).agg(F.flatten(F.collect_list("c")).alias("cuts")))
    joined = rows.join(cuts, rows["id"].eqNullSafe(cuts["_id"]), "left").select("id", "text", "print", "cuts")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, before, spans = [], [], []
        lists = batch.column("cuts")
        for i, (text, own) in enumerate(zip(batch.column("text").to_pylist(), batch.column("print").to_pylist(), strict=True)):
            before.append(len(text))
            found = []
            if lists[i].is_valid:
                c = lists[i].values
                mine = c.field("print").to_numpy() == own
                a, b = c.field("a").to_numpy()[mine], c.field("b").to_numpy()[mine]
                order = np.argsort(a, kind="stable")
                a, b = a[order], b[order]
                if len(a):
                    top = np.maximum.accumulate(b)
                    starts = np.flatnonzero(np.concatenate([[True], a[1:] > top[:-1]]))
                    found = list(zip(a[starts].tolist(), top[np.append(starts[1:], len(a)) - 1].tolist(), strict=True))
            spans.append(len(found))
            parts, at = [], 0
            for x, y in found:
                parts.append(text[at:x])
                at = y
            kept.append(b"".join([*parts, text[at:]]))
        removed = np.array(before) - np.fromiter(map(len, kept), np.int64, len(kept))
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(kept, pa.binary()), pa.array(before, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())],
            ["id", "kept", "n_bytes", "n_removed", "n_spans"],
        )

    return joined.mapInArrow(by_batch(cut), f"id {id_type}, kept binary, n_bytes long, n_removed long, n_spans long")


def _expanded(held: list[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    block = pa.Table.from_batches(held).combine_chunks()
    docs = []
    for side in ("least", "most"):
        c = block.column(side).combine_chunks()
        docs += list(zip(c.field("known").to_pylist(), c.field("id").to_pylist(), strict=True))
    ordered = sorted(set(docs))
    rank = {d: i for i, d in enumerate(ordered)}
    ranks = np.fromiter((rank[d] for d in docs), np.int64, len(docs))
    n = block.num_rows
    found = list(least_holders(block.column("s").to_pylist(), ranks[:n], ranks[n:], length))
    if found:
        row, lo, hi, holder = map(list, zip(*found, strict=True))
        take = pa.array(row, pa.int32())
        kind = block.schema.field("least").type
        yield pa.RecordBatch.from_arrays(
            [block.column("key").combine_chunks().take(take), block.column("piece").combine_chunks().take(take), pa.array(lo, pa.int32()), pa.array(hi, pa.int32()),
             pa.array([{"known": ordered[x][0], "id": ordered[x][1]} for x in holder], kind)],
            ["key", "piece", "lo", "hi", "holder"],
        )
