"""Line dedup: lines that many documents hold stay in one of them.

Digests of eligible lines go through two Bloom filters (``suspects``); only lines that are suspected
to repeat are shuffled with their text, counted exactly, and their owner chosen.  The text of documents
is shuffled once, by id, to meet first the suspects and then the decisions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mortarline.llm.suspects import per_document, suspected
from mortarline.llm.text import by_batch, bytes_of
from mortarline.session import cut_lineage

#: Bytes that continue a code point in UTF-8.
_INNER = bytes(range(0x80, 0xC0))


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The line without outer ASCII white space, A-Z lower-cased; None if under ``min_chars`` code points."""
    key = line.strip()
    if len(key) < min_chars:
        return None
    key = key.lower()
    return key if len(key.translate(None, _INNER)) >= min_chars else None


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The rows with ``text`` cut down, plus ``n_lines`` (before) and ``n_dropped`` (long).

    A line's key is the line without outer white space, A-Z lower-cased.  Keys of ``min_chars`` or more
    code points that ``min_docs`` or more documents hold lose all their lines but those in the document
    of the largest id.  Rows that share an id are one document, as are all rows without an id, which
    has the smallest.  A null text is one empty line.  Extra columns are kept, whatever their names.
    """
    text_at, id_at = docs.columns.index(text_col), docs.columns.index(id_col)
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    id_name, text_name = names[id_at], names[text_at]
    narrow = rows.select(F.col(id_name).alias("k"), F.col(text_name).alias("t"))
    id_type = rows.schema[id_name].dataType.simpleString()

    def digest(batch: pa.RecordBatch) -> list[np.ndarray]:
        out = []
        for text in bytes_of(batch.column("t")):
            keys = {key for x in text.split(b"\n") if (key := line_key(x, min_chars))}
            out.append(np.fromiter(set(map(xxhash.xxh3_64_intdigest, keys)), np.uint64))
        return out

    found = per_document(suspected(narrow, digest, "k"))

    def name_lines(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, keys = [], []
        suspects = batch.column("hashes")
        for i, text in enumerate(bytes_of(batch.column("t"))):
            wanted = set(np.asarray(suspects[i].values).view(np.uint64).tolist())
            mine = {key for x in text.split(b"\n") if (key := line_key(x, min_chars)) and xxhash.xxh3_64_intdigest(key) in wanted}
            at += [i] * len(mine)
            keys += mine
        ids = batch.column("k").take(pa.array(at, pa.int32()))
        return pa.RecordBatch.from_arrays([ids, pa.array(keys, pa.binary())], ["k", "key"])

    held = narrow.join(found, narrow["k"].eqNullSafe(found["id"])).select("k", "t", "hashes")
    pairs = cut_lineage(held.mapInArrow(by_batch(name_lines), f"k {id_type}, key binary").distinct())
    often = (
        pairs.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("owner")).where(F.col("n") >= min_docs)
        .select(F.col("key").alias("often"), "owner")
    )
    lost = pairs.join(often, F.col("key") == F.col("often")).where(~F.col("k").eqNullSafe(F.col("owner")))
    drops = lost.groupBy(F.col("k").alias("id")).agg(F.collect_list(F.md5("key")).alias("drops"))

    schema = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    joined = rows.join(drops, rows[id_name].eqNullSafe(drops["id"]), "left").select(*names, "drops")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        import hashlib

        texts, before, dropped = [], [], []
        drops = batch.column("drops").to_pylist()
        for text, gone in zip(bytes_of(batch.column(text_name)), drops, strict=True):
            lines = text.split(b"\n")
            before.append(len(lines))
            if gone:
                gone = set(gone)
                lines = [x for x in lines if not ((key := line_key(x, min_chars)) and hashlib.md5(key).hexdigest() in gone)]
                text = b"\n".join(lines)
            dropped.append(before[-1] - len(lines))
            texts.append(text)
        columns = list(batch.columns[:-1])
        columns[text_at] = pa.array(texts, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([*columns, pa.array(before, pa.int64()), pa.array(dropped, pa.int64())], [*names, "n_lines", "n_dropped"])

    done = joined.mapInArrow(by_batch(cut), f"{schema}, n_lines long, n_dropped long")
    return done.toDF(*docs.columns, "n_lines", "n_dropped")
