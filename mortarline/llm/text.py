"""What the operators share: word and byte conventions, batch loops, fresh column names."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mortarline.session import cut_lineage

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def read(spark, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def bytes_of(column: pa.Array) -> list[bytes]:
    """Values of a string column as UTF-8 bytes, null as empty."""
    return [b"" if v is None else v for v in column.cast(pa.large_binary()).to_pylist()]


def by_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable:
    """Function for ``mapInArrow`` that treats one batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield out

    return run


#: Setting by which Spark removes the shuffle files of a query when it ends.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def sha_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def cut_and_release(df: DataFrame) -> DataFrame:
    """``cut_lineage``, and let go of the shuffle files that only the written rows needed.

    Spark removes them at the end of the write.  Without ``RELEASE`` it does so once the driver has collected the objects
    that stand for them as garbage, which a driver with little to do may put off until the disks of the executors are full.
    """
    conf = df.sparkSession.conf
    before = conf.get(RELEASE, None)
    conf.set(RELEASE, "true")
    try:
        out = cut_lineage(df)
    finally:
        if before is None:
            conf.unset(RELEASE)
        else:
            conf.set(RELEASE, before)
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads 64-bit values over all bits (wrapping arithmetic)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of the named columns."""
    out = F.lit(True)
    for n in names:
        out = out & left[n].eqNullSafe(right[n])
    return out


#: Value of each byte in a word's digest, A-Z as a-z; 0 for white space.
_VALUES = np.arange(256, dtype=np.uint64) + np.uint64(1)
_VALUES[65:91] += np.uint64(32)
_VALUES[[9, 10, 11, 12, 13, 32]] = 0
_BASE = 0x9E3779B97F4A7C15
_PIECE = 1 << 20
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of _BASE and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(2 * n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers


def word_digests(data: bytes) -> np.ndarray:
    """64-bit digests of the words of a UTF-8 text, in order, A-Z as a-z.

    A word's digest is a polynomial of its bytes, read off running sums over the text, so the words
    need no Python objects.  Long texts are treated piece by piece, cut at white space.
    """
    out, at = [], 0
    while at < len(data):
        end = at + _PIECE
        if end < len(data):
            cut = re.compile(rb"[\x20\x09-\x0D]").search(data, end)
            end = cut.start() if cut else len(data)
        part = np.frombuffer(data, np.uint8, min(end, len(data)) - at, at)
        powers, inverse = _power_tables(len(part) + 1)
        values = _VALUES[part]
        inside = np.zeros(len(part) + 2, np.int8)
        inside[1:-1] = values != 0
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(values * powers[: len(part)], out=sums[1:])
        out.append(mixed((sums[ends] - sums[starts]) * inverse[starts]))
        at = end
    return np.concatenate(out) if out else np.array([], np.uint64)
