"""WARC archives written in deterministic shards and read back.

Records are ordered by id over shards whose bounds come from a sample picked by the ids' hash, so
the same table always gives the same shards.  A task writes a shard's records in order, rolls to a
new file when the compressed size reaches the limit, and makes every header and digest anew.
Files get temporary names that no other attempt uses; the rows they return are the manifest, which
alone decides what exists: a second job renames the listed files, and the manifest is written last.
Files of lost or repeated attempts are in no manifest and are never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline.session import scratch_path

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "shard int, part int, temp string, name string, records long, bytes long, first_id string, last_id string, sha256 string"
#: Rows of the sample per shard; the sample on the driver is this times the shards.
PER_SHARD = 20


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Rows (id, url, payload) of a table of pages; a null payload is empty."""
    return pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    )


def plan_revisits(records: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """Rows (id, sha, refers_to): records that only point to one of an equal payload, without payloads.

    Of records with equal payloads of ``min_bytes`` or more the largest id is kept in full, the others
    refer to it.  Equality is that of SHA-256.  Of records that share both payload and largest id all stay in full, as do
    those of a payload that has no id at all.
    """
    long = records.where(F.octet_length("payload") >= min_bytes).select("id", F.sha2("payload", 256).alias("sha"))
    target = (
        long.groupBy("sha").agg(F.max("id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select(F.col("sha").alias("_s"), "refers_to")
    )
    joined = long.join(target, F.col("sha") == F.col("_s"))
    return joined.where(~F.col("id").eqNullSafe(F.col("refers_to"))).select("id", "sha", "refers_to").distinct()


def _bounds(records: DataFrame, shards: int) -> list:
    """At most ``shards - 1`` ids that split the rows evenly, from a sample picked by hash."""
    n = records.count()
    share = max(1, n // (shards * PER_SHARD))
    ids = records.where(F.col("id").isNotNull()).select("id").distinct()
    sample = sorted(r[0] for r in ids.where(F.pmod(F.xxhash64("id"), F.lit(share)) == 0).collect())
    return sorted({sample[i * len(sample) // shards] for i in range(1, shards)}) if sample else []


def _urn(i) -> str:
    return f"<urn:record:{'' if i is None else i}>"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(i, url: str | None, payload: bytes, revisit: bool, refers_to) -> bytes:
    """One uncompressed record: response with its payload, or revisit with the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = "".join(c for c in url or "" if c not in "\r\n")
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(i)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: {_sha1(payload)}", f"WARC-Block-Digest: {_sha1(block)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _packed(data: bytes) -> bytes:
    """One gzip member without a time stamp."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class _Shard:
    """Files of one shard, written under temporary names."""

    def __init__(self, fs, folder: str, shard: int, limit: int):
        self.fs, self.folder, self.shard, self.limit, self.part, self.out = fs, folder, shard, limit, 0, None

    def add(self, i, member: bytes) -> Iterator[dict]:
        if self.out is None:
            self.temp = f"_temporary/{self.shard:06d}-{self.part:05d}-{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.temp}")
            self.n = self.bytes = 0
            self.first, self.sha = i, hashlib.sha256()
        self.out.write(member)
        self.sha.update(member)
        self.n, self.bytes, self.last = self.n + 1, self.bytes + len(member), i
        if self.bytes >= self.limit:
            yield from self.close()

    def close(self) -> Iterator[dict]:
        if self.out is not None:
            self.out.close()
            self.out = None
            text = lambda x: None if x is None else str(x)
            yield {
                "shard": self.shard, "part": self.part, "temp": self.temp, "name": f"shard-{self.shard:06d}-{self.part:05d}.warc.gz",
                "records": self.n, "bytes": self.bytes, "first_id": text(self.first), "last_id": text(self.last), "sha256": self.sha.hexdigest(),
            }
            self.part += 1


def write_warc(records: DataFrame, revisits: DataFrame, folder: str, shards: int, roll_bytes: int = 64 << 20) -> DataFrame:
    """Write ``page_records`` below ``folder`` (a new one) and return the manifest's rows.

    ``plan_revisits`` says which records point to another.  Its rows go to the shards of their ids and
    are met there just before the records, so payloads are shuffled once and joined to nothing.  Null ids come first.  The order within a shard is that of id, then url, then payload, so repeated
    rows and ids do not disturb it.  An empty table gives an empty manifest.
    """
    from pyarrow import fs as pafs

    bounds = _bounds(records, shards)
    id_type = records.schema["id"].dataType.simpleString()
    array = np.array(bounds)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            shard = np.zeros(len(ids), np.int32)
            known = np.flatnonzero(np.asarray(ids.is_valid()))
            if len(known) and len(array):
                shard[known] = np.searchsorted(array, ids.take(pa.array(known)).to_numpy(zero_copy_only=False), side="right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard)], [*batch.schema.names, "shard"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(f"{root}/_temporary", recursive=True)
        now: _Shard | None = None
        done: list[dict] = []
        at: tuple = ()  # the last id with revisits, and where they point by digest
        for batch in batches:
            for r in batch.to_pylist():
                if r["sha"] is not None:
                    if not at or at[0] != (r["shard"], r["id"]):
                        at = ((r["shard"], r["id"]), {})
                    at[1][r["sha"]] = r["refers_to"]
                    continue
                if now is None or now.shard != r["shard"]:
                    if now is not None:
                        done += now.close()
                    now = _Shard(fs, root, r["shard"], roll_bytes)
                known = at[1] if at and at[0] == (r["shard"], r["id"]) else {}
                sha = hashlib.sha256(r["payload"]).hexdigest() if known else None
                done += now.add(r["id"], _packed(record_bytes(r["id"], r["url"], r["payload"], sha in known, known.get(sha))))
        if now is not None:
            done += now.close()
        if done:
            yield pa.RecordBatch.from_pylist(done, _MANIFEST)

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for temp, name in zip(batch.column("temp").to_pylist(), batch.column("name").to_pylist(), strict=True):
                # done by an earlier attempt if the temporary name is gone
                if fs.get_file_info(f"{root}/{temp}").type != pafs.FileType.NotFound:
                    fs.move(f"{root}/{temp}", f"{root}/{name}")
            yield batch

    none = F.lit(None)
    both = records.select("id", "url", "payload", none.cast("string").alias("sha"), none.cast(id_type).alias("refers_to")).unionByName(
        revisits.select("id", none.cast("string").alias("url"), none.cast("binary").alias("payload"), "sha", "refers_to")
    )
    sharded = both.mapInArrow(place, f"id {id_type}, url string, payload binary, sha string, refers_to {id_type}, shard int")
    # rows of revisits before the records of their id
    ordered = sharded.repartition(shards, "shard").sortWithinPartitions("shard", "id", F.col("sha").desc_nulls_last(), "url", "payload")
    written = ordered.mapInArrow(write, MANIFEST)
    spark = records.sparkSession
    written.write.parquet(f"{folder}/_written")
    listed = spark.read.schema(MANIFEST).parquet(f"{folder}/_written").repartition(shards)
    listed.mapInArrow(rename, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


_MANIFEST = pa.schema(
    [("shard", pa.int32()), ("part", pa.int32()), ("temp", pa.string()), ("name", pa.string()), ("records", pa.int64()),
     ("bytes", pa.int64()), ("first_id", pa.string()), ("last_id", pa.string()), ("sha256", pa.string())]
)


def _members(stream) -> Iterator[bytes]:
    """Uncompressed gzip members of a file, one record each."""
    rest, z, parts = b"", None, []
    while True:
        data = rest or stream.read(1 << 20)
        rest = b""
        if not data:
            if z is not None:
                raise ValueError("archive ends within a record")
            return
        z = z or zlib.decompressobj(31)
        parts.append(z.decompress(data))
        if z.eof:
            rest = z.unused_data
            yield b"".join(parts)
            z, parts = None, []


def parse_record(data: bytes) -> dict:
    """Fields of a record; raises ValueError where lengths or digests do not agree."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    fields = dict(x.split(": ", 1) for x in (line if ": " in line else line.replace(":", ": ", 1) for line in lines[1:]))
    n = int(fields["Content-Length"])
    block = rest[:n]
    if not lines[0].startswith("WARC/") or rest[n:] != b"\r\n\r\n" or _sha1(block) != fields["WARC-Block-Digest"]:
        raise ValueError(f"broken record {fields.get('WARC-Record-ID')}")
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (_sha1(payload) != fields["WARC-Payload-Digest"] or len(payload) != sizes[0]):
        raise ValueError(f"broken payload of {fields['WARC-Record-ID']}")
    name = lambda urn: urn.removeprefix("<urn:record:").removesuffix(">") or None
    return {
        "id": name(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "record_type": fields["WARC-Type"],
        "payload": None if revisit else payload, "payload_bytes": sizes[0],
        "payload_digest": base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex(),
        "refers_to": name(fields["WARC-Refers-To"]) if revisit else None,
    }


READ = "id string, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to string"
_READ = pa.schema(
    [("id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string())]
)


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Records of the files in the manifest, each checked against its lengths and digests."""
    from pyarrow import fs as pafs

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for file in batch.column("name").to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(f"{root}/{file}", compression=None) as stream:
                    for data in _members(stream):
                        row = parse_record(data)
                        size += len(data) if payloads else 400
                        rows.append(row if payloads else row | {"payload": None})
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _READ)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _READ)

    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select("name")
    # a task per file: the rows are small, but the files they name are not
    return files.repartition(max(1, files.count())).mapInArrow(load, READ)


def new_folder(spark: SparkSession) -> str:
    path = scratch_path(spark, "warc")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
