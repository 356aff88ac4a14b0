"""SentencePiece encoding and decoding with a table of distinct chunks.

Where no piece of a model has a whitespace marker after another character, merges never
cross from one marked word into the next.  A text then falls into chunks, each a run of markers
with the word that follows (a marker typed in the text counts as one), and the ids of a text are its chunks' ids in order.  Every batch
collects its distinct chunks, segments each of them once, and joins ids back by position.  A line
feed that is in no piece stands alone in the same way and also begins a chunk.

A batch holds its own table, so nothing is shuffled and a lost task only repeats its split.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
#: Characters of text treated at a time, so that a table never outgrows a worker.
BLOCK_CHARS = 4_000_000


def model_facts(model: bytes) -> tuple[bool, bool]:
    """(markers bound chunks, line feeds bound chunks) for a serialized model.

    Read from its pieces: false where some piece has a marker behind another character, or where
    the model normalizes text, drops white space or has user-defined symbols.
    """
    from sentencepiece import sentencepiece_model_pb2 as pb

    spec = pb.ModelProto()
    spec.ParseFromString(model)
    norm = spec.normalizer_spec
    plain = not (norm.precompiled_charsmap or norm.remove_extra_whitespaces or spec.trainer_spec.treat_whitespace_as_suffix)
    plain = plain and norm.add_dummy_prefix and norm.escape_whitespaces and not any(p.type == 4 for p in spec.pieces)
    crossing = any(re.search(f"[^{MARK}]{MARK}", p.piece) for p in spec.pieces)
    return plain and not crossing, not any("\n" in p.piece for p in spec.pieces)


class Encoder:
    """Encodes and decodes lists of texts with one model; made once per task."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        marks, feeds = model_facts(model)
        self.chunks = re.compile("[ ▁]+[^ ▁\n]*|\n[^ ▁\n]*" if feeds else "[ ▁]+[^ ▁]*") if marks else None
        self.space = self.sp.piece_to_id(MARK)

    def _segment(self, chunks: list[str]) -> list[list[int]]:
        """Ids of distinct chunks; the library sets one marker before each text it gets."""
        bare = [c[1:] if c[0] != "\n" else c for c in chunks]
        ids = self.sp.encode(bare, num_threads=1)
        out = []
        for c, b, i in zip(chunks, bare, ids, strict=True):
            if not b:
                out.append([self.space])
            elif c[0] == "\n":
                # the marker that the library sets before a line feed stands alone
                out.append(i[1:])
            else:
                out.append(i)
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids per text, as the library gives them without begin and end ids."""
        if self.chunks is None:
            return [np.array(x, dtype=np.int32) for x in self.sp.encode(texts, num_threads=1)]
        found = [self.chunks.findall(" " + t) if t else [] for t in texts]
        table: dict[str, int] = {}
        places = [np.fromiter((table.setdefault(c, len(table)) for c in f), np.int64, len(f)) for f in found]
        ids = self._segment(list(table))
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for x in ids for i in x), np.int32, int(lengths.sum()))
        starts = np.cumsum(lengths) - lengths
        out = []
        for p in places:
            n = lengths[p]
            # position of every id: its chunk's start, counted on within the chunk
            at = np.repeat(starts[p] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            out.append(flat[at])
        return out

    def decode(self, ids: np.ndarray) -> str:
        return self.sp.decode(ids.tolist())


def _blocks(texts: list[str]) -> Iterator[slice]:
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BLOCK_CHARS:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False) -> DataFrame:
    """Rows (id, ids, decoded) in the order of the input, one per row of it.

    ``decoded`` is the model's own decoding of ``ids``, or null unless ``decode``.  Null and empty texts have no
    ids and decode to an empty text.  Other columns are not read, so their names cannot clash;
    repeated rows are encoded alike.  The model (a file on the driver, some 0.5 MB) travels with the
    function, so executors need no such file.
    """
    with open(model_path, "rb") as f:
        model = f.read()
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for part in _blocks(texts):
                found = encoder.encode(texts[part])
                lengths = np.array([0, *map(len, found)], dtype=np.int64).cumsum()
                lists = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(np.concatenate(found), pa.int32()))
                back = pa.array([encoder.decode(x) if decode else None for x in found], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("id")[part.start : part.stop], lists, back], ["id", "ids", "decoded"])

    return rows.mapInArrow(run, f"id {id_type}, ids array<int>, decoded string")


def decode_ids(rows: DataFrame, model_path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """Rows (id, decoded) from arrays of ids; null arrays decode to an empty text."""
    with open(model_path, "rb") as f:
        model = f.read()
    given = rows.select(rows[id_col].alias("id"), rows[ids_col].alias("ids"))
    id_type = given.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for batch in batches:
            back = [encoder.sp.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(back, pa.string())], ["id", "decoded"])

    return given.mapInArrow(run, f"id {id_type}, decoded string")
