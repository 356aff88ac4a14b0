"""Alignment of two tokenizers' tokens over the same bytes by interval coalescing.

All tokens of a block of documents, of A and of B, are intervals of bytes.  One lexsort puts them in the order
of their starts, ``maximum.accumulate`` runs over their ends, and a group begins wherever a start
reaches the running maximum: there tokens of both kinds end.  Overlapping pairs are expanded inside
the groups, which gives no more pairs than there are tokens, as each tokenizer's intervals do not overlap.

Of the overlapping pairs those that end together are links.  Of two linked tokens one is a suffix of the
other, so the number of different linked pairs has a bound that depends on the two vocabularies
only (``linkable``), not on the corpus; up to BROADCAST_PAIRS their counts are broadcast, beyond that they are joined by a shuffle.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mortarline.llm.bytebpe import text_blocks
from mortarline.llm.pieces import MARK, Encoder
from mortarline.llm.text import bytes_of
from mortarline.session import cut_lineage

#: Letters and signs that all versions of Unicode class alike: texts of these alone take the faster of two equal encoders.
PLAIN = re.compile("[\t\n\r -~¡-ɏ‐-‧‰-⁞]*")
#: Most pairs of counts that are broadcast (24 bytes each), and bytes of text treated at a time.
BROADCAST_PAIRS, BLOCK_BYTES = 4_000_000, 400_000


def byte_letters() -> dict[str, int]:
    """Letters that byte-level vocabularies write for bytes: printable ones as they are, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def bytes_of_level(content: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary in its JSON form; added tokens stand for their own letters."""
    spec, letters = json.loads(content), byte_letters()
    added = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    vocab = {i: bytes(letters[c] for c in token) for token, i in spec["model"]["vocab"].items() if i not in added} | added
    return [vocab.get(i, b"") for i in range(max(vocab) + 1)]


def bytes_of_pieces(model: bytes) -> list[bytes]:
    """Bytes of each piece: the marker is a space, byte pieces are their byte."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    spec = pb.ModelProto()
    spec.ParseFromString(model)
    return [bytes([int(p.piece[3:5], 16)]) if p.type == 6 else p.piece.replace(MARK, " ").encode() for p in spec.pieces]


def linkable(a: list[bytes], b: list[bytes]) -> int:
    """Bound of the number of different linked pairs: those in which one token is a suffix of the other."""
    total = 0
    for left, right, equal in ((a, b, True), (b, a, False)):
        ids: dict[bytes, int] = {}
        for token in right:
            if token:
                ids[token] = ids.get(token, 0) + 1
        for token in left:
            total += sum(ids.get(token[i:], 0) for i in range(0 if equal else 1, len(token)))
    return total


class Vocabulary:
    """Bytes of a tokenizer's ids as one array with starts and lengths."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        n = self.lengths[ids]
        return self.blob[np.repeat(self.starts[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))].tobytes()


def coalesce(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by start, group of each interval in that order) of intervals; touching ones are apart."""
    order = np.lexsort((ends, starts))
    top = np.maximum.accumulate(ends[order])
    fresh = np.ones(len(order), bool)
    fresh[1:] = starts[order][1:] >= top[:-1]
    return order, np.cumsum(fresh) - 1


def overlaps(a_starts: np.ndarray, a_ends: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (position in A, position in B) of overlapping intervals; within a side they ascend and do not overlap."""
    first = np.searchsorted(b_ends, a_starts, "right")
    n = np.maximum(np.searchsorted(b_starts, a_ends, "left") - first, 0)
    return np.repeat(np.arange(len(a_starts)), n), np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def ranked(content: str):
    """An encoder by ranks that equals a byte-level JSON tokenizer, or None if its ids are not the order of its merges."""
    import tiktoken
    from public_tokenizers import PATTERN

    spec = json.loads(content)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    known = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not spec.get("normalizer")
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if not known or model.get("ignore_merges") or any(model["vocab"].get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
        return None
    letters = byte_letters()
    ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if i < 256 + len(pairs)}
    return tiktoken.Encoding("by ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Aligner:
    """Both tokenizers of a task, and the alignment of blocks of texts."""

    def __init__(self, level: str, model: bytes):
        self.content, self.made = level, None
        self.fast = ranked(level)
        self.pieces = Encoder(model)
        self.a, self.b = Vocabulary(bytes_of_level(level)), Vocabulary(bytes_of_pieces(model))
        most = max(len(self.a.lengths), len(self.b.lengths))
        # a token's text by what follows it: the same side, the other side, the next group, nothing
        self.most, self.texts = most, [f"{i}{sep}" for sep in (",", "|", ";", "") for i in range(most)]

    @property
    def level(self):
        """The byte-level tokenizer, made when a text needs it."""
        if self.made is None:
            from tokenizers import Tokenizer

            self.made = Tokenizer.from_str(self.content)
            self.made.encode_special_tokens = True
        return self.made

    def level_ids(self, texts: list[str]) -> list[np.ndarray]:
        """The byte-level tokenizer's ids per text."""
        out: list = [None] * len(texts)
        other = []
        for i, t in enumerate(texts):
            if self.fast and PLAIN.fullmatch(t):
                out[i] = self.fast.encode_ordinary(t)
            else:
                other.append(i)
        if other:
            for i, e in zip(other, self.level.encode_batch_fast([texts[i] for i in other], add_special_tokens=False), strict=True):
                out[i] = e.ids
        return [np.array(x, np.int64) for x in out]

    def tokens(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B per text; none where the joined bytes of one of them are not space + text."""
        plain = [t.decode("utf-8", "replace") for t in texts]
        a = self.level_ids([" " + t for t in plain])
        b = [x.astype(np.int64) for x in self.pieces.encode(plain)]
        none = np.array([], np.int64)
        out = []
        for t, x, y in zip(texts, a, b, strict=True):
            kept = t and self.a.joined(x) == b" " + t == self.b.joined(y)
            out.append((x, y) if kept else (none, none))
        return out

    def block(self, texts: list[bytes]) -> dict[str, list]:
        """Columns n_a, n_b, ends, groups, links (codes) and times of a block of texts."""
        found = self.tokens(texts)
        n_a, n_b = (np.array([len(p[i]) for p in found], np.int64) for i in (0, 1))
        ids = [np.concatenate([p[i] for p in found]) for i in (0, 1)]
        # documents lie one after the other, so no group spans two
        sizes = [self.a.lengths[ids[0]], self.b.lengths[ids[1]]]
        ends = [np.cumsum(s) for s in sizes]
        starts = [e - s for e, s in zip(ends, sizes, strict=True)]
        order, group = coalesce(np.concatenate(starts), np.concatenate(ends))
        both = np.concatenate(ids)[order]
        side = (order >= len(ids[0])).astype(np.int64)
        doc = np.concatenate([np.repeat(np.arange(len(found)), n_a), np.repeat(np.arange(len(found)), n_b)])[order]
        # groups as text: A's tokens before B's, each in the order of their starts
        shown = np.lexsort((np.arange(len(order)), side, group))
        g, s, d = group[shown], side[shown], doc[shown]
        sep = np.full(len(shown), 3)
        if len(shown) > 1:
            sep[:-1] = np.where(d[1:] != d[:-1], 3, np.where(g[1:] != g[:-1], 2, np.where(s[1:] != s[:-1], 1, 0)))
        words = list(map(self.texts.__getitem__, (sep * self.most + both[shown]).tolist()))
        cuts = np.concatenate([[0], np.cumsum(n_a + n_b)])
        # where groups end, counted from the beginning of space + text
        last = np.flatnonzero(np.diff(group, append=-1) != 0) if len(group) else np.array([], np.int64)
        top = np.maximum.accumulate(np.concatenate(ends)[order])[last] if len(group) else last
        begins = np.concatenate([[0], np.cumsum([len(t) + 1 if n else 0 for t, n in zip(texts, n_a, strict=True)])])
        per_doc = np.bincount(doc[last], minlength=len(found))
        of_a, of_b = overlaps(starts[0], ends[0], starts[1], ends[1])
        together = ends[0][of_a] == ends[1][of_b]
        of_a, of_b = of_a[together], of_b[together]
        code = ids[0][of_a] * len(self.b.lengths) + ids[1][of_b]
        span = len(self.a.lengths) * len(self.b.lengths)
        home = np.repeat(np.arange(len(found)), n_a)[of_a]
        pairs, times = np.unique(home * span + code, return_counts=True)
        return {
            "n_a": n_a,
            "n_b": n_b,
            "ends": (top - begins[doc[last]], per_doc),
            "groups": ["".join(words[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)],
            "links": (pairs % span, np.bincount(pairs // span, minlength=len(found))),
            "times": (times, np.bincount(pairs // span, minlength=len(found))),
        }


_made: dict[bytes, Aligner] = {}


def aligner_of(level: str, model: bytes) -> Aligner:
    """The worker's aligner of two tokenizers; a worker that serves several tasks keeps it."""
    key = hashlib.sha256(level.encode() + model).digest()
    if key not in _made:
        _made[key] = Aligner(level, model)
    return _made[key]


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, pa.int64()))


def align_tokens(docs: DataFrame, level_path: str, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (row, id, n_a, n_b, ends, groups, links, times), one per input row.

    A is a byte-level tokenizer (JSON file) on space + text, B a SentencePiece model on the text; both files lie on
    the driver and travel with the function.  ``ends`` are the byte offsets in space + text where both end a token, ``groups`` the
    ids between them as ``a1,a2|b1;a3|b2,b3``.  ``links`` are codes ``a * size of B + b`` of the different linked pairs and
    ``times`` how often each occurs; ``row`` names the row within one run of the job.  Texts that are null or empty, or that one of the two
    does not reproduce byte by byte, have no tokens.  Repeated rows and ids are rows of their own.  Other columns are
    not read, so their names cannot clash; an empty table gives an empty result.
    """
    with open(level_path, encoding="utf-8") as f:
        level = f.read()
    with open(model_path, "rb") as f:
        model = f.read()
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        aligner, at = aligner_of(level, model), TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = bytes_of(batch.column("text"))
            for part in text_blocks(texts, BLOCK_BYTES):
                found = aligner.block(texts[part])
                n = part.stop - part.start
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(at, at + n)), batch.column("id")[part.start : part.stop], pa.array(found["n_a"]), pa.array(found["n_b"]),
                        _lists(*found["ends"]), pa.array(found["groups"], pa.string()), _lists(*found["links"]), _lists(*found["times"]),
                    ],
                    ["row", "id", "n_a", "n_b", "ends", "groups", "links", "times"],
                )
                at += n

    return rows.mapInArrow(
        run,
        f"row bigint, id {id_type}, n_a bigint, n_b bigint, ends array<bigint>, groups string, links array<bigint>, times array<bigint>",
    )


def link_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """Rows (link, count, best): how often each pair is linked in all rows, and whether no other count of its B id is higher."""
    each = aligned.select(F.explode(F.arrays_zip("links", "times")).alias("x")).select(F.col("x.links").alias("link"), F.col("x.times").alias("n"))
    counts = each.groupBy("link").agg(F.sum("n").alias("count")).withColumn("b", F.col("link") % b_size)
    top = counts.groupBy("b").agg(F.max("count").alias("top"))
    return counts.join(top, "b").select("link", "count", (F.col("count") == F.col("top")).alias("best"))


def align_corpus(docs: DataFrame, level_path: str, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one per input row.

    ``count_sum`` adds the corpus-wide counts of a row's links, ``n_best`` counts the links whose count is the highest of their B id.
    Without tokens all numbers are 0 and the digest is ''.  Nulls, repeats and the rest as in ``align_tokens``.
    """
    with open(level_path, encoding="utf-8") as f:
        a = bytes_of_level(f.read())
    with open(model_path, "rb") as f:
        b = bytes_of_pieces(f.read())
    found = align_tokens(docs, level_path, model_path, id_col, text_col)
    # tokens, texts and offsets end here; what is written once holds the different links of each document
    rows = cut_lineage(
        found.select(
            "row", "id", "n_a", "n_b", F.size("ends").cast("long").alias("n_groups"),
            F.aggregate("times", F.lit(0).cast("long"), lambda x, y: x + y).alias("n_links"),
            F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"), "links", "times",
        )
    )
    counts = link_counts(rows, len(b))
    if linkable(a, b) <= BROADCAST_PAIRS:
        counts = F.broadcast(counts)
    each = rows.select("row", F.explode(F.arrays_zip("links", "times")).alias("x")).select("row", F.col("x.links").alias("link"), F.col("x.times").alias("n"))
    sums = each.join(counts, "link").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return rows.join(sums, "row", "left").select("id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
