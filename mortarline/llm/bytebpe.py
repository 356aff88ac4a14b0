"""Byte-level BPE encoding and decoding without regular expressions.

Pre-tokenisation is a scan.  Every code point has a class, every class a transition function on twelve
states, and functions compose: the closure of the twelve functions under composition is a small
monoid, so a prefix scan over element numbers (one table look-up a character, all blocks of the
texts at once) gives the state before each character, and a second table says where a token begins.
The pattern is the usual one: contractions, an optional blank before a run of letters, of numbers or of
other signs, and white space, whose last character is left to what follows.

The slices between begins are collected in a table of distinct ones; each is merged once per worker
(lowest rank first, leftmost among equals) and its ids are put back by position.  Byte offsets of all
tokens are kept, and decoding is one gather from the vocabulary's bytes.

A text is encoded in its task, so nothing is shuffled and a lost task only repeats its split.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mortarline.llm.text import bytes_of

#: Code points treated at a time, and most distinct slices a worker remembers.
BLOCK_CHARS, REMEMBERED = 2_000_000, 400_000
#: Slices of more bytes are merged with a heap and not remembered.
LONG_SLICE = 256

# classes of code points; END stands between texts, FILL after the last one
END, BLANK, SPACE, LETTER, NUMBER, OTHER, QUOTE, STMD, RV, ELL, E, FILL = range(12)
# states: what was read last; the four for white space tell first or later, blank or not
(FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_QUOTE, WANT_E, WANT_L, SHORTENED, BLANK_1, SPACE_1, BLANK_2, SPACE_2) = range(12)
STATES = CLASSES = 12
#: A token begins at this character, and at the one before it (decided late).
HERE, BEFORE = 1, 2

# fixed values: the code points of the Unicode property White_Space
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# fixed values: ranges of letters and numbers that Unicode 16 added, unknown to Python's tables of 15.1
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
]


@cache
def class_table() -> np.ndarray:
    """Class of every code point; END has the number after the last one."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table = np.append(table, np.uint8(END))
    for ranges, kind in ((NEW_LETTERS, LETTER), (NEW_NUMBERS, NUMBER)):
        for low, high in ranges:
            table[low : high + 1] = kind
    table[WHITE_SPACE] = SPACE
    table[0x20] = BLANK
    table[0x27] = QUOTE
    for letters, kind in (("stmd", STMD), ("rv", RV), ("l", ELL), ("e", E)):
        table[[ord(c) for c in letters]] = kind
    return table


def step(state: int, kind: int) -> tuple[int, int]:
    """(next state, begins) for one character, with ``begins`` of HERE and BEFORE."""
    if kind == FILL:
        return state, 0
    if kind == END:
        # the white space at the end of a text is one token
        return FRESH, BEFORE if state in (WANT_E, WANT_L) else 0
    if state in (BLANK_2, SPACE_2) and kind not in (BLANK, SPACE):
        late = BEFORE
    else:
        late = 0
    if state in (WANT_E, WANT_L):
        if (state, kind) in ((WANT_E, E), (WANT_L, ELL)):
            return SHORTENED, 0
        late, state = BEFORE, IN_LETTERS  # not a contraction: its letter began a token
    if kind in (BLANK, SPACE):
        if state in (BLANK_1, SPACE_1, BLANK_2, SPACE_2):
            return (BLANK_2 if kind == BLANK else SPACE_2), late
        return (BLANK_1 if kind == BLANK else SPACE_1), late | HERE
    joined = state in (BLANK_1, BLANK_2)
    if kind == NUMBER:
        return IN_NUMBERS, late | (0 if joined or state == IN_NUMBERS else HERE)
    if kind == OTHER or (kind == QUOTE and (joined or state in (IN_OTHERS, AFTER_QUOTE))):
        return IN_OTHERS, late | (0 if joined or state in (IN_OTHERS, AFTER_QUOTE) else HERE)
    if kind == QUOTE:
        return AFTER_QUOTE, late | HERE
    if state == AFTER_QUOTE and kind == STMD:
        return SHORTENED, late
    if state == AFTER_QUOTE and kind in (RV, ELL):
        return (WANT_E if kind == RV else WANT_L), late
    return IN_LETTERS, late | (0 if joined or state == IN_LETTERS else HERE)


@cache
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(apply[element, state], after[element, class], compose[first, second], begins[state, class]); element 0 changes nothing."""
    moves = [tuple(step(s, c)[0] for s in range(STATES)) for c in range(CLASSES)]
    found = {tuple(range(STATES)): 0}
    queue = list(found)
    for f in queue:
        for g in moves:
            h = tuple(g[s] for s in f)
            if h not in found:
                found[h] = len(found)
                queue.append(h)
    apply = np.array(queue, np.int16)
    after = np.array([[found[tuple(g[s] for s in f)] for g in moves] for f in queue], np.int16)
    compose = np.array([[found[tuple(g[s] for s in f)] for g in queue] for f in queue], np.int16)
    begins = np.array([[step(s, c)[1] for c in range(CLASSES)] for s in range(STATES)], np.uint8)
    return apply, after, compose, begins


def _prefix(elements: np.ndarray, compose: np.ndarray) -> np.ndarray:
    """Element of everything up to and with each place, by doubling distances."""
    out, gap = elements.copy(), 1
    while gap < len(out):
        out[gap:] = compose[out[:-gap], out[gap:]]
        gap *= 2
    return out


def begins_of(classes: np.ndarray) -> np.ndarray:
    """Where tokens begin in a sequence of classes that ends with END: a boolean for each."""
    apply, after, compose, begins = monoid()
    n = len(classes)
    width = max(1, min(1024, int(n**0.5)))
    rows = -(-n // width)
    grid = np.full(rows * width, FILL, np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)
    flat = after.ravel()
    read = np.zeros((width + 1, rows), np.int16)
    for i in range(width):
        read[i + 1] = flat[read[i] * np.int16(CLASSES) + grid[i]]
    ends = _prefix(read[-1], compose)
    start = np.zeros(rows, np.int16)
    start[1:] = apply[ends[:-1], FRESH]
    state = apply.ravel()[read[:-1].astype(np.int32) * STATES + start]
    marks = begins.ravel()[state * CLASSES + grid].T.ravel()[:n]
    out = (marks & HERE) != 0
    out[:-1] |= (marks[1:] & BEFORE) != 0
    return out


def merge_slice(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: the lowest-ranked neighbours are merged first, the leftmost of equals."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) <= LONG_SLICE:
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [ranks.get(a + b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs and (low := min(pairs)) != _NONE:
            i = pairs.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], _NONE)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], _NONE)
        return [ranks[p] for p in parts]
    n = len(piece)
    ahead, back, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2], _NONE)) != _NONE]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = ahead[i] if alive[i] else n
        if j >= n or ahead[j] != end:
            continue  # one of the two has been merged since
        alive[j], ahead[i] = False, end
        if end < n:
            back[end] = i
            if (r := ranks.get(piece[i : ahead[end]], _NONE)) != _NONE:
                heapq.heappush(heap, (r, i, ahead[end]))
        if (p := back[i]) >= 0 and (r := ranks.get(piece[p:end], _NONE)) != _NONE:
            heapq.heappush(heap, (r, p, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : ahead[i]]])
        i = ahead[i]
    return out


_NONE = 1 << 60


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a file with a base64 token and its rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class ByteBpe:
    """Encoder and decoder of one vocabulary, with its table of slices met so far."""

    def __init__(self, data: bytes):
        self.ranks = read_ranks(data)
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.met: dict[bytes, list[int]] = {}
        top = max(self.ranks.values()) + 1
        tokens = [b""] * top
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.lengths = np.fromiter(map(len, tokens), np.int64, top)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)

    def slices(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(byte offsets of the slices in the joined texts and of their end, how many slices each text has)."""
        joined = "".join(t.decode("utf-8", "replace") for t in texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = 1 + (points >= 0x80) + (points >= 0x800).astype(np.int64) + (points >= 0x10000)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        ends = np.searchsorted(offsets, text_ends)
        begin = begins_of(np.insert(class_table()[points], ends, END))
        begin = np.delete(begin, ends + np.arange(len(ends)))
        at = np.flatnonzero(begin)
        counts = np.diff(np.searchsorted(at, np.concatenate([[0], ends])))
        return offsets[np.append(at, len(points))], counts

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids per text) of valid UTF-8 texts."""
        data = b"".join(texts)
        offsets, counts = self.slices(texts)
        cuts = offsets.tolist()
        table: dict[bytes, int] = {}
        places = np.fromiter(
            (table.setdefault(data[a:b], len(table)) for a, b in zip(cuts, cuts[1:], strict=False)), np.int64, len(cuts) - 1
        )
        if len(self.met) > REMEMBERED:
            self.met.clear()
        found = []
        for piece in table:
            ids = self.met.get(piece)
            if ids is None:
                ids = merge_slice(piece, self.ranks)
                if len(piece) <= LONG_SLICE:
                    self.met[piece] = ids
            found.append(ids)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.int32, int(lengths.sum()))
        n = lengths[places]
        before = np.concatenate([[0], np.cumsum(n)])
        starts = np.cumsum(lengths) - lengths
        ids = flat[np.repeat(starts[places] - before[:-1], n) + np.arange(before[-1])]
        return ids, np.diff(before[np.concatenate([[0], np.cumsum(counts)])])

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the tokens one after the other; an id beyond the vocabulary is an error."""
        n = self.lengths[ids]
        before = np.cumsum(n) - n
        return self.blob[np.repeat(self.starts[ids] - before, n) + np.arange(int(n.sum()))].tobytes()


_made: dict[bytes, ByteBpe] = {}


def encoder_of(data: bytes) -> ByteBpe:
    """The worker's encoder of a vocabulary; a worker that serves several tasks keeps it."""
    key = hashlib.sha256(data).digest()
    if key not in _made:
        _made[key] = ByteBpe(data)
    return _made[key]


def valid_utf8(text: bytes) -> bytes:
    """The text, with bytes that are no UTF-8 replaced as Python does."""
    try:
        text.decode()
        return text
    except UnicodeDecodeError:
        return text.decode("utf-8", "replace").encode()


def text_blocks(texts: list[bytes], most: int = BLOCK_CHARS) -> Iterator[slice]:
    """Slices of a batch with some ``most`` bytes each, one text at least."""
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, kind))


def encode_bpe(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False) -> DataFrame:
    """Rows (id, ids, ends, decoded), one per input row: token ids, their end offsets in bytes of the text, decoded bytes.

    ``ranks_path`` is a file on the driver (base64 token and rank per line); its content, about a megabyte, travels with the
    function.  ``decoded`` is null unless ``decode``.  Special tokens have no meaning here: their strings are plain text.
    Null and empty texts have no ids and decode to nothing; repeated rows are encoded alike; other columns are not read,
    so their names cannot clash.  Bytes that are no UTF-8 count as U+FFFD.  Empty tables give empty results.
    """
    with open(ranks_path, "rb") as f:
        data = f.read()
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(data)
        for batch in batches:
            texts = [valid_utf8(t) for t in bytes_of(batch.column("text"))]
            for part in text_blocks(texts):
                ids, counts = encoder.encode(texts[part])
                sums = np.concatenate([[0], np.cumsum(encoder.lengths[ids])])
                firsts = np.cumsum(counts) - counts
                ends = sums[1:] - np.repeat(sums[firsts], counts)
                back = [encoder.decode(ids[a : a + n]) if decode else None for a, n in zip(firsts, counts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id")[part.start : part.stop], _lists(ids, counts, pa.int32()), _lists(ends, counts, pa.int64()), pa.array(back, pa.binary())],
                    ["id", "ids", "ends", "decoded"],
                )

    return rows.mapInArrow(run, f"id {id_type}, ids array<int>, ends array<bigint>, decoded binary")


def decode_bpe(rows: DataFrame, ranks_path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """Rows (id, decoded) with the bytes of arrays of ids; null arrays, and null ids in them, decode to nothing."""
    with open(ranks_path, "rb") as f:
        data = f.read()
    given = rows.select(rows[id_col].alias("id"), rows[ids_col].alias("ids"))
    id_type = given.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(data)
        for batch in batches:
            back = [encoder.decode(np.array([i for i in x or [] if i is not None], np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(back, pa.binary())], ["id", "decoded"])

    return given.mapInArrow(run, f"id {id_type}, decoded binary")
