"""Secret scans with structural confirmation.

Base patterns report assignments, access keys and long hexadecimal runs as they stand.  Beyond
them, runs of base64 or hexadecimal characters are candidates only: each is decoded and reported
if the bytes have the structure of a secret.  DER private keys must be nested tags whose lengths
add up exactly (PKCS#1, PKCS#8 plain or encrypted, SEC 1), OpenSSH private keys must begin with their magic and hold
length-prefixed fields that fit, and a signed token must have a JSON header that names an algorithm
and a JSON payload.  Bodies between markers may have headers, escaped line breaks, quotes and comment signs
around their lines; without markers, base64 is followed over line breaks as far as its own lengths say.
An encrypted body has no tags: its headers must name a cipher whose blocks fill it.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from mortarline.llm.text import by_batch

#: Kinds in the order that breaks ties of spans with the same start.
KINDS = ("assign", "access", "hex", "der", "openssh", "token")

ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
#: Every match of ASSIGN has one of these pieces, in either case.
HINTS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: Same leftmost matches as HEX, without the short ones.
LONG_HEX = re.compile(r"[0-9a-f]{32,}")

MARKER = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")
#: Line breaks, also as escapes in strings.
BREAK = re.compile(r"(?:\\+[rn])+|[\r\n]+")
#: A line's base64, and the comment or diff sign, quotes and joining signs around it.
LINE = re.compile(r"""\s*(?:(?://+|\++|-+|rem)\s+|[#*>;%|!]+\s*)?[\s"'`(]*([A-Za-z0-9+/_-]*={0,2})[\s"'`,;.)\\]*(?:\s\+|&)?\s*""")
HEADER = re.compile(r"""[\s"'`#*>;/+-]*([A-Za-z][A-Za-z0-9-]*):\s*([^"'`\\]*)""")
#: Where a wrapped key may begin: a sequence tag or the magic of OpenSSH.
BEGIN = re.compile(r"(?:(?<![A-Za-z0-9])|(?<=\\[nr]))(?:M[A-P]|b3BlbnNzaC1rZXkt)[A-Za-z0-9+/_-]{14,}={0,2}")
#: From one line's base64 to the next one's.
NEXT = re.compile(
    r"""[\x20\t"'`,;+.)\\]*?(?:(?:\\+[rn])+|[\r\n]+)(?:[\x20\t"'`(]|(?://+|\++)[\x20\t]+|[#*>;%|!])*([A-Za-z0-9+/_-]+={0,2})"""
)
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
HEX_KEY = re.compile(r"(?:[0-9a-fA-F]{2}){32,}")
TOKEN = re.compile(r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")


def _header(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end of content) of the DER element at ``at``, if its length fits."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n & 0x80:
        size = n & 0x7F
        if not 1 <= size <= 4 or at + size > end:
            return None
        n, at = int.from_bytes(data[at : at + size], "big"), at + size
        if n < 0x80:
            return None
    return (tag, at, at + n) if at + n <= end else None


def _children(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    out = []
    while at < end:
        if (x := _header(data, at, end)) is None:
            return None
        out.append(x)
        at = x[2]
    return out


def _encrypted(data: bytes, inner: list[tuple[int, int, int]], named: bool) -> bool:
    """Algorithm and octets.  Digests have that form with no parameters, so these must be there unless ``named`` as a key."""
    if [x[0] for x in inner] != [0x30, 0x04] or inner[1][2] - inner[1][1] < 16:
        return False
    parts = _children(data, inner[0][1], inner[0][2])
    return bool(parts) and parts[0][0] == 0x06 and (named or [x[0] for x in parts[1:]] == [0x30])


def der_private_key(data: bytes, named: bool = False) -> bool:
    """A whole DER private key: its nested lengths add up to the bytes there are."""
    top = _header(data, 0, len(data))
    if top is None or top[0] != 0x30 or top[2] != len(data):
        return False
    inner = _children(data, top[1], top[2])
    if inner and inner[0][0] == 0x30:
        return _encrypted(data, inner, named)
    if not inner or inner[0][0] != 0x02 or inner[0][2] - inner[0][1] != 1:
        return False
    version, tags = data[inner[0][1]], [x[0] for x in inner]
    if version in (0, 1) and len(tags) >= 9 and all(t == 0x02 for t in tags[:9]):
        return True
    if version in (0, 1) and len(tags) >= 3 and tags[1:3] == [0x30, 0x04]:
        names = _children(data, inner[1][1], inner[1][2])
        return bool(names) and names[0][0] == 0x06
    return version == 1 and len(tags) >= 2 and tags[1] == 0x04 and inner[1][2] - inner[1][1] >= 16


def openssh_private_key(data: bytes) -> bool:
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at, fields = len(magic), []
    for _ in range(3):  # cipher, key derivation, its options
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + n > len(data):
            return False
        fields.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    count, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    if not 1 <= count <= 16 or not fields[0]:
        return False
    for _ in range(count + 1):  # public keys, then the private part
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 > len(data) or at + 4 + n > len(data):
            return False
        at += 4 + n
    return at == len(data)


def _decoded(candidate: str) -> bytes | None:
    text = candidate.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _key_kind(data: bytes | None, named: bool = False) -> str | None:
    if not data:
        return None
    return "der" if der_private_key(data, named) else "openssh" if openssh_private_key(data) else None


def _body_kind(body: str, label: str) -> str | None:
    """Kind of the key between two markers, if its structure is confirmed."""
    lines, heads = [], {}
    for line in BREAK.split(body):
        if m := HEADER.fullmatch(line.strip().rstrip("\"'`,;+\\ ")):
            heads[m[1].lower()] = m[2].strip()
        else:
            lines.append(line)
    stripped = [m[1] if (m := LINE.fullmatch(x)) else None for x in lines]
    # what has signs alone joins strings or opens a comment
    stripped = ["" if x is not None and not x.strip("+/_-") else x for x in stripped]
    ways = ["".join("".join(lines).split())]
    if None not in stripped:
        ways.append("".join(stripped))
        if all(x.startswith("//") for x in stripped if x):
            ways.append("".join(x.lstrip("/") for x in stripped))
    for way in ways:
        data = _decoded(way)
        if kind := _key_kind(data, label.startswith("ENCRYPTED")):
            return kind
        if data and "ENCRYPTED" in heads.get("proc-type", ""):
            block = len(heads.get("dek-info", "").partition(",")[2].strip())
            iv = re.fullmatch(r"[A-Za-z0-9-]+,\s*(?:[0-9A-Fa-f]{16}|[0-9A-Fa-f]{32})", heads.get("dek-info", ""))
            if iv and len(data) >= 32 and len(data) % (block // 2) == 0:
                return "der"
    return None


def _wrapped(text: str, m: re.Match) -> tuple[str, int] | None:
    """(kind, end) of the key that begins at a match of BEGIN and goes on over line breaks."""
    start = _decoded(m[0].rstrip("=")[: len(m[0].rstrip("=")) // 4 * 4])
    if start is None:
        return None
    needed = None
    if not start.startswith(b"openssh-key-v"):
        size = start[1] & 0x7F if start[1] & 0x80 else 0
        at = 2 + size
        # a version, or the algorithm of an encrypted key, comes first
        if size > 4 or not (start[at : at + 2] == b"\x02\x01" or start[at : at + 1] == b"\x30"):
            return None
        needed = at + (int.from_bytes(start[2:at], "big") if size else start[1])
        needed = -(-needed * 4 // 3)
    got, ends, n = [m[0].rstrip("=")], [m.end()], len(m[0].rstrip("="))
    closed = m[0].endswith("=")
    while not closed and (needed is None or n < needed) and (x := NEXT.match(text, ends[-1])):
        got.append(x[1].rstrip("="))
        ends.append(x.end())
        n, closed = n + len(got[-1]), x[1].endswith("=")
    if needed is not None:
        kind = _key_kind(_decoded("".join(got))) if n == needed else None
        return (kind, ends[-1]) if kind else None
    # OpenSSH keys do not say their length at the front: their fields tell the line with the end
    whole = "".join(got)
    for end in reversed(ends):
        data = _decoded(whole)
        if data and openssh_private_key(data):
            return "openssh", end
        whole = whole[: len(whole) - len(got.pop())]
    return None


def signed_token(candidate: str) -> bool:
    parts = [_decoded(p) for p in candidate.split(".")[:2]]
    try:
        header, payload = (json.loads(p.decode("utf-8")) for p in parts if p is not None)
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(payload, dict)


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base patterns, in code points, end exclusive."""
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), "hex", m.end()) for m in LONG_HEX.finditer(text)]
    return out


def confirmed_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of candidates whose decoded structure is that of a secret."""
    out, taken = [], []
    if "PRIVATE KEY-----" in text:
        open_at = None
        for m in MARKER.finditer(text):
            if m[1] == "BEGIN":
                open_at = m
            elif open_at is not None:
                if open_at[2] == m[2] and (kind := _body_kind(text[open_at.end() : m.start()], m[2])):
                    out.append((open_at.start(), kind, m.end()))
                    taken.append((open_at.start(), m.end()))
                open_at = None
    for m in BASE64.finditer(text):
        if not any(a <= m.start() < b for a, b in taken) and (kind := _key_kind(_decoded(m[0]))):
            out.append((m.start(), kind, m.end()))
            taken.append((m.start(), m.end()))
    for m in BEGIN.finditer(text):
        if not any(a <= m.start() < b for a, b in taken) and (found := _wrapped(text, m)):
            out.append((m.start(), *found))
            taken.append((m.start(), found[1]))
    for m in HEX_KEY.finditer(text):
        if m[0][:2] in ("30", "6f", "6F") and not any(a <= m.start() < b for a, b in taken) and (kind := _key_kind(bytes.fromhex(m[0]))):
            out.append((m.start(), kind, m.end()))
    if "eyJ" in text:
        out += [(m.start(), "token", m.end()) for m in TOKEN.finditer(text) if signed_token(m[0])]
    return out


def _ordered(spans: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[1])))


SCHEMA = "base array<struct<kind:string,start:int,end:int>>, added array<struct<kind:string,start:int,end:int>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, base, added), one per document: spans as arrays of (kind, start, end) in order.

    Positions are code points, end exclusive.  A null text is scanned as an empty one and has no spans.
    Rows are treated one by one, so ids may be null or repeated; other columns are not read.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, added = [], []
        for text in batch.column("text").to_pylist():
            text = text or ""
            base.append([{"kind": k, "start": a, "end": b} for a, k, b in _ordered(base_spans(text))])
            added.append([{"kind": k, "start": a, "end": b} for a, k, b in _ordered(confirmed_spans(text))])
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(base, _SPAN), pa.array(added, _SPAN)], ["id", "base", "added"]
        )

    return rows.mapInArrow(by_batch(scan), f"id {id_type}, {SCHEMA}")
