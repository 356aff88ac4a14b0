"""Line dedup against a dictionary of lines, over nulls, repeats, ties and Bloom filters of any content."""

import random

import numpy as np

from mortarline.llm.lines import dedup_lines
from mortarline.llm.suspects import Bloom

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars, min_docs):
    key = lambda x: x.strip(SPACE).translate(LOW)
    rank = lambda i: (i is not None, i or 0)
    held = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                held.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if not (len(held.get(key(x), ())) >= min_docs and max(held[key(x)], key=rank) != i)]
        out.append((str(i), "\n".join(keep), len(lines), len(lines) - len(keep)))
    return sorted(out)


def test_against_brute_force(spark):
    rng = random.Random(3)
    pool = ["é" * 9, "Éa" * 6, "abc def ghi", "ABC def GHI", " abc def ghi\r", "short", "", "\t", "x" * 30000, "q😀" * 5, "word " * 4]
    rows = [(i, "\n".join(rng.choice(pool) + rng.choice(["", "", str(rng.randrange(4))]) for _ in range(rng.randrange(9)))) for i in range(300)]
    rows += [(None, "abc def ghi\nlone line here"), (None, "abc def ghi"), (7, rows[7][1]), (8, "abc def ghi\nother text 1"), (400, None), (401, "")]
    table = spark.createDataFrame([(t, i, "x") for i, t in rows], "text string, doc_id long, id string")
    got = dedup_lines(table.repartition(6), min_chars=10, min_docs=3)
    assert got.columns == ["text", "doc_id", "id", "n_lines", "n_dropped"]
    assert sorted((str(r["doc_id"]), r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()) == brute(rows, 10, 3)
    assert dedup_lines(table.where("false")).count() == 0


def test_bloom_has_no_false_negatives():
    h = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    bloom = Bloom(len(h))
    bloom.add(h)
    assert bloom.has(h).all()
    assert bloom.has(h + np.uint64(12345)).mean() < 0.05
