"""Scanned pre-tokenisation and cached merging against the library, and the round trip."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import mortarline.llm.bytebpe as bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def own():
    with open(PATH, "rb") as f:
        return bpe.ByteBpe(f.read())


@pytest.fixture(scope="module")
def library(own):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def per_text(own, texts):
    ids, counts = own.encode([t.encode() for t in texts])
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_ids_equal_the_library(own, library):
    rng = random.Random(7)
    letters = "  '''\n\t\rstmdrevlab1.,é漢٣ ́😀<|endoftext|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(20000)]
    texts += ["", "", " ", "\n", "a" * 5000, "ab'" * 900, " " * 5000, "a  \n", "x're", "x'r", "x'l", "'", "word " * 30000]
    assert per_text(own, texts) == library.encode_ordinary_batch(texts, num_threads=1)


def test_code_points_have_their_class(own, library):
    # all of the planes with small scripts, some of the large ones of ideographs
    texts = [f"a{chr(c)}1{chr(c)}\n" for c in [*range(0x1F000), *range(0x1F000, 0x110000, 97)] if not 0xD800 <= c < 0xE000]
    assert per_text(own, texts) == library.encode_ordinary_batch(texts, num_threads=1)


def test_scan_equals_the_automaton_step_by_step():
    rng = np.random.default_rng(1)
    apply, after, compose, _ = bpe.monoid()
    n = len(apply)
    assert (apply[compose] == apply[np.arange(n)[None, :, None], apply[:, None, :]]).all()
    for size in (1, 2, 3, 50, 999, 40000):
        classes = rng.integers(0, bpe.FILL, size).astype(np.uint8)
        classes[-1] = bpe.END
        want, state = np.zeros(size, bool), bpe.FRESH
        for i, c in enumerate(classes):
            state, marks = bpe.step(state, c)
            want[i] |= bool(marks & bpe.HERE)
            if marks & bpe.BEFORE:
                want[i - 1] = True
        assert (bpe.begins_of(classes) == want).all()


def test_both_merges_agree(own, monkeypatch):
    rng = random.Random(3)
    pieces = ["".join(rng.choice("abeinst") for _ in range(rng.randrange(2, 250))).encode() for _ in range(200)]
    short = [bpe.merge_slice(p, own.ranks) for p in pieces]
    monkeypatch.setattr(bpe, "LONG_SLICE", 1)
    assert [bpe.merge_slice(p, own.ranks) for p in pieces] == short


def test_table_with_nulls_repeats_and_clashing_columns(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 1)
    rows = [(1, "to be", "a"), (1, "to be", "a"), (None, "x  y\nz é", "b"), (3, None, "c"), (4, "", "d"), (5, "z" * 100000, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.encode_bpe(docs, PATH, decode=True).collect()
    want = sorted((str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows)
    assert sorted((str(r["id"]), r["ids"], bytes(r["decoded"])) for r in got) == want
    for r in got:
        ends = np.cumsum([len(library.decode_single_token_bytes(i)) for i in r["ids"]])
        assert r["ends"] == ends.tolist()
    back = bpe.decode_bpe(bpe.encode_bpe(docs, PATH), PATH)
    assert sorted(bytes(r["decoded"]) for r in back.collect()) == sorted(x[2] for x in want)
    assert bpe.encode_bpe(docs.where("false"), PATH).count() == 0
    odd = spark.createDataFrame([(None, None), (1, []), (2, [None, 64])], "id long, ids array<int>")
    assert sorted(bytes(r["decoded"]) for r in bpe.decode_bpe(odd, PATH).collect()) == [b"", b"", library.decode_single_token_bytes(64)]
