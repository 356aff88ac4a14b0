"""Alignment against a plain search over all token pairs, with corpus-wide counts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import mortarline.llm.align as align

LEVEL, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    level = Tokenizer.from_file(LEVEL)
    level.encode_special_tokens = True
    return level, sentencepiece.SentencePieceProcessor(model_file=MODEL)


def spans(ids, table):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(table[i]), i))
        at += len(table[i])
    return out


def brute(texts, libraries):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, digest) from the definition."""
    level, pieces = libraries
    with open(LEVEL, encoding="utf-8") as f:
        a_table = align.bytes_of_level(f.read())
    b_table = [
        bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()
        for p in (pieces.id_to_piece(i) for i in range(pieces.get_piece_size()))
    ]
    found = []
    for t in texts:
        a = spans(level.encode(" " + (t or ""), add_special_tokens=False).ids, a_table)
        b = spans(pieces.encode(t or ""), b_table)
        want = b" " + (t or "").encode()
        if not t or b"".join(a_table[x[2]] for x in a) != want or b"".join(b_table[x[2]] for x in b) != want:
            found.append(([], [], [], []))
            continue
        cuts = sorted({x[1] for x in a} & {x[1] for x in b})
        groups, low = [], 0
        for c in cuts:
            groups.append("|".join(",".join(str(i) for s, e, i in side if low <= s and e <= c) for side in (a, b)))
            low = c
        found.append((a, b, groups, [(x[2], y[2]) for x in a for y in b if x[1] == y[1]]))
    counts = Counter(p for *_, links in found for p in links)
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return [
        (
            len(a), len(b), len(groups), len(links), sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "",
        )
        for a, b, groups, links in found
    ]


def test_corpus_equals_brute_force(spark, libraries, monkeypatch):
    rng = random.Random(4)
    letters = "  \n\tab.é▁漢😀'<the> ing0x41"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(300)]
    words = "the of nation inter ation. <|endoftext|> 2024 naïve\n".split(" ")
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(80))) for _ in range(100)]
    texts += [None, "", " ", "▁", "a▁b", "the the", "the the", "é" * 3000, "word " * 4000]
    monkeypatch.setattr(align, "BLOCK_BYTES", 700)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, groups string, row int").repartition(3)
    want = {i: x for i, x in enumerate(brute(texts, libraries))}
    for limit in (align.BROADCAST_PAIRS, 0):
        monkeypatch.setattr(align, "BROADCAST_PAIRS", limit)
        got = align.align_corpus(docs, LEVEL, MODEL).collect()
        assert {r["id"]: tuple(r)[1:] for r in got} == want
        assert len(got) == len(texts)


def test_repeated_ids_nulls_and_empty_table(spark, libraries):
    rows = [(1, "to be"), (1, "to be"), (None, "or not"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(align.align_corpus(docs, LEVEL, MODEL).collect(), key=str)
    want = brute([t for _, t in rows], libraries)
    assert sorted(tuple(r)[1:] for r in got) == sorted(want)
    assert align.align_corpus(docs.where("false"), LEVEL, MODEL).count() == 0


def test_groups_and_offsets_of_one_text(spark):
    docs = spark.createDataFrame([(1, "hello there")], "doc_id long, text string")
    r = align.align_tokens(docs, LEVEL, MODEL).select("n_a", "n_b", "ends", "groups", F.size("links")).first()
    assert tuple(r) == (2, 3, [6, 12], "23748|6312,28709;612|736", 2)


def test_coalescing_and_overlaps_of_any_intervals():
    rng = np.random.default_rng(2)
    for _ in range(200):
        starts = rng.integers(0, 60, 25)
        ends = starts + rng.integers(1, 9, 25)
        order, group = align.coalesce(starts, ends)
        parent = list(range(25))
        for i in range(25):
            for j in range(25):
                if starts[i] < ends[j] and starts[j] < ends[i]:
                    a, b = parent[i], parent[j]
                    parent = [a if p == b else p for p in parent]
        own = np.empty(25, int)
        own[order] = group
        assert all((own[i] == own[j]) == (parent[i] == parent[j]) for i in range(25) for j in range(25))
        cuts = [np.sort(rng.choice(np.arange(1, 60), 9, replace=False)) for _ in range(2)]
        (sa, ea), (sb, eb) = ((c[:-1], c[1:]) for c in cuts)
        x, y = align.overlaps(sa, ea, sb, eb)
        assert set(zip(x.tolist(), y.tolist(), strict=True)) == {(i, j) for i in range(8) for j in range(8) if sa[i] < eb[j] and sb[j] < ea[i]}


def test_both_encoders_give_the_library_s_ids(libraries):
    with open(LEVEL, encoding="utf-8") as f, open(MODEL, "rb") as g:
        aligner = align.Aligner(f.read(), g.read())
    rng = random.Random(9)
    assert aligner.fast is not None
    letters = "   \n\t\r'stmdrevlab1.,éÿ漢٣ ́\u180e\u200b\x1c\x85😀<|endoftext|>"
    texts = [" " + "".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(20000)]
    vocabulary = sorted(aligner.level.get_vocab())
    plain = "   \n\t'stmdrevlab1.,éÿßœ–’ABCZ<|endoftext|>"
    texts += [" " + "".join(rng.choice(plain) for _ in range(rng.randrange(60))) for _ in range(20000)]
    texts += [" " + " ".join(t.strip() for t in rng.sample(vocabulary, 20)).replace("Ġ", " ") for _ in range(3000)]
    assert [x.tolist() for x in aligner.level_ids(texts)] == [e.ids for e in libraries[0].encode_batch(texts, add_special_tokens=False)]


def test_bound_of_linked_pairs():
    assert align.linkable([b"ab", b"b", b""], [b"b", b"ab", b"cab", b"b"]) == 2 + 1 + 2 + 1 + 2
