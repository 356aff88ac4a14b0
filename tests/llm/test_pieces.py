"""Chunk-wise encoding against the library itself, and the round trip."""

import random

import public_tokenizers
import pytest
import sentencepiece

from mortarline.llm.pieces import Encoder, decode_ids, encode_texts, model_facts

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def odd_texts():
    rng = random.Random(5)
    letters = "  \n\n\tab.é▁漢😀\r\x00 <s></s>the ing"
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(3000)]
    return [*made, "", " ", "  ", "\n", " \n", "\n ", "▁", "▁▁ a", "a▁b", " lead", "trail ", "x" * 5000, "word " * 30000]


def test_ids_equal_the_library(library):
    texts = odd_texts()
    with open(PATH, "rb") as f:
        encoder = Encoder(f.read())
    assert [x.tolist() for x in encoder.encode(texts)] == library.encode(texts)


def test_model_is_bounded_by_markers():
    with open(PATH, "rb") as f:
        assert model_facts(f.read()) == (True, True)


def test_table_with_nulls_repeats_and_clashing_columns(spark, library):
    rows = [(1, "to be", "a"), (1, "to be", "a"), (None, "x  y\nz", "b"), (3, None, "c"), (4, "", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted((str(r["id"]), r["ids"], r["decoded"]) for r in encode_texts(docs, PATH, decode=True).collect())
    want = sorted((str(i), library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t, _ in rows)
    assert got == want
    assert encode_texts(docs.where("false"), PATH).count() == 0
    back = decode_ids(encode_texts(docs, PATH), PATH)
    assert sorted(r["decoded"] for r in back.collect()) == sorted(x[2] for x in want)
