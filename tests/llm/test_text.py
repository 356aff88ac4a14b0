"""Word digests against the words themselves."""

import random

import mortarline.llm.text as text

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_digests_tell_words_apart(monkeypatch):
    rng = random.Random(2)
    made = "".join(rng.choice("aAbZ é\0\t\n\x1f  1") for _ in range(60_000)).encode()
    words = made.decode().translate(LOW).encode().split()
    whole = text.word_digests(made).tolist()
    assert len(whole) == len(words)
    seen = dict(zip(whole, words, strict=True))
    assert [seen[h] for h in whole] == words and len(seen) == len(set(words))
    monkeypatch.setattr(text, "_PIECE", 97)
    assert text.word_digests(made).tolist() == whole
    assert len(text.word_digests(b"")) == len(text.word_digests(b" \n")) == 0
