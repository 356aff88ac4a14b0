"""Base facts against a plain count; the robust verdict on planted outliers; edge cases."""

import random
import re

from mortarline.llm.quality import quality_rules, text_facts

WORD = re.compile("[^\x20\x09-\x0d]+")


def facts(text):
    words = WORD.findall(text or "")
    where = {}
    for k in range(len(words) - 4):
        where.setdefault(tuple(words[k : k + 5]), []).append(k)
    covered = {j for v in where.values() if len(v) > 1 for k in v for j in range(k, k + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_facts(spark):
    rng = random.Random(2)
    texts = [None, "", " \n\t", "a b c d e a b c d e", "x " * 5000, "é😀# b\n\n é😀# b\nq"]
    texts += ["".join(rng.choice("ab \n#") for _ in range(rng.randrange(90))) for _ in range(300)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = {r["doc_id"]: tuple(r[n] for n in names) for r in text_facts(table).collect()}
    assert got == {i: facts(t) for i, t in enumerate(texts)}


def test_outliers_go_and_clean_documents_stay(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeioustrnl") for _ in range(rng.randrange(2, 9)))
    rows = []
    for i in range(600):
        words = [word() for _ in range(int(rng.lognormvariate(5, 1)) + 12)]
        rows.append((i, " ".join(words), "en" if i % 3 else None, f"s{i % 4}"))
    for i in range(600, 640):
        rows.append((i, " ".join(word() + "###" for _ in range(90)), "en", f"s{i % 4}"))
    rows += [(700, "alone in its own group of one row, with some more words", "xx", None), (701, None, None, None), (702, "", "en", "s1")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["id"]: r for r in quality_rules(table).collect()}
    assert len(got) == len(rows)
    assert not any(got[i]["kept"] for i in range(600, 640))
    assert all(got[i]["kept"] for i in range(600)) and got[700]["kept"]
    assert got[701]["base_failed"] and got[702]["base_failed"]
    assert quality_rules(table.where("false")).count() == 0


def test_repeated_rows_and_clashing_columns(spark):
    rows = [(1, "one two three four five six seven eight nine ten eleven", "en", "a", "z")] * 5
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words string")
    assert [r["kept"] for r in quality_rules(table).collect()] == [True] * 5


def test_outliers_on_every_axis_of_a_large_tight_group(spark):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("aeioustrnl") for _ in range(n))
    lines = lambda words: "\n".join(" ".join(words[k : k + 15]) for k in range(0, len(words), 15))
    plain = lambda n: [word(rng.randrange(3, 8)) for _ in range(n)]
    rows = []
    for i in range(2000):
        words = plain(rng.randrange(270, 330))
        if i % 20 == 0:
            words[7] += "#"
        text = lines(words)
        # one line of three words again, as ordinary texts have
        rows.append((i, text + "\nab cd ef\nab cd ef" if i % 25 == 0 else text))
    short = word(6)
    planted = {
        "length": " ".join(plain(12)), "long": lines(plain(20000)), "word": lines([word(18) for _ in range(300)]),
        "symbol": lines([w + "#" * (k % 8 == 0) for k, w in enumerate(plain(300))]),
        "line": "\n".join(f"{short}\n{' '.join(plain(19))}" for _ in range(15)),
        "repeat": lines((p := plain(300))[:280] + p[:25]),
    }
    rows += [(5000 + i, t) for i, t in enumerate(planted.values())]
    table = spark.createDataFrame([(*r, "en", "s") for r in rows], "doc_id long, text string, lang string, source string")
    got = {r["id"]: r for r in quality_rules(table).collect()}
    for i, name in enumerate(planted):
        assert not got[5000 + i]["kept"] and not got[5000 + i]["base_failed"], (name, got[5000 + i])
    lost = [i for i in range(2000) if not got[i]["kept"]]
    assert len(lost) <= 10, [got[i] for i in lost[:9]]
