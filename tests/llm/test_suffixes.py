"""Removed bytes against a dictionary of all strings; the expansion against sorted suffixes."""

import random

import numpy as np
import pyarrow as pa

import mortarline.llm.suffixes as suffixes
from mortarline.llm.suffixes import common_strings, remove_repeats


def brute(rows, length):
    rank = lambda i: (i is not None, i or 0)
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            first[s] = min(first.get(s, rank(i)), rank(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < rank(i):
                gone[p : p + length] = True
        gone = gone[:-1]
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((str(i), kept, len(b), int(gone.sum()), spans))
    return sorted(out)


def corpus(rng):
    word = lambda: "".join(rng.choice("abéd") for _ in range(rng.randrange(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(20) for _ in range(4)]
    rows = []
    for i in range(260):
        t = text(rng.randrange(60))
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            t = t[: len(t) // 2] + p[a : a + rng.randrange(80)] + t[len(t) // 2 :]
        rows.append((i, t))
    base = text(80)
    rows += [(300 + i, base) for i in range(20)] + [(340 + i, base[:200] + word() + base[200:]) for i in range(20)]
    rows += [(400, "-" * 900), (401, "x" + "-" * 500), (402, "ab" * 300), (403, "ab" * 40), (404, None), (405, ""), (None, base), (None, "q" + base)]
    rows += [(300, base), (301, "other row of one id " + base[:90]), (500, text(4000) + passages[0]), (501, "\0\x01" * 60), (502, "\0\x01" * 60 + "\0")]
    return rows


def test_removed_bytes_equal_brute_force(spark, monkeypatch):
    for crowded in (suffixes.CROWDED, 3):
        monkeypatch.setattr(suffixes, "CROWDED", crowded)
        rows = corpus(random.Random(crowded))
        table = spark.createDataFrame([(t, i, 1) for i, t in rows], "text string, doc_id long, kept int").repartition(7)
        got = sorted((str(r["id"]), bytes(r["kept"]), r["n_bytes"], r["n_removed"], r["n_spans"]) for r in remove_repeats(table, length=24).collect())
        want = brute(rows, 24)
        assert len(got) == len(want)
        assert [g for g, w in zip(got, want, strict=True) if g != w] == []


def test_contract_length(spark):
    rows = corpus(random.Random(9))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["id"]), bytes(r["kept"]), r["n_bytes"], r["n_removed"], r["n_spans"]) for r in remove_repeats(table).collect())
    assert got == brute(rows, 50)
    assert remove_repeats(table.where("false")).count() == 0


def test_groups_are_equal_strings():
    rng = np.random.default_rng(3)
    for letters, n in ((2, 300), (3, 2000), (1, 90), (200, 500)):
        symbols = np.append(rng.integers(1, letters + 1, n), 0).astype(np.uint8)
        symbols[:: max(1, n // 7)] = 0
        symbols[-1] = 0
        order, group = common_strings(symbols, 10)
        text = symbols.tobytes() + bytes(10)
        strings = {}
        for p, g in zip(order.tolist(), group.tolist(), strict=True):
            if 0 not in text[p : p + 10]:
                strings.setdefault(g, set()).add(text[p : p + 10])
        assert all(len(v) == 1 for v in strings.values())
        assert len(strings) == len({next(iter(v)) for v in strings.values()})


def test_shuffle_files_go_at_the_end_of_each_step(spark, monkeypatch):
    import mortarline.llm.text as text

    seen = []
    monkeypatch.setattr(text, "cut_lineage", lambda df: seen.append(spark.conf.get(text.RELEASE, None)) or df)
    before = spark.conf.get(text.RELEASE, None)
    remove_repeats(spark.createDataFrame([(1, "a" * 60), (2, "b" + "a" * 70)], "doc_id long, text string"))
    assert seen and set(seen) == {"true"}
    assert spark.conf.get(text.RELEASE, None) == before


def test_suspects_travel_packed_not_by_document_and_segment(spark):
    from mortarline.llm.suspects import per_document, suspected

    ids = [*range(300), None]
    docs = spark.createDataFrame([(i,) for i in ids], "id long").repartition(4)
    digest = lambda batch: [np.unique(np.append(np.arange(50, dtype=np.uint64) * 977, 10**9 + (x or 7))).astype(np.uint64) for x in batch.column("id").field("id").to_pylist()]
    packed = suspected(docs, digest, "id")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert packed.count() <= buckets * buckets
    rows = per_document(packed).collect()
    assert len(rows) == len(ids) and {r["id"] for r in rows} == set(ids)
    assert all({x * 977 for x in range(50)} <= set(r["hashes"]) and len(r["hashes"]) <= 51 for r in rows)


def test_strings_of_crowded_anchors_meet_packed_and_places_by_stretch(spark, monkeypatch):
    dealt, met, rows = suffixes.dealt, suffixes.met, corpus(random.Random(5))
    texts = ["q" * 10 + "w" * 51, "w" * 50, "é" * 30, "x" + "w" * 50]
    least, most = [{"known": k is not None, "id": k} for k in (7, 4, None, 2)], [{"known": True, "id": k} for k in (7, 9, 3, 2)]
    kind = pa.struct([("known", pa.bool_()), ("id", pa.int64())])
    batch = pa.RecordBatch.from_arrays(
        [pa.array([5, 5, 6, 6]), pa.array([1, 2, 3, 4]), pa.array([t.encode() for t in texts]), pa.array(least, kind), pa.array(most, kind)],
        ["key", "piece", "s", "least", "most"],
    )
    parts = [dealt(batch.slice(i, 2), 50, 3) for i in (0, 2)]
    assert all(p.num_rows <= 3 for p in parts)
    got = sorted((r["key"], r["piece"], r["lo"], r["hi"], r["holder"]["id"]) for r in met(parts).to_pylist())
    want = [(5, 1, 10, 10, 2), (5, 1, 11, 11, 2), (5, 2, 0, 0, 2)] + [(6, 3, i, i, None) for i in range(11)]
    assert got == want
    monkeypatch.setattr(suffixes, "CROWDED", 1)
    table = spark.createDataFrame([(str(i) if i is not None else None, t) for i, t in rows], "doc_id string, text string")
    plans, release = [], suffixes.cut_and_release
    monkeypatch.setattr(suffixes, "cut_and_release", lambda df: plans.append(df._jdf.queryExecution().analyzed().toString()) or release(df))
    out = remove_repeats(table, length=24)
    # no row for each string, and none for each place and run of a stretch
    assert not any("Generate" in p for p in plans) and any("flatten(collect_list(" in p for p in plans)
    rank = {None: None} | {str(i): n for n, i in enumerate(sorted({str(i) for i, _ in rows if i is not None}))}
    want = {(rank_of, *rest) for rank_of, *rest in brute([(None if i is None else rank[str(i)], t) for i, t in rows], 24)}
    assert {(str(rank[r["id"]]), bytes(r["kept"]), r["n_bytes"], r["n_removed"], r["n_spans"]) for r in out.collect()} == want
