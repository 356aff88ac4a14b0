"""Stages on a small documents table with odd rows: columns, decisions, and the registered query."""

import random

import corpus_pipeline as pipeline
import __spark_entry__ as entry


def test_stages(spark, tmp_path):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("aeioustrnlm") for _ in range(rng.randrange(3, 9)))
    rows = []
    for i in range(120):
        lines = [" ".join(word() for _ in range(12)) for _ in range(rng.randrange(3, 12))]
        if i % 3 == 0:
            lines.insert(1, "the very same long line stands in many of these documents")
        rows.append((i, "\n".join(lines), "en", "hot" if i % 2 else f"s{i % 5}", 7))
    rows += [(200 + i, rows[5][1], "en", "s1", 7) for i in range(9)]
    rows += [(300, None, None, None, None), (301, "", "en", "s1", 0), (302, "### " * 300, "en", "hot", 1), (None, rows[7][1] + " and more", "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    at, seen = docs, {}
    for name, stage in pipeline.STAGES:
        at = pipeline.cut_lineage(stage(spark, at, str(tmp_path)))
        seen[name] = at.collect()
        if name != "sentencepiece":
            assert at.columns == pipeline.COLUMNS
    ids = lambda name: [r["doc_id"] for r in seen[name]]
    assert not {300, 301, 302} & set(ids("quality")) and len(ids("quality")) == 130
    held = [r["doc_id"] for r in seen["line_dedup"] if "very same long line" in r["text"]]
    assert held == [117] and all(r["n_chars"] == len(r["text"]) for r in seen["line_dedup"])
    # lines that ten copies share stay in the last of them; the emptied ones are one class
    assert sorted(map(str, ids("minhash"))) == sorted([*map(str, range(120)), "208", "None"])
    assert max(ids("mixing").count(i) for i in set(ids("mixing"))) <= 2
    assert len(ids("sentencepiece")) == len(ids("mixing"))
    assert entry.queries()["pipeline"](spark, str(tmp_path)).count() == len(ids("mixing"))
    empty = str(tmp_path / "none")
    docs.where("false").write.parquet(f"{empty}/documents.parquet")
    assert pipeline.run(spark, empty).count() == 0


def test_verdicts_belong_to_rows(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("aeioustrnlm") for _ in range(rng.randrange(3, 9)))
    good = [" ".join(word() for _ in range(60)) for _ in range(40)]
    rows = [(None, t, "en", "s", 1) for t in good] + [(None, "junk", "en", "s", 1), (7, good[0] + " seven", "en", "s", 1), (7, "junk too", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = pipeline.quality(spark, docs, "").collect()
    assert len(kept) == 41 and not any(r["text"].startswith("junk") for r in kept)
