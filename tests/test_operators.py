"""Edge cases on tiny tables, against brute force or hand-worked results."""

import itertools

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mortarline.functions import text_checks as C
from mortarline.functions.scalars import render
from mortarline.operators import evals as E
from mortarline.operators import experiments as G
from mortarline.operators import failures as X
from mortarline.operators import layout as L
from mortarline.operators import ml as M
from mortarline.operators import modelfiles as B
from mortarline.operators import retrieval as R
from mortarline.operators import rollout as O
from mortarline.operators import telemetry as T
from mortarline.operators import traces as V


def test_stamp_caller_wins(spark):
    df = spark.createDataFrame([({"service": "mine", "n": "1"},), (None,)], "dims map<string,string>")
    rows = [r["dims"] for r in T.stamp_dimensions(df, {"service": "base", "trace_id": None}).collect()]
    assert rows == [{"trace_id": "unknown", "service": "mine", "n": "1"}, {"service": "base", "trace_id": "unknown"}]


def test_empty_traces(spark):
    schema = "duration_ms double, duration double, status string, result_code string, properties map<string,string>"
    row = V.trace_metrics(spark.createDataFrame([], schema)).collect()[0]
    assert row["total_requests"] == 0 and row["p95_latency_ms"] == 0.0 and row["error_rate"] == 0.0


def test_trace_fallbacks(spark):
    rows = [(0.0, 7.0, "", "404", {"total_tokens": "5"}), (3.0, 9.0, "Failed", "200", {}), (None, None, "ok", "500", {"total_tokens": "x"})]
    schema = "duration_ms double, duration double, status string, result_code string, properties map<string,string>"
    row = V.trace_metrics(spark.createDataFrame(rows, schema)).collect()[0]
    assert (row["error_count"], row["avg_total_tokens"], row["avg_latency_ms"]) == (2, 5.0, pytest.approx(10 / 3))


def test_response_fields(spark):
    rows = [('{"prediction": 1}',), ('"{\\"prediction\\": 1}"',), ("nonsense",), ('{"x": 1}',)]
    out = spark.createDataFrame(rows, "response string").select(V.response_fields(F.col("response")).alias("k"))
    assert [r["k"] for r in out.collect()] == [["prediction"], ["prediction"], None, ["x"]]


@pytest.mark.parametrize(
    "text,passed",
    [
        ("32 studs wide", [True, False, False, True, False]),
        ("3-story", [True, False, False, True, False]),
        ("uses 3004.dat", [False, True, False, True, False]),
        ("uses 3004.DAT and 3040B", [False, True, False, True, False]),
        ("one brick", [False, False, False, True, False]),
        ("brick and SNOT", [False, True, False, True, False]),
        ("Dark  Tan", [False, False, True, True, False]),
        ("Floating Roof", [False, False, False, False, False]),
        ("a cantilever to exceed 6 studs", [False, True, False, False, False]),
        ("# A\n- item", [False, False, False, True, True]),
        ("# A only", [False, False, False, True, False]),
        ("", [False, False, False, True, False]),
    ],
)
def test_buildability(spark, text, passed):
    row = E.buildability(spark.createDataFrame([(text,)], "response string")).collect()[0]
    assert [d["passed"] for d in row["details"]] == passed
    assert row["score"] == pytest.approx(sum(passed) / 5)


def test_pattern_literals_are_necessary():
    import re

    from mortarline import dims as D

    samples = [
        "40 studs tall", "9 LDU deep", "width: 3", "length = 4", "3x4 studs", "2 x 2 footprint", "2-stories", "1 story",
        "height is about 7", "Primary color:", "roof =", "colour scheme", "color palette", "Reddish Brown", "grey",
        "color code 7", "floating wall", "unsupported span", "cantilever over 5 studs", "no base", "## x", "**Bold",
        "\nPalette: x", "\nFloor Plan -", "- item",
    ]
    hit = set()
    for s, (p, needed) in itertools.product(samples, D.PATTERN_LITERALS.items()):
        if re.search(p, s, re.IGNORECASE):
            hit.add(p)
            assert any(n in s.lower() for n in needed), (s, p)
    assert hit == set(D.PATTERN_LITERALS)


def test_unknown_colors(spark):
    df = spark.createDataFrame([("Color 15, color code 999 and color 3",)], "t string")
    assert df.select(C.unknown_colors(F.col("t")).alias("c")).collect()[0]["c"] == [3, 999]


def test_failures(spark):
    rows = [
        ('{"id":"a","passed":false}', ["unspecified"]),
        ('{"id":"b","failure_reason":null}', [None]),
        ('{"id":"c","errors":[]}', ["unspecified"]),
        ('{"id":"d","fluency":0.5,"fluency_threshold":0.85,"errors":["TIMEOUT"]}', ["fluency_failure", "TIMEOUT"]),
        ('{"id":"e","fluency":0.85,"fluency_threshold":0.85}', None),
        ('{"id":"f","success":false,"failure_reasons":["x","y"]}', ["x", "y"]),
        ('{"id":"g","passed":true}', None),
    ]
    got = {r["id"]: r["failure_reasons"] for r in X.extract_failures(spark.createDataFrame([(r[0],) for r in rows], "entry string")).collect()}
    assert got == {r[0][7]: r[1] for r in rows if r[1] is not None}


@pytest.mark.parametrize(
    "reason,category",
    [("floating roof, wrong size", "missing_dimensions"), ("buildability_failure", "other"), ("RATE_LIMIT hit", "api_error"), (None, "other"), ("information lost", "format_error")],
)
def test_taxonomy(spark, reason, category):
    df = spark.createDataFrame([(reason,)], "r string")
    assert df.select(X.categorize(F.col("r")).alias("c")).collect()[0]["c"] == category


def test_recent_entries(spark):
    rows = ['{"timestamp":"2020-01-01T00:00:00Z"}', '{"timestamp":"2020-01-01T00:00:00"}', '{"timestamp":"soon"}', "{}", '{"timestamp":"2030-01-01T00:00:00+02:00"}']
    df = spark.createDataFrame([(r,) for r in rows], "entry string")
    assert [r["entry"] for r in X.recent_entries(df, "2024-01-01 00:00:00").collect()] == rows[1:]
    assert X.recent_entries(df, None).count() == 5


def test_pareto_brute_force(spark):
    rng = np.random.default_rng(5)
    points = [(i, float(c), float(q)) for i, (c, q) in enumerate(rng.integers(0, 12, size=(150, 2)))]
    keep = {
        i for i, c, q in points
        if not any(q2 >= q and c2 <= c and (q2 > q or c2 < c) for _, c2, q2 in points)
    }
    df = spark.createDataFrame(points, "i int, cost double, quality double")
    assert {r["i"] for r in G.pareto_front(df.repartition(7), "quality", "cost").collect()} == keep
    assert G.pareto_front(df.limit(1), "quality", "cost").count() == 1


def test_grid(spark):
    grid = G.config_grid(spark, {"a": [1, 2], "b": ["x", "y", "z"]}).collect()
    assert [(r["combo_no"], r["a"], r["b"]) for r in grid] == [(i, a, b) for i, (a, b) in enumerate(itertools.product([1, 2], "xyz"))]


def test_render(spark):
    df = spark.createDataFrame([("{{ a }}/{{a}}/{{ b }}", "$1", "\\n")], "t string, a string, b string")
    out = df.select(render(F.col("t"), {"a": F.col("a"), "b": F.col("b")}).alias("o"))
    assert out.collect()[0]["o"] == "$1/$1/\\n"


def lines(spark, *values):
    return spark.createDataFrame([("m", v) for v in values], "model string, value string")


def test_parse_edges(spark):
    rot = "1 0 0 0 1 0 0 0 1"
    good = f"  1 4 1.5 -2 3e1 {rot} 3001.dat extra"
    bad = [f"1 4 1 2 {rot} 3001.dat", f"1 4 nan 0 0 {rot} x.dat", f"1 4 1_0 0 0 {rot} x.dat", f"1 4 1f 0 0 {rot} x.dat", "0 STEP", "", f"11 4 1 2 3 {rot} x.dat"]
    rows = B.parse_placements(lines(spark, good, *bad)).collect()
    assert [(r["x"], r["y"], r["z"], r["part"], r["rot"]) for r in rows] == [(1.5, -2.0, 30.0, "3001.dat", rot)]


def structure(points):
    """Plain loop over one model's points."""
    ys = {}
    for x, y, z in points:
        ys.setdefault(round(y), []).append((round(x, 1), round(z, 1)))
    order, hanging = sorted(ys), 0
    for below, layer in zip(order, order[1:]):
        hanging += len(set(ys[layer]) - set(ys[below]))
    rounded = [tuple(round(c, 1) for c in p) for p in points]
    return hanging / len(points), len(points) - len(set(rounded)), np.var([len(v) for v in ys.values()])


@pytest.mark.parametrize("seed", range(3))
def test_structural_features(spark, seed):
    rng = np.random.default_rng(seed)
    points = [(float(x), float(y), float(z)) for x, y, z in rng.choice([0.0, 0.5, 1.5, 2.46, 2.5, 2.54, -0.5, -2.46, -2.54], size=(60, 3))]
    df = spark.createDataFrame([("m", *p) for p in points], "model string, x double, y double, z double")
    row = B.structural_features(df).collect()[0]
    over, hits, density = structure(points)
    assert row["overhang_ratio"] == pytest.approx(over, abs=1e-4)
    assert row["collision_count"] == hits
    assert row["layer_density"] == pytest.approx(density, abs=1e-4)


@pytest.mark.parametrize("y_down", [False, True])
def test_models_are_worked_out_in_one_shuffle(spark, monkeypatch, y_down):
    rng = np.random.default_rng(5)
    picks = rng.choice([0.0, -0.0, 0.5, 1.5, 2.46, 2.5, 2.54, -0.5, -2.46, None], size=(900, 3))
    rows = [(f"m{m}" if m else None, *p) for m, p in zip(rng.integers(0, 40, 900).tolist(), picks.tolist())] + [("flat", 1.0, None, 2.0)]
    df = spark.createDataFrame(rows, "model string, x double, y double, z double").repartition(5)
    monkeypatch.setattr(B, "MODEL_ROWS", 300)
    out = B.structural_features(df, y_down=y_down)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Exchange hashpartitioning(model" in plan and ", 4)" in plan
    got = sorted(map(tuple, out.collect()))
    assert len(got) == 39 and all(r[0] not in ("flat", None) for r in got)
    monkeypatch.setattr(B, "BUCKETS", 1)  # a full bucket without a large model
    assert B._large_models(df.where("model is not null")) == (sum(r[0] is not None for r in rows), [])
    monkeypatch.setattr(B, "MODEL_ROWS", 22)  # some models are large
    assert sorted(map(tuple, B.structural_features(df, y_down=y_down).collect())) == got
    monkeypatch.setattr(B, "MODEL_ROWS", 0.5)  # all models are
    assert sorted(map(tuple, B.structural_features(df, y_down=y_down).collect())) == got


def test_models_without_parts(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, 3.0)], "model string, x double, y double, z double")
    names = spark.createDataFrame([("a",), ("b",)], "model string")
    rows = {r["model"]: r for r in B.structural_features(df, models=names).collect()}
    assert rows["b"]["overhang_ratio"] == 0.0 and rows["b"]["label"] == 0


def test_overlaps_brute_force(spark):
    from mortarline import dims as D

    rng = np.random.default_rng(2)
    parts = list(D.PART_SIZES)[:12]
    rows = [("m", float(x), float(y), float(z), D.ROTATIONS["R0" if t else "R90"], parts[p])
            for x, y, z, t, p in zip(*rng.integers(-150, 150, (3, 60)), rng.integers(0, 2, 60), rng.integers(0, 12, 60))]
    boxes = set()
    for _, x, y, z, rot, part in rows:
        w, length, h = D.PART_SIZES[part]
        dx, dz = (length / 2, w / 2) if rot == D.ROTATIONS["R0"] else (w / 2, length / 2)
        boxes.add((x - dx, x + dx, y, y + h, z - dz, z + dz))
    pairs = sum(
        a[0] < b[1] and b[0] < a[1] and a[2] < b[3] and b[2] < a[3] and a[4] < b[5] and b[4] < a[5]
        for a, b in itertools.combinations(boxes, 2)
    )
    df = spark.createDataFrame(rows, "model string, x double, y double, z double, rot string, part string")
    for cell in (30.0, 160.0):
        assert B.overlaps(df, cell).count() == pairs > 0


def greedy(start, end, offset):
    sizes, out, pos = [160, 120, 80, 60, 40, 20], [], start + offset
    if 0 < offset < 160:
        out += [(start + w / 2, w) for w in [next((w for w in sizes if w <= offset + 0.1), None)] if w]
    while pos < end - 0.1 and end - pos >= 19.9:
        w = next(w for w in sizes if w <= end - pos + 0.1)
        out.append((pos + w / 2, w))
        pos += w
    return sorted(out)


def test_fill_is_greedy(spark):
    cases = [(float(s), float(s + n), o) for s in (0, -35) for n in [0, 10, 19.9, 20, 99.95, 140, 170, 333, *range(180, 700, 37)] for o in (0, 20, 50, 160)]
    rows = [(i, 4, s, e, 8.0, 10.0, "X", "brick", o) for i, (s, e, o) in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, color int, span_start double, span_end double, y double, cross_pos double, axis string, kind string, stagger int")
    got = {}
    for r in L.fill_spans(df, ["i"]).collect():
        got.setdefault(r["i"], []).append(r["x"])
    for i, (s, e, o) in enumerate(cases):
        assert sorted(got.get(i, [])) == pytest.approx([round(c, 1) for c, _ in greedy(s, e, o)]), cases[i]


@pytest.mark.parametrize("size,overlap", [(4, 0), (4, 2), (5, 1), (10, 3)])
def test_chunks_cover(spark, size, overlap):
    docs = [(i, " ".join(f"w{j}" for j in range(i))) for i in range(14)]
    out = {}
    for r in R.chunk(spark.createDataFrame(docs, "id int, text string"), "id", size, overlap).collect():
        out.setdefault(r["id"], {})[r["chunk_no"]] = r["chunk"].split()
    assert 0 not in out
    for n in range(1, 14):
        chunks = [out[n][k] for k in sorted(out[n])]
        joined = chunks[0] + [w for c in chunks[1:] for w in c[overlap:]]
        assert joined == [f"w{j}" for j in range(n)]
        assert all(len(c) <= size for c in chunks) and all(len(c) > overlap for c in chunks[1:])


def test_vector_paths_agree(spark):
    rng = np.random.default_rng(4)
    docs, queries = rng.normal(size=(90, 6)), rng.normal(size=(25, 6))
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(docs)], "doc_id long, vector array<double>")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id long, vector array<double>")
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    want = np.argsort(-(unit(queries) @ unit(docs).T), axis=1)[:, :4]
    for d_rows, q_rows in ((20_000, 4096), (17, 6)):
        out = R.vector_topk(d, q, 4, block_rows=d_rows, query_rows=q_rows).collect()
        got = {(r["query_id"], r["rank"]): r["doc_id"] for r in out}
        assert got == {(i, k + 1): int(want[i, k]) for i in range(25) for k in range(4)}


def test_vector_block_memory_is_bounded():
    """A pair of blocks of 20,000 documents and 1,000 queries is scored 256 queries at a time."""
    scores = np.random.default_rng(1).normal(size=(20_000, 256))
    best = R._best(scores, np.arange(20_000), np.arange(256), 5)
    assert len(best) == 256 * 5
    assert (best.groupby("query_id")["score"].max() == np.round(scores.max(axis=0), R.DIGITS)).all()


def test_keyword_scores(spark):
    rows = [(1, "red brick wall"), (2, "red red roof"), (3, "blue door"), (4, "Brick, brick; BRICK"), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    queries = spark.createDataFrame([(1, "red brick"), (2, "door"), (3, "zebra")], "query_id long, text string")
    got = {(r["query_id"], r["rank"]): (r["doc_id"], r["score"]) for r in R.keyword_topk(docs, queries, 2).collect()}
    tokens = {i: [w.strip(",;").lower() for w in t.split()] for i, t in rows}
    average = sum(map(len, tokens.values())) / len(tokens)
    want = {}
    for q, terms in ((1, ["red", "brick"]), (2, ["door"]), (3, ["zebra"])):
        found = []
        for i, t in tokens.items():
            score = 0.0
            for w in terms:
                n = sum(w in o for o in tokens.values())
                score += math.log(1 + (5 - n + 0.5) / (n + 0.5)) * t.count(w) * 2.2 / (t.count(w) + 1.2 * (0.25 + 0.75 * len(t) / average))
            if score:
                found.append((-round(score, 6), i))
        want |= {(q, r): (i, -s) for r, (s, i) in enumerate(sorted(found)[:2], 1)}
    assert got == want


def test_stratified_split_is_exact(spark):
    rows = [(i, "hot" if i < 700 else f"c{i % 3}") for i in range(1000)]
    df = M.stratified_split(spark.createDataFrame(rows, "id int, label string"), "id", "label")
    got = {r["label"]: (r["n"], r["t"]) for r in df.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert got["hot"] == (700, 140) and all(t == n * 20 // 100 for n, t in got.values())


def test_isolation_finds_outliers(spark):
    rng = np.random.default_rng(9)
    points = np.concatenate([rng.normal(size=(380, 2)), rng.choice([-1, 1], size=(20, 2)) * rng.uniform(9, 16, size=(20, 2))])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id int, x double, y double")
    out = M.isolation_flags(df, "id", ["x", "y"], contamination=0.05, trees=40).collect()
    flagged = {r["id"] for r in out if r["prediction"] == -1}
    assert len(flagged) == 20 and len([i for i in flagged if i >= 380]) >= 18
    assert all(0 < r["anomaly_score"] <= 1 for r in out)


def test_every_tree_gets_its_sample_at_any_size(spark):
    for n in (40, 400, 6000):
        df = spark.range(n, numPartitions=5).select("id", F.col("id").cast("double").alias("x"))
        deals = {}
        for r in M._dealt(df, "id", ["x"], trees=12, sample=256, seed=42).collect():
            deals.setdefault(r["tree"], set()).add(r["x"])
        assert sorted(deals) == list(range(12)) and all(len(d) == min(n, 256) for d in deals.values())
        again = {}
        for r in M._dealt(df.repartition(3), "id", ["x"], trees=12, sample=256, seed=42).collect():
            again.setdefault(r["tree"], set()).add(r["x"])
        assert again == deals
        # rows of one tree say nothing about those of the next one
        shared = np.mean([len(deals[t] & deals[t + 1]) for t in range(11)])
        assert shared == pytest.approx(min(n, 256) ** 2 / n, rel=0.4)


def test_silhouette_degenerate(spark):
    df = spark.createDataFrame([([0.0, 1.0], 0), ([1.0, 1.0], 0)], "v array<double>, c int")
    assert M.silhouette(df, "v", "c").collect()[0]["silhouette"] is None


@pytest.mark.parametrize("parts,share,want", [
    ({"a": 50, "b": 50}, 30, {"a": 30, "b": 70}),
    ({"a": 0, "b": 0, "c": 0}, 40, {"a": 40, "b": 30, "c": 30}),
    ({"a": 10, "b": 60, "c": 30}, 33, {"a": 33, "b": 44, "c": 23}),
    ({"a": 100}, 100, {"a": 100}),
    ({"b": 70, "c": 30}, 0, {"a": 0, "b": 70, "c": 30}),
])
def test_promote(spark, parts, share, want):
    traffic = spark.createDataFrame([("e", i, d, p) for i, (d, p) in enumerate(parts.items())], "endpoint string, position int, deployment string, percent int")
    targets = spark.createDataFrame([("e", "a", share)], "endpoint string, deployment string, share int")
    got = {r["deployment"]: r["percent"] for r in O.promote(traffic, targets).collect()}
    assert got == want


def test_pareto_front_needs_no_single_task(spark):
    # correlated: no point beats another, so the whole table is its front
    df = spark.range(200_000).select((F.col("id") * 3 % 200_000).cast("double").alias("cost")).withColumn("quality", F.col("cost") * 2)
    front = G.pareto_front(df, "quality", "cost")
    assert front.count() == 200_000
    rows = [(1.0, 5.0), (1.0, 5.0), (2.0, 5.0), (None, 9.0), (0.5, None), (3.0, 6.0), (3.0, 4.0)]
    odd = spark.createDataFrame(rows, "cost double, quality double")
    assert sorted(tuple(r) for r in G.pareto_front(odd, "quality", "cost").collect()) == [(1.0, 5.0), (1.0, 5.0), (3.0, 6.0)]
    assert G.pareto_front(odd.where("false"), "quality", "cost").count() == 0


def test_keyword_tasks_follow_documents_and_queries(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"red brick {i % 3} wall") for i in range(40)], "doc_id long, text string")
    queries = spark.createDataFrame([(1, "red wall"), (2, "brick 2"), (3, "roof")], "query_id long, text string")
    want = sorted(map(tuple, R.keyword_topk(docs, queries, 3).collect()))
    monkeypatch.setattr(R, "TASK_PAIRS", 5)
    out = R.keyword_topk(docs, queries, 3)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [doc_id" in plan and ", 24" in plan  # 40 documents, 3 queries, 5 pairs a task
    assert sorted(map(tuple, out.collect())) == want


def test_gaps_are_not_broadcast(spark):
    walls = [(i, 3, 0.0, 200.0, 100.0, 4, 10.0, "X") for i in (1, 1, 2)] + [(None, 3, 0.0, 200.0, 100.0, 4, 10.0, "X")]
    schema = "wall_id long, color int, span_start double, span_end double, ground_y double, n_rows int, cross_pos double, axis string"
    openings = spark.createDataFrame([(2, 40.0, 80.0, 2, 3), (2, 100.0, 120.0, 3, 3), (None, 0.0, 20.0, 1, 9)], "wall_id long, o_start double, o_end double, from_row int, to_row int")
    out = L.wall_segments(spark.createDataFrame(walls, schema), openings)
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
    got = sorted((r["row"], r["span_start"], r["span_end"]) for r in out.where("wall_id = 2").collect())
    assert got == [(1, 0.0, 200.0), (2, 0.0, 40.0), (2, 80.0, 200.0), (3, 0.0, 40.0), (3, 80.0, 100.0), (3, 120.0, 200.0), (4, 0.0, 200.0)]
    assert out.where("wall_id = 1").count() == 8 and out.where("wall_id is null").count() == 4


def test_wall_rows_are_dealt_over_tasks(spark, monkeypatch):
    walls = spark.range(60).selectExpr("id wall_id", "3 color", "0D span_start", "200D span_end", "100D ground_y", "4 n_rows", "10D cross_pos", "'X' axis")
    openings = spark.range(0, 60, 2).selectExpr("id wall_id", "40D o_start", "80D o_end", "2 from_row", "3 to_row")
    want = sorted(map(tuple, L.wall_segments(walls, openings).collect()))
    monkeypatch.setattr(L, "TASK_ROWS", 5)
    monkeypatch.setattr(L, "_dealt", lambda df: df)
    out = L.wall_segments(walls, openings)
    assert out._jdf.queryExecution().optimizedPlan().toString().count(", 18") == 2  # 90 walls and openings, 5 a task, on both sides
    assert sorted(map(tuple, out.collect())) == want and len(want) == 300


def test_validation_counts_in_bounded_tasks(spark, monkeypatch):
    part = "1 {} 0 {} 0 1 0 0 0 1 0 0 0 1 {}"
    values = [("a", part.format(4, 8, "3001.dat")), ("a", part.format(4, -2, "3001.DAT")), ("a", part.format(7, "x", "bad")), ("a", "1 "),
              ("a", "0 FILE m.ldr"), ("a", "0 NOFILE"), ("a", "0 STEP"), ("a", "0 STEP"), (None, None), ("b", "0 file x")]
    lines = spark.createDataFrame(values, "model string, value string")
    monkeypatch.setattr(B, "TASK_LINES", 1)
    out = B.validate(lines)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and ", 20" in plan  # ten lines, each met by part and by colour
    got = {r["model"]: tuple(r)[1:] for r in out.collect()}
    assert got["a"] == (8, 4, 1, 1, 2, 3, 3, -2.0, 8.0, 2, "PASS", "FAIL")
    assert got["b"] == (1, 0, 1, 0, 0, 0, 0, None, None, 0, "FAIL", "PASS")
    assert got[None] == (1, 0, 0, 0, 0, 0, 0, None, None, 0, "PASS", "PASS")


def test_kmeans_computes_its_rows_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.range(40).selectExpr("id", "cast(id % 2 * 100 + id as double) x").mapInArrow(seen, "id long, x double")
    out = M.kmeans(rows, ["x"], k=2, restarts=2)
    assert sorted(r["count"] for r in out.groupBy("cluster").count().collect()) == [20, 20]
    assert out.count() == 40 and read.value == 40


def test_floors_are_dealt_over_tasks(spark, monkeypatch):
    floors = spark.range(50).coalesce(1).selectExpr("id", "1 color", "0D x_min", "400D x_max", "0D z_min", "60D z_max", "0D y", "2 layers")
    want = sorted(map(tuple, L.floor_plates(floors, ["id"]).collect()))
    monkeypatch.setattr(L, "TASK_ROWS", 10)
    out = L.floor_plates(floors, ["id"])
    assert out.rdd.getNumPartitions() == 5
    assert sorted(map(tuple, out.collect())) == want


def test_forest_rows_are_dealt_over_tasks(spark, monkeypatch):
    rows = spark.range(60).coalesce(1).selectExpr("cast(id as double) x", "cast(id >= 30 as int) label", "id % 3 = 0 is_test")
    seen = []

    class Forest(M.RandomForestClassifier):
        def fit(self, dataset, params=None):
            seen.append(dataset.rdd.getNumPartitions())
            return super().fit(dataset, params)

    monkeypatch.setattr(M, "RandomForestClassifier", Forest)
    monkeypatch.setattr(M, "FOREST_ROWS", 10)
    out = M.forest_scores(rows.where("not is_test"), rows.where("is_test"), ["x"], trees=9).collect()
    assert seen == [4] and len(out) == 20 and sum(r["prediction"] == r["label"] for r in out) >= 18
