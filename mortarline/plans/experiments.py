"""Experiment and tuning queries.

``rag_runs``, ``rag_summary`` and ``rag_tuning`` run every retrieval configuration over every benchmark case; the
``judged_`` ones summarise stored judge scores, which are dealt one configuration per case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline import dims as D
from mortarline.functions.scalars import render
from mortarline.operators import experiments as X
from mortarline.operators import retrieval as R
from mortarline.operators import tuning as T
from mortarline.plans.adapters import ctes, table, view
from mortarline.plans.quality import _CASES, _cases
from mortarline.plans.registry import register
from mortarline.plans.retrieval import _bm25_sql
from mortarline.session import cut_lineage

PROMPT_AXES = {"system_prompt": ["v1", "v2"], "rag_template": ["v1", "v2"]}
RAG_AXES = {
    "chunk_size": [300, 600, 1000],
    "overlap": [0, 50, 100],
    "search_mode": ["vector", "hybrid", "keyword_semantic"],
    "top_k": [3, 5, 10],
}


def _number(axes: dict) -> str:
    """The configuration whose label a stored response is dealt, by its prompt version and document number.

    Nothing was chunked, searched or measured under it."""
    n = 1
    for values in axes.values():
        n *= len(values)
    return f"CAST((CAST(substring(prompt_version, 4) AS BIGINT) + 20 * (doc_id % 5)) % {n} AS INT)"


def _runs(spark: SparkSession, sf: str, axes: dict) -> DataFrame:
    cases = _cases(spark, sf).drop("buildability_details", "response_preview")
    return X.stored_runs(cases.withColumn("combo_no", F.expr(_number(axes))), axes)


def _runs_sql(axes: dict) -> str:
    grid, n = "SELECT 0 AS z", 1
    for name, values in axes.items():
        vals = ", ".join(f"({i}, {v!r})" for i, v in enumerate(values))
        grid = f"SELECT g.* EXCLUDE z, z * {len(values)} + i AS z, v AS {name} FROM ({grid}) g, (VALUES {vals}) t(i, v)"
    return f"""{_CASES}, grid AS (SELECT * EXCLUDE z, z AS combo_no FROM ({grid}) q),
    runs AS (SELECT grid.*, {', '.join(D.QUALITY_METRICS)}, input_tokens, output_tokens, latency_ms, retrieval_ms
      FROM (SELECT *, {_number(axes)} AS c_no FROM cases) c JOIN grid ON combo_no = c_no)"""


_MEANS = ", ".join(f"round(avg({m}), 4) AS {m}" for m in D.QUALITY_METRICS)
_COST = "round(avg(input_tokens) * (3e-2 / 1000) + avg(output_tokens) * (6e-2 / 1000), 6) AS estimated_cost_per_request"


def _weighted(weights: dict) -> str:
    return " + ".join(f"{m} * {w}e0" for m, w in weights.items())


_PROMPT = f"""{_runs_sql(PROMPT_AXES)}, s AS (SELECT combo_no, system_prompt, rag_template, {_MEANS},
      round(avg(input_tokens), 1) AS avg_input_tokens, round(avg(output_tokens), 1) AS avg_output_tokens,
      round(avg(latency_ms), 1) AS avg_latency_ms, {_COST} FROM runs GROUP BY 1, 2, 3),
    c AS (SELECT *, {_weighted(D.PROMPT_WEIGHTS)} AS composite FROM s)"""
_RAG = f"""{_runs_sql(RAG_AXES)}, s AS (SELECT combo_no, chunk_size, overlap, search_mode, top_k, {_MEANS},
      round(avg(retrieval_ms), 1) AS avg_retrieval_latency_ms, round(avg(latency_ms), 1) AS avg_generation_latency_ms,
      round((sum(retrieval_ms) + sum(latency_ms)) / count(*), 1) AS avg_total_latency_ms,
      round(avg(input_tokens), 1) AS avg_input_tokens, round(avg(output_tokens), 1) AS avg_output_tokens, {_COST}
      FROM runs GROUP BY 1, 2, 3, 4, 5),
    c AS (SELECT *, round({_weighted(D.RAG_WEIGHTS)}, 4) AS composite_quality FROM s)"""


@register("judged_prompt_experiment", f"{_PROMPT} SELECT * REPLACE (round(composite, 6) AS composite) FROM c")
def judged_prompt_experiment(spark: SparkSession, sf: str) -> DataFrame:
    out = X.prompt_summary(_runs(spark, sf, PROMPT_AXES), ["combo_no", *PROMPT_AXES])
    return out.withColumn("composite", F.round("composite", 6))


@register(
    "judged_winner",
    f"{_PROMPT} SELECT system_prompt, rag_template, round(composite, 6) AS composite FROM c ORDER BY c.composite DESC, combo_no LIMIT 1",
)
def judged_winner(spark: SparkSession, sf: str) -> DataFrame:
    out = X.winner(X.prompt_summary(_runs(spark, sf, PROMPT_AXES), ["combo_no", *PROMPT_AXES]), "composite")
    return out.select("system_prompt", "rag_template", F.round("composite", 6).alias("composite"))


@register("judged_rag_summary", f"{_RAG} SELECT * FROM c")
def judged_rag_summary(spark: SparkSession, sf: str) -> DataFrame:
    return X.rag_summary(_runs(spark, sf, RAG_AXES), ["combo_no", *RAG_AXES])


_CHUNKINGS = [(s, o) for s in RAG_AXES["chunk_size"] for o in RAG_AXES["overlap"]]
_TOKENS = "list_filter(regexp_split_to_array({}, '[ \\t\\n\\r\\f\\v]+'), lambda w: w <> '')"
_TERMS = "list_filter(regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
_DEPTH = 20


def _place(name: str, source: str, order: str, parts: str = "chunking, case_id") -> str:
    return f"{name} AS (SELECT *, row_number() OVER (PARTITION BY {parts} ORDER BY {order}, doc_id, chunk_no) AS rank FROM {source})"


_RAG_RUNS = f"""WITH t AS (SELECT doc_id, {_TOKENS.format('text')} AS t FROM documents),
    ax AS (SELECT * FROM (VALUES {', '.join(f'({i}, {s}, {o})' for i, (s, o) in enumerate(_CHUNKINGS))}) v(chunking, chunk_size, overlap)),
    ch AS (SELECT *, unnest(range(0, greatest(0, len(t) - overlap - 1) + 1, chunk_size - overlap)) AS s FROM t, ax WHERE len(t) > 0),
    cs AS (SELECT chunking, doc_id, s // (chunk_size - overlap) AS chunk_no, t[s + 1 : s + chunk_size] AS tokens FROM ch),
    cw AS (SELECT chunking, doc_id, chunk_no, len(tokens) AS n, array_to_string(tokens, ' ') AS chunk,
      {_TERMS.format("array_to_string(tokens, ' ')")} AS w FROM cs),
    tw AS (SELECT chunking, doc_id, chunk_no, n, unnest(w) AS term FROM cw),
    tf AS (SELECT chunking, doc_id, chunk_no, n, term, count(*) AS tf FROM tw GROUP BY ALL),
    st AS (SELECT chunking, count(*) AS c, avg(n) AS al FROM cw GROUP BY 1),
    b AS (SELECT item_id AS case_id, array_to_string({_TOKENS.format('text')}, ' ') AS passage, {_TERMS.format('text')} AS w FROM benchmark),
    q AS (SELECT case_id, term, count(*) AS qn FROM (SELECT case_id, unnest(w) AS term FROM b) GROUP BY ALL),
    idf AS (SELECT chunking, term, ln(1 + (c - count(*) + 5e-1) / (count(*) + 5e-1)) AS idf FROM tf JOIN st USING (chunking)
      WHERE term IN (SELECT term FROM q) GROUP BY chunking, term, c),
    ks AS (SELECT chunking, case_id, doc_id, chunk_no, round(sum(idf * tf * 22e-1 / (tf + 12e-1 * (25e-2 + 75e-2 * n / al))), 6) AS score
      FROM tf JOIN idf USING (chunking, term) JOIN q USING (term) JOIN st USING (chunking) GROUP BY ALL),
    h AS (SELECT term, CAST(concat('0x', substr(md5(term), 1, 4)) AS INT) % {T.SLOTS} AS slot,
      CASE WHEN CAST(concat('0x', substr(md5(term), 5, 1)) AS INT) % 2 = 1 THEN 1 ELSE -1 END AS sign
      FROM (SELECT term FROM tf UNION SELECT term FROM q) u),
    cv AS (SELECT chunking, doc_id, chunk_no, slot, CAST(sum(tf * sign) AS DOUBLE) AS v FROM tf JOIN h USING (term) GROUP BY ALL),
    cn AS (SELECT chunking, doc_id, chunk_no, sqrt(sum(v * v)) AS cn FROM cv GROUP BY ALL),
    qv AS (SELECT case_id, slot, CAST(sum(qn * sign) AS DOUBLE) AS u FROM q JOIN h USING (term) GROUP BY ALL),
    qn AS (SELECT case_id, sqrt(sum(u * u)) AS qn FROM qv GROUP BY ALL),
    vs AS (SELECT chunking, case_id, doc_id, chunk_no, round(sum(u * v) / (cn * qn), 6) AS score
      FROM cv JOIN qv USING (slot) JOIN cn USING (chunking, doc_id, chunk_no) JOIN qn USING (case_id) WHERE cn * qn > 0 GROUP BY chunking, case_id, doc_id, chunk_no, cn, qn),
    {_place('kr', 'ks', 'score DESC')}, {_place('vr', '(SELECT * FROM vs WHERE score > 0)', 'score DESC')},
    kd AS (SELECT chunking, case_id, doc_id, chunk_no, score, rank AS k_rank FROM kr WHERE rank <= {_DEPTH}),
    vd AS (SELECT chunking, case_id, doc_id, chunk_no, score, rank AS v_rank FROM vr WHERE rank <= {_DEPTH}),
    sd AS (SELECT kd.chunking, kd.case_id, kd.doc_id, kd.chunk_no, kd.score AS k_score, coalesce(vs.score, 0) AS v_score
      FROM kd LEFT JOIN vs USING (chunking, case_id, doc_id, chunk_no)),
    fd AS (SELECT chunking, case_id, doc_id, chunk_no, round(coalesce(1e0 / (60 + k_rank), 0) + coalesce(1e0 / (60 + v_rank), 0), 9) AS score
      FROM kd FULL JOIN vd USING (chunking, case_id, doc_id, chunk_no)),
    {_place('sr', 'sd', 'v_score DESC, k_score DESC')}, {_place('fr', 'fd', 'score DESC')},
    found AS (SELECT chunking, 'vector' AS search_mode, case_id, doc_id, chunk_no, v_rank AS rank FROM vd
      UNION ALL SELECT chunking, 'keyword_semantic', case_id, doc_id, chunk_no, rank FROM sr
      UNION ALL SELECT chunking, 'hybrid', case_id, doc_id, chunk_no, rank FROM fr),
    judged AS (SELECT f.chunking, search_mode, f.case_id, rank, cw.n, CASE WHEN passage <> '' AND contains(chunk, passage) THEN rank END AS hit_rank,
        list_intersect(list_distinct(b.w), list_distinct(cw.w)) AS held
      FROM found f JOIN cw ON cw.chunking = f.chunking AND cw.doc_id = f.doc_id AND cw.chunk_no = f.chunk_no JOIN b ON b.case_id = f.case_id),
    per_k AS (SELECT chunking, search_mode, top_k, case_id, min(hit_rank) AS hit_rank, len(list_distinct(flatten(list(held)))) AS held, sum(n) AS n
      FROM judged, (VALUES {', '.join(f'({k})' for k in RAG_AXES['top_k'])}) k(top_k) WHERE rank <= top_k GROUP BY ALL),
    kc AS (SELECT chunking, case_id, count(*) AS k_n FROM ks GROUP BY ALL),
    vc AS (SELECT chunking, case_id, count(*) AS v_n FROM vs WHERE score > 0 GROUP BY ALL),
    grid AS (SELECT (chunking * {len(RAG_AXES['search_mode'])} + m) * {len(RAG_AXES['top_k'])} + i AS combo_no, chunking, chunk_size, overlap, search_mode, top_k
      FROM ax, (VALUES {', '.join(f"({i}, '{m}')" for i, m in enumerate(RAG_AXES['search_mode']))}) m(m, search_mode),
        (VALUES {', '.join(f'({i}, {k})' for i, k in enumerate(RAG_AXES['top_k']))}) k(i, top_k)),
    runs AS (SELECT combo_no, chunk_size, overlap, search_mode, top_k, case_id,
        CASE WHEN hit_rank IS NULL THEN 0e0 ELSE 1e0 END AS hit,
        CASE WHEN len(w) > 0 THEN coalesce(held, 0) / CAST(len(list_distinct(w)) AS DOUBLE) ELSE 0e0 END AS coverage,
        coalesce(1e0 / hit_rank, 0) AS reciprocal_rank, CAST(coalesce(n, 0) AS BIGINT) AS context_tokens,
        CASE WHEN search_mode = 'keyword_semantic' THEN 0 ELSE coalesce(v_n, 0) END + CASE WHEN search_mode = 'vector' THEN 0 ELSE coalesce(k_n, 0) END AS chunks_scored
      FROM grid CROSS JOIN b LEFT JOIN per_k USING (chunking, search_mode, top_k, case_id) LEFT JOIN kc USING (chunking, case_id) LEFT JOIN vc USING (chunking, case_id))"""
_RAG_SCORES = f"""{_RAG_RUNS},
    s AS (SELECT combo_no, chunk_size, overlap, search_mode, top_k, count(*) AS n_cases, {', '.join(f'round(avg({m}), 4) AS {m}' for m in T.WEIGHTS)},
      round(avg(context_tokens), 1) AS avg_context_tokens, round(avg(chunks_scored), 1) AS avg_chunks_scored,
      round(avg(context_tokens) * (3e-2 / 1000), 6) AS estimated_cost_per_request FROM runs GROUP BY 1, 2, 3, 4, 5),
    c AS (SELECT *, round({_weighted(T.WEIGHTS)}, 4) AS composite_quality FROM s)"""


def _measured(spark: SparkSession, sf: str) -> DataFrame:
    cases = table(spark, sf, "benchmark").select(F.col("item_id").alias("case_id"), "text")
    return T.rag_runs(table(spark, sf, "documents").select("doc_id", "text"), cases, RAG_AXES, depth=_DEPTH)


@register("rag_runs", f"{_RAG_RUNS} SELECT * FROM runs")
def rag_runs(spark: SparkSession, sf: str) -> DataFrame:
    return _measured(spark, sf)


@register("rag_summary", f"{_RAG_SCORES} SELECT * FROM c")
def rag_summary(spark: SparkSession, sf: str) -> DataFrame:
    return T.rag_scores(_measured(spark, sf), ["combo_no", *RAG_AXES])


@register(
    "rag_tuning",
    f"""{_RAG_SCORES}, p AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c o WHERE o.composite_quality >= c.composite_quality
        AND o.estimated_cost_per_request <= c.estimated_cost_per_request AND (o.composite_quality > c.composite_quality
        OR o.estimated_cost_per_request < c.estimated_cost_per_request)))
    SELECT combo_no, composite_quality, estimated_cost_per_request,
      row_number() OVER (ORDER BY composite_quality DESC, combo_no) AS rank FROM p""",
)
def rag_tuning(spark: SparkSession, sf: str) -> DataFrame:
    # the front reads the scores, a row per configuration, several times
    scores = cut_lineage(T.rag_scores(_measured(spark, sf), ["combo_no", *RAG_AXES]))
    front = X.pareto_front(scores, "composite_quality", "estimated_cost_per_request")
    return X.ranked(front, "composite_quality").select("combo_no", "composite_quality", "estimated_cost_per_request", "rank")


SYSTEMS = {
    "v1": "You turn requests into building specifications.",
    "v2": "You turn requests into building specifications. State dimensions, colors and part numbers, lay out every floor from the ground up, "
    "name what carries the roof, and answer only from the material that is given to you. Say so where it does not suffice.",
}
TEMPLATES = {
    "v1": "Context:\n{{ context }}\n\n---\n\nRequest:\n{{ prompt }}",
    "v2": "Request:\n{{ prompt }}\n\nAnswer it with this material only.\n\nContext:\n{{ context }}",
}
_WINDOW = 600
_PROMPT_SCORES = {"request_kept": 0.4, "coverage": 0.4, "context_kept": 0.2}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _filled(template: str, **values: str) -> str:
    """SQL of a template with ``{{ name }}`` replaced by expressions."""
    out = _text(template)
    for name, value in values.items():
        out = f"replace({out}, '{{{{ {name} }}}}', {value})"
    return out


_PROMPT_GRID = " UNION ALL ".join(
    f"SELECT {i * len(TEMPLATES) + j} AS combo_no, '{s}' AS system_prompt, '{t}' AS rag_template, case_id, p, c, "
    f"concat({_text(SYSTEMS[s])}, '\n\n', {_filled(TEMPLATES[t], context='c', prompt='p')}) AS body, "
    f"concat({_text(SYSTEMS[s])}, '\n\n', {_filled(TEMPLATES[t].split('{{ context }}')[0], prompt='p')}) AS before FROM cases"
    for i, s in enumerate(SYSTEMS)
    for j, t in enumerate(TEMPLATES)
)
_PROMPT_RUNS = f"""WITH {_bm25_sql(3)}, bl AS (SELECT query_id, rank, concat('Title: ', CAST(kw.doc_id AS VARCHAR), '\nStyle: ', lang, '\nContent: ', text) AS t
      FROM kw JOIN documents d ON d.doc_id = kw.doc_id),
    cx AS (SELECT query_id, string_agg(t, '\n---\n' ORDER BY rank) AS context FROM bl GROUP BY 1),
    cases AS (SELECT item_id AS case_id, text AS p, coalesce(context, 'No relevant specs found.') AS c FROM benchmark LEFT JOIN cx ON item_id = query_id),
    g AS ({_PROMPT_GRID}),
    k AS (SELECT *, {_TOKENS.format('body')} AS t, {_TOKENS.format('c')} AS ct, {_TOKENS.format('p')} AS pt,
      greatest(0, {_WINDOW} - len({_TOKENS.format('before')})) AS room, list_distinct({_TERMS.format('p')}) AS w FROM g),
    runs AS (SELECT combo_no, system_prompt, rag_template, case_id,
      CASE WHEN contains(array_to_string(t[1:{_WINDOW}], ' '), array_to_string(pt, ' ')) THEN 1e0 ELSE 0e0 END AS request_kept,
      CASE WHEN len(ct) > 0 THEN CAST(least(room, len(ct)) AS DOUBLE) / len(ct) ELSE 1e0 END AS context_kept,
      CASE WHEN len(w) > 0 THEN CAST(len(list_intersect(w, list_distinct({_TERMS.format("array_to_string(ct[1:room], ' ')")}))) AS DOUBLE) / len(w) ELSE 1e0 END AS coverage,
      CAST(least(len(t), {_WINDOW}) AS BIGINT) AS input_tokens FROM k)"""
_DIGITS = ", ".join(f"CAST(concat('0x', substr(h, {4 * i + 1}, 4)) AS INT)" for i in range(8))
_RESAMPLED = f"""{_PROMPT_RUNS},
    x AS (SELECT combo_no, case_id, {_weighted(_PROMPT_SCORES)} AS s FROM runs),
    pt AS (SELECT combo_no, count(*) AS n_cases, round(avg(s), 9) AS mean FROM x GROUP BY 1),
    top AS (SELECT combo_no AS winner, mean AS best FROM pt ORDER BY mean DESC, combo_no LIMIT 1),
    dg AS (SELECT case_id, z, md5(concat_ws(':', CAST(z AS VARCHAR), CAST(case_id AS VARCHAR))) AS h FROM (SELECT DISTINCT case_id FROM x), range(0, 25) r(z)),
    dr AS (SELECT case_id, z * 8 + generate_subscripts(u, 1) - 1 AS replicate, unnest(u) AS u FROM (SELECT case_id, z, [{_DIGITS}] AS u FROM dg)),
    wt AS (SELECT case_id, replicate, len(list_filter({X.POISSON}, lambda p: u >= p)) AS w FROM dr),
    rp AS (SELECT replicate, combo_no, round(sum(w * s) / sum(w), 9) AS mean FROM wt JOIN x USING (case_id) WHERE w > 0 GROUP BY 1, 2),
    ld AS (SELECT rp.*, l.mean AS lead FROM rp JOIN (SELECT replicate, mean FROM rp, top WHERE combo_no = winner) l USING (replicate)),
    wn AS (SELECT combo_no, count(*) AS wins FROM (SELECT *, row_number() OVER (PARTITION BY replicate ORDER BY mean DESC, combo_no) AS r FROM rp) WHERE r = 1 GROUP BY 1),
    sp AS (SELECT combo_no, count(*) AS n_replicates, round(quantile_cont(mean, 0.025), 6) AS low, round(quantile_cont(mean, 0.975), 6) AS high,
      round(quantile_cont(lead - mean, 0.025), 6) AS behind_low, round(quantile_cont(lead - mean, 0.975), 6) AS behind_high FROM ld GROUP BY 1),
    res AS (SELECT pt.combo_no, n_cases, round(mean, 6) AS mean, low, high, round(best - mean, 6) AS behind, behind_low, behind_high,
      round(coalesce(wins, 0) / CAST(n_replicates AS DOUBLE), 4) AS win_share, pt.combo_no = winner AS is_winner
      FROM pt JOIN sp USING (combo_no) LEFT JOIN wn USING (combo_no), top)"""


def _prompt_runs(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    docs = table(spark, sf, "documents")
    passages = docs.select("doc_id", F.col("doc_id").cast("string").alias("title"), F.col("lang").alias("style"), F.col("text").alias("content"))
    context = R.assemble_context(R.keyword_topk(docs, items, 3), passages, items)
    cases = items.join(context, "query_id").select(F.col("query_id").alias("case_id"), F.col("text").alias("prompt"), "context")
    return X.prompt_runs(cases, SYSTEMS, TEMPLATES, _WINDOW)


def _resampled(spark: SparkSession, sf: str) -> DataFrame:
    runs = _prompt_runs(spark, sf).withColumn("score", X.composite(_PROMPT_SCORES))
    return X.resampled(runs, range(len(SYSTEMS) * len(TEMPLATES)), "score", replicates=200)


@register("prompt_runs", f"{_PROMPT_RUNS} SELECT * FROM runs")
def prompt_runs(spark: SparkSession, sf: str) -> DataFrame:
    return _prompt_runs(spark, sf)


@register("prompt_experiment", f"{_RESAMPLED} SELECT * FROM res")
def prompt_experiment(spark: SparkSession, sf: str) -> DataFrame:
    return _resampled(spark, sf)


@register("winner", f"{_RESAMPLED} SELECT combo_no, mean, low, high, win_share FROM res WHERE is_winner")
def winner(spark: SparkSession, sf: str) -> DataFrame:
    return _resampled(spark, sf).where("is_winner").select("combo_no", "mean", "low", "high", "win_share")


@register(
    "pareto_front",
    f"""{ctes('grid_scores')} SELECT candidate, cost, quality FROM grid_scores c WHERE NOT EXISTS (SELECT 1 FROM grid_scores o
      WHERE o.quality >= c.quality AND o.cost <= c.cost AND (o.quality > c.quality OR o.cost < c.cost))""",
)
def pareto_front(spark: SparkSession, sf: str) -> DataFrame:
    return X.pareto_front(view(spark, sf, "grid_scores"), "quality", "cost").select("candidate", "cost", "quality")


@register(
    "prompt_rendering",
    """SELECT doc_id, md5(concat('Context:\n', text, '\n\n---\n\nRequest:\n', source, ' in ', lang)) AS digest FROM documents""",
)
def prompt_rendering(spark: SparkSession, sf: str) -> DataFrame:
    template = F.lit("Context:\n{{ context }}\n\n---\n\nRequest:\n{{prompt}}")
    values = {"context": F.col("text"), "prompt": F.concat("source", F.lit(" in "), "lang")}
    text = render(template, values)
    return table(spark, sf, "documents").select("doc_id", F.md5(text.cast("binary")).alias("digest"))


@register(
    "request_cost",
    f"""{ctes('responses')} SELECT doc_id, round(input_tokens * (3e-2 / 1000) + output_tokens * (6e-2 / 1000), 6) AS cost FROM responses""",
)
def request_cost(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "responses").select("doc_id", X.cost(F.col("input_tokens"), F.col("output_tokens")).alias("cost"))
