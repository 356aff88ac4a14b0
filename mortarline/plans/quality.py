"""Evaluation, gate and failure-trend queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline import dims as D
from mortarline.functions import text_checks as C
from mortarline.operators import evals as E
from mortarline.operators import failures as X
from mortarline.plans.adapters import ctes, table, view
from mortarline.plans.registry import register


def _lit(p: str) -> str:
    return "'" + p.replace("'", "''") + "'"


def _any(col: str, patterns: list[str]) -> str:
    return "(" + " OR ".join(f"regexp_matches({col}, {_lit('(?i)' + p)})" for p in patterns) + ")"


def _words(col: str, words: str) -> str:
    return f"list_filter({words}, lambda w: contains(lower({col}), lower(w)))"


_PARTS = "[" + ", ".join(_lit(p) for p in D.VALID_PARTS) + "]"
_KEYS = "[" + ", ".join(_lit(p) for p in D.PART_KEYWORDS) + "]"
_FLAG = "coalesce(" + ", ".join(
    f"nullif(regexp_extract(response, {_lit('(?i)' + p)}, 0), '')" for p in D.RED_FLAG_PATTERNS
) + ")"
_SECTIONS = " + ".join(f"CAST(regexp_matches(response, {_lit('(?i)' + p)}) AS INT)" for p in D.SECTION_PATTERNS)

_CHECKED = f"""{ctes('responses')},
    raw AS (SELECT *, {_any('response', D.DIMENSION_PATTERNS)} AS dimensions_present,
        list_sort(list_intersect(list_distinct(regexp_extract_all(response, {_lit(D.PART_NUMBER_PATTERN)}, 1)), {_PARTS})) AS found,
        {_words('response', _KEYS)} AS words, {_any('response', D.COLOR_PATTERNS)} AS color_palette_specified,
        {_FLAG} AS flag, ({_SECTIONS}) >= 2 AS format_compliance FROM responses),
    checked AS (SELECT *, len(found) > 0 OR len(words) >= 2 AS brick_part_references, flag IS NULL AS structural_feasibility FROM raw),
    scored AS (SELECT *, round((CAST(dimensions_present AS INT) + CAST(brick_part_references AS INT) + CAST(color_palette_specified AS INT)
        + CAST(structural_feasibility AS INT) + CAST(format_compliance AS INT)) / 5e0, 4) AS score FROM checked)"""
_CASES = f"""{_CHECKED},
    cases AS (SELECT *, coalesce(groundedness_score, 0) / 5e0 AS groundedness, coalesce(relevance_score, 0) / 5e0 AS relevance,
        coalesce(coherence_score, 0) / 5e0 AS coherence, coalesce(fluency_score, 0) / 5e0 AS fluency,
        CASE WHEN coalesce(toxic, 0) = 0 THEN 1e0 ELSE 0e0 END AS safety_pass_rate, score AS buildability FROM scored)"""
_MEANS = ", ".join(f"round(avg({m}), 4) AS {m}" for m in D.QUALITY_METRICS)
JUDGES = {m: f"{m}_score" for m in ("groundedness", "relevance", "coherence", "fluency")}


def _cases(spark: SparkSession, sf: str) -> DataFrame:
    return E.score_cases(view(spark, sf, "responses"), JUDGES, "toxic")


@register(
    "buildability",
    f"""{_CHECKED}
    SELECT doc_id, score, dimensions_present, brick_part_references, color_palette_specified, structural_feasibility,
      format_compliance,
      CASE WHEN len(found) > 0 THEN concat('Known parts: ', array_to_string(found, ', '), '.')
        WHEN len(words) >= 2 THEN concat('Words for parts: ', array_to_string(words, ', '), '.')
        ELSE 'Neither known parts nor enough words for parts.' END AS parts_reason,
      CASE WHEN flag IS NULL THEN 'Nothing doubtful in the structure.'
        ELSE concat('Doubtful structure: ''', flag, '''.') END AS structure_reason
    FROM scored""",
)
def buildability(spark: SparkSession, sf: str) -> DataFrame:
    out = C.evaluate(view(spark, sf, "responses"), C.registered_evaluators())
    details = F.col("buildability.details")
    return out.select(
        "doc_id",
        F.col("buildability.score").alias("score"),
        *[details[i]["passed"].alias(name) for i, (name, _) in enumerate(C.BUILDABILITY_CHECKS)],
        details[1]["reason"].alias("parts_reason"),
        details[3]["reason"].alias("structure_reason"),
    )


@register(
    "scored_cases",
    f"""{_CASES} SELECT doc_id, prompt_version, substring(response, 1, 200) AS response_preview,
      {', '.join(f'round({m}, 6) AS {m}' for m in D.QUALITY_METRICS)}, input_tokens, output_tokens, latency_ms FROM cases""",
)
def scored_cases(spark: SparkSession, sf: str) -> DataFrame:
    return _cases(spark, sf).select(
        "doc_id", "prompt_version", "response_preview",
        *[F.round(m, 6).alias(m) for m in D.QUALITY_METRICS], "input_tokens", "output_tokens", "latency_ms",
    )


@register("metric_means", f"{_CASES} SELECT prompt_version, count(*) AS cases, {_MEANS} FROM cases GROUP BY 1")
def metric_means(spark: SparkSession, sf: str) -> DataFrame:
    return E.metric_means(_cases(spark, sf), ["prompt_version"])


_GATE = f"""{_CASES}, means AS (SELECT prompt_version, {_MEANS} FROM cases GROUP BY 1),
    gates AS ({' UNION ALL '.join(f"SELECT prompt_version, '{m}' AS metric, {m} AS score, CAST({t} AS DOUBLE) AS threshold FROM means"
                                  for m, t in D.QUALITY_GATES.items())})"""


@register("threshold_gate", f"{_GATE} SELECT *, score >= threshold AS passed FROM gates")
def threshold_gate(spark: SparkSession, sf: str) -> DataFrame:
    return E.threshold_gate(E.metric_means(_cases(spark, sf), ["prompt_version"]), ["prompt_version"])


@register(
    "gate_verdict",
    f"""{_GATE} SELECT prompt_version, bool_and(score >= threshold) AS all_passed, count(*) FILTER (score < threshold) AS failed_checks,
      CASE WHEN bool_and(score >= threshold) THEN 0 ELSE 1 END AS exit_code FROM gates GROUP BY 1""",
)
def gate_verdict(spark: SparkSession, sf: str) -> DataFrame:
    means = E.metric_means(_cases(spark, sf), ["prompt_version"])
    return E.gate_verdict(E.threshold_gate(means, ["prompt_version"]), ["prompt_version"])


@register(
    "safety_pass_rate",
    """SELECT source, count(*) AS rated, round(avg(CASE WHEN toxic = 0 THEN 1e0 ELSE 0e0 END), 6) AS safety_pass_rate,
      avg(CASE WHEN toxic = 0 THEN 1e0 ELSE 0e0 END) >= 1 AS passed
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""",
)
def safety_pass_rate(spark: SparkSession, sf: str) -> DataFrame:
    rated = table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels"), "doc_id")
    return E.safety_rate(rated, ["source"], "toxic").withColumn("safety_pass_rate", F.round("safety_pass_rate", 6))


_COLOR_LIST = "[" + ", ".join(str(c) for c in D.VALID_COLORS) + "]"


@register(
    "color_code_validity",
    f"""{ctes('responses')}, c AS (SELECT doc_id, list_distinct(list_transform(
        regexp_extract_all(lower(response), 'color\\s+(?:code\\s+)?(\\d+)', 1), lambda x: TRY_CAST(x AS INT))) AS codes FROM responses)
    SELECT doc_id, array_to_string(list_sort(list_filter(codes, lambda x: NOT list_contains({_COLOR_LIST}, x))), ',') AS unknown FROM c""",
)
def color_code_validity(spark: SparkSession, sf: str) -> DataFrame:
    bad = C.unknown_colors(F.col("response"))
    return view(spark, sf, "responses").select("doc_id", F.array_join(bad.cast("array<string>"), ",").alias("unknown"))


_GOLD = {"en": ["window", "roof", "the"], "de": ["die", "und", "slope", "zzz"], "fr": ["les", "mur"], "es": ["que", "Roof", "los"]}
_BAD = ["no foundation", "Floating Roof", "unsupported overhang"]


@register(
    "keyword_coverage",
    f"""{ctes('responses')}, g(lang, words) AS (VALUES {', '.join(f"('{k}', {v})" for k, v in _GOLD.items())}),
    h AS (SELECT doc_id, words, {_words('response', 'words')} AS hit, {_words('response', str(_BAD))} AS bad
      FROM responses JOIN g ON responses.lang = g.lang)
    SELECT doc_id, len(hit) AS keywords_found, round(len(hit) / len(words), 6) AS keyword_coverage,
      array_to_string(bad, '|') AS bad_found FROM h""",
)
def keyword_coverage(spark: SparkSession, sf: str) -> DataFrame:
    golden = F.create_map(
        *[x for k, v in _GOLD.items() for x in (F.lit(k), F.array(*[F.lit(w) for w in v]))]
    )
    cases = view(spark, sf, "responses").withColumns(
        {"golden_keywords": F.try_element_at(golden, F.col("lang")), "bad_patterns": F.array(*[F.lit(b) for b in _BAD])}
    )
    out = E.keyword_coverage(cases)
    return out.select(
        "doc_id",
        "keywords_found",
        F.round("keyword_coverage", 6).alias("keyword_coverage"),
        F.array_join("bad_found", "|").alias("bad_found"),
    )


@register(
    "expected_traits",
    f"""{_CHECKED}
    SELECT doc_id, CAST(dimensions_present AS INT) + CAST(color_palette_specified = (quality IS NOT NULL) AS INT)
      + CAST(brick_part_references AS INT) + CAST(contains(lower(response), 'house') AS INT)
      + CAST(contains(lower(response), '2-story') AS INT) + CAST(regexp_matches(lower(response), 'floor[ -]?plan') = (toxic = 1) AS INT)
      + CAST(contains(lower(response), 'brick') AS INT) AS traits_met
    FROM (SELECT * REPLACE (coalesce(toxic, 0) AS toxic) FROM scored) s""",
)
def expected_traits(spark: SparkSession, sf: str) -> DataFrame:
    traits = F.struct(
        F.lit(True).alias("has_dimensions"),
        F.col("quality").isNotNull().alias("has_color_palette"),
        F.lit(True).alias("has_brick_references"),
        F.lit("House").alias("style_matches"),
        F.lit(2).alias("story_count"),
        (F.coalesce("toxic", F.lit(0)) == 1).alias("has_floor_plan"),
        F.lit("Brick").alias("building_type"),
    )
    return E.trait_check(view(spark, sf, "responses").withColumn("expected_traits", traits)).select("doc_id", "traits_met")


@register(
    "strategy_totals",
    f"""{ctes('responses')} SELECT prompt_version AS strategy, count(*) AS outputs, CAST(sum(input_tokens + output_tokens) AS BIGINT) AS total_tokens,
      round(avg(input_tokens + output_tokens), 6) AS mean_tokens FROM responses GROUP BY 1""",
)
def strategy_totals(spark: SparkSession, sf: str) -> DataFrame:
    runs = view(spark, sf, "responses").select(
        F.col("prompt_version").alias("strategy"), (F.col("input_tokens") + F.col("output_tokens")).alias("tokens")
    )
    return E.strategy_totals(runs).withColumn("mean_tokens", F.round("mean_tokens", 6))


@register(
    "attempt_log",
    """WITH o AS (SELECT conv_id, max(turn // 2 + 1) AS attempts, min(turn // 2 + 1) FILTER (length(text) % 3 = 0) AS first_pass
      FROM conversations WHERE role = 'assistant' GROUP BY 1)
    SELECT count(*) AS jobs, round(avg(CASE WHEN first_pass = 1 THEN 1e0 ELSE 0e0 END), 6) AS first_pass_rate,
      round(avg(CASE WHEN first_pass <= 3 THEN 1e0 ELSE 0e0 END), 6) AS solved_rate, round(avg(attempts), 6) AS avg_attempts FROM o""",
)
def attempt_log(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").where(F.col("role") == "assistant")
    attempts = turns.select(
        "conv_id", F.floor(F.col("turn") / 2 + 1).alias("attempt"), (F.length("text") % 3 == 0).alias("passed")
    )
    out = E.attempt_summary(E.attempt_outcomes(attempts, "conv_id", "attempt", "passed"))
    return out.withColumns({c: F.round(c, 6) for c in ("first_pass_rate", "solved_rate", "avg_attempts")})


_J = "json_extract_string(entry, '$.{}')"
_BELOW = ", ".join(
    f"CASE WHEN TRY_CAST({_J.format(m)} AS DOUBLE) < TRY_CAST({_J.format(m + '_threshold')} AS DOUBLE) THEN '{m}_failure' END"
    for m in X.LOG_METRICS
)
_TAX = "CASE " + " ".join(
    f"WHEN {' OR '.join(f'contains(lower(reason), {_lit(k)})' for k in kws)} THEN '{c}'" for c, kws in D.FAILURE_TAXONOMY
) + " ELSE 'other' END"
_FAILED = f"""{ctes('eval_log')},
    kept AS (SELECT * FROM eval_log WHERE NOT coalesce(regexp_matches({_J.format('timestamp')}, '(Z|[+-][0-9][0-9]:?[0-9][0-9])$')
      AND TRY_CAST({_J.format('timestamp')} AS TIMESTAMPTZ) < TIMESTAMPTZ '2023-06-01 00:00:00+00', false)),
    k AS (SELECT *, json_keys(entry) AS ks FROM kept),
    r AS (SELECT *, list_concat(list_concat(list_concat(list_filter([{_BELOW}], lambda x: x IS NOT NULL),
        CASE WHEN list_contains(ks, 'failure_reason') THEN [{_J.format('failure_reason')}] ELSE [] END),
        CASE WHEN list_contains(ks, 'failure_reasons') THEN CAST(json_extract(entry, '$.failure_reasons') AS VARCHAR[]) ELSE [] END),
        CASE WHEN list_contains(ks, 'errors') THEN CAST(json_extract(entry, '$.errors') AS VARCHAR[]) ELSE [] END) AS rs FROM k),
    failures AS (SELECT doc_id, coalesce({_J.format('id')}, 'unknown') AS id, coalesce({_J.format('prompt_version')}, 'unknown') AS prompt_version,
        coalesce({_J.format('timestamp')}, '') AS timestamp,
        CASE WHEN len(rs) > 0 THEN rs ELSE ['unspecified'] END AS rs FROM r
      WHERE {_J.format('passed')} = 'false' OR {_J.format('success')} = 'false' OR len(rs) > 0 OR list_contains(ks, 'failure_reason')
        OR list_contains(ks, 'failure_reasons') OR list_contains(ks, 'errors')),
    reasons AS (SELECT *, {_TAX} AS category FROM (SELECT doc_id, prompt_version, timestamp,
        unnest(rs) AS reason, unnest(range(len(rs))) AS reason_pos FROM failures) u)"""


def _failures(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    log = X.recent_entries(view(spark, sf, "eval_log"), "2023-06-01 00:00:00")
    return log, X.extract_failures(log)


@register(
    "failure_extract",
    f"""{_FAILED} SELECT doc_id, id, prompt_version, timestamp,
      array_to_string(list_transform(rs, lambda x: coalesce(x, '<null>')), '|') AS reasons FROM failures""",
)
def failure_extract(spark: SparkSession, sf: str) -> DataFrame:
    _, failed = _failures(spark, sf)
    joined = F.array_join(F.transform("failure_reasons", lambda r: F.coalesce(r, F.lit("<null>"))), "|")
    return failed.select("doc_id", "id", "prompt_version", "timestamp", joined.alias("reasons"))


@register(
    "failure_categories",
    f"""{_FAILED} SELECT category, count(*) AS count, round(count(*) * 100e0 / sum(count(*)) OVER (), 6) AS percentage
    FROM reasons GROUP BY 1""",
)
def failure_categories(spark: SparkSession, sf: str) -> DataFrame:
    out = X.category_counts(X.explode_reasons(_failures(spark, sf)[1]))
    return out.select("category", "count", F.round("percentage", 6).alias("percentage"))


@register("failure_by_version", f"{_FAILED} SELECT prompt_version, category, count(*) AS count FROM reasons GROUP BY 1, 2")
def failure_by_version(spark: SparkSession, sf: str) -> DataFrame:
    return X.by_version(X.explode_reasons(_failures(spark, sf)[1]))


@register(
    "failure_summary",
    f"""{_FAILED} SELECT (SELECT count(*) FROM kept) AS total_evaluations, (SELECT count(*) FROM failures) AS total_failures,
      round((SELECT count(*) FROM failures) / greatest((SELECT count(*) FROM kept), 1), 6) AS failure_rate,
      (SELECT count(DISTINCT category) FROM reasons) AS unique_categories""",
)
def failure_summary(spark: SparkSession, sf: str) -> DataFrame:
    log, failed = _failures(spark, sf)
    out = X.failure_summary(log, failed, X.explode_reasons(failed))
    return out.withColumn("failure_rate", F.round("failure_rate", 6))


@register(
    "failure_examples",
    f"""{_FAILED} SELECT * FROM (SELECT category, doc_id, reason,
      row_number() OVER (PARTITION BY category ORDER BY doc_id, reason_pos) AS rank FROM reasons) t WHERE rank <= 3""",
)
def failure_examples(spark: SparkSession, sf: str) -> DataFrame:
    out = X.examples(X.explode_reasons(_failures(spark, sf)[1]), ["doc_id"])
    return out.select("category", "doc_id", "reason", "rank")


@register(
    "weekly_failure_trend",
    f"""{ctes('failure_metrics')}, t AS (SELECT date_trunc('week', ts) AS week,
        coalesce(nullif(failure_category, ''), nullif(failure_reason, ''), 'unspecified') AS category, count(*) AS n
      FROM failure_metrics GROUP BY 1, 2)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY week ORDER BY n DESC, category) AS rank FROM t) r WHERE rank <= 5""",
)
def weekly_failure_trend(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "failure_metrics").withColumn(
        "category",
        F.coalesce(
            F.nullif("failure_category", F.lit("")), F.nullif("failure_reason", F.lit("")), F.lit("unspecified")
        ),
    )
    return E.weekly_top(rows, "ts", "category")


@register(
    "case_context",
    """WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN concat('doc/', CAST(conv_id AS VARCHAR)) ELSE concat('doc/', CAST(conv_id * 100000 AS VARCHAR)) END AS a,
        concat('doc/', CAST(turn AS VARCHAR)) AS b FROM conversations),
    d AS (SELECT concat('doc/', CAST(doc_id AS VARCHAR)) AS path, text FROM documents)
    SELECT conv_id, turn, md5(concat(coalesce(x.text, concat('[Context document not available: ', a, ']')), '\n\n---\n\n',
      coalesce(y.text, concat('[Context document not available: ', b, ']')))) AS digest
    FROM c LEFT JOIN d x ON x.path = a LEFT JOIN d y ON y.path = b""",
)
def case_context(spark: SparkSession, sf: str) -> DataFrame:
    conv = table(spark, sf, "conversations")
    own = F.when(F.col("turn") % 2 == 0, F.col("conv_id")).otherwise(F.col("conv_id") * 100000)
    cases = conv.select(
        F.struct("conv_id", "turn").alias("case"),
        F.array(F.concat(F.lit("doc/"), own), F.concat(F.lit("doc/"), F.col("turn"))).alias("context_docs"),
    )
    docs = table(spark, sf, "documents").select(F.concat(F.lit("doc/"), F.col("doc_id")).alias("path"), "text")
    out = E.context_text(cases, docs, "case")
    return out.select("case.conv_id", "case.turn", F.md5(F.col("context").cast("binary")).alias("digest"))


@register(
    "prompt_lookup",
    """SELECT doc_id, source AS version, CASE source WHEN 'src1' THEN 'Be brief.' WHEN 'src2' THEN 'Be complete.'
      ELSE 'Write a building specification.' END AS template FROM documents""",
)
def prompt_lookup(spark: SparkSession, sf: str) -> DataFrame:
    templates = spark.createDataFrame([("src1", "Be brief."), ("src2", "Be complete.")], "version string, template string")
    wanted = table(spark, sf, "documents").select("doc_id", F.col("source").alias("version"))
    return E.versioned_text(wanted, templates, "Write a building specification.")
