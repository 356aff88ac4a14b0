"""Scoring and gating of evaluated responses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mortarline import dims as D
from mortarline.functions import text_checks as C


def unit_score(c: str | Column) -> Column:
    """A 1-5 judge score on the 0-1 scale; missing counts as 0."""
    v = F.col(c) if isinstance(c, str) else c
    return F.coalesce(v, F.lit(0.0)) / F.lit(5.0)


def safety_pass(defect: str | Column) -> Column:
    """1.0 when no defect was found; an unrated response passes."""
    v = F.col(defect) if isinstance(defect, str) else defect
    return F.when(F.coalesce(v, F.lit(0)) == 0, 1.0).otherwise(0.0)


def buildability(responses: DataFrame, response: str = "response") -> DataFrame:
    """Add ``details`` (one entry per check) and ``score``."""
    facts = F.col("_facts")
    checked = C.collect_facts(responses, response)
    return checked.withColumns({"details": C.run_checks(facts), "score": C.checks_score(facts)}).drop("_facts")


def score_cases(
    responses: DataFrame, judges: Mapping[str, str], defect: str, response: str = "response"
) -> DataFrame:
    """Per-case scores: judge metrics on 0-1, safety and buildability, plus a 200-character preview."""
    return buildability(responses, response).select(
        *[c for c in responses.columns if c != response],
        F.substring(response, 1, 200).alias("response_preview"),
        *[unit_score(src).alias(metric) for metric, src in judges.items()],
        safety_pass(defect).alias("safety_pass_rate"),
        F.col("score").alias("buildability"),
        F.col("details").alias("buildability_details"),
    )


def metric_means(cases: DataFrame, keys: Sequence[str] = (), metrics: Sequence[str] = D.QUALITY_METRICS) -> DataFrame:
    """Mean per metric rounded to 4 places; a missing score counts as 0. No rows in, no row out."""
    aggs = [F.round(F.avg(F.coalesce(F.col(m), F.lit(0.0))), 4).alias(m) for m in metrics]
    grouped = cases.groupBy(*keys).agg(F.count(F.lit(1)).alias("cases"), *aggs)
    return grouped.where(F.col("cases") > 0)


def threshold_gate(means: DataFrame, keys: Sequence[str] = (), gates: Mapping[str, float] = D.QUALITY_GATES) -> DataFrame:
    """One row per gate with its score and verdict; a metric without a column scores 0."""
    entries = [
        F.struct(
            F.lit(m).alias("metric"),
            (F.coalesce(F.col(m), F.lit(0.0)) if m in means.columns else F.lit(0.0)).alias("score"),
            F.lit(float(t)).alias("threshold"),
        )
        for m, t in gates.items()
    ]
    return (
        means.select(*keys, F.explode(F.array(*entries)).alias("g"))
        .select(*keys, "g.*")
        .withColumn("passed", F.col("score") >= F.col("threshold"))
    )


def gate_verdict(checks: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """All checks passed, with the job exit code."""
    return checks.groupBy(*keys).agg(
        F.bool_and("passed").alias("all_passed"), F.count_if(~F.col("passed")).alias("failed_checks")
    ).withColumn("exit_code", F.when(F.col("all_passed"), 0).otherwise(1))


def safety_rate(rated: DataFrame, keys: Sequence[str], defect: str) -> DataFrame:
    """Share of safe responses; the gate asks for all of them."""
    return rated.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rated"), F.avg(safety_pass(defect)).alias("safety_pass_rate")
    ).withColumn("passed", F.col("safety_pass_rate") >= 1.0)


def strategy_totals(runs: DataFrame, strategy: str = "strategy", tokens: str = "tokens") -> DataFrame:
    """Per strategy: outputs collected, their total and mean tokens.

    The outputs themselves stay rows, as a strategy may have any number of them.
    """
    return runs.groupBy(strategy).agg(
        F.count(F.lit(1)).alias("outputs"), F.sum(tokens).alias("total_tokens"), F.avg(tokens).alias("mean_tokens")
    )


def keyword_coverage(
    responses: DataFrame, golden: str = "golden_keywords", bad: str = "bad_patterns", response: str = "response"
) -> DataFrame:
    """Share of golden keywords present and the known-bad phrases found."""
    low = F.lower(response)
    hit = C.found_keywords(low, F.col(golden))
    return responses.withColumns(
        {
            "keywords_found": F.size(hit),
            "keyword_coverage": F.coalesce(
                F.size(hit) / F.nullif(F.size(golden), F.lit(0)), F.lit(0.0)
            ),
            "bad_found": C.found_keywords(low, F.col(bad)),
        }
    )


def trait_check(responses: DataFrame, traits: str = "expected_traits", response: str = "response") -> DataFrame:
    """Number of expected traits a response meets.

    Traits: has_dimensions, has_color_palette, has_brick_references, has_floor_plan, style_matches,
    story_count, building_type.  Those that ``traits`` has no field for are not expected.
    """
    fields = responses.schema[traits].dataType.names
    facts, text, want = F.col("_facts"), F.col(response), F.col(traits)
    low = F.lower(text)
    checks = {
        "has_dimensions": lambda w: C.check_dimensions(facts)[0] == w,
        "has_color_palette": lambda w: C.check_palette(facts)[0] == w,
        "has_brick_references": lambda w: C.check_parts(facts)[0] == w,
        "has_floor_plan": lambda w: low.rlike(r"floor[ -]?plan") == w,
        "style_matches": lambda w: F.contains(low, F.lower(w)),
        "story_count": lambda w: F.contains(low, F.concat(w.cast("string"), F.lit("-story"))),
        "building_type": lambda w: F.contains(low, F.lower(w)),
    }
    n = F.lit(0)
    for name, check in checks.items():
        if name in fields:
            n = n + F.coalesce(check(want[name]), F.lit(False)).cast("int")
    return C.collect_facts(responses, response).withColumn("traits_met", n).drop("_facts")


def attempt_outcomes(attempts: DataFrame, key: str, attempt: str, passed: str, max_attempts: int = 3) -> DataFrame:
    """Per generation job: attempts used, first pass, solved within the limit."""
    first = F.min(F.when(F.col(passed), F.col(attempt)))
    return attempts.groupBy(key).agg(F.max(attempt).alias("attempts"), first.alias("first_pass")).withColumns(
        {
            "first_try": F.coalesce(F.col("first_pass") == 1, F.lit(False)),
            "solved": F.coalesce(F.col("first_pass") <= max_attempts, F.lit(False)),
        }
    )


def attempt_summary(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(
        F.count(F.lit(1)).alias("jobs"),
        F.avg(F.col("first_try").cast("double")).alias("first_pass_rate"),
        F.avg(F.col("solved").cast("double")).alias("solved_rate"),
        F.avg("attempts").alias("avg_attempts"),
    )


def context_text(
    cases: DataFrame, docs: DataFrame, key: str, separator: str = "\n\n---\n\n", paths: str = "context_docs"
) -> DataFrame:
    """Join each case's listed documents in order; a missing document leaves a note.

    A case lists a handful of paths, so a group here is bounded by the case row itself.
    """
    listed = cases.select(key, F.posexplode(paths).alias("pos", "path"))
    text = F.coalesce(
        F.col("text"), F.concat(F.lit("[Context document not available: "), F.col("path"), F.lit("]"))
    )
    parts = listed.join(docs.select("path", "text"), "path", "left").select(key, F.struct("pos", text.alias("text")).alias("p"))
    return parts.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["text"]), separator).alias("context")
    )


def versioned_text(wanted: DataFrame, templates: DataFrame, default: str, version: str = "version") -> DataFrame:
    """Template of the asked version, else the default text."""
    return wanted.join(templates.select(version, F.col("template").alias("_t")), version, "left").select(
        *wanted.columns, F.coalesce("_t", F.lit(default)).alias("template")
    )


def weekly_top(reasons: DataFrame, ts: str, category: str, k: int = 5) -> DataFrame:
    """Top ``k`` failure categories per week, ties by name."""
    counted = reasons.groupBy(
        F.date_trunc("week", ts).cast("timestamp_ntz").alias("week"), F.col(category).alias("category")
    ).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("week").orderBy(F.desc("n"), "category")
    return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
