"""Experiment grids, per-configuration summaries, composites, winners and Pareto fronts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mortarline import dims as D
from mortarline.functions.scalars import render, words
from mortarline.session import cut_lineage


def grid_array(axes: Mapping[str, Sequence]) -> Column:
    """Every combination of the axis values as one literal array, numbered in declared order.

    The grid is a handful of configurations typed by a person, so it travels inside the
    plan: expanding it is a map-side explode, not a join.
    """
    combos = [
        F.struct(F.lit(i).alias("combo_no"), *[F.lit(v).alias(k) for k, v in zip(axes, values)])
        for i, values in enumerate(product(*axes.values()))
    ]
    return F.array(*combos)


def config_grid(spark: SparkSession, axes: Mapping[str, Sequence]) -> DataFrame:
    return spark.range(1).select(F.inline(grid_array(axes)))


def stored_runs(cases: DataFrame, axes: Mapping[str, Sequence], combo: str = "combo_no") -> DataFrame:
    """Stored runs (one row per case and configuration that was run) with the axis values of
    their configuration; runs of numbers outside the grid are dropped.

    The grid travels inside the plan as one map, so no row is shuffled or copied.
    """
    grid = grid_array(axes)
    by_number = F.map_from_entries(F.transform(grid, lambda c: F.struct(c["combo_no"], c)))
    placed = cases.withColumn("_c", F.try_element_at(by_number, F.col(combo).cast("int"))).where(F.col("_c").isNotNull())
    return placed.select("*", *[F.col(f"_c.{k}").alias(k) for k in axes]).drop("_c")


def cost(tokens_in: Column, tokens_out: Column, rate_in: float = D.TOKEN_PRICE_IN, rate_out: float = D.TOKEN_PRICE_OUT) -> Column:
    return F.round(tokens_in * F.lit(rate_in) + tokens_out * F.lit(rate_out), 6)


def composite(weights: Mapping[str, float]) -> Column:
    total = F.lit(0.0)
    for metric, w in weights.items():
        total = total + F.coalesce(F.col(metric), F.lit(0.0)) * F.lit(w)
    return total


def _scores(metrics: Sequence[str]) -> list[Column]:
    return [F.round(F.avg(F.coalesce(F.col(m), F.lit(0.0))), 4).alias(m) for m in metrics]


def prompt_summary(runs: DataFrame, keys: Sequence[str], metrics: Sequence[str] = D.QUALITY_METRICS) -> DataFrame:
    """Per combination: metric means, average tokens and latency, cost, composite."""
    out = runs.groupBy(*keys).agg(
        *_scores(metrics),
        F.round(F.avg("input_tokens"), 1).alias("avg_input_tokens"),
        F.round(F.avg("output_tokens"), 1).alias("avg_output_tokens"),
        F.round(F.avg("latency_ms"), 1).alias("avg_latency_ms"),
        cost(F.avg("input_tokens"), F.avg("output_tokens")).alias("estimated_cost_per_request"),
    )
    return out.withColumn("composite", composite(D.PROMPT_WEIGHTS))


def rag_summary(runs: DataFrame, keys: Sequence[str], metrics: Sequence[str] = D.QUALITY_METRICS) -> DataFrame:
    """Per retrieval configuration: metric means, composite, latency split and cost."""
    out = runs.groupBy(*keys).agg(
        *_scores(metrics),
        F.round(F.avg("retrieval_ms"), 1).alias("avg_retrieval_latency_ms"),
        F.round(F.avg("latency_ms"), 1).alias("avg_generation_latency_ms"),
        F.round((F.sum("retrieval_ms") + F.sum("latency_ms")) / F.count(F.lit(1)), 1).alias("avg_total_latency_ms"),
        F.round(F.avg("input_tokens"), 1).alias("avg_input_tokens"),
        F.round(F.avg("output_tokens"), 1).alias("avg_output_tokens"),
        cost(F.avg("input_tokens"), F.avg("output_tokens")).alias("estimated_cost_per_request"),
    )
    return out.withColumn("composite_quality", F.round(composite(D.RAG_WEIGHTS), 4))


def ranked(summary: DataFrame, score: str, tie: str = "combo_no") -> DataFrame:
    """Rank configurations; the earliest wins a tie.  One row per grid configuration."""
    return summary.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(score), tie)))


def winner(summary: DataFrame, score: str, tie: str = "combo_no") -> DataFrame:
    return summary.orderBy(F.desc(score), tie).limit(1)


def pareto_front(candidates: DataFrame, quality: str, price: str) -> DataFrame:
    """Candidates no other candidate beats: as good and as cheap with one strictly better.

    In the order of prices a point survives if it is better than all cheaper ones: a prefix maximum in two steps.  The best
    point of each price goes to partitions by ranges of prices, which are written once; the largest quality of each
    partition (one small row in all) says what every later partition has to exceed, and the running maximum is taken
    inside partitions over the points that do.  So no task orders more than its range.  Equal points stand or fall together and all
    come back in the last join; candidates with a null quality or price are left out.
    """
    points = candidates.where(F.col(quality).isNotNull() & F.col(price).isNotNull()).groupBy(price).agg(F.max(quality).alias(quality))
    placed = cut_lineage(points.repartitionByRange(price).withColumn("_part", F.spark_partition_id()))
    tops = placed.groupBy("_part").agg(F.max(quality).alias("_q")).agg(F.collect_list(F.struct("_part", "_q")).alias("_tops"))
    cheaper = F.array_max(F.transform(F.filter("_tops", lambda t: t["_part"] < F.col("_part")), lambda t: t["_q"]))
    open_ = placed.crossJoin(F.broadcast(tops)).withColumn("_floor", cheaper).drop("_tops")
    open_ = open_.where(F.col("_floor").isNull() | (F.col(quality) > F.col("_floor")))
    before = Window.partitionBy("_part").orderBy(price).rowsBetween(Window.unboundedPreceding, -1)
    best = open_.withColumn("_best", F.max(quality).over(before))
    keep = best.where(F.col("_best").isNull() | (F.col(quality) > F.col("_best"))).select(price, quality)
    return candidates.join(keep, [price, quality], "left_semi")


def prompt_runs(
    cases: DataFrame, systems: Mapping[str, str], templates: Mapping[str, str], window: int, case: str = "case_id"
) -> DataFrame:
    """One measured row per combination and case: every prompt is rendered and held against a window of tokens.

    ``cases`` (case_id, prompt, context); ``templates`` hold ``{{ context }}`` and ``{{ prompt }}``.  Of the first ``window`` white-space tokens of
    system prompt and rendered template: ``request_kept`` is 1 if the whole request is among them, ``context_kept`` the share of the context's
    tokens that fits, ``coverage`` the share of the request's different words that the fitting context holds.  An empty context counts as kept,
    an empty request as kept and covered; null texts are empty.
    """
    axes = {"system_prompt": list(systems), "rag_template": list(templates)}
    texts = lambda given: F.create_map(*[F.lit(x) for pair in given.items() for x in pair])
    tokens = lambda t: F.filter(F.split(t, r"\s+"), lambda w: w != "")
    head = {name: text.split("{{ context }}")[0] for name, text in templates.items()}
    filled = cases.select(case, F.coalesce("prompt", F.lit("")).alias("_p"), F.coalesce("context", F.lit("")).alias("_c"))
    filled = filled.select(case, "_p", "_c", tokens(F.col("_c")).alias("_ct"), F.array_distinct(words(F.col("_p"))).alias("_w"))
    rows = filled.select("*", F.inline(grid_array(axes)))
    system = F.element_at(texts(systems), F.col("system_prompt"))
    values = {"context": F.col("_c"), "prompt": F.col("_p")}
    body = F.concat(system, F.lit("\n\n"), render(F.element_at(texts(templates), F.col("rag_template")), values))
    before = F.concat(system, F.lit("\n\n"), render(F.element_at(texts(head), F.col("rag_template")), {"prompt": F.col("_p")}))
    rows = rows.withColumn("_t", tokens(body)).withColumn("_room", F.greatest(F.lit(0), F.lit(window) - F.size(tokens(before))))
    rows = rows.withColumn("_k", F.slice("_ct", F.lit(1), F.col("_room")))
    shown = F.array_join(F.slice("_t", 1, window), " ")
    held = F.size(F.array_intersect("_w", words(F.array_join("_k", " "))))
    return rows.select(
        "combo_no", *axes, case,
        F.contains(shown, F.array_join(tokens(F.col("_p")), " ")).cast("double").alias("request_kept"),
        F.when(F.size("_ct") > 0, F.size("_k") / F.size("_ct")).otherwise(1.0).alias("context_kept"),
        F.when(F.size("_w") > 0, held / F.size("_w")).otherwise(1.0).alias("coverage"),
        F.least(F.size("_t"), F.lit(window)).cast("long").alias("input_tokens"),
    )


#: Poisson(1): chances of at most 0, 1, ... events, in 65536ths.
POISSON = [24109, 48219, 60273, 64292, 65296, 65497, 65531, 65535]


def poisson_weights(case: Column, block: Column) -> Column:
    """Eight weights of a case for the replicates of a block, each from four digits of one MD5 digest."""
    digest = F.md5(F.concat_ws(":", block.cast("string"), case.cast("string")).cast("binary"))
    drawn = [F.conv(F.substring(digest, 4 * i + 1, 4), 16, 10).cast("int") for i in range(8)]
    return F.transform(F.array(*drawn), lambda u: F.size(F.filter(F.array(*[F.lit(p) for p in POISSON]), lambda p: u >= p)))


def resampled(
    runs: DataFrame, combos: Sequence[int], score: str, combo: str = "combo_no", case: str = "case_id", replicates: int = 200, level: float = 0.95
) -> DataFrame:
    """Per combination: mean score with an interval, its paired difference to the winner with an interval, share of wins.

    Cases are drawn anew in each replicate with Poisson weights that depend on case and replicate only: all combinations share them, so
    differences are paired, a repeated run gives the same rows, and no row is copied or collected.  One aggregate with a group
    per replicate holds the weighted sums of all combinations.  Cases that lack a combination take no part; without cases there are no rows.
    The winner has the highest mean; the smaller number wins ties.  ``replicates`` is rounded up to a multiple of eight.
    """
    name = lambda c: f"s{c}"
    wide = runs.groupBy(case).agg(*[F.max(F.when(F.col(combo) == c, F.col(score).cast("double"))).alias(name(c)) for c in combos])
    wide = cut_lineage(wide.dropna(subset=[name(c) for c in combos]))
    blocks = F.sequence(F.lit(0), F.lit((replicates + 7) // 8 - 1))
    drawn = wide.withColumn("_b", F.explode(blocks)).select("*", F.posexplode(poisson_weights(F.col(case), F.col("_b"))).alias("_i", "_w")).where("_w > 0")
    sums = drawn.groupBy((F.col("_b") * 8 + F.col("_i")).alias("replicate")).agg(
        *[F.round(F.sum(F.col("_w") * F.col(name(c))) / F.sum("_w"), 9).alias(name(c)) for c in combos]
    )
    sums = cut_lineage(sums)
    stack = lambda df, *keep: df.select(*keep, F.inline(F.array(*[F.struct(F.lit(c).alias(combo), F.col(name(c)).alias("mean")) for c in combos])))
    best = lambda: F.min_by(combo, F.struct(-F.col("mean"), F.col(combo)))
    point = stack(wide.agg(F.count(F.lit(1)).alias("n_cases"), *[F.round(F.avg(name(c)), 9).alias(name(c)) for c in combos]), "n_cases").where("n_cases > 0")
    top = point.agg(best().alias("winner"), F.max("mean").alias("best"))
    # from here on one row per combination, and one per replicate
    drawn_lead = sums.crossJoin(F.broadcast(top.select("winner")))
    lead = F.element_at(F.map_from_arrays(F.array(*[F.lit(c) for c in combos]), F.array(*[F.col(name(c)) for c in combos])), F.col("winner"))
    each = stack(drawn_lead.withColumn("lead", lead), "replicate", "lead")
    wins = each.groupBy("replicate").agg(best().alias(combo)).groupBy(combo).agg(F.count(F.lit(1)).alias("wins"))
    low, high = (1 - level) / 2, (1 + level) / 2
    cut = lambda c, p: F.round(F.percentile(c, F.lit(p)), 6)
    spread = each.groupBy(combo).agg(
        F.count(F.lit(1)).alias("n_replicates"), cut(F.col("mean"), low).alias("low"), cut(F.col("mean"), high).alias("high"),
        cut(F.col("lead") - F.col("mean"), low).alias("behind_low"), cut(F.col("lead") - F.col("mean"), high).alias("behind_high"),
    )
    return point.join(spread, combo).join(wins, combo, "left").crossJoin(F.broadcast(top)).select(
        combo, "n_cases", F.round("mean", 6).alias("mean"), "low", "high", F.round(F.col("best") - F.col("mean"), 6).alias("behind"), "behind_low", "behind_high",
        F.round(F.coalesce("wins", F.lit(0)) / F.col("n_replicates"), 4).alias("win_share"), (F.col(combo) == F.col("winner")).alias("is_winner"),
    )
