"""Profile and drift queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline.operators import drift as X
from mortarline.operators import profile as P
from mortarline.operators.telemetry import metric_long_form
from mortarline.plans.adapters import ctes, table, text, view
from mortarline.plans.registry import check_of, register
from mortarline.session import scratch_path
from mortarline.sources.writers import append_captures

NUMERIC = ["quantity", "price", "discount", "tax"]
CATEGORICAL = ["flag", "status"]


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def _long(src: str, name: str) -> str:
    parts = " UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS v FROM {src}" for f in NUMERIC)
    return f"{name} AS (SELECT * FROM ({parts}) u WHERE v IS NOT NULL)"


_EDGES = """edges AS (SELECT feature, list_append(list_transform(range(10), lambda i: lo + CAST(i AS DOUBLE) * ((hi - lo) / 10e0)), hi) AS e
    FROM (SELECT feature, CASE WHEN min(v) = max(v) THEN min(v) - 5e-1 ELSE min(v) END AS lo,
      CASE WHEN min(v) = max(v) THEN max(v) + 5e-1 ELSE max(v) END AS hi FROM base_long GROUP BY 1) b)"""


def _hist(src: str, name: str) -> str:
    return f"""{name} AS (SELECT f.feature, f.bin, coalesce(n, 0) AS n
      FROM (SELECT feature, unnest(range(1, 11)) AS bin FROM edges) f
      LEFT JOIN (SELECT feature, bin, count(*) AS n FROM (
        SELECT l.feature, CASE WHEN v = e[11] THEN 10 ELSE len(list_filter(e, lambda x: x <= v)) END AS bin
        FROM {src} l JOIN edges USING (feature)) b WHERE bin BETWEEN 1 AND 10 GROUP BY 1, 2) c
      ON f.feature = c.feature AND f.bin = c.bin)"""


_BASE = f"{ctes('features_base', 'features_inf')}, {_long('features_base', 'base_long')}, {_long('features_inf', 'inf_long')}, {_EDGES}"
_PAIR = f"{_BASE}, {_hist('base_long', 'hb')}, {_hist('inf_long', 'hi_')}"
_DIV = f"""{_PAIR},
    pq AS (SELECT b.feature, greatest(b.n / (sum(b.n) OVER (PARTITION BY b.feature) + 1e-10), 1e-10) AS p,
        greatest(i.n / (sum(i.n) OVER (PARTITION BY b.feature) + 1e-10), 1e-10) AS q
      FROM hb b JOIN hi_ i ON b.feature = i.feature AND b.bin = i.bin),
    div AS (SELECT feature, sum((q - p) * ln(q / p)) AS psi,
        5e-1 * sum(p * ln(p / ((p + q) * 5e-1))) + 5e-1 * sum(q * ln(q / ((p + q) * 5e-1))) AS js_divergence
      FROM pq GROUP BY 1)"""
_KS = """s AS (SELECT feature, v, sum(a) AS a, sum(b) AS b FROM (
        SELECT feature, v, 1 AS a, 0 AS b FROM base_long UNION ALL SELECT feature, v, 0, 1 FROM inf_long) u GROUP BY 1, 2),
    c AS (SELECT feature, sum(a) OVER w / sum(a) OVER g AS fa, sum(b) OVER w / sum(b) OVER g AS fb FROM s
      WINDOW w AS (PARTITION BY feature ORDER BY v), g AS (PARTITION BY feature)),
    ks AS (SELECT feature, max(abs(fa - fb)) AS ks_statistic FROM c GROUP BY 1)"""


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return view(spark, sf, "features_base"), view(spark, sf, "features_inf")


@register(
    "numeric_profile",
    f"""{_BASE}, nulls AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature, count(*) - count({f}) AS k FROM features_base" for f in NUMERIC)})
    SELECT l.feature, count(*) AS count, any_value(k) AS null_count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
      min(v) AS min, max(v) AS max,
      {', '.join(f"round(quantile_cont(v, {q}), 6) AS {p}" for p, q in P.PERCENTILES.items())}
    FROM base_long l JOIN nulls n ON l.feature = n.feature GROUP BY 1""",
)
def numeric_profile(spark: SparkSession, sf: str) -> DataFrame:
    base, _ = _sides(spark, sf)
    return rounded(P.numeric_profile(base, [*NUMERIC, "not_there"]), "mean", "std", *P.PERCENTILES)


@register(
    "categorical_profile",
    f"""{ctes('features_inf')}, l AS (SELECT 'flag' AS feature, flag AS value FROM features_inf
      UNION ALL SELECT 'status', status FROM features_inf), c AS (SELECT feature, value, count(*) AS n FROM l GROUP BY 1, 2)
    SELECT feature, value, n, round(n / sum(n) OVER (PARTITION BY feature), 6) AS proportion,
      count(*) OVER (PARTITION BY feature) AS n_unique, 0 AS null_count FROM c WHERE value IS NOT NULL""",
)
def categorical_profile(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(P.categorical_profile(_sides(spark, sf)[1], CATEGORICAL), "proportion")


@register("histogram_baseline", f"{_BASE}, {_hist('base_long', 'hb')} SELECT * FROM hb")
def histogram_baseline(spark: SparkSession, sf: str) -> DataFrame:
    base, _ = _sides(spark, sf)
    return P.histogram(base, P.bin_edges(P.numeric_summary(base, NUMERIC)), NUMERIC)


@register("histogram_inference", f"{_BASE}, {_hist('inf_long', 'hi_')} SELECT * FROM hi_")
def histogram_inference(spark: SparkSession, sf: str) -> DataFrame:
    base, inf = _sides(spark, sf)
    return P.histogram(inf, P.bin_edges(P.numeric_summary(base, NUMERIC)), NUMERIC)


@register(
    "baseline_profile_json",
    f"""{ctes('features_base')} SELECT 'numeric' AS type, CAST(4 AS BIGINT) AS features, CAST(count(*) * 4 AS BIGINT) AS total
      FROM features_base UNION ALL SELECT 'categorical', 2, CAST(count(*) * 2 AS BIGINT) FROM features_base""",
)
def baseline_profile_json(spark: SparkSession, sf: str) -> DataFrame:
    profile = P.baseline_profile(_sides(spark, sf)[0], NUMERIC, CATEGORICAL)
    return profile.groupBy("type").agg(F.count("*").alias("features"), F.sum("count").alias("total"))


@register("psi_by_feature", f"{_DIV} SELECT feature, round(psi, 6) AS psi FROM div")
def psi_by_feature(spark: SparkSession, sf: str) -> DataFrame:
    div = X.divergence(X.paired_histogram(*_sides(spark, sf), NUMERIC))
    return rounded(div.select("feature", "psi"), "psi")


@register("js_by_feature", f"{_DIV} SELECT feature, round(js_divergence, 6) AS js_divergence FROM div")
def js_by_feature(spark: SparkSession, sf: str) -> DataFrame:
    div = X.divergence(X.paired_histogram(*_sides(spark, sf), NUMERIC))
    return rounded(div.select("feature", "js_divergence"), "js_divergence")


_SERIES = " + ".join(f"{2 if j % 2 else -2} * exp({-2 * j * j} * x2)" for j in range(1, 41))


@register(
    "ks_by_feature",
    f"""{_BASE}, {_KS}, nb AS (SELECT feature, count(*) AS n FROM base_long GROUP BY 1), ni AS (SELECT feature, count(*) AS m FROM inf_long GROUP BY 1),
    x AS (SELECT feature, ks_statistic, ks_statistic * ks_statistic * n * m / (n + m) AS x2 FROM ks JOIN nb USING (feature) JOIN ni USING (feature))
    SELECT feature, round(ks_statistic, 6) AS ks_statistic,
      round(CASE WHEN x2 < 4e-2 THEN 1 ELSE least(greatest({_SERIES}, 0), 1) END, 6) AS ks_pvalue FROM x""",
)
def ks_by_feature(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(X.ks_two_sample(*_sides(spark, sf), NUMERIC), "ks_statistic", "ks_pvalue")


@register("ks_between_languages")
def ks_between_languages(spark: SparkSession, sf: str) -> DataFrame:
    """Exact p-values where samples are small: mean vector entries of even and odd labels, per language of the row's document."""
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    rows = table(spark, sf, "embeddings").join(docs, F.col("vec_id") == F.col("doc_id"))
    mean = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double")) / F.size("embedding")
    langs = ["de", "en", "es", "fr"]
    wide = rows.select("label", *[F.when(F.col("lang") == code, mean).alias(code) for code in langs])
    out = X.ks_two_sample(wide.where("label % 2 = 0"), wide.where("label % 2 = 1"), langs)
    return rounded(out, "ks_statistic", "ks_pvalue")


@register(
    "ks_uniform_by_feature",
    f"""{_BASE}, b AS (SELECT feature, min(v) AS lo, max(v) AS hi FROM base_long GROUP BY 1),
    s AS (SELECT feature, v, count(*) AS b FROM inf_long GROUP BY 1, 2),
    c AS (SELECT s.feature, sum(b) OVER w / sum(b) OVER g AS at_, (sum(b) OVER w - b) / sum(b) OVER g AS under,
        greatest(0, least(1, (v - lo) / (hi - lo))) AS u
      FROM s JOIN b ON s.feature = b.feature WINDOW w AS (PARTITION BY s.feature ORDER BY v), g AS (PARTITION BY s.feature))
    SELECT feature, round(max(greatest(abs(at_ - u), abs(under - u))), 6) AS ks_statistic FROM c GROUP BY 1""",
)
def ks_uniform_by_feature(spark: SparkSession, sf: str) -> DataFrame:
    base, inf = _sides(spark, sf)
    ks = X.ks_uniform(P.numeric_summary(base, NUMERIC), inf, NUMERIC)
    return rounded(ks.select("feature", "ks_statistic"), "ks_statistic")


_REPORT = f"""{_DIV}, {_KS},
    st AS (SELECT feature, avg(v) AS m, stddev_pop(v) AS sd, count(*) AS n FROM inf_long GROUP BY 1),
    bs AS (SELECT feature, avg(v) AS m, stddev_samp(v) AS sd FROM base_long GROUP BY 1)"""


@register(
    "drift_report",
    f"""{_REPORT}
    SELECT d.feature, n < 10 AS skipped, CAST(NULL AS VARCHAR) AS reason, round(psi, 6) AS psi,
      round(ks_statistic, 6) AS ks_statistic, round(js_divergence, 6) AS js_divergence, round(st.m, 6) AS inference_mean,
      round(st.sd, 6) AS inference_std, round(bs.m, 6) AS baseline_mean, round(bs.sd, 6) AS baseline_std, n AS inference_count,
      CASE WHEN psi > 4e-1 OR ks_statistic > 3e-1 OR js_divergence > 25e-2 THEN 'critical'
        WHEN psi > 2e-1 OR ks_statistic > 15e-2 OR js_divergence > 1e-1 THEN 'warning' ELSE 'none' END AS severity
    FROM div d JOIN ks USING (feature) JOIN st USING (feature) JOIN bs USING (feature)""",
)
def drift_report(spark: SparkSession, sf: str) -> DataFrame:
    out = X.classify(X.drift_by_feature(*_sides(spark, sf), NUMERIC)).drop("ks_pvalue")
    return rounded(
        out, "psi", "ks_statistic", "js_divergence", "inference_mean", "inference_std", "baseline_mean", "baseline_std"
    )


_RUN_CTE = """run AS (SELECT round(max(psi), 6) AS max_psi, count(*) FILTER (psi > 2e-1) AS drifted_feature_count,
      coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (psi > 2e-1), '') AS drifted_features,
      CASE WHEN max(psi) > 4e-1 THEN 'critical' WHEN max(psi) > 2e-1 THEN 'warning' ELSE 'none' END AS severity FROM div)"""
_RUN = f"{_DIV}, {_RUN_CTE}"


@register("drift_rollup", f"{_RUN} SELECT * FROM run")
def drift_rollup(spark: SparkSession, sf: str) -> DataFrame:
    run = X.run_rollup(X.drift_by_feature(*_sides(spark, sf), NUMERIC))
    return rounded(run, "max_psi").withColumn("drifted_features", F.array_join("drifted_features", ","))


@register(
    "drift_alert",
    f"""{_RUN} SELECT severity, max_psi, concat('["', replace(drifted_features, ',', '","'), '"]') AS drifted_features,
      drifted_feature_count AS feature_count FROM run WHERE severity <> 'none'""",
)
def drift_alert(spark: SparkSession, sf: str) -> DataFrame:
    run = X.run_rollup(X.drift_by_feature(*_sides(spark, sf), NUMERIC))
    return rounded(X.alert_record(run, model="classifier").drop("retrain_payload"), "max_psi")


def _shifted(check: str) -> str:
    """The check over inference rows that have moved: one feature by over 0.2, one by over 0.4."""
    return check.replace(text("features_inf"), text("features_shifted"))


def _shifted_drift(spark: SparkSession, sf: str) -> DataFrame:
    return X.drift_by_feature(view(spark, sf, "features_base"), view(spark, sf, "features_shifted"), NUMERIC)


@register("drift_report_shifted", _shifted(check_of("drift_report")))
def drift_report_shifted(spark: SparkSession, sf: str) -> DataFrame:
    out = X.classify(_shifted_drift(spark, sf)).drop("ks_pvalue")
    return rounded(
        out, "psi", "ks_statistic", "js_divergence", "inference_mean", "inference_std", "baseline_mean", "baseline_std"
    )


@register("drift_rollup_shifted", _shifted(check_of("drift_rollup")))
def drift_rollup_shifted(spark: SparkSession, sf: str) -> DataFrame:
    run = X.run_rollup(_shifted_drift(spark, sf))
    return rounded(run, "max_psi").withColumn("drifted_features", F.array_join("drifted_features", ","))


@register("drift_alert_shifted", _shifted(check_of("drift_alert")))
def drift_alert_shifted(spark: SparkSession, sf: str) -> DataFrame:
    run = X.run_rollup(_shifted_drift(spark, sf))
    return rounded(X.alert_record(run, model="classifier").drop("retrain_payload"), "max_psi")


@register(
    "drift_metric_rows",
    f"""{_REPORT}, {_RUN_CTE}
    SELECT feature || '_psi' AS name, round(psi, 6) AS value, feature FROM div
    UNION ALL SELECT feature || '_js_div', round(js_divergence, 6), feature FROM div
    UNION ALL SELECT feature || '_ks_stat', round(ks_statistic, 6), feature FROM ks
    UNION ALL SELECT 'max_psi', max_psi, NULL FROM run
    UNION ALL SELECT 'drifted_feature_count', CAST(drifted_feature_count AS DOUBLE), NULL FROM run
    UNION ALL SELECT 'drift_alert', 1e0, NULL FROM run WHERE severity <> 'none'""",
)
def drift_metric_rows(spark: SparkSession, sf: str) -> DataFrame:
    drift = X.drift_by_feature(*_sides(spark, sf), NUMERIC)
    rows = metric_long_form(drift, X.run_rollup(drift))
    return rows.select("name", F.round("value", 6).alias("value"), F.try_element_at("dims", F.lit("feature")).alias("feature"))


@register(
    "categorical_drift",
    f"""{ctes('features_base', 'features_inf')},
    b AS (SELECT 'flag' AS feature, flag AS value FROM features_base UNION ALL SELECT 'status', status FROM features_base),
    i AS (SELECT 'flag' AS feature, flag AS value FROM features_inf UNION ALL SELECT 'status', status FROM features_inf),
    c AS (SELECT feature, value, coalesce(x.n, 0) AS nb, coalesce(y.n, 0) AS ni
      FROM (SELECT feature, value, count(*) AS n FROM b GROUP BY 1, 2) x
      FULL JOIN (SELECT feature, value, count(*) AS n FROM i GROUP BY 1, 2) y USING (feature, value)),
    pq AS (SELECT feature, greatest(nb / (sum(nb) OVER w + 1e-10), 1e-10) AS p, greatest(ni / (sum(ni) OVER w + 1e-10), 1e-10) AS q
      FROM c WINDOW w AS (PARTITION BY feature))
    SELECT feature, round(sum((q - p) * ln(q / p)), 6) AS psi,
      round(5e-1 * sum(p * ln(p / ((p + q) * 5e-1))) + 5e-1 * sum(q * ln(q / ((p + q) * 5e-1))), 6) AS js_divergence
    FROM pq GROUP BY 1""",
)
def categorical_drift(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(X.categorical_drift(*_sides(spark, sf), CATEGORICAL), "psi", "js_divergence")


@register(
    "holdout_accuracy",
    """SELECT count(*) AS n, round(avg(CASE WHEN toxic = 1 - quality THEN 1e0 ELSE 0e0 END), 6) AS accuracy,
      CASE WHEN count(*) < 50 THEN 'insufficient_data'
        WHEN avg(CASE WHEN toxic = 1 - quality THEN 1e0 ELSE 0e0 END) < 8e-1 THEN 'critical'
        WHEN avg(CASE WHEN toxic = 1 - quality THEN 1e0 ELSE 0e0 END) < 85e-2 THEN 'warning' ELSE 'none' END AS level
    FROM labels""",
)
def holdout_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    scored = table(spark, sf, "labels").select(F.col("toxic").alias("label"), (1 - F.col("quality")).alias("prediction"))
    return rounded(X.accuracy_alert(scored), "accuracy")


@register(
    "inference_capture",
    """SELECT CAST(l_shipdate AS DATE) AS day, l_returnflag AS prediction, count(*) AS n, round(avg(l_discount), 6) AS confidence,
      round(sum(l_quantity), 4) AS quantity FROM lineitem GROUP BY 1, 2""",
)
def inference_capture(spark: SparkSession, sf: str) -> DataFrame:
    """The capture log written in two appends and read back, summed per day and prediction."""
    scored = table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("ts"), F.col("l_quantity").alias("quantity"),
        F.col("l_returnflag").alias("prediction"), F.col("l_discount").alias("confidence"),
    )
    path = scratch_path(spark, "captures")
    # rows of a month meet first, so a month has few files
    for half in (0, 1):
        part = scored.where(F.pmod(F.xxhash64("ts"), F.lit(2)) == half)
        append_captures(part.repartition(F.date_trunc("month", "ts")), path)
    log = spark.read.parquet(path)
    return log.groupBy(F.to_date("ts").alias("day"), "prediction").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("confidence"), 6).alias("confidence"), F.round(F.sum("quantity"), 4).alias("quantity")
    )


@register(
    "weekly_drift",
    f"""{ctes('features_base')}, {_long('features_base', 'base_long')}, {_EDGES}, {_hist('base_long', 'hb')},
    cap AS (SELECT time_bucket(INTERVAL 7 DAYS, l_shipdate, TIMESTAMP '1970-01-01') AS w, l_quantity AS quantity,
        l_extendedprice AS price, l_discount AS discount, l_tax AS tax FROM lineitem),
    cl AS ({' UNION ALL '.join(f"SELECT w, '{f}' AS feature, {f} AS v FROM cap" for f in NUMERIC)}),
    cb AS (SELECT w, feature, bin, count(*) AS n FROM (SELECT w, feature,
        CASE WHEN v = e[11] THEN 10 ELSE len(list_filter(e, lambda x: x <= v)) END AS bin FROM cl JOIN edges USING (feature)) t
      WHERE bin BETWEEN 1 AND 10 GROUP BY 1, 2, 3),
    f AS (SELECT k.w, hb.feature, hb.bin, hb.n AS nb, coalesce(cb.n, 0) AS ni
      FROM (SELECT DISTINCT w, feature FROM cb) k JOIN hb ON k.feature = hb.feature
      LEFT JOIN cb ON cb.w = k.w AND cb.feature = hb.feature AND cb.bin = hb.bin),
    pq AS (SELECT w, feature, greatest(nb / (sum(nb) OVER g + 1e-10), 1e-10) AS p, greatest(ni / (sum(ni) OVER g + 1e-10), 1e-10) AS q
      FROM f WINDOW g AS (PARTITION BY w, feature))
    SELECT w AS window_start, feature, round(sum((q - p) * ln(q / p)), 6) AS psi,
      round(5e-1 * sum(p * ln(p / ((p + q) * 5e-1))) + 5e-1 * sum(q * ln(q / ((p + q) * 5e-1))), 6) AS js_divergence
    FROM pq GROUP BY 1, 2""",
)
def weekly_drift(spark: SparkSession, sf: str) -> DataFrame:
    captured = table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("ts"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
    )
    out = X.window_drift(captured, view(spark, sf, "features_base"), NUMERIC, width="7 days")
    return rounded(out, "psi", "js_divergence").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
