"""Machine-learning queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline.operators import ml as M
from mortarline.operators import modelfiles as X
from mortarline.operators.density import density_clusters as density_clusters_of
from mortarline.plans.adapters import ctes, table, view
from mortarline.plans.registry import register
from mortarline.session import cut_lineage
from mortarline.sources.payloads import decode_payloads

STRUCTURE = ["overhang_ratio", "collision_count", "height_to_base_ratio", "layer_density"]
STATS = [
    "total_parts", "brick_count", "plate_count", "slope_count", "window_count", "door_count",
    "height_studs", "width_studs", "depth_studs", "window_to_wall_ratio",
]

_GUESS = """CASE WHEN regexp_matches(text, ' (der|und|die) ') THEN 'de' WHEN regexp_matches(text, ' (le|les|et) ') THEN 'fr'
      WHEN regexp_matches(text, ' (que|los|el) ') THEN 'es' ELSE 'en' END"""


def _guessed(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    guess = (
        F.when(text.rlike(" (der|und|die) "), "de")
        .when(text.rlike(" (le|les|et) "), "fr")
        .when(text.rlike(" (que|los|el) "), "es")
        .otherwise("en")
    )
    return table(spark, sf, "documents").select("doc_id", "lang", guess.alias("guess"))


_REPORT = f"""WITH g AS (SELECT lang, {_GUESS} AS guess FROM documents),
    k AS (SELECT lang AS class FROM g UNION SELECT guess FROM g),
    c AS (SELECT class, (SELECT count(*) FROM g WHERE lang = class AND guess = class) AS tp,
        (SELECT count(*) FROM g WHERE guess = class) AS p, (SELECT count(*) FROM g WHERE lang = class) AS support FROM k),
    m AS (SELECT class, support, tp, CASE WHEN p > 0 THEN tp / p ELSE 0 END AS precision, CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall FROM c),
    f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM m),
    r AS (SELECT class, precision, recall, f1, support FROM f
      UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM f
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM f
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
        sum(f1 * support) / sum(support), sum(support) FROM f)"""


@register(
    "confusion_report",
    f"""{_REPORT} SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM r""",
)
def confusion_report(spark: SparkSession, sf: str) -> DataFrame:
    out = M.classification_report(_guessed(spark, sf), "lang", "guess")
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@register(
    "model_gate",
    f"""{_REPORT} SELECT round(f1, 6) AS accuracy, 85e-2 AS threshold, f1 >= 85e-2 AS passed FROM r WHERE class = 'accuracy'""",
)
def model_gate(spark: SparkSession, sf: str) -> DataFrame:
    out = M.model_gate(M.classification_report(_guessed(spark, sf), "lang", "guess"))
    return out.withColumn("accuracy", F.round("accuracy", 6))


@register(
    "stratified_split",
    """WITH
    r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY CAST('0x' || substring(md5(concat(k, '-42')), 1, 13) AS BIGINT)) AS i,
      count(*) OVER (PARTITION BY l_returnflag) AS n FROM (SELECT l_returnflag, concat(CAST(l_orderkey AS VARCHAR), '/', CAST(l_linenumber AS VARCHAR), '/', CAST(l_partkey AS VARCHAR), '/', CAST(l_suppkey AS VARCHAR)) AS k FROM lineitem) q)
    SELECT l_returnflag AS label, i <= n * 20 // 100 AS is_test, count(*) AS n FROM r GROUP BY 1, 2""",
)
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    key = F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    rows = table(spark, sf, "lineitem").select(key.alias("k"), F.col("l_returnflag").alias("label"))
    return M.stratified_split(rows, "k", "label").groupBy("label", "is_test").agg(F.count(F.lit(1)).alias("n"))


@register(
    "split_rows",
    """WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY CAST('0x' || substring(md5(concat(CAST(doc_id AS VARCHAR), '-42')), 1, 13) AS BIGINT)) AS i,
      count(*) OVER (PARTITION BY lang) AS n FROM documents)
    SELECT doc_id, lang, i <= n * 20 // 100 AS is_test FROM r""",
)
def split_rows(spark: SparkSession, sf: str) -> DataFrame:
    return M.stratified_split(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", "lang")


@register(
    "standardize",
    """SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / (SELECT stddev_pop(c_acctbal) FROM customer), 6) AS c_acctbal,
      round((c_nationkey - (SELECT avg(c_nationkey) FROM customer)) / (SELECT stddev_pop(c_nationkey) FROM customer), 6) AS c_nationkey, 0e0 AS same
    FROM customer""",
)
def standardize(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["c_acctbal", "c_nationkey", "same"]
    rows = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey", F.lit(3.0).alias("same"))
    out = M.standardize(rows, cols)
    return out.select("c_custkey", *[F.round(c, 6).alias(c) for c in cols])


@register(
    "silhouette",
    """WITH r AS (SELECT label AS c, CAST(embedding AS DOUBLE[]) AS v, list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) AS sq FROM embeddings),
    e AS (SELECT c, generate_subscripts(v, 1) AS pos, unnest(v) AS x FROM r),
    s AS (SELECT c, list(x ORDER BY pos) AS s FROM (SELECT c, pos, sum(x) AS x FROM e GROUP BY 1, 2) q GROUP BY 1),
    k AS (SELECT r.c, count(*) AS n, sum(sq) AS psi, any_value(s) AS s FROM r JOIN s ON r.c = s.c GROUP BY 1),
    i AS (SELECT row_number() OVER () AS id, * FROM r),
    d AS (SELECT id, i.c, k.c AS kc, n, n * sq + psi - 2 * list_inner_product(v, s) AS t FROM i, k),
    ab AS (SELECT id, max(CASE WHEN c = kc THEN t / (n - 1) END) AS a, min(CASE WHEN c <> kc THEN t / n END) AS b FROM d GROUP BY 1)
    SELECT count(*) AS rows, (SELECT count(*) FROM k) AS clusters, round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM ab""",
)
def silhouette(spark: SparkSession, sf: str) -> DataFrame:
    return M.silhouette(table(spark, sf, "embeddings"), "embedding", "label").withColumn("silhouette", F.round("silhouette", 6))


@register(
    "cluster_sizes",
    """SELECT label AS cluster, count(*) AS n, count(*) OVER () AS n_clusters FROM embeddings GROUP BY 1""",
)
def cluster_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return M.cluster_sizes(table(spark, sf, "embeddings"), "label")


_PAYLOAD = """SELECT event_id, CASE event_type WHEN 'view' THEN concat('{"image_base64": "', to_base64(encode(props)), '"}')
      WHEN 'click' THEN concat('{"features": [', CAST(user_id AS VARCHAR), '.5, 2]}') WHEN 'error' THEN 'not json' ELSE '{"other": 1}' END AS payload,
      event_type, length(props) AS n, user_id FROM events"""


@register(
    "score_payloads",
    f"""WITH p AS ({_PAYLOAD})
    SELECT event_id, CASE event_type WHEN 'view' THEN 'image' WHEN 'click' THEN 'features' ELSE 'error' END AS kind,
      CASE WHEN event_type = 'view' THEN n END AS image_bytes, CASE WHEN event_type = 'click' THEN user_id + 25e-1 END AS feature_sum,
      CASE WHEN event_type NOT IN ('view', 'click') THEN 'Provide ''image_base64'' or ''features''' END AS error FROM p""",
)
def score_payloads(spark: SparkSession, sf: str) -> DataFrame:
    payload = (
        F.when(
            F.col("event_type") == "view",
            F.concat(F.lit('{"image_base64": "'), F.base64(F.col("props").cast("binary")), F.lit('"}')),
        )
        .when(F.col("event_type") == "click", F.concat(F.lit('{"features": ['), F.col("user_id"), F.lit(".5, 2]}")))
        .when(F.col("event_type") == "error", F.lit("not json"))
        .otherwise(F.lit('{"other": 1}'))
    )
    out = decode_payloads(table(spark, sf, "events").withColumn("payload", payload))
    total = F.when(F.col("features").isNotNull(), F.aggregate("features", F.lit(0.0), lambda a, x: a + x))
    return out.select("event_id", "kind", F.length("image").alias("image_bytes"), total.alias("feature_sum"), "error")


def _structure(spark: SparkSession, sf: str) -> DataFrame:
    # several passes follow, so the feature table is written to shared storage once
    return cut_lineage(X.structural_features(view(spark, sf, "placements"), view(spark, sf, "model_labels")))


@register("kmeans_clusters")
def kmeans_clusters(spark: SparkSession, sf: str) -> DataFrame:
    stats = X.part_stats(X.parse_placements(view(spark, sf, "model_lines")))
    return M.cluster_sizes(M.kmeans(stats, STATS))


@register("random_forest_scores")
def random_forest_scores(spark: SparkSession, sf: str) -> DataFrame:
    split = cut_lineage(M.plain_split(_structure(spark, sf), "model"))
    scored = M.forest_scores(split.where("not is_test"), split.where("is_test"), STRUCTURE)
    return M.classification_report(scored.withColumn("prediction", F.col("prediction").cast("int")), "label", "prediction")


@register("isolation_flags")
def isolation_flags(spark: SparkSession, sf: str) -> DataFrame:
    flagged = M.isolation_flags(_structure(spark, sf), "model", STRUCTURE)
    named = M.label_predictions(flagged, {-1: "fail", 1: "pass"})
    return named.groupBy("result").agg(F.count(F.lit(1)).alias("n"))


_FOLD = 16


def _customer_points(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", (F.col("c_acctbal") / 500).alias("a"), F.col("c_nationkey").cast("double").alias("b"))


def _density(spark: SparkSession, sf: str) -> DataFrame:
    return density_clusters_of(_customer_points(spark, sf), "c_custkey", ["a", "b"], 1.0, min_points=4, min_cluster_size=5, rungs=5, resolution=1 / _FOLD)


@register(
    "density_clusters",
    f"""WITH RECURSIVE f AS (SELECT c_custkey, floor(c_acctbal / 500e0 * {_FOLD}) / {_FOLD} AS a, CAST(c_nationkey AS DOUBLE) AS b FROM customer),
    p AS (SELECT a, b, min(c_custkey) AS id, count(*) AS w FROM f GROUP BY 1, 2),
    n AS (SELECT x.id, y.id AS other, y.w, sqrt((x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b)) AS d FROM p x JOIN p y
      ON abs(x.a - y.a) <= 1 AND abs(x.b - y.b) <= 1),
    i AS (SELECT * FROM n WHERE d <= 1),
    k AS (SELECT id FROM i GROUP BY id HAVING sum(w) >= 4),
    e AS (SELECT id AS u, other AS v FROM i WHERE id IN (SELECT id FROM k) AND other IN (SELECT id FROM k)),
    r AS (SELECT id, id AS label FROM k UNION SELECT e.v, r.label FROM r JOIN e ON r.id = e.u),
    l AS (SELECT id, min(label) AS label FROM r GROUP BY 1),
    s AS (SELECT label FROM l JOIN p ON l.id = p.id GROUP BY 1 HAVING sum(w) >= 5)
    SELECT c_custkey, coalesce(s.label, -1) AS cluster FROM f JOIN p ON f.a = p.a AND f.b = p.b
    LEFT JOIN l ON p.id = l.id LEFT JOIN s ON l.label = s.label""",
)
def density_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return _density(spark, sf).select("c_custkey", F.col("component").alias("cluster"))


@register("density_hierarchy")
def density_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    return _density(spark, sf).select("c_custkey", "component", "cluster")
