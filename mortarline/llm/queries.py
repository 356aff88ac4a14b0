"""The registered queries of the package and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline.llm.text import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if check:
            CHECKS[name] = check
        return fn

    return keep


@query(
    "op1_mixing",
    r"""
    WITH d AS (
      SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
        md5(concat_ws(':', '0', coalesce(CAST(doc_id AS VARCHAR), 'null'))) AS k
      FROM documents),
    s AS (
      SELECT source, CAST(sum(size) AS DOUBLE) AS n, 2 * sum(size) AS cap,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0e0 WHEN 1 THEN 2.0e0 ELSE 1.0e0 END AS w
      FROM d GROUP BY source),
    o AS (
      SELECT *, cap / w AS ratio,
        coalesce(sum(cap) OVER (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_words,
        sum(w) OVER (ORDER BY cap / w DESC, source DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS open_w,
        sum(n) OVER () * 1.5e0 AS total
      FROM s),
    l AS (
      SELECT (SELECT (total - full_words) / open_w FROM o WHERE (total - full_words) / open_w <= ratio
        ORDER BY ratio, source LIMIT 1) AS level),
    t AS (
      SELECT source AS src, n, least(coalesce(level, 1e300) * w, CAST(cap AS DOUBLE)) AS target
      FROM o CROSS JOIN l),
    r AS (SELECT *, CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END AS whole FROM t),
    m AS (
      SELECT d.*, r.*, target - whole * n AS missing,
        sum(size) OVER (PARTITION BY source ORDER BY k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
          - sum(size) OVER (PARTITION BY source, k) / 2.0e0 AS middle
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.src)
    SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(n AS BIGINT) AS source_size, target,
      CAST((whole + CASE WHEN missing > 0 AND middle <= missing THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
    FROM m""",
)
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mortarline.llm.mixing import cycled_weights, mix

    docs = read(spark, sf_dir, "documents", "doc_id", "text", "source")
    mixed = mix(docs, cycled_weights(docs, (5, 2, 1)), share=1.5, epochs=2)
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mortarline.llm.quality import quality_rules

    rows = quality_rules(read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))
    return rows.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "distance2",
    )


@query("op2_pieces")
def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from mortarline.llm.pieces import encode_texts

    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    rows = encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"), decode=True)
    return rows.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _span_text(spans):
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


@query("op8_secrets")
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mortarline.llm.secrets import KINDS, scan_secrets

    rows = scan_secrets(read(spark, sf_dir, "documents", "doc_id", "text"))
    rank = F.array(*[F.lit(k) for k in KINDS])
    both = F.array_sort(
        F.transform(
            F.concat("base", "added"),
            lambda s: F.struct(s["start"].alias("start"), F.array_position(rank, s["kind"]).alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")),
        )
    )
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return rows.select(
        F.col("id").alias("doc_id"),
        count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_span_text(F.col("base")), 256).alias("base_sha256"),
        _span_text(both).alias("spans"),
    )


@query(
    "op10_lines",
    r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
    k AS (
      SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM l),
    o AS (
      SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 40
      GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
    j AS (SELECT k.*, coalesce(o.owner <> k.doc_id, false) AS gone FROM k LEFT JOIN o ON k.key = o.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM j GROUP BY doc_id""",
)
def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mortarline.llm.lines import dedup_lines

    rows = dedup_lines(read(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query(
    "op5_warc",
    """
    WITH p AS (
      SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
    q AS (
      SELECT page_id, octet_length(b) AS n, b,
        CASE WHEN octet_length(b) >= 1000 THEN max(page_id) OVER (PARTITION BY b) ELSE page_id END AS target
      FROM p)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(b) AS payload_digest,
      CASE WHEN target = page_id THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN target <> page_id THEN target END AS refers_to
    FROM q""",
)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mortarline.llm.warc import new_folder, page_records, plan_revisits, read_warc, write_warc

    records = page_records(read(spark, sf_dir, "pages", "page_id", "url", "html"))
    folder = new_folder(spark)
    write_warc(records, plan_revisits(records), folder, shards=int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = read_warc(spark, folder, payloads=False)
    return rows.select(
        F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


@query("op6_neardup")
def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mortarline.llm.neardup import near_duplicates

    rows = near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.select(F.col("id").alias("doc_id"), "class_id")


@query(
    "op7_topk",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    p AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
)
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mortarline.llm.topk import top_k

    rows = read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(256) * x.cast("double")))
    rows = rows.where(F.col("embedding").isNotNull() & finite).select("vec_id", whole.alias("vector"))
    return top_k(rows, F.col("vec_id") % 50 == 0, k=5).withColumnRenamed("id", "vec_id")


@query("op9_lm")
def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mortarline.llm.lm import score_documents

    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    rows = score_documents(docs.withColumn("train", ~held))
    return rows.select(
        F.col("id").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query("op4_suffixes")
def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mortarline.llm.suffixes import remove_repeats

    rows = remove_repeats(read(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def _digests(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op11_bytebpe")
def op11_bytebpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from mortarline.llm.bytebpe import encode_bpe

    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return _digests(encode_bpe(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), decode=True))


@query("op13_align")
def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from mortarline.llm.align import align_corpus

    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    rows = align_corpus(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.withColumnRenamed("id", "doc_id")


@query(
    "op12_negatives",
    """
    WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    p AS (
      SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
    o AS (
      SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
        row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
      FROM p WHERE same),
    n AS (
      SELECT o.anchor_id, o.positive_id, o.positive_score, p.vec_id AS negative_id, p.score AS negative_score,
        row_number() OVER (PARTITION BY o.anchor_id, o.positive_id ORDER BY p.score DESC, p.vec_id) AS rank
      FROM o JOIN p ON o.anchor_id = p.anchor_id AND NOT p.same
        AND 50 * o.positive_score <= 100 * p.score AND 100 * p.score <= 95 * o.positive_score
      WHERE o.place <= 5)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
    FROM n WHERE rank <= 3""",
)
def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mortarline.llm.negatives import mine_negatives

    rows = read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(256) * x.cast("double")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.where(F.col("embedding").isNotNull() & finite).select("vec_id", label.alias("label"), whole.alias("vector"))
    return mine_negatives(rows, F.col("vec_id") % 50 == 0, positives=5, negatives=3, low=50, high=95)
