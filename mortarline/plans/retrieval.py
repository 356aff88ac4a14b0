"""Chunking, search and training-example queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline.operators import retrieval as R
from mortarline.operators import vectorindex as V
from mortarline.plans.adapters import table, view
from mortarline.plans.quality import _CASES, _cases
from mortarline.plans.registry import check_of, register
from mortarline.session import scratch_path
from mortarline.sources.buckets import read_buckets, upsert_buckets

SYSTEM = "Write the building specification as JSON."


def _chunk_sql(size: int, overlap: int) -> str:
    return f"""WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \\t\\n\\r\\f\\v]+'), lambda w: w <> '') AS t FROM documents),
    s AS (SELECT doc_id, t, unnest(range(0, greatest(0, len(t) - {overlap} - 1) + 1, {size - overlap})) AS s FROM t WHERE len(t) > 0)
    SELECT doc_id, s // {size - overlap} AS chunk_no, len(t[s + 1 : s + {size}]) AS n_tokens,
      md5(array_to_string(t[s + 1 : s + {size}], ' ')) AS digest FROM s"""


def _chunks(spark: SparkSession, sf: str, size: int, overlap: int) -> DataFrame:
    out = R.chunk(table(spark, sf, "documents"), "doc_id", size, overlap)
    return out.select("doc_id", "chunk_no", "n_tokens", F.md5(F.col("chunk").cast("binary")).alias("digest"))


@register("chunk_documents", _chunk_sql(1024, 128))
def chunk_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _chunks(spark, sf, 1024, 128)


@register("chunk_documents_small", _chunk_sql(300, 50))
def chunk_documents_small(spark: SparkSession, sf: str) -> DataFrame:
    return _chunks(spark, sf, 300, 50)


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))


def _item_vectors(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"))
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return items.join(vectors, "query_id")


def _centroids(spark: SparkSession, sf: str) -> DataFrame:
    """Mean vector per label, averaged per dimension."""
    dims = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("pos", "v"))
    means = dims.groupBy("label", "pos").agg(F.avg(F.col("v").cast("double")).alias("v"))
    return means.groupBy(F.col("label").cast("long").alias("query_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"]).alias("vector")
    )


_COS = "list_cosine_similarity(CAST({} AS DOUBLE[]), CAST({} AS DOUBLE[]))"


@register(
    "vector_topk",
    f"""WITH d AS (SELECT label, generate_subscripts(embedding, 1) AS pos, unnest(embedding) AS v FROM embeddings),
    m AS (SELECT label, pos, avg(CAST(v AS DOUBLE)) AS v FROM d GROUP BY 1, 2),
    q AS (SELECT CAST(label AS BIGINT) AS query_id, list(v ORDER BY pos) AS vector FROM m GROUP BY 1),
    s AS (SELECT query_id, vec_id AS doc_id, round({_COS.format('embedding', 'vector')}, 6) AS score FROM embeddings, q)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s) r WHERE rank <= 10""",
)
def vector_topk(spark: SparkSession, sf: str) -> DataFrame:
    return R.vector_topk(_vectors(spark, sf), _centroids(spark, sf), 10)


def _index(spark: SparkSession, sf: str) -> str:
    """Folder of an index over all vectors, in the shared folder; the searches read its tables."""
    path = scratch_path(spark, "vectors")
    V.build_index(_vectors(spark, sf), path)
    return path


@register("vector_topk_index", check_of("vector_topk"))
def vector_topk_index(spark: SparkSession, sf: str) -> DataFrame:
    return V.search_index(spark, _index(spark, sf), _centroids(spark, sf), 10)


@register("vector_recall")
def vector_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Recall at 10 of a search that probes three lists in four, per vector of a benchmark item, against the exact search."""
    path, asked = _index(spark, sf), _item_vectors(spark, sf)
    lists = spark.read.parquet(f"{path}/lists").count()
    return V.recall(V.search_index(spark, path, asked, 10, probes=-(-3 * lists // 4)), V.search_index(spark, path, asked, 10))


_WORDS = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"


def _bm25_sql(depth: int) -> str:
    return f"""d AS (SELECT doc_id, {_WORDS} AS t FROM documents),
    st AS (SELECT count(*) AS n, avg(len(t)) AS al FROM d),
    tf AS (SELECT doc_id, len(t) AS len, unnest(t) AS term FROM d),
    tc AS (SELECT doc_id, len, term, count(*) AS tf FROM tf GROUP BY 1, 2, 3),
    q AS (SELECT item_id AS query_id, unnest(list_distinct({_WORDS})) AS term FROM benchmark),
    idf AS (SELECT term, ln(1 + (n - count(*) + 5e-1) / (count(*) + 5e-1)) AS idf FROM tc, st WHERE term IN (SELECT term FROM q) GROUP BY term, n),
    ks AS (SELECT query_id, doc_id, round(sum(idf * tf * 22e-1 / (tf + 12e-1 * (25e-2 + 75e-2 * len / al))), 6) AS score
      FROM tc JOIN idf USING (term) JOIN q USING (term), st GROUP BY 1, 2),
    kw AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM ks) r WHERE rank <= {depth})"""


def _keyword(spark: SparkSession, sf: str, k: int) -> DataFrame:
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return R.keyword_topk(table(spark, sf, "documents"), items, k)


@register("keyword_topk", f"WITH {_bm25_sql(3)} SELECT query_id, doc_id, score, rank FROM kw")
def keyword_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _keyword(spark, sf, 3)


@register(
    "hybrid_topk",
    f"""WITH {_bm25_sql(50)},
    vs AS (SELECT item_id AS query_id, e.vec_id AS doc_id, round({_COS.format('e.embedding', 'i.embedding')}, 6) AS score
      FROM benchmark JOIN embeddings i ON item_id = i.vec_id, embeddings e),
    vr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM vs) r WHERE rank <= 50),
    f AS (SELECT query_id, doc_id, round(sum(1e0 / (60 + rank)), 9) AS score
      FROM (SELECT query_id, doc_id, rank FROM kw UNION ALL SELECT query_id, doc_id, rank FROM vr) u GROUP BY 1, 2)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM f) r WHERE rank <= 10""",
)
def hybrid_topk(spark: SparkSession, sf: str) -> DataFrame:
    vector = R.vector_topk(_vectors(spark, sf), _item_vectors(spark, sf), 50)
    return R.hybrid_topk([_keyword(spark, sf, 50), vector], 10)


@register(
    "context_assembly",
    f"""WITH {_bm25_sql(3)}, b AS (SELECT query_id, rank, concat('Title: ', CAST(kw.doc_id AS VARCHAR), '\nStyle: ', lang, '\nContent: ', text) AS t
      FROM kw JOIN documents d ON d.doc_id = kw.doc_id WHERE score >= 20),
    c AS (SELECT query_id, string_agg(t, '\n---\n' ORDER BY rank) AS context FROM b GROUP BY 1)
    SELECT item_id AS query_id, md5(coalesce(context, 'No relevant specs found.')) AS digest FROM benchmark LEFT JOIN c ON item_id = query_id""",
)
def context_assembly(spark: SparkSession, sf: str) -> DataFrame:
    passages = table(spark, sf, "documents").select(
        "doc_id", F.col("doc_id").cast("string").alias("title"), F.col("lang").alias("style"), F.col("text").alias("content")
    )
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"))
    out = R.assemble_context(_keyword(spark, sf, 3), passages, items, floor=20.0)
    return out.select("query_id", F.md5(F.col("context").cast("binary")).alias("digest"))


def _line(user: str, assistant: str) -> str:
    def msg(role: str, content: str) -> str:
        return f"""'{{"role":"{role}","content":', CAST(to_json({content}) AS VARCHAR), '}}'"""

    parts = ["'{\"messages\":['", msg("system", f"'{SYSTEM}'"), "','", msg("user", user), "','", msg("assistant", assistant), "']}'"]
    return f"concat({', '.join(parts)})"


@register(
    "finetune_messages",
    f"""SELECT u.conv_id, u.turn, {_line('u.text', 'a.text')} AS line FROM conversations u
    JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'""",
)
def finetune_messages(spark: SparkSession, sf: str) -> DataFrame:
    return R.turn_examples(table(spark, sf, "conversations"), SYSTEM)


@register(
    "finetune_specs",
    f"""WITH s AS (SELECT p_partkey, concat('A ', p_name) AS prompt, concat('{{"height":', CAST(p_size AS VARCHAR), ',"style":"', p_type,
      '","colors":{{"primary":"', p_brand, '"}},"features":["', p_name, '"]}}') AS spec FROM part)
    SELECT p_partkey, {_line('prompt', 'spec')} AS line FROM s""",
)
def finetune_specs(spark: SparkSession, sf: str) -> DataFrame:
    specs = table(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.lit("A "), "p_name").alias("prompt"),
        F.struct(
            F.col("p_size").alias("height"),
            F.col("p_type").alias("style"),
            F.struct(F.col("p_brand").alias("primary")).alias("colors"),
            F.array("p_name").alias("features"),
        ).alias("spec"),
    )
    return R.spec_examples(specs, SYSTEM)


@register(
    "finetune_filtered",
    f"""{_CASES} SELECT c.doc_id, {_line('c.lang', 'd.text')} AS line FROM cases c JOIN documents d ON c.doc_id = d.doc_id
    WHERE c.quality = 1 AND c.toxic = 0 AND c.buildability >= 4e-1""",
)
def finetune_filtered(spark: SparkSession, sf: str) -> DataFrame:
    good = _cases(spark, sf).where((F.col("quality") == 1) & (F.col("toxic") == 0) & (F.col("buildability") >= 0.4))
    rows = good.select("doc_id", "lang").join(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return rows.select("doc_id", R.message_json(F.lit(SYSTEM), F.col("lang"), F.col("text")).alias("line"))


@register(
    "index_upsert",
    """SELECT coalesce(page_id, doc_id) AS id, CASE WHEN page_id IS NULL THEN source ELSE url END AS title,
      md5(CASE WHEN page_id IS NULL THEN text ELSE html END) AS digest, CASE WHEN page_id IS NULL THEN 1 ELSE 2 END AS version
    FROM documents FULL JOIN pages ON page_id = doc_id""",
)
def index_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return R.upsert(*_versions(spark, sf), "id", "version")


@register("index_upsert_buckets", check_of("index_upsert"))
def index_upsert_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """The same merge into a bucketed table, of which only the buckets with changed keys are written anew."""
    current, changes = _versions(spark, sf)
    path = scratch_path(spark, "buckets")
    upsert_buckets(current, path, "id", "version")
    upsert_buckets(changes, path, "id", "version")
    return read_buckets(spark, path, current)


def _versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    current = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("title"), F.md5(F.col("text").cast("binary")).alias("digest"), F.lit(1).alias("version")
    )
    changes = table(spark, sf, "pages").select(
        F.col("page_id").alias("id"), F.col("url").alias("title"), F.md5(F.col("html").cast("binary")).alias("digest"), F.lit(2).alias("version")
    )
    return current, changes
