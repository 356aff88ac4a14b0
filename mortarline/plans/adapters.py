"""Shape the given tables into the inputs the operators expect.

Each adapter is one SELECT in the subset of SQL that Spark and DuckDB share, over
whole tables.  ``view`` runs it on Spark, ``text`` splices it into a check query.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

NOW = "2024-01-31 00:00:00"

_EVENTS = "(SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM {events})"

ADAPTERS: dict[str, str] = {
    "requests": f"""
        SELECT event_id, ts,
          CASE event_type WHEN 'view' THEN 'generate_spec' WHEN 'click' THEN 'Generate_Spec_v2'
            WHEN 'purchase' THEN 'rag_pipeline' WHEN 'signup' THEN 'health_probe'
            ELSE 'generate_spec_batch' END AS name,
          value * 7.31e0 AS duration,
          event_type <> 'error' AS success,
          CASE WHEN k % 7 = 0 THEN NULL WHEN k % 7 = 1 THEN ''
            ELSE concat('v', CAST(k % 3 + 1 AS STRING)) END AS prompt_version,
          concat('deploy-', CAST(user_id % 4 AS STRING)) AS deployment
        FROM {_EVENTS} e""",
    "exceptions": f"""
        SELECT event_id, ts,
          CASE k % 4 WHEN 1 THEN 'TimeoutError' WHEN 2 THEN 'ValueError' WHEN 3 THEN 'RateLimitError' END AS type,
          CASE WHEN k % 7 = 0 THEN NULL ELSE concat('v', CAST(k % 3 + 1 AS STRING)) END AS prompt_version
        FROM {_EVENTS} e WHERE event_type = 'error'""",
    "quality_metrics": f"""
        SELECT event_id, ts,
          CASE event_type WHEN 'signup' THEN 'groundedness' WHEN 'view' THEN 'relevance'
            WHEN 'click' THEN 'coherence' WHEN 'error' THEN 'fluency' ELSE 'buildability' END AS name,
          CAST(event_id % 101 AS DOUBLE) / 100 AS value,
          CASE WHEN k % 7 = 0 THEN NULL ELSE concat('v', CAST(k % 3 + 1 AS STRING)) END AS prompt_version
        FROM {_EVENTS} e""",
    "token_metrics": f"""
        SELECT event_id, ts,
          CASE event_type WHEN 'view' THEN 'input_tokens' WHEN 'click' THEN 'output_tokens'
            WHEN 'purchase' THEN 'estimated_cost_usd' ELSE 'queue_depth' END AS name,
          CASE WHEN event_type = 'purchase' THEN value / 733 ELSE CAST(k * 13 + 5 AS DOUBLE) END AS value,
          CASE WHEN k % 7 = 0 THEN NULL ELSE concat('v', CAST(k % 3 + 1 AS STRING)) END AS prompt_version,
          concat('m', CAST(user_id % 2 AS STRING)) AS model_version
        FROM {_EVENTS} e""",
    "failure_metrics": f"""
        SELECT event_id, ts,
          CASE event_type WHEN 'signup' THEN 'drift_alert' WHEN 'error' THEN 'evaluation_failure'
            WHEN 'view' THEN 'evaluation_failure' ELSE 'heartbeat' END AS name,
          CASE WHEN k % 6 = 0 THEN NULL WHEN k % 6 = 1 THEN ''
            ELSE concat('category_', CAST(k % 13 AS STRING)) END AS failure_category,
          CASE WHEN k % 4 = 0 THEN '' ELSE concat('reason_', CAST(k % 9 AS STRING)) END AS failure_reason,
          CASE WHEN k % 7 = 0 THEN NULL ELSE concat('v', CAST(user_id % 3 + 1 AS STRING)) END AS prompt_version
        FROM {_EVENTS} e""",
    "traces": f"""
        SELECT event_id, ts AS start_time,
          CASE WHEN k % 10 = 0 THEN 0 WHEN k % 10 = 1 THEN NULL ELSE value * 10 END AS duration_ms,
          value * 12 AS duration,
          CASE k % 8 WHEN 0 THEN '' WHEN 1 THEN '404' WHEN 2 THEN 'Failed' WHEN 3 THEN NULL
            WHEN 4 THEN '503' ELSE 'ok' END AS status,
          CASE WHEN k % 16 = 0 THEN '500' ELSE '200' END AS result_code,
          CASE WHEN k % 9 = 0 THEN NULL ELSE CAST(k * 7 + 20 AS STRING) END AS prompt_tokens,
          CASE WHEN k % 5 = 0 THEN NULL ELSE CAST(k * 3 + 11 AS STRING) END AS completion_tokens,
          CASE WHEN k % 5 = 0 THEN NULL ELSE CAST(k * 60 + 31 AS STRING) END AS total_tokens,
          CASE WHEN k % 3 = 0 THEN concat('upstream said ', CAST(k % 12 AS STRING)) ELSE '' END AS prop_error_message,
          CASE WHEN k % 4 = 1 THEN concat('code ', CAST(k % 5 AS STRING)) END AS prop_error,
          CASE WHEN k % 2 = 0 THEN concat('trace fault ', repeat('x', 250), CAST(k % 3 AS STRING)) END AS error_message
        FROM {_EVENTS} e""",
    "smoke": f"""
        SELECT event_id, concat('endpoint-', CAST(user_id % 5 AS STRING)) AS endpoint,
          value / 200 AS seconds,
          CASE WHEN event_type = 'error' THEN NULL
            WHEN k % 50 = 0 THEN '{{{{"score": 1}}}}'
            WHEN k % 3 = 0 THEN '"{{{{\\"prediction\\": 2}}}}"'
            ELSE '{{{{"prediction": 1}}}}' END AS response
        FROM {_EVENTS} e""",
    "features_base": """
        SELECT l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax,
          l_returnflag AS flag, l_linestatus AS status
        FROM {lineitem} WHERE l_shipdate < CAST('1998-07-01' AS TIMESTAMP)""",
    "features_inf": """
        SELECT CASE WHEN l_returnflag = 'R' THEN l_quantity + 9 ELSE l_quantity END AS quantity,
          l_extendedprice * 1.05e0 AS price, l_discount AS discount,
          CASE WHEN l_linestatus = 'F' THEN l_tax END AS tax,
          CASE WHEN l_discount > 0.07e0 THEN 'X' ELSE l_returnflag END AS flag, l_linestatus AS status
        FROM {lineitem} WHERE l_shipdate >= CAST('1998-07-01' AS TIMESTAMP)""",
    "features_shifted": """
        SELECT CASE WHEN l_quantity <= 25 AND l_partkey % 2 = 0 THEN l_quantity + 25 ELSE l_quantity END AS quantity,
          l_extendedprice AS price, CASE WHEN l_discount < 0.05e0 AND l_partkey % 4 <> 1 THEN 0.1e0 ELSE l_discount END AS discount,
          l_tax AS tax, l_returnflag AS flag, l_linestatus AS status
        FROM {lineitem} WHERE l_shipdate >= CAST('1998-07-01' AS TIMESTAMP)""",
    "responses": """
        SELECT d.doc_id, d.source AS prompt_version, d.lang,
          concat(d.text, CASE d.doc_id % 6
            WHEN 0 THEN '\n## Dimensions\nWidth: 32 studs wide\n## Palette\nprimary color: tan\n- 3004.dat brick wall\n- 3811 baseplate'
            WHEN 1 THEN '\n2-story house with a window and a door, floating roof'
            WHEN 2 THEN '\n**Roof** slope and tile\n- color code 15\n- no foundation'
            WHEN 3 THEN '\nheight = 12\nunsupported overhang'
            WHEN 4 THEN '\nWalls: 98283 masonry\nRoof: 3040B slopes\n- 16 x 32 baseplate'
            ELSE '' END) AS response,
          l.quality, l.toxic,
          CAST(d.n_chars % 5 + 1 AS DOUBLE) AS groundedness_score,
          CAST(d.n_chars % 4 + 2 AS DOUBLE) AS relevance_score,
          CASE WHEN d.n_chars % 11 = 0 THEN NULL ELSE CAST(d.n_chars % 3 + 3 AS DOUBLE) END AS coherence_score,
          CAST(5 - d.n_chars % 2 AS DOUBLE) AS fluency_score,
          d.n_chars % 900 + 100 AS input_tokens, d.n_chars % 300 + 20 AS output_tokens,
          CAST(d.n_chars % 4000 AS DOUBLE) + 0.5e0 AS latency_ms,
          CAST(d.n_chars % 90 AS DOUBLE) + 0.25e0 AS retrieval_ms
        FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id""",
    "eval_log": """
        SELECT d.doc_id,
          concat('{{"id": "case-', CAST(d.doc_id AS STRING), '"',
            CASE WHEN d.n_chars % 10 = 0 THEN '' ELSE concat(', "prompt_version": "', d.source, '"') END,
            CASE d.n_chars % 4 WHEN 0 THEN ', "timestamp": "2024-01-10T00:00:00+00:00"'
              WHEN 1 THEN ', "timestamp": "2023-01-10T00:00:00+00:00"'
              WHEN 2 THEN ', "timestamp": "not a time"' ELSE '' END,
            CASE WHEN l.toxic = 1 THEN ', "passed": false' WHEN l.toxic = 0 THEN ', "passed": true' ELSE '' END,
            CASE d.n_chars % 13 WHEN 0 THEN ', "success": false' WHEN 1 THEN ', "failure_reason": null'
              WHEN 2 THEN ', "errors": []' WHEN 3 THEN ', "errors": ["TIMEOUT after 30s", "weird"]'
              WHEN 4 THEN ', "failure_reasons": ["floating roof and missing_color", "off_topic answer"]'
              WHEN 5 THEN ', "failure_reason": "bad_part 9999"'
              WHEN 6 THEN ', "groundedness": 0.4, "groundedness_threshold": 0.7'
              WHEN 7 THEN ', "fluency": 0.85, "fluency_threshold": 0.85'
              WHEN 8 THEN ', "coherence": 0.3, "coherence_threshold": 0.8, "buildability": 0.2, "buildability_threshold": 0.7'
              ELSE ', "relevance": 0.9' END,
            '}}') AS entry
        FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id""",
    "placements": """
        SELECT l_orderkey AS model, l_suppkey % 16 AS color, l_quantity * 20 AS x,
          CAST(l_linenumber * 24 AS DOUBLE) AS y, CAST(l_suppkey % 8 * 20 AS DOUBLE) AS z,
          CASE WHEN l_partkey % 2 = 0 THEN '1 0 0 0 1 0 0 0 1' ELSE '0 0 -1 0 1 0 1 0 0' END AS rot,
          CASE l_partkey % 12 WHEN 0 THEN '3005.dat' WHEN 1 THEN '3004.dat' WHEN 2 THEN '3010.dat'
            WHEN 3 THEN '3023.dat' WHEN 4 THEN '3710.dat' WHEN 5 THEN '3037.dat' WHEN 6 THEN '60594.dat'
            WHEN 7 THEN '60603.dat' WHEN 8 THEN '60596.dat' WHEN 9 THEN '57895.dat' WHEN 10 THEN '3665.dat'
            ELSE '98283.dat' END AS part
        FROM {lineitem}""",
    "model_lines": """
        SELECT l_orderkey AS model,
          CASE WHEN l_linenumber = 7 THEN '0 STEP'
            WHEN l_suppkey % 17 = 0 THEN concat('0 FILE sub', CAST(l_linenumber AS STRING), '.ldr')
            WHEN l_suppkey % 17 = 1 THEN '0 NOFILE'
            WHEN l_suppkey % 17 = 2 THEN concat('1 4 ', CAST(l_linenumber AS STRING), ' 0 0 1 0 0 0 1 0 0 0 1')
            WHEN l_suppkey % 17 = 3 THEN '1 16 0 0 0 1 0 0 0 1 0 0 0 1 sub.LDR'
            WHEN l_suppkey % 17 = 4 THEN '1 16 nan 0 0 1 0 0 0 1 0 0 0 1 3001.dat'
            WHEN l_suppkey % 17 = 5 THEN '1 16 bad 0 0 1 0 0 0 1 0 0 0 1 3001'
            ELSE concat('1 ', CAST(l_suppkey % 16 AS STRING), ' ', CAST(CAST(l_quantity AS INT) * 20 AS STRING), '.5 ',
              CAST(l_linenumber * 24 AS STRING), '  ', CAST(l_suppkey % 8 * 20 AS STRING), ' 1 0 0 0 1 0 0 0 1 ',
              CASE l_partkey % 5 WHEN 0 THEN '3001.dat' WHEN 1 THEN '3023.dat' WHEN 2 THEN '3037.dat'
                WHEN 3 THEN '60594.dat' ELSE '57895.dat' END) END AS value
        FROM {lineitem}""",
    "model_labels": "SELECT o_orderkey AS model, CAST(o_orderkey % 2 AS INT) AS label FROM {orders} WHERE o_orderstatus = 'F'",
    "spans": """
        SELECT p_partkey AS span_id, p_size % 16 AS color, CAST(0 AS DOUBLE) AS span_start,
          CAST(p_size * 20 AS DOUBLE) + CASE WHEN p_brand = 'Brand#3' THEN 7 ELSE 0 END AS span_end,
          CAST(140 - p_size AS DOUBLE) AS y, CAST(10 AS DOUBLE) AS cross_pos,
          CASE WHEN p_type = 'ECONOMY' THEN 'Z' ELSE 'X' END AS axis,
          CASE WHEN p_type = 'STANDARD' THEN 'plate' WHEN p_type = 'PROMO' THEN 'tile' ELSE 'brick' END AS kind,
          CASE WHEN p_partkey % 2 = 0 THEN 20 ELSE 0 END AS stagger
        FROM {part}""",
    "walls": """
        SELECT p_partkey AS wall_id, p_size % 16 AS color, CAST(0 AS DOUBLE) AS span_start,
          CAST(p_size * 20 AS DOUBLE) AS span_end, CAST(140 AS DOUBLE) AS ground_y,
          CAST(CASE WHEN p_partkey % 17 = 0 THEN 0 ELSE p_partkey % 6 + 4 END AS INT) AS n_rows, CAST(10 AS DOUBLE) AS cross_pos,
          CASE WHEN p_partkey % 2 = 0 THEN 'X' ELSE 'Z' END AS axis,
          CASE p_partkey % 4 WHEN 0 THEN 'Front' WHEN 1 THEN 'Back' WHEN 2 THEN 'Left' ELSE 'Right' END AS wall,
          CASE p_partkey % 3 WHEN 0 THEN 'Georgian' WHEN 1 THEN 'Victorian' ELSE 'Baroque' END AS style
        FROM {part}""",
    "openings": """
        SELECT p_partkey AS wall_id, CAST(p_size * 4 AS DOUBLE) AS o_start, CAST(p_size * 4 + 80 AS DOUBLE) AS o_end,
          CAST(p_partkey % 3 + 1 AS INT) AS from_row, CAST(CASE WHEN p_partkey % 13 = 0 THEN 0 ELSE p_partkey % 3 + 4 END AS INT) AS to_row
        FROM {part}
        UNION ALL
        SELECT p_partkey AS wall_id, CAST(p_size * 12 AS DOUBLE) AS o_start, CAST(p_size * 12 + 60 AS DOUBLE) AS o_end,
          2 AS from_row, 3 AS to_row
        FROM {part}""",
    "grid_scores": """
        SELECT o_orderkey AS candidate, round(o_totalprice / 1000, 1) AS cost,
          round(CAST(o_custkey % 997 AS DOUBLE) / 997 * 0.5e0 + o_totalprice / 1000000, 3) AS quality
        FROM {orders}""",
    "traffic": """
        SELECT concat('endpoint-', CAST(s_nationkey AS STRING)) AS endpoint, s_suppkey AS position, s_name AS deployment,
          CAST(floor(abs(s_acctbal)) AS INT) % 101 AS percent
        FROM {supplier}""",
    "asset_versions": """
        SELECT concat('model-', CAST(o_custkey AS STRING)) AS name, o_orderkey AS version, o_orderdate AS created_at,
          o_orderstatus = 'P' AS in_use
        FROM {orders}""",
}


def _tables(body: str) -> list[str]:
    return sorted(set(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", body)))


def text(name: str) -> str:
    """Adapter as plain SQL over the bare table names."""
    body = ADAPTERS[name]
    return body.format(**{t: t for t in _tables(body)})


def ctes(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` prefix for a check query."""
    return "WITH " + ", ".join(f"{n} AS ({text(n)})" for n in names)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Adapter as a Spark DataFrame."""
    body = ADAPTERS[name]
    sources = {t: table(spark, sf_dir, t) for t in _tables(body)}
    # Spark reads a backslash in a literal as an escape, standard SQL does not
    return spark.sql(body.replace("\\", "\\\\"), **sources)
