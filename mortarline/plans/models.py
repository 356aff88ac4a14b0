"""Model-file queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mortarline import dims as D
from mortarline.operators import modelfiles as M
from mortarline.plans.adapters import ctes, view
from mortarline.plans.registry import register

_NUM = "'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$'"
_PARSED = f"""{ctes('model_lines')},
    t AS (SELECT model, value, regexp_split_to_array(trim(value), '[ \\t]+') AS t FROM model_lines),
    parsed AS (SELECT model, TRY_CAST(t[2] AS INT) AS color, TRY_CAST(t[3] AS DOUBLE) AS x, TRY_CAST(t[4] AS DOUBLE) AS y,
        TRY_CAST(t[5] AS DOUBLE) AS z, array_to_string(t[6:14], ' ') AS rot, t[15] AS part
      FROM t WHERE trim(value) LIKE '1 %' AND len(t) >= 15 AND regexp_matches(t[3], {_NUM}) AND regexp_matches(t[4], {_NUM})
        AND regexp_matches(t[5], {_NUM}))"""


@register("ldr_parse", f"{_PARSED} SELECT * FROM parsed")
def ldr_parse(spark: SparkSession, sf: str) -> DataFrame:
    return M.parse_placements(view(spark, sf, "model_lines"))


@register(
    "ldr_validate",
    f"""{ctes('model_lines')},
    k AS (SELECT model, value, regexp_matches(value, '^1[ \\t]') AS p, regexp_split_to_array(value, '[ \\t]+') AS t FROM model_lines),
    g AS (SELECT model, count(*) AS line_count, count(*) FILTER (p) AS part_count,
        count(*) FILTER (NOT p AND lower(value) LIKE '0 file%') AS file_count,
        count(*) FILTER (NOT p AND lower(value) LIKE '0 nofile%') AS nofile_count,
        count(*) FILTER (NOT p AND lower(value) LIKE '0 step%') AS step_count,
        count(DISTINCT lower(t[-1])) FILTER (p) AS unique_parts, count(DISTINCT t[2]) FILTER (p) AS unique_colors,
        min(CASE WHEN regexp_matches(t[4], {_NUM}) THEN TRY_CAST(t[4] AS DOUBLE) END) FILTER (p) AS y_min,
        max(CASE WHEN regexp_matches(t[4], {_NUM}) THEN TRY_CAST(t[4] AS DOUBLE) END) FILTER (p) AS y_max,
        count(*) FILTER (p AND NOT (lower(value) LIKE '%.dat' OR lower(value) LIKE '%.ldr')) AS bad_refs FROM k GROUP BY 1)
    SELECT *, CASE WHEN file_count = nofile_count THEN 'PASS' ELSE 'FAIL' END AS submodels,
      CASE WHEN bad_refs = 0 THEN 'PASS' ELSE 'FAIL' END AS references FROM g""".replace("AS references", 'AS "references"'),
)
def ldr_validate(spark: SparkSession, sf: str) -> DataFrame:
    return M.validate(view(spark, sf, "model_lines"))


_STRUCT = """c AS (SELECT *, round_even(x, 1) AS px, round_even(y, 1) AS py, round_even(z, 1) AS pz, round_even(y, 0) AS layer FROM src),
    m AS (SELECT model, count(*) AS parts, count(*) - count(DISTINCT (px, py, pz)) AS collisions,
        (max(y) - min(y)) / sqrt(greatest((max(x) - min(x)) * (max(z) - min(z)), 1)) AS htb FROM c GROUP BY 1),
    l AS (SELECT model, layer, count(*) AS n, lag(layer) OVER (PARTITION BY model ORDER BY layer) AS prev FROM c GROUP BY 1, 2),
    d AS (SELECT model, var_pop(n) AS density FROM l GROUP BY 1),
    o AS (SELECT DISTINCT model, layer, px, pz FROM c),
    u AS (SELECT o.model, count(*) AS unsupported FROM o JOIN l ON o.model = l.model AND o.layer = l.layer
      WHERE prev IS NOT NULL AND NOT EXISTS (SELECT 1 FROM o b WHERE b.model = o.model AND b.layer = l.prev AND b.px = o.px AND b.pz = o.pz)
      GROUP BY 1)"""


@register(
    "structural_features",
    f"""{_PARSED}, src AS (SELECT * FROM parsed), {_STRUCT}, {ctes('model_labels').replace('WITH ', '')},
    files AS (SELECT DISTINCT model FROM model_lines)
    SELECT f.model, round(coalesce(coalesce(unsupported, 0) / parts, 0), 4) AS overhang_ratio, coalesce(collisions, 0) AS collision_count,
      round(coalesce(htb, 0), 4) AS height_to_base_ratio, round(coalesce(density, 0), 4) AS layer_density, coalesce(label, 0) AS label
    FROM files f LEFT JOIN m ON f.model = m.model LEFT JOIN d ON f.model = d.model LEFT JOIN u ON f.model = u.model
    LEFT JOIN model_labels b ON f.model = b.model""",
)
def structural_features(spark: SparkSession, sf: str) -> DataFrame:
    lines = view(spark, sf, "model_lines")
    return M.structural_features(M.parse_placements(lines), view(spark, sf, "model_labels"), lines)


@register(
    "overhang",
    f"""{ctes('placements')}, src AS (SELECT * FROM placements), {_STRUCT}
    SELECT m.model, round(coalesce(unsupported, 0) / parts, 4) AS overhang_ratio FROM m LEFT JOIN u ON m.model = u.model""",
)
def overhang(spark: SparkSession, sf: str) -> DataFrame:
    return M.structural_features(view(spark, sf, "placements")).select("model", "overhang_ratio")


@register(
    "collisions",
    f"""{ctes('placements')}, src AS (SELECT * FROM placements), {_STRUCT}
    SELECT model, collisions AS collision_count FROM m""",
)
def collisions(spark: SparkSession, sf: str) -> DataFrame:
    return M.structural_features(view(spark, sf, "placements")).select("model", "collision_count")


def _in(parts: list[str]) -> str:
    return "(" + ", ".join(f"'{p}'" for p in parts) + ")"


@register(
    "part_stats",
    f"""{_PARSED}, s AS (SELECT model, count(*) AS total_parts,
      {', '.join(f"count(*) FILTER (replace(part, '.dat', '') IN {_in(v)}) AS {k}_count" for k, v in D.STAT_CATEGORIES.items())},
      round((max(y) - min(y)) / 24, 1) AS height_studs, round((max(x) - min(x)) / 20, 1) AS width_studs,
      round((max(z) - min(z)) / 20, 1) AS depth_studs FROM parsed GROUP BY 1)
    SELECT *, round(CASE WHEN brick_count + window_count + door_count > 0
      THEN window_count / (brick_count + window_count + door_count) ELSE 0 END, 4) AS window_to_wall_ratio FROM s""",
)
def part_stats(spark: SparkSession, sf: str) -> DataFrame:
    return M.part_stats(M.parse_placements(view(spark, sf, "model_lines")))


@register(
    "duplicate_placements",
    f"""{ctes('placements')} SELECT model, x, y, z, rot, part, count(*) AS copies FROM placements
    GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_placements(spark: SparkSession, sf: str) -> DataFrame:
    return M.duplicates(view(spark, sf, "placements"))


@register(
    "bbox_overlaps",
    f"""{ctes('placements')}, sz(part, w, l, h) AS (VALUES {', '.join(f"('{p}', {w}, {l}, {h})" for p, (w, l, h) in D.PART_SIZES.items())}),
    s AS (SELECT model, x, y, z, h, CASE WHEN rot IN ('{D.ROTATIONS['R90']}', '{D.ROTATIONS['R270']}') THEN w ELSE l END / 2 AS dx,
        CASE WHEN rot IN ('{D.ROTATIONS['R90']}', '{D.ROTATIONS['R270']}') THEN l ELSE w END / 2 AS dz
      FROM placements p JOIN sz ON p.part = sz.part),
    b AS (SELECT model, x - dx AS x0, x + dx AS x1, y AS y0, y + h AS y1, z - dz AS z0, z + dz AS z1, count(*) AS copies FROM s GROUP BY ALL)
    SELECT coalesce(o.model, n.model) AS model, coalesce(box_pairs, 0) AS box_pairs, coalesce(placement_pairs, 0) AS placement_pairs,
      coalesce(unsized, 0) AS unsized
    FROM (SELECT a.model, count(*) AS box_pairs, CAST(sum(a.copies * c.copies) AS BIGINT) AS placement_pairs
    FROM b a JOIN b c ON a.model = c.model AND (a.x0, a.y0, a.z0, a.x1, a.y1, a.z1) < (c.x0, c.y0, c.z0, c.x1, c.y1, c.z1)
      AND a.x0 < c.x1 AND c.x0 < a.x1 AND a.y0 < c.y1 AND c.y0 < a.y1 AND a.z0 < c.z1 AND c.z0 < a.z1 GROUP BY 1) o
    FULL JOIN (SELECT model, count(*) AS unsized FROM placements WHERE part NOT IN (SELECT part FROM sz) GROUP BY 1) n ON o.model = n.model""",
)
def bbox_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    return M.overlap_counts(view(spark, sf, "placements"))


_ALL_GLASS = sorted({g for gs in D.GLASS_PAIRS.values() for g in gs})


@register(
    "glass_pairing",
    f"""{ctes('placements')}, p(frame, glass) AS (VALUES {', '.join(f"('{f}', '{g}')" for f, gs in D.GLASS_PAIRS.items() for g in gs)}),
    f AS (SELECT model, x, y, z, part AS frame, count(*) AS frames FROM placements WHERE part IN {_in(list(D.GLASS_PAIRS))} GROUP BY ALL)
    SELECT f.*, CASE WHEN EXISTS (SELECT 1 FROM placements q JOIN p ON q.part = p.glass
          WHERE p.frame = f.frame AND q.model = f.model AND q.x = f.x AND q.y = f.y AND q.z = f.z) THEN 'ok'
        WHEN EXISTS (SELECT 1 FROM placements q WHERE q.part IN {_in(_ALL_GLASS)} AND q.model = f.model AND q.x = f.x AND q.y = f.y AND q.z = f.z)
        THEN 'wrong_glass' ELSE 'missing_glass' END AS verdict FROM f""",
)
def glass_pairing(spark: SparkSession, sf: str) -> DataFrame:
    return M.glass_pairing(view(spark, sf, "placements"))


@register(
    "color_share",
    f"""{ctes('placements')}, c AS (SELECT model, color, count(*) AS n FROM placements GROUP BY 1, 2),
    r AS (SELECT *, n / sum(n) OVER (PARTITION BY model) AS share, row_number() OVER (PARTITION BY model ORDER BY n DESC, color) AS rank,
      count(*) OVER (PARTITION BY model) AS n_colors FROM c),
    bands(rank, role, lo, hi) AS (VALUES (1, 'primary', 6e-1, 7e-1), (2, 'secondary', 15e-2, 2e-1), (3, 'trim', 5e-2, 1e-1), (4, 'accent', 2e-2, 5e-2))
    SELECT model, color, n, round(share, 6) AS share, r.rank, n_colors, role, share BETWEEN lo AND hi AS in_band, n_colors <= 7 AS palette_ok
    FROM r LEFT JOIN bands b ON r.rank = b.rank""",
)
def color_share(spark: SparkSession, sf: str) -> DataFrame:
    return M.color_share(view(spark, sf, "placements")).withColumn("share", F.round("share", 6))


@register(
    "bill_of_materials",
    f"{ctes('placements')} SELECT model, part, color, count(*) AS n FROM placements GROUP BY ALL",
)
def bill_of_materials(spark: SparkSession, sf: str) -> DataFrame:
    return M.bill_of_materials(view(spark, sf, "placements"))


@register(
    "placement_lines",
    f"""{ctes('placements')} SELECT model, concat('1 ', CAST(color AS VARCHAR), ' ', CAST(CAST(x AS BIGINT) AS VARCHAR), ' ',
      CAST(CAST(y AS BIGINT) AS VARCHAR), ' ', CAST(CAST(z AS BIGINT) AS VARCHAR), ' ', rot, ' ', part) AS value FROM placements""",
)
def placement_lines(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "placements").select("model", M.placement_line().alias("value"))


@register(
    "framed_models",
    f"""{ctes('placements')}, p AS (SELECT *, concat('c', CAST(color AS VARCHAR)) AS sub, CAST(model AS VARCHAR) AS m,
        concat_ws(' ', '1', CAST(color AS VARCHAR), CAST(CAST(x AS BIGINT) AS VARCHAR), CAST(CAST(y AS BIGINT) AS VARCHAR),
          CAST(CAST(z AS BIGINT) AS VARCHAR), rot, part) AS value FROM placements),
    t AS (SELECT DISTINCT model, m FROM p), s AS (SELECT DISTINCT model, sub FROM p),
    h(i, a, b) AS (VALUES (0, '0 FILE ', '.ldr'), (1, '0 ', ''), (2, '0 Name: ', '.ldr'), (3, '0 Author: unknown', NULL)),
    l AS (
      SELECT model, 0 AS sec, '' AS sub, 0 AS part_no, NULL AS y, NULL AS x, NULL AS z, NULL AS part, i AS line_no,
        CASE WHEN b IS NULL THEN a ELSE concat(a, m, b) END AS value FROM t CROSS JOIN h
      UNION ALL SELECT model, 0, '', 0, NULL, NULL, NULL, NULL, 4, '0 !LDRAW_ORG Model' FROM t
      UNION ALL SELECT model, 0, '', 0, NULL, NULL, NULL, NULL, 5, '' FROM t
      UNION ALL SELECT model, 1, sub, 0, NULL, NULL, NULL, NULL, 0, concat('1 16 0 0 0 {D.ROTATIONS["R0"]} ', sub, '.ldr') FROM s
      UNION ALL SELECT model, 1, '~', 1, NULL, NULL, NULL, NULL, 0, '0 NOFILE' FROM t
      UNION ALL SELECT model, 2, sub, 0, NULL, NULL, NULL, NULL, 0, '' FROM s
      UNION ALL SELECT model, 2, sub, 0, NULL, NULL, NULL, NULL, i + 1, CASE WHEN b IS NULL THEN a ELSE concat(a, sub, b) END FROM s CROSS JOIN h
      UNION ALL SELECT model, 2, sub, 0, NULL, NULL, NULL, NULL, 5, '' FROM s
      UNION ALL SELECT model, 2, sub, 1, y, x, z, part, 0, '0 // window' FROM p WHERE part = '60594.dat'
      UNION ALL SELECT model, 2, sub, 1, y, x, z, part, 1, value FROM p
      UNION ALL SELECT model, 2, sub, 2, NULL, NULL, NULL, NULL, 0, '0 STEP' FROM s
      UNION ALL SELECT model, 2, sub, 2, NULL, NULL, NULL, NULL, 1, '0 NOFILE' FROM s)
    SELECT model, row_number() OVER (PARTITION BY model ORDER BY sec, sub, part_no, y, x, z, part, line_no, value) AS n, value FROM l""",
)
def framed_models(spark: SparkSession, sf: str) -> DataFrame:
    placed = view(spark, sf, "placements").withColumn("submodel", F.concat(F.lit("c"), F.col("color")))
    placed = placed.withColumn("comment", F.when(F.col("part") == "60594.dat", "window"))
    lines = M.framed_lines(placed, ["y", "x", "z", "part"])
    order = Window.partitionBy("model").orderBy(*[c for c in M.line_order(lines)])
    return lines.select("model", F.row_number().over(order).cast("long").alias("n"), "value")
