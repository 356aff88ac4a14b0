"""Layout queries. The check SQL runs the greedy fill as a recursive loop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline import dims as D
from mortarline.operators import layout as L
from mortarline.plans.adapters import ctes, view
from mortarline.plans.registry import register

_R = {k: f"'{v}'" for k, v in D.ROTATIONS.items()}
_KINDS = ", ".join(f"('{k}', {w}, '{p}')" for k, parts in D.FILL_PARTS.items() for w, p in parts.items())


def _widest(rest: str) -> str:
    whens = " ".join(f"WHEN ({rest}) + 1e-1 >= {w} THEN {w}" for w in (160, 120, 80, 60, 40, 20))
    return f"CASE WHEN ({rest}) < 199e-1 THEN NULL {whens} END"


def _fill(head: str, src: str, keys: str) -> str:
    """Greedy fill of ``src`` spans as SQL; ``head`` defines ``src``."""
    cols = f"{keys}, color, y, cross_pos, axis, kind"
    return f"""{head.replace('WITH ', 'WITH RECURSIVE ', 1)}, sizes(kind, w, part) AS (VALUES {_KINDS}),
    loop AS (SELECT {cols}, span_end, span_start + stagger AS pos, {_widest('span_end - span_start - stagger')} AS w FROM {src}
      UNION ALL SELECT {cols}, span_end, pos + w, {_widest('span_end - pos - w')} FROM loop WHERE w IS NOT NULL),
    pieces AS (SELECT {cols}, w, pos + w / 2 AS c FROM loop WHERE w IS NOT NULL
      UNION ALL SELECT {cols}, CASE WHEN stagger >= 120 THEN 120 WHEN stagger >= 80 THEN 80 WHEN stagger >= 60 THEN 60
          WHEN stagger >= 40 THEN 40 ELSE 20 END AS w, span_start + (CASE WHEN stagger >= 120 THEN 120 WHEN stagger >= 80 THEN 80
          WHEN stagger >= 60 THEN 60 WHEN stagger >= 40 THEN 40 ELSE 20 END) / 2 AS c FROM {src} WHERE stagger >= 20 AND stagger < 160),
    filled AS (SELECT {keys}, color, CASE WHEN axis = 'X' THEN round_even(c, 1) ELSE cross_pos END AS x, y,
        CASE WHEN axis = 'X' THEN cross_pos ELSE round_even(c, 1) END AS z, part,
        CASE WHEN axis = 'X' THEN {_R['R0']} ELSE {_R['R90']} END AS rot
      FROM pieces p JOIN sizes s ON p.kind = s.kind AND p.w = s.w)"""


@register("span_fill", f"{_fill(ctes('spans'), 'spans', 'span_id')} SELECT * FROM filled")
def span_fill(spark: SparkSession, sf: str) -> DataFrame:
    return L.fill_spans(view(spark, sf, "spans"), ["span_id"])


_SEGMENTS = f"""{ctes('walls', 'openings')},
    wr AS (SELECT *, unnest(range(1, n_rows + 1)) AS row FROM walls),
    og AS (SELECT wall_id, unnest(range(from_row, to_row + 1)) AS row, o_start, o_end FROM openings),
    gp AS (SELECT wr.wall_id, wr.row, o_start, o_end, lag(o_end) OVER w AS prev, lead(o_end) OVER w IS NULL AS is_last
      FROM wr JOIN og ON wr.wall_id = og.wall_id AND wr.row = og.row WINDOW w AS (PARTITION BY wr.wall_id, wr.row ORDER BY o_start, o_end)),
    sg AS (SELECT wall_id, row, span_start AS a, span_end AS b FROM wr WHERE NOT EXISTS (SELECT 1 FROM gp WHERE gp.wall_id = wr.wall_id AND gp.row = wr.row)
      UNION ALL SELECT gp.wall_id, gp.row, coalesce(prev, span_start), o_start FROM gp JOIN wr ON gp.wall_id = wr.wall_id AND gp.row = wr.row
        WHERE o_start > coalesce(prev, span_start) + 1e-1
      UNION ALL SELECT gp.wall_id, gp.row, o_end, span_end FROM gp JOIN wr ON gp.wall_id = wr.wall_id AND gp.row = wr.row
        WHERE is_last AND o_end < span_end - 1e-1),
    segs AS (SELECT sg.wall_id, CAST(sg.row AS INT) AS row, color, a AS span_start, b AS span_end, ground_y - sg.row * 24 AS y, cross_pos, axis,
        'brick' AS kind, sg.row % 2 * 20 AS stagger FROM sg JOIN walls w ON sg.wall_id = w.wall_id)"""


@register("wall_rows", f"{_SEGMENTS} SELECT wall_id, row, span_start, span_end, y, stagger FROM segs")
def wall_rows(spark: SparkSession, sf: str) -> DataFrame:
    out = L.wall_segments(view(spark, sf, "walls"), view(spark, sf, "openings"))
    return out.select("wall_id", "row", "span_start", "span_end", "y", "stagger")


@register("walls_built", f"{_fill(_SEGMENTS, 'segs', 'wall_id, row')} SELECT * FROM filled")
def walls_built(spark: SparkSession, sf: str) -> DataFrame:
    return L.build_walls(view(spark, sf, "walls"), view(spark, sf, "openings"))


_BAYS = f"""{ctes('walls')}, b AS (SELECT *, span_end / 2 AS bx, CAST(68 AS DOUBLE) AS by_, cross_pos AS bz, n_rows % 2 = 0 AS recessed,
      style = 'Georgian' AS trim, wall IN ('Front', 'Back') AS on_x,
      CASE wall WHEN 'Front' THEN 1 WHEN 'Left' THEN 1 ELSE -1 END * 10 AS shift,
      CASE wall WHEN 'Front' THEN {_R['R0']} WHEN 'Back' THEN {_R['R180']} WHEN 'Left' THEN {_R['R270']} ELSE {_R['R90']} END AS wrot FROM walls),
    f AS (SELECT *, CASE WHEN recessed AND NOT on_x THEN bx + shift ELSE bx END AS fx,
      CASE WHEN recessed AND on_x THEN bz + shift ELSE bz END AS fz, CASE WHEN on_x THEN {_R['R0']} ELSE {_R['R90']} END AS trot FROM b)"""


def _bays(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "walls").select(
        "wall_id",
        "wall",
        F.lit(15).alias("frame_color"),
        F.lit(71).alias("door_color"),
        F.col("color").alias("wall_color"),
        (F.col("span_end") / 2).alias("x"),
        F.lit(68.0).alias("y"),
        F.col("cross_pos").alias("z"),
        (F.col("n_rows") % 2 == 0).alias("recessed"),
        (F.col("style") == "Georgian").alias("sill"),
        (F.col("style") == "Georgian").alias("header"),
    )


@register(
    "window_bays",
    f"""{_BAYS} SELECT wall_id, 15 AS color, fx AS x, by_ AS y, fz AS z, '60594.dat' AS part, wrot AS rot FROM f
    UNION ALL SELECT wall_id, 47, fx, by_, fz, '60603.dat', wrot FROM f
    UNION ALL SELECT wall_id, color, bx, by_ + 72, bz, '3710.dat', trot FROM f WHERE trim
    UNION ALL SELECT wall_id, color, bx, by_ - 8, bz, '3710.dat', trot FROM f WHERE trim""",
)
def window_bays(spark: SparkSession, sf: str) -> DataFrame:
    return L.window_bays(_bays(spark, sf), ["wall_id"])


@register(
    "door_surrounds",
    f"""{_BAYS} SELECT wall_id, 15 AS color, fx AS x, by_ AS y, fz AS z, '60596.dat' AS part, wrot AS rot FROM f
    UNION ALL SELECT wall_id, 71, fx, by_, fz, '57895.dat', wrot FROM f
    UNION ALL SELECT wall_id, color, bx, by_ - 8, bz, '3710.dat', trot FROM f WHERE trim""",
)
def door_surrounds(spark: SparkSession, sf: str) -> DataFrame:
    return L.door_surrounds(_bays(spark, sf), ["wall_id"])


_BANDS = f"""{ctes('walls')}, st AS (SELECT *, CASE style WHEN 'Georgian' THEN 'Dentil' WHEN 'Victorian' THEN 'Corbel' ELSE 'Plain' END AS band,
      wall IN ('Front', 'Back') AS on_x, cross_pos - CASE wall WHEN 'Front' THEN 10 WHEN 'Left' THEN 10 ELSE -10 END AS out_,
      CASE wall WHEN 'Front' THEN {_R['R0']} WHEN 'Back' THEN {_R['R180']} WHEN 'Left' THEN {_R['R270']} ELSE {_R['R90']} END AS wrot FROM walls),
    teeth AS (SELECT *, unnest(list_filter(range(0, 100), lambda i: span_start + 10 + i * 40 < span_end - 1e-1)) * 40 + span_start + 10 AS pos FROM st)"""


def _bands(spark: SparkSession, sf: str) -> DataFrame:
    style = F.when(F.col("style") == "Georgian", "Dentil").when(F.col("style") == "Victorian", "Corbel").otherwise("Plain")
    return view(spark, sf, "walls").select(
        "wall_id", "color", "span_start", "span_end", F.lit(44.0).alias("y"), F.col("cross_pos").alias("wall_pos"),
        "wall", style.alias("style"),
    )


_PLAIN = f"""{_BANDS}, plain AS (SELECT wall_id, color, span_start, span_end, CAST(44 AS DOUBLE) AS y, out_ AS cross_pos,
      CASE WHEN on_x THEN 'X' ELSE 'Z' END AS axis, 'plate' AS kind, 0 AS stagger FROM st WHERE band = 'Plain')"""


def _tooth(y: str, where: str) -> str:
    return f"""SELECT wall_id, color, CASE WHEN on_x THEN pos ELSE out_ END AS x, {y} AS y, CASE WHEN on_x THEN out_ ELSE pos END AS z,
      CASE WHEN band = 'Dentil' THEN '3023.dat' ELSE '3665.dat' END AS part,
      CASE WHEN band = 'Dentil' THEN CASE WHEN on_x THEN {_R['R90']} ELSE {_R['R0']} END ELSE wrot END AS rot FROM teeth WHERE {where}"""


@register(
    "cornice",
    f"{_fill(_PLAIN, 'plain', 'wall_id')} SELECT * FROM filled UNION ALL {_tooth('44e0', chr(39).join(['band <> ', 'Plain', '']))}",
)
def cornice(spark: SparkSession, sf: str) -> DataFrame:
    return L.cornices(_bands(spark, sf), ["wall_id"])


_FLOOR = f"""{_BANDS}, plain AS (SELECT wall_id, color, span_start, span_end, CAST(44 AS DOUBLE) AS y, cross_pos,
      CASE WHEN on_x THEN 'X' ELSE 'Z' END AS axis, 'plate' AS kind, 0 AS stagger FROM st)"""


@register(
    "floor_band",
    f"{_fill(_FLOOR, 'plain', 'wall_id')} SELECT * FROM filled UNION ALL {_tooth('52e0', chr(39).join(['band = ', 'Dentil', '']))}",
)
def floor_band(spark: SparkSession, sf: str) -> DataFrame:
    return L.floor_bands(_bands(spark, sf), ["wall_id"])


def _floors(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "walls").select(
        "wall_id", "color", F.col("span_start").alias("x_min"), F.col("span_end").alias("x_max"), F.lit(0.0).alias("z_min"),
        (F.col("n_rows") * 20.0).alias("z_max"), F.lit(-100.0).alias("y"), F.when(F.col("wall_id") % 11 == 0, 0).otherwise(2).alias("layers"),
        F.greatest(F.col("n_rows") - 4, F.lit(0)).alias("n_rows"), ((F.col("n_rows") > 5) | (F.col("n_rows") < 5)).alias("cap"),
        F.when(F.col("axis") == "X", "FBLR").otherwise("FL").alias("sides"),
    )


def _plates_sql(zs: str, shift: int) -> str:
    return f"""{ctes('walls')}, rows_ AS (SELECT wall_id, color, span_start, span_end, -100e0 - layer * 8 AS y, CAST(z * 20 + {shift} AS DOUBLE) AS cross_pos,
      'X' AS axis, 'plate' AS kind, 0 AS stagger
      FROM (SELECT *, unnest(range(0, {zs})) AS z FROM walls) w, (VALUES (0), (1)) l(layer) WHERE wall_id % 11 <> 0)"""


@register("floor_plates", f"{_fill(_plates_sql('n_rows + 1', 0), 'rows_', 'wall_id')} SELECT * FROM filled")
def floor_plates(spark: SparkSession, sf: str) -> DataFrame:
    return L.floor_plates(_floors(spark, sf), ["wall_id"])


@register("floor_fill", f"{_fill(_plates_sql('n_rows', 10), 'rows_', 'wall_id')} SELECT * FROM filled")
def floor_fill(spark: SparkSession, sf: str) -> DataFrame:
    return L.floor_plates(_floors(spark, sf), ["wall_id"], inset=10.0)


_PARAPET = f"""{ctes('walls')}, s(sides, letter, axis) AS (VALUES ('FBLR', 'F', 'X'), ('FBLR', 'B', 'X'), ('FBLR', 'L', 'Z'), ('FBLR', 'R', 'Z'), ('FL', 'F', 'X'), ('FL', 'L', 'Z')),
    courses AS (SELECT *, unnest(range(0, n_rows - 4)) AS r, 'brick' AS kind FROM walls UNION ALL SELECT *, greatest(n_rows - 4, 0) AS r, 'tile' FROM walls WHERE n_rows > 5 OR n_rows < 5),
    rows_ AS (SELECT wall_id, color, CAST(0 AS DOUBLE) AS span_start, CASE WHEN s.axis = 'X' THEN span_end ELSE n_rows * 20e0 END AS span_end,
      CASE WHEN kind = 'tile' THEN -100e0 - r * 24 + 16 ELSE -100e0 - r * 24 END AS y,
      CASE letter WHEN 'B' THEN n_rows * 20e0 WHEN 'R' THEN span_end ELSE 0e0 END AS cross_pos, s.axis, kind, 0 AS stagger
      FROM courses c JOIN s ON s.sides = CASE WHEN c.axis = 'X' THEN 'FBLR' ELSE 'FL' END)"""


@register("parapets", f"{_fill(_PARAPET, 'rows_', 'wall_id')} SELECT * FROM filled")
def parapets(spark: SparkSession, sf: str) -> DataFrame:
    return L.parapets(_floors(spark, sf), ["wall_id"])


_ACROSS = f"CASE WHEN axis = 'X' THEN {_R['R270']} ELSE {_R['R90']} END"
_XZ = "CASE WHEN axis = 'X' THEN pos ELSE cross_pos END AS x, y, CASE WHEN axis = 'X' THEN cross_pos ELSE pos END AS z"


@register(
    "masonry_rows",
    f"""{_SEGMENTS}, m AS (SELECT *, span_start + 20 + 40 * unnest(list_filter(range(0, 100), lambda i: span_start + 40 * (i + 1) <= span_end + 1e-1)) AS pos FROM segs)
    SELECT wall_id, row, color, {_XZ}, '98283.dat' AS part, {_ACROSS} AS rot FROM m""",
)
def masonry_rows(spark: SparkSession, sf: str) -> DataFrame:
    segments = L.wall_segments(view(spark, sf, "walls"), view(spark, sf, "openings"))
    return L.masonry_rows(segments, ["wall_id", "row"])


@register(
    "dentil_tiles",
    f"""{ctes('spans')}, m AS (SELECT *, span_start + 20 + 40 * unnest(list_filter(range(0, 100), lambda i: span_start + 40 * i <= span_end)) AS pos FROM spans)
    SELECT span_id, color, {_XZ}, '3794b.dat' AS part, {_ACROSS} AS rot FROM m""",
)
def dentil_tiles(spark: SparkSession, sf: str) -> DataFrame:
    return L.dentil_tiles(view(spark, sf, "spans"), ["span_id"])


@register(
    "finials",
    f"""{ctes('spans')}, m AS (SELECT *, span_start + 60 * unnest(list_filter(range(0, 100), lambda i: span_start + 60 * i <= span_end)) AS pos FROM spans)
    SELECT span_id, color, {_XZ}, '4070.dat' AS part, CASE WHEN axis = 'X' THEN {_R['R0']} ELSE {_R['R90']} END AS rot FROM m""",
)
def finials(spark: SparkSession, sf: str) -> DataFrame:
    return L.finials(view(spark, sf, "spans"), ["span_id"])


@register(
    "flower_boxes",
    f"""{ctes('spans')}, pal AS (SELECT [14, 4, 2, 9] AS p)
    SELECT span_id, 70 AS color, span_end AS x, y, cross_pos AS z, '3710.dat' AS part, CASE WHEN axis = 'X' THEN {_R['R0']} ELSE {_R['R90']} END AS rot FROM spans
    UNION ALL SELECT span_id, p[CAST((span_id + i) % 4 + 1 AS INT)], CASE WHEN axis = 'X' THEN span_end + (i - 1) * 20 ELSE span_end END, y - 8,
      CASE WHEN axis = 'X' THEN cross_pos ELSE cross_pos + (i - 1) * 20 END, '4073.dat', {_R['R0']}
    FROM spans, pal, (VALUES (0), (1), (2)) t(i)""",
)
def flower_boxes(spark: SparkSession, sf: str) -> DataFrame:
    boxes = view(spark, sf, "spans").select(
        "span_id", F.col("span_id").alias("box_no"), F.col("span_end").alias("x"), "y", F.col("cross_pos").alias("z"), "axis"
    )
    return L.flower_boxes(boxes, ["span_id"], [14, 4, 2, 9])


@register(
    "slope_ridges",
    f"""{ctes('spans')} SELECT span_id, color, span_end AS x, y, cross_pos AS z, '3040b.dat' AS part, {_R['R0']} AS rot FROM spans
    UNION ALL SELECT span_id, color, span_end, y, cross_pos + 20, '3040b.dat', {_R['R180']} FROM spans""",
)
def slope_ridges(spark: SparkSession, sf: str) -> DataFrame:
    ridges = view(spark, sf, "spans").select(
        "span_id", "color", F.col("span_end").alias("x"), "y", F.col("cross_pos").alias("z")
    )
    return L.slope_ridges(ridges, ["span_id"])


@register(
    "style_presets",
    f"""{ctes('walls')}, s(style_name, rows_per_floor, window_recess, cornice_style, parapet_rows, floor_band_style) AS (VALUES
      ('Georgian', 10, true, 'Dentil', 2, 'Plain'), ('Victorian', 12, true, 'Corbel', 3, 'Dentil'), ('Simple', 8, false, 'None', 1, 'None'))
    SELECT wall_id, s.* FROM walls w JOIN s ON s.style_name = CASE WHEN w.style IN ('Georgian', 'Victorian', 'Simple') THEN w.style ELSE 'Georgian' END""",
)
def style_presets(spark: SparkSession, sf: str) -> DataFrame:
    out = L.apply_style(view(spark, sf, "walls"))
    return out.select(
        "wall_id", "style_name", "rows_per_floor", "window_recess", "cornice_style", "parapet_rows", "floor_band_style"
    )
