"""Bulk layout: expand tables of spans, walls, openings and bands into part placements.

Every operator is an ``explode`` of closed-form positions, over tasks whose number follows the
input rows; only wall rows with openings need a join.  Placements carry the input keys plus ``color``, ``x``, ``y``,
``z`` (one decimal), ``part`` and ``rot``.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mortarline import dims as D

_PIECE = "array<struct<w:int,c:double>>"
_COURSE = "array<struct<y:double,kind:string>>"
#: Input rows of one task where each of them becomes many placements.
TASK_ROWS = 20_000


def _dealt(df: DataFrame) -> DataFrame:
    """The rows over enough tasks: a small file can hold spans for millions of placements."""
    tasks = ceil(df.count() / TASK_ROWS)
    return df.repartition(tasks) if tasks > 1 else df


def _rot(name: str) -> Column:
    return F.lit(D.ROTATIONS[name])


def _strings(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def wall_fact(wall: Column, index: int) -> Column:
    """Axis (0), rotation (1) or recess sign (2) of a named wall."""
    out = None
    for name, facts in D.WALLS.items():
        value = _rot(facts[1]) if index == 1 else F.lit(facts[index])
        out = F.when(wall == name, value) if out is None else out.when(wall == name, value)
    return out


def _piece(w: int, c: Column) -> Column:
    return F.struct(F.lit(w).alias("w"), c.alias("c"))


def greedy_pieces(start: Column, end: Column) -> Column:
    """Widths and centres of the greedy fill from ``start`` to ``end``.

    The loop "largest piece that fits" has a closed form in 20-unit studs: whole
    eights first, then at most two pieces for the rest.
    """
    units = F.greatest(F.floor((end - start + 0.1) / 20), F.lit(0))
    eights, rest = F.floor(units / 8), units % 8
    empty = F.array().cast(_PIECE)
    at = start + eights * 160
    tail = empty
    for studs, widths in {1: (20,), 2: (40,), 3: (60,), 4: (80,), 5: (80, 20), 6: (120,), 7: (120, 20)}.items():
        offset, pieces = 0, []
        for w in widths:
            pieces.append(_piece(w, at + offset + w / 2))
            offset += w
        tail = F.when(rest == studs, F.array(*pieces).cast(_PIECE)).otherwise(tail)
    whole = F.when(
        eights > 0,
        F.transform(F.sequence(F.lit(0).cast("long"), eights - 1), lambda i: _piece(160, start + i * 160 + 80)).cast(_PIECE),
    ).otherwise(empty)
    return F.concat(whole, tail)


def stagger_piece(start: Column, offset: Column) -> Column:
    """The piece that fills the start of a staggered row: the widest not above the offset."""
    out = F.array().cast(_PIECE)
    for w in (20, 40, 60, 80, 120):
        fits = (offset + 0.1 >= w) & (offset > 0) & (offset < 160)
        out = F.when(fits, F.array(_piece(w, start + w / 2)).cast(_PIECE)).otherwise(out)
    return out


def fill_spans(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fill each span with parts.

    ``spans``: keys, color, span_start, span_end, y, cross_pos, axis (X or Z), kind
    (brick, plate or tile), stagger.  A remainder under one stud stays open.
    """
    start, end, offset = F.col("span_start"), F.col("span_end"), F.col("stagger")
    pieces = F.concat(stagger_piece(start, offset), greedy_pieces(start + offset, end))
    along_x = F.col("axis") == "X"
    part = None
    for kind, parts in D.FILL_PARTS.items():
        value = F.try_element_at(_strings(parts), F.col("p.w"))
        part = F.when(F.col("kind") == kind, value) if part is None else part.when(F.col("kind") == kind, value)
    centre = F.bround(F.col("p.c"), 1)
    cross = F.bround("cross_pos", 1)
    return spans.select(*keys, "color", "y", "cross_pos", "axis", "kind", F.explode(pieces).alias("p")).select(
        *keys,
        "color",
        F.when(along_x, centre).otherwise(cross).alias("x"),
        F.bround("y", 1).alias("y"),
        F.when(along_x, cross).otherwise(centre).alias("z"),
        part.alias("part"),
        F.when(along_x, _rot("R0")).otherwise(_rot("R90")).alias("rot"),
    )


def _upward(first: Column, last: Column) -> Column:
    """Whole numbers from ``first`` up to ``last``; null, so no row, where ``last`` is below ``first``."""
    return F.when(last >= first, F.sequence(first, last))


def wall_segments(walls: DataFrame, openings: DataFrame, key: str = "wall_id") -> DataFrame:
    """Solid segments of every wall row: (wall columns, row, span_start, span_end, y, stagger).

    A row without openings is one segment.  Otherwise the gaps, sorted by start, cut the
    row: each segment runs from the previous gap's end to the next gap's start, and
    slivers of 0.1 or less vanish.  A wall of no rows has no segment, and an opening whose
    last row is below its first cuts nothing.  The window runs over the gaps of one row of one wall.
    The gaps are sorted and merged by wall and row: their number is unknown before they are
    expanded, so they must not be broadcast.  The number of those tasks follows the walls and openings, so what one
    holds does not grow with the tables.
    """
    tasks = ceil((walls.count() + openings.count()) / TASK_ROWS) or 1
    rows = _dealt(walls).withColumn("row", F.explode(_upward(F.lit(1), F.col("n_rows")))).repartition(tasks, key, "row")
    gaps = openings.withColumn("row", F.explode(_upward(F.col("from_row"), F.col("to_row")))).select(key, "row", "o_start", "o_end")
    gaps = gaps.repartition(tasks, key, "row").hint("merge")
    w = Window.partitionBy(key, "row").orderBy("o_start", "o_end")
    cut = (
        rows.join(gaps, [key, "row"], "left")
        .withColumn("_from", F.coalesce(F.lag("o_end").over(w), F.col("span_start")))
        .withColumn("_last", F.lead(F.lit(1)).over(w).isNull())
    )

    def segment(keep: Column, a: Column, b: Column) -> Column:
        return F.when(keep, F.struct(a.alias("a"), b.alias("b")))

    solid = F.col("o_start").isNull()
    pieces = F.array_compact(
        F.array(
            segment(solid, F.col("span_start"), F.col("span_end")),
            segment(~solid & (F.col("o_start") > F.col("_from") + 0.1), F.col("_from"), F.col("o_start")),
            segment(~solid & F.col("_last") & (F.col("o_end") < F.col("span_end") - 0.1), F.col("o_end"), F.col("span_end")),
        )
    )
    kept = [c for c in walls.columns if c not in ("span_start", "span_end", "n_rows")]
    return cut.select(*kept, "row", F.explode(pieces).alias("s")).select(
        *kept,
        "row",
        F.col("s.a").alias("span_start"),
        F.col("s.b").alias("span_end"),
        (F.col("ground_y") - F.col("row") * 24).alias("y"),
        (F.col("row") % 2 * 20).alias("stagger"),
    )


def build_walls(walls: DataFrame, openings: DataFrame, key: str = "wall_id") -> DataFrame:
    """Brick placements of whole walls; alternate rows are staggered by one stud."""
    segments = wall_segments(walls, openings, key).withColumn("kind", F.lit("brick"))
    return fill_spans(segments, [key, "row"])


def _placed(color: Column, x: Column, y: Column, z: Column, part: str | Column, rot: Column) -> Column:
    return F.struct(
        color.cast("int").alias("color"),
        F.bround(x, 1).alias("x"),
        F.bround(y, 1).alias("y"),
        F.bround(z, 1).alias("z"),
        (F.lit(part) if isinstance(part, str) else part).alias("part"),
        rot.alias("rot"),
    )


def _expand(df: DataFrame, keys: Sequence[str], pieces: Sequence[Column]) -> DataFrame:
    return df.select(*keys, F.inline(F.array_compact(F.array(*pieces))))


def _faces() -> tuple[Column, Column, Column, Column, Column]:
    """Recessed x and z, wall rotation, and the rotation of flat trim along the wall."""
    wall = F.col("wall")
    on_x = wall_fact(wall, 0) == "X"
    shift = F.when(F.col("recessed"), wall_fact(wall, 2) * 10).otherwise(0)
    x = F.when(on_x, F.col("x")).otherwise(F.col("x") + shift)
    z = F.when(on_x, F.col("z") + shift).otherwise(F.col("z"))
    return x, z, wall_fact(wall, 1), F.when(on_x, _rot("R0")).otherwise(_rot("R90")), on_x


def window_bays(bays: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Frame, glass, and optional sill and header plates per bay.

    ``bays``: keys, frame_color, wall_color, x, y, z, wall, recessed, sill, header.
    """
    x, z, rot, trim, _ = _faces()
    y, color = F.col("y"), F.col("wall_color")
    return _expand(
        bays,
        keys,
        [
            _placed(F.col("frame_color"), x, y, z, "60594.dat", rot),
            _placed(F.lit(47), x, y, z, "60603.dat", rot),
            F.when(F.col("sill"), _placed(color, F.col("x"), y + 72, F.col("z"), "3710.dat", trim)),
            F.when(F.col("header"), _placed(color, F.col("x"), y - 8, F.col("z"), "3710.dat", trim)),
        ],
    )


def door_surrounds(doors: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Frame, door and optional header plate: keys, frame_color, door_color, wall_color, x, y, z, wall, recessed, header."""
    x, z, rot, trim, _ = _faces()
    y = F.col("y")
    return _expand(
        doors,
        keys,
        [
            _placed(F.col("frame_color"), x, y, z, "60596.dat", rot),
            _placed(F.col("door_color"), x, y, z, "57895.dat", rot),
            F.when(F.col("header"), _placed(F.col("wall_color"), F.col("x"), y - 8, F.col("z"), "3710.dat", trim)),
        ],
    )


def _repeat(df: DataFrame, keys: Sequence[str], first: Column, n: Column, step: int) -> DataFrame:
    """Add ``pos``: ``n`` positions from ``first`` every ``step``."""
    steps = F.when(n > 0, F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))
    return df.withColumn("_i", F.explode(steps)).withColumn("pos", first + F.col("_i") * step).drop("_i")


def _along(pos: Column, y: Column, cross: Column, on_x: Column, color: Column, part: str | Column, rot: Column) -> Column:
    return _placed(color, F.when(on_x, pos).otherwise(cross), y, F.when(on_x, cross).otherwise(pos), part, rot)


def cornices(bands: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Dentil, Corbel or Plain bands: keys, color, span_start, span_end, y, wall_pos, wall, style.

    Teeth sit every 40 units starting 10 in, one half stud outside the wall face.
    Other styles place nothing.
    """
    wall = F.col("wall")
    axis = wall_fact(wall, 0)
    out = bands.withColumns({"axis": axis, "cross_pos": F.col("wall_pos") - wall_fact(wall, 2) * 10})
    on_x = F.col("axis") == "X"
    teeth = _repeat(
        out.where(F.col("style").isin("Dentil", "Corbel")),
        keys,
        F.col("span_start") + 10,
        F.ceil((F.col("span_end") - 0.1 - F.col("span_start") - 10) / 40),
        40,
    )
    dentil = F.col("style") == "Dentil"
    across = F.when(on_x, _rot("R90")).otherwise(_rot("R0"))
    piece = _along(
        F.col("pos"), F.col("y"), F.col("cross_pos"), on_x, F.col("color"),
        F.when(dentil, "3023.dat").otherwise("3665.dat"), F.when(dentil, across).otherwise(wall_fact(wall, 1)),
    )
    plain = out.where(F.col("style") == "Plain").withColumns({"kind": F.lit("plate"), "stagger": F.lit(0)})
    return _expand(teeth, keys, [piece]).unionByName(fill_spans(plain, keys))


def floor_bands(bands: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A plate course on the wall face, with dentils one plate below when the style asks."""
    plates = bands.withColumns(
        {"axis": wall_fact(F.col("wall"), 0), "cross_pos": F.col("wall_pos"), "kind": F.lit("plate"), "stagger": F.lit(0)}
    )
    teeth = bands.where(F.col("style") == "Dentil").withColumn("y", F.col("y") + 8)
    return fill_spans(plates, keys).unionByName(cornices(teeth, keys))


def floor_plates(floors: DataFrame, keys: Sequence[str], inset: float = 0.0) -> DataFrame:
    """Plate rows over a rectangle: keys, color, x_min, x_max, z_min, z_max, y, layers.

    Rows run every 20 units up to and including ``z_max``.  With ``inset`` the rows are
    shifted by it and the one at ``z_max`` is left out.
    """
    span = F.col("z_max") - F.col("z_min")
    n = F.floor(span / 20) + 1 if not inset else F.ceil((span - 0.1) / 20)
    rows = (
        _repeat(_dealt(floors), keys, F.col("z_min"), n, 20)
        .withColumn("layer", F.explode(_upward(F.lit(0), F.col("layers") - 1)))
        .select(
            *keys,
            "color",
            F.col("x_min").alias("span_start"),
            F.col("x_max").alias("span_end"),
            (F.col("y") - F.col("layer") * 8).alias("y"),
            (F.col("pos") + inset).alias("cross_pos"),
            F.lit("X").alias("axis"),
            F.lit("plate").alias("kind"),
            F.lit(0).alias("stagger"),
        )
    )
    return fill_spans(rows, keys)


def parapets(roofs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Brick rows and cap tiles on chosen sides: keys, color, x_min, x_max, z_min, z_max, y, n_rows, cap, sides."""
    x0, x1, z0, z1 = (F.col(c) for c in ("x_min", "x_max", "z_min", "z_max"))

    def side(letter: str, axis: str, a: Column, b: Column, cross: Column) -> Column:
        s = F.struct(F.lit(axis).alias("axis"), a.alias("span_start"), b.alias("span_end"), cross.alias("cross_pos"))
        return F.when(F.contains(F.upper("sides"), F.lit(letter)), s)

    sides = F.array_compact(
        F.array(
            side("F", "X", x0, x1, z0), side("B", "X", x0, x1, z1), side("L", "Z", z0, z1, x0), side("R", "Z", z0, z1, x1)
        )
    )
    courses = F.concat(
        F.coalesce(
            F.transform(
                _upward(F.lit(0), F.col("n_rows") - 1),
                lambda r: F.struct((F.col("y") - r * 24).alias("y"), F.lit("brick").alias("kind")),
            ).cast(_COURSE),
            F.array().cast(_COURSE),
        ),
        F.when(
            F.col("cap"),
            F.array(F.struct((F.col("y") - F.col("n_rows") * 24 + 16).alias("y"), F.lit("tile").alias("kind"))).cast(_COURSE),
        ).otherwise(F.array().cast(_COURSE)),
    )
    rows = (
        _dealt(roofs).select(*keys, "color", F.explode(sides).alias("s"), courses.alias("cs"))
        .select(*keys, "color", "s.*", F.explode("cs").alias("c"))
        .select(*keys, "color", "axis", "span_start", "span_end", "cross_pos", "c.y", "c.kind", F.lit(0).alias("stagger"))
    )
    return fill_spans(rows, keys)


def masonry_rows(segments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two-stud textured bricks along each segment (see ``wall_segments``); the rest stays open.

    A ``rot`` column, where given, sets the turn of each row.
    """
    on_x = F.col("axis") == "X"
    n = F.floor((F.col("span_end") - F.col("span_start") + 0.1) / 40)
    laid = _repeat(segments, keys, F.col("span_start") + 20, n, 40)
    rot = F.col("rot") if "rot" in segments.columns else F.when(on_x, _rot("R270")).otherwise(_rot("R90"))
    return _expand(laid, keys, [_along(F.col("pos"), F.col("y"), F.col("cross_pos"), on_x, F.col("color"), "98283.dat", rot)])


def repeats(
    bands: DataFrame, keys: Sequence[str], part: str, step: int, lead: float, x_rot: str = "R0", z_rot: str = "R90"
) -> DataFrame:
    """One part every ``step`` from span_start to span_end inclusive, shifted by ``lead``."""
    on_x = F.col("axis") == "X"
    n = F.floor((F.col("span_end") - F.col("span_start")) / step) + 1
    rot = F.when(on_x, _rot(x_rot)).otherwise(_rot(z_rot))
    laid = _repeat(bands, keys, F.col("span_start"), n, step)
    return _expand(laid, keys, [_along(F.col("pos") + lead, F.col("y"), F.col("cross_pos"), on_x, F.col("color"), part, rot)])


def dentil_tiles(bands: DataFrame, keys: Sequence[str]) -> DataFrame:
    return repeats(bands, keys, "3794b.dat", 40, 20.0, "R270", "R90")


def finials(bands: DataFrame, keys: Sequence[str], spacing: int = 60) -> DataFrame:
    return repeats(bands, keys, "4070.dat", spacing, 0.0)


def flower_boxes(boxes: DataFrame, keys: Sequence[str], palette: Sequence[int], shelf_color: int = 70) -> DataFrame:
    """Shelf plate with three flowers; colours cycle through the palette by ``box_no``.

    ``boxes``: keys, box_no, x, y, z, axis.
    """
    on_x = F.col("axis") == "X"
    colors = F.array(*[F.lit(c) for c in palette])
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    flowers = []
    for i, shift in enumerate((-20, 0, 20)):
        c = F.element_at(colors, (F.pmod(F.col("box_no") + i, F.lit(len(palette))) + 1).cast("int"))
        flowers.append(
            _placed(
                c, F.when(on_x, x + shift).otherwise(x), y - 8, F.when(on_x, z).otherwise(z + shift), "4073.dat", _rot("R0")
            )
        )
    shelf = _placed(F.lit(shelf_color), x, y, z, "3710.dat", F.when(on_x, _rot("R0")).otherwise(_rot("R90")))
    return _expand(boxes, keys, [shelf, *flowers])


def slope_ridges(
    ridges: DataFrame, keys: Sequence[str], front: str = "R0", back: str = "R180", part: str = "3040b.dat"
) -> DataFrame:
    """Two slopes meeting at a peak, one stud apart."""
    x, y, z, c = F.col("x"), F.col("y"), F.col("z"), F.col("color")
    return _expand(ridges, keys, [_placed(c, x, y, z, part, _rot(front)), _placed(c, x, y, z + 20, part, _rot(back))])


def apply_style(df: DataFrame, style: str = "style") -> DataFrame:
    """Add the style preset's settings; an unknown style falls back to the default one."""
    fields = [
        "rows_per_floor", "window_recess", "window_sill", "window_header", "cornice_style",
        "parapet_rows", "parapet_cap", "floor_band", "floor_band_style",
    ]
    known = F.when(F.col(style).isin(list(D.STYLES)), F.col(style)).otherwise(D.DEFAULT_STYLE)
    out = df.withColumn("style_name", known)
    for i, f in enumerate(fields):
        value = None
        for name, facts in D.STYLES.items():
            hit = F.col("style_name") == name
            value = F.when(hit, facts[i]) if value is None else value.when(hit, facts[i])
        out = out.withColumn(f, value)
    return out
