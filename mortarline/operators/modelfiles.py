"""Line-based 3D model files: parsing, validation, structural features, part statistics.

``lines`` tables have ``model`` and ``value``; ``placements`` tables have ``model``,
``color``, ``x``, ``y``, ``z``, ``rot`` (nine numbers as text) and ``part``.  No operator
orders or collects a whole model in one task, unless it is known to be small: the finest
shuffle key always includes the position, the layer or the part.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mortarline import dims as D

#: Parts and colours of lines that one task of a validation counts, and tasks over which a model's other lines go.
TASK_LINES, SPREAD = 400_000, 64
#: Placements of one task of structural features, and of the largest model that one task takes whole.
MODEL_ROWS = 500_000
#: Buckets that models are counted in to find large ones.
BUCKETS = 65_536

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _number(token: Column) -> Column:
    return F.when(token.rlike(_NUMBER), token.try_cast("double"))


def parse_placements(lines: DataFrame) -> DataFrame:
    """Type-1 lines ("1" and a blank) with 15 tokens or more and numeric coordinates; others are dropped."""
    text = F.btrim("value", F.lit(" \t\r\n\f\x0b"))
    kept = [c for c in lines.columns if c != "value"]
    # the one-element explode keeps the split from being evaluated again per use
    parsed = lines.where(text.startswith("1 ")).select(*kept, F.explode(F.array(F.split(text, r"\s+"))).alias("_t"))
    t = F.col("_t")
    return (
        parsed.where((t[0] == "1") & (F.size(t) >= 15))
        .select(
            *kept,
            t[1].try_cast("int").alias("color"),
            _number(t[2]).alias("x"),
            _number(t[3]).alias("y"),
            _number(t[4]).alias("z"),
            F.array_join(F.slice(t, 6, 9), " ").alias("rot"),
            t[14].alias("part"),
        )
        .where(F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull())
    )


def validate(lines: DataFrame) -> DataFrame:
    """Per model: line, part, FILE/NOFILE, STEP and bad-reference counts, distinct parts
    and colours (ignoring case), y range and PASS/FAIL verdicts.

    Lines meet by model and part, and by model and colour, in tasks whose number follows the lines, so what one
    holds does not grow with the tables; other lines of a model are spread.
    """
    low = F.lower("value")
    is_part = F.col("value").rlike(r"^1\s")
    tokens = F.col("_t")
    split = lines.select(
        "model", "value", F.explode(F.array(F.when(is_part, F.split("value", r"\s+")))).alias("_t")
    )
    is_part = tokens.isNotNull()
    kinds = split.select(
        "model",
        F.when(is_part, "part")
        .when(low.startswith("0 file"), "file")
        .when(low.startswith("0 nofile"), "nofile")
        .when(low.startswith("0 step"), "step")
        .otherwise("other")
        .alias("kind"),
        F.when(is_part, F.lower(F.element_at(tokens, -1))).alias("part"),
        F.when(is_part, F.lower(F.try_element_at(tokens, F.lit(2)))).alias("color"),
        F.when(is_part, _number(F.try_element_at(tokens, F.lit(4)))).alias("y"),
        F.when(~is_part, F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD))).alias("spread"),
    )
    # a part line is met by its part and once more by its colour, so both are counted in one shuffle
    line = F.struct("kind", F.col("part").alias("name"), "y", "spread")
    nothing = F.lit(None)
    color = F.struct(
        F.lit("color").alias("kind"), F.col("color").alias("name"), nothing.cast("double").alias("y"), nothing.cast("long").alias("spread")
    )
    keys = ["model", "kind", "name", "spread"]
    met = kinds.select("model", F.inline(F.array_compact(F.array(line, F.when(F.col("kind") == "part", color)))))
    tasks = ceil(2 * lines.count() / TASK_LINES) or 1
    small = met.repartition(tasks, *keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("y").alias("y_min"), F.max("y").alias("y_max")
    )

    def total(when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0))

    kind = F.col("kind")
    bad = (kind == "part") & ~(F.col("name").endswith(".dat") | F.col("name").endswith(".ldr"))
    out = small.groupBy("model").agg(
        total(kind != "color").alias("line_count"),
        total(kind == "part").alias("part_count"),
        total(kind == "file").alias("file_count"),
        total(kind == "nofile").alias("nofile_count"),
        total(kind == "step").alias("step_count"),
        F.count_if(kind == "part").alias("unique_parts"),
        F.count_if((kind == "color") & F.col("name").isNotNull()).alias("unique_colors"),
        F.min("y_min").alias("y_min"),
        F.max("y_max").alias("y_max"),
        total(bad).alias("bad_refs"),
    )
    return out.withColumns(
        {
            "submodels": F.when(F.col("file_count") == F.col("nofile_count"), "PASS").otherwise("FAIL"),
            "references": F.when(F.col("bad_refs") == 0, "PASS").otherwise("FAIL"),
        }
    )


def _large_models(placements: DataFrame) -> tuple[int, list]:
    """Number of placements, and the models with over ``MODEL_ROWS`` of them.

    Models are counted in ``BUCKETS`` buckets first, and one by one where a bucket has as many rows as a large model.
    """
    bucket = F.pmod(F.xxhash64("model"), F.lit(BUCKETS))
    counts = placements.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    rows, full = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.collect_list(F.when(F.col("n") > MODEL_ROWS, F.col("b")))).first()
    if not full:
        return rows, []
    models = placements.where(bucket.isin(full)).groupBy("model").count()
    return rows, [r["model"] for r in models.where(F.col("count") > MODEL_ROWS).collect()]


def _height_to_base(low: str, high: str) -> Column:
    """Height over the root of the base, from columns named by axis behind ``low`` and ``high``."""
    side = {c: F.max(f"{high}{c}") - F.min(f"{low}{c}") for c in "xyz"}
    return side["y"] / F.sqrt(F.greatest(side["x"] * side["z"], F.lit(1.0)))


def _whole_models(placements: DataFrame, tasks: int, y_down: bool) -> DataFrame:
    """Parts, collisions, height to base, layer density and unsupported positions per model, in one shuffle by model.

    In their order by layer and height, rows of one position of a column come one after the other, also where it lies in two layers.
    """
    turned = F.desc if y_down else F.asc
    by_layer = Window.partitionBy("model").orderBy(turned("layer"))
    ranked = placements.select("model", "x", "y", "z").repartition(tasks, "model").select(
        "*", F.bround("x", 1).alias("px"), F.bround("y", 1).alias("py"), F.bround("z", 1).alias("pz"), F.bround("y", 0).alias("layer")
    ).withColumns({"rank": F.dense_rank().over(by_layer), "nth": F.row_number().over(by_layer) - F.rank().over(by_layer)})
    column = Window.partitionBy("model", "px", "pz").orderBy("step", turned("py"))
    placed = ranked.withColumn("step", F.when(F.col("layer").isNotNull(), F.col("rank"))).withColumns(
        {"below": F.lag("step").over(column), "again": (F.row_number().over(column) > 1) & F.lag("py").over(column).eqNullSafe(F.col("py"))}
    )
    n, layers = F.count(F.lit(1)), F.max("rank")
    # the rows of a layer, numbered from 0, make 2 * nth + 1 add up to the square of their number
    squares = F.sum(2 * F.col("nth").cast("long") + 1)
    return (
        placed.groupBy("model")
        .agg(
            n.alias("parts"),
            F.count_if("again").alias("collisions"),
            _height_to_base("", "").alias("height_to_base"),
            ((layers * squares - n * n) / (layers.cast("double") * layers)).alias("density"),
            F.count_if((F.col("step") > 1) & (F.coalesce("below", F.lit(0)) < F.col("step") - 1)).alias("unsupported"),
            F.count("step").alias("_placed"),
        )
        .where(F.col("_placed") > 0)
        .drop("_placed")
    )


def _spread_models(placements: DataFrame, y_down: bool) -> DataFrame:
    """The same for models of any size, spread over tasks by position and by layer."""
    layer = F.bround("y", 0)
    # a position rounded to one decimal lies in one layer, or in two when it ends in .5
    spots = placements.groupBy(
        "model", F.bround("x", 1).alias("px"), F.bround("y", 1).alias("py"), F.bround("z", 1).alias("pz")
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(layer == F.floor("y")).alias("n_low"),
        F.min(layer).alias("low"),
        F.max(layer).alias("high"),
        *[f(c).alias(f"{f.__name__}_{c}") for c in "xyz" for f in (F.min, F.max)],
    )
    split = F.col("low") != F.col("high")
    parts = F.filter(
        F.array(
            F.struct(
                F.col("low").alias("layer"), F.when(split, F.col("n_low")).otherwise(F.col("n")).alias("n"), F.lit(1).alias("spot")
            ),
            F.struct(F.col("high").alias("layer"), (F.col("n") - F.col("n_low")).alias("n"), F.lit(0).alias("spot")),
        ),
        lambda s: (s["spot"] == 1) | split,
    )
    extents = [f"{f}_{c}" for c in "xyz" for f in ("min", "max")]
    layers = (
        spots.select("model", *extents, F.inline(parts))
        .groupBy("model", "layer")
        .agg(
            F.sum("n").alias("n"),
            F.sum("spot").alias("spots"),
            *[(F.min if e.startswith("min") else F.max)(e).alias(e) for e in extents],
        )
    )
    per_model = layers.groupBy("model").agg(
        F.sum("n").alias("parts"),
        (F.sum("n") - F.sum("spots")).alias("collisions"),
        _height_to_base("min_", "max_").alias("height_to_base"),
        F.var_pop("n").alias("density"),
    )
    by_layer = Window.partitionBy("model").orderBy(F.desc("layer") if y_down else F.asc("layer"))
    steps = (
        placements.groupBy("model", layer.alias("layer")).agg(F.lit(1).alias("_"))
        .select("model", "layer", F.row_number().over(by_layer).alias("step"))
    )
    column = Window.partitionBy("model", "px", "pz").orderBy("step")
    overhang = (
        placements.groupBy("model", layer.alias("layer"), F.bround("x", 1).alias("px"), F.bround("z", 1).alias("pz"))
        .agg(F.lit(1).alias("_"))
        .join(steps, ["model", "layer"])
        .withColumn("below", F.lag("step").over(column))
        .groupBy("model")
        .agg(
            F.count_if((F.col("step") > 1) & ~(F.coalesce("below", F.lit(-1)) == F.col("step") - 1)).alias("unsupported")
        )
    )
    return per_model.join(overhang, "model")


def structural_features(
    placements: DataFrame,
    labels: DataFrame | None = None,
    models: DataFrame | None = None,
    y_down: bool = False,
) -> DataFrame:
    """Overhang ratio, collisions, height-to-base ratio, layer density and label per model.

    A position is supported when the previous occupied layer of its model holds the same
    (x, z).  Layers run by growing y; ``y_down`` reverses that.  Models listed in
    ``models`` without placements are kept as zeros.  Models of up to ``MODEL_ROWS`` placements
    are each worked out in one task, larger ones are spread.
    """
    placements = placements.where(F.col("model").isNotNull())
    rows, large = _large_models(placements)
    small = placements.where(~F.col("model").isin(large)) if large else placements
    out = _whole_models(small, ceil(rows / MODEL_ROWS) or 1, y_down)
    if large:
        out = out.unionByName(_spread_models(placements.where(F.col("model").isin(large)), y_down))
    if models is not None:
        out = models.select("model").distinct().join(out, "model", "left")
    if labels is not None:
        # one label per model, the largest where several are given
        out = out.join(labels.groupBy("model").agg(F.max("label").alias("label")), "model", "left")
    else:
        out = out.withColumn("label", F.lit(0))
    zero = F.lit(0.0)
    return out.select(
        "model",
        F.round(F.coalesce(F.col("unsupported") / F.col("parts"), zero), 4).alias("overhang_ratio"),
        F.coalesce("collisions", F.lit(0)).alias("collision_count"),
        F.round(F.coalesce("height_to_base", zero), 4).alias("height_to_base_ratio"),
        F.round(F.coalesce("density", zero), 4).alias("layer_density"),
        F.coalesce("label", F.lit(0)).alias("label"),
    )


def part_category(part: Column, categories: Mapping[str, Sequence[str]] = D.STAT_CATEGORIES) -> Column:
    bare = F.replace(part, F.lit(".dat"), F.lit(""))
    out = None
    for name, parts in categories.items():
        out = F.when(bare.isin(list(parts)), name) if out is None else out.when(bare.isin(list(parts)), name)
    return out


def part_stats(placements: DataFrame) -> DataFrame:
    """Part counts per category, size in studs and window share; models without parts are absent."""
    kinds = placements.withColumn("_k", part_category(F.col("part")))
    counts = {k: F.count_if(F.col("_k") == k) for k in D.STAT_CATEGORIES}
    out = kinds.groupBy("model").agg(
        F.count(F.lit(1)).alias("total_parts"),
        *[c.alias(f"{k}_count") for k, c in counts.items()],
        F.round((F.max("y") - F.min("y")) / 24, 1).alias("height_studs"),
        F.round((F.max("x") - F.min("x")) / 20, 1).alias("width_studs"),
        F.round((F.max("z") - F.min("z")) / 20, 1).alias("depth_studs"),
    )
    wall = F.col("brick_count") + F.col("window_count") + F.col("door_count")
    ratio = F.when(wall > 0, F.col("window_count") / wall).otherwise(0.0)
    return out.withColumn("window_to_wall_ratio", F.round(ratio, 4))


def duplicates(placements: DataFrame) -> DataFrame:
    """Placements repeated with the same position, rotation and part."""
    return (
        placements.groupBy("model", "x", "y", "z", "rot", "part")
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def boxes(placements: DataFrame, sizes: Mapping[str, tuple[int, int, int]] = D.PART_SIZES) -> DataFrame:
    """Distinct bounding boxes with their number of copies.

    Parts of unknown size have no box; ``overlap_counts`` reports how many there are.

    The anchor is the centre of the top face and y grows downward; a quarter turn swaps
    the sides.
    """
    rows = [(p, float(w), float(length), float(h)) for p, (w, length, h) in sizes.items()]
    dim = placements.sparkSession.createDataFrame(rows, "part string, w double, l double, h double")
    turned = F.col("rot").isin(D.ROTATIONS["R90"], D.ROTATIONS["R270"])
    sized = placements.join(F.broadcast(dim), "part")  # fixed catalogue, a few dozen rows
    along, across = F.col("l") / 2, F.col("w") / 2
    dx = F.when(turned, across).otherwise(along)
    dz = F.when(turned, along).otherwise(across)
    return sized.groupBy(
        "model",
        (F.col("x") - dx).alias("x0"), (F.col("x") + dx).alias("x1"),
        F.col("y").alias("y0"), (F.col("y") + F.col("h")).alias("y1"),
        (F.col("z") - dz).alias("z0"), (F.col("z") + dz).alias("z1"),
    ).agg(F.count(F.lit(1)).alias("copies"))


def overlaps(placements: DataFrame, cell: float = 160.0) -> DataFrame:
    """Pairs of distinct boxes of one model that share space.

    Boxes meet in grid cells, so only neighbours are compared; each pair is reported
    from one cell only, the highest of the two lowest corners.  Copies of one box are
    folded into a single row beforehand (see ``duplicates``).
    """
    b = boxes(placements)
    for axis in "xyz":
        low, high = F.floor(F.col(f"{axis}0") / cell), F.ceil(F.col(f"{axis}1") / cell) - 1
        b = b.withColumn(f"g{axis}", low).withColumn(f"c{axis}", F.explode(F.sequence(low, F.greatest(low, high))))
    corner = ["x0", "y0", "z0", "x1", "y1", "z1"]
    left, right = b.alias("a"), b.alias("b")
    near = F.col("a.model") == F.col("b.model")
    touch = F.struct(*[F.col(f"a.{c}") for c in corner]) < F.struct(*[F.col(f"b.{c}") for c in corner])
    for axis in "xyz":
        near = near & (F.col(f"a.c{axis}") == F.col(f"b.c{axis}"))
        touch = (
            touch
            & (F.col(f"a.{axis}0") < F.col(f"b.{axis}1"))
            & (F.col(f"b.{axis}0") < F.col(f"a.{axis}1"))
            & (F.col(f"a.c{axis}") == F.greatest(F.col(f"a.g{axis}"), F.col(f"b.g{axis}")))
        )
    return left.join(right, near & touch).select(
        F.col("a.model").alias("model"),
        *[F.col(f"a.{c}").alias(f"a_{c}") for c in corner],
        *[F.col(f"b.{c}").alias(f"b_{c}") for c in corner],
        (F.col("a.copies") * F.col("b.copies")).alias("weight"),
    )


def overlap_counts(placements: DataFrame, cell: float = 160.0) -> DataFrame:
    """Overlaps per model, and its placements whose part has no known size and takes no part."""
    found = overlaps(placements, cell).groupBy("model").agg(
        F.count(F.lit(1)).alias("box_pairs"), F.sum("weight").alias("placement_pairs")
    )
    known = F.col("part").isin(list(D.PART_SIZES))
    unsized = placements.where(~known | F.col("part").isNull()).groupBy("model").agg(F.count(F.lit(1)).alias("unsized"))
    return found.join(unsized, "model", "full").na.fill(0, ["box_pairs", "placement_pairs", "unsized"])


def glass_pairing(placements: DataFrame, pairs: Mapping[str, Sequence[str]] = D.GLASS_PAIRS) -> DataFrame:
    """For every position with a frame: does it hold a glass that fits?

    One conditional aggregation per position, no self-join.
    """
    part = F.col("part")
    glass = sorted({g for gs in pairs.values() for g in gs})
    spots = placements.where(part.isin([*pairs, *glass])).groupBy("model", "x", "y", "z").agg(
        F.count_if(part.isin(glass)).alias("_any"),
        *[F.count_if(part == f).alias(f"_f{i}") for i, f in enumerate(pairs)],
        *[F.count_if(part.isin(list(gs))).alias(f"_g{i}") for i, gs in enumerate(pairs.values())],
    )
    frames = F.filter(
        F.array(
            *[
                F.struct(F.lit(f).alias("frame"), F.col(f"_f{i}").alias("frames"), F.col(f"_g{i}").alias("fitting"))
                for i, f in enumerate(pairs)
            ]
        ),
        lambda s: s["frames"] > 0,
    )
    verdict = F.when(F.col("fitting") > 0, "ok").when(F.col("_any") > 0, "wrong_glass").otherwise("missing_glass")
    return spots.select("model", "x", "y", "z", "_any", F.inline(frames)).select(
        "model", "x", "y", "z", "frame", "frames", verdict.alias("verdict")
    )


def color_share(placements: DataFrame) -> DataFrame:
    """Share of each colour in its model, role by rank, and whether the share fits the role's band.

    The windows run over one row per (model, colour).
    """
    by_model = Window.partitionBy("model")
    ranked = by_model.orderBy(F.desc("n"), "color")
    roles = list(D.COLOR_BANDS)
    counted = placements.groupBy("model", "color").agg(F.count(F.lit(1)).alias("n")).select(
        "model",
        "color",
        "n",
        (F.col("n") / F.sum("n").over(by_model)).alias("share"),
        F.row_number().over(ranked).alias("rank"),
        F.count(F.lit(1)).over(by_model).alias("n_colors"),
    )
    role, fits = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for i, name in enumerate(roles):
        low, high = D.COLOR_BANDS[name]
        role = F.when(F.col("rank") == i + 1, name).otherwise(role)
        fits = F.when(F.col("rank") == i + 1, F.col("share").between(low, high)).otherwise(fits)
    return counted.withColumns(
        {"role": role, "in_band": fits, "palette_ok": F.col("n_colors") <= D.MAX_MODEL_COLORS}
    )


def bill_of_materials(placements: DataFrame) -> DataFrame:
    return placements.groupBy("model", "part", "color").agg(F.count(F.lit(1)).alias("n"))


def short_number(c: str | Column) -> Column:
    """One decimal at most, no trailing zero."""
    v = F.bround(F.col(c) if isinstance(c, str) else c, 1)
    return F.regexp_replace(v.cast("decimal(20,1)").cast("string"), r"\.0$", "")


def placement_line() -> Column:
    return F.concat_ws(
        " ", F.lit("1"), F.col("color").cast("string"), *[short_number(c) for c in "xyz"], F.col("rot"), F.col("part")
    )


def line_order(lines: DataFrame) -> list[str]:
    """Columns of ``framed_lines`` that put a model's lines in order."""
    marks = [c for c in lines.columns if c.startswith("o_")]
    return ["section", "submodel", "part_no", *marks, "line_no", "value"]


def framed_lines(placements: DataFrame, order: Sequence[str], author: str = "unknown") -> DataFrame:
    """Whole model text as rows: header, submodel references, submodel bodies with STEP, footer.

    ``placements`` adds ``submodel``, and may carry ``comment``, written as a line of its own
    before its placement.  Rows carry (section, submodel, part_no, o_*, line_no) to sort on when
    written; ``o_*`` are the ``order`` columns, so lines stand in their order, ties by text.
    """
    marks = [f"o_{i}" for i in range(len(order))]
    kinds = [placements.schema[c].dataType.simpleString() for c in order]

    def block(df: DataFrame, section: int, part_no: int, *values: Column) -> DataFrame:
        rows = F.array(
            *[F.struct(F.lit(i).cast("long").alias("line_no"), v.alias("value")) for i, v in enumerate(values)]
        )
        blank = [F.lit(None).cast(k).alias(m) for m, k in zip(marks, kinds, strict=True)]
        return df.select(
            "model", F.lit(section).alias("section"), "submodel", F.lit(part_no).alias("part_no"), *blank, F.inline(rows)
        )

    def header(name: Column, *extra: Column) -> list[Column]:
        return [
            F.concat(F.lit("0 FILE "), name, F.lit(".ldr")),
            F.concat(F.lit("0 "), name),
            F.concat(F.lit("0 Name: "), name, F.lit(".ldr")),
            F.lit(f"0 Author: {author}"),
            *extra,
            F.lit(""),
        ]

    subs = placements.select("model", F.col("submodel").cast("string").alias("submodel")).distinct()
    tops = subs.select("model", F.lit("").alias("submodel")).distinct()
    model, sub = F.col("model").cast("string"), F.col("submodel")
    reference = F.concat_ws(" ", F.lit("1 16 0 0 0"), F.lit(D.ROTATIONS["R0"]), F.concat(sub, F.lit(".ldr")))
    line = F.struct(F.lit(1).cast("long").alias("line_no"), placement_line().alias("value"))
    if "comment" in placements.columns:
        note = F.when(
            F.col("comment") != "", F.struct(F.lit(0).cast("long").alias("line_no"), F.concat(F.lit("0 // "), "comment").alias("value"))
        )
        lines = F.array_compact(F.array(note, line))
    else:
        lines = F.array(line)
    body = placements.select(
        "model",
        F.lit(2).alias("section"),
        F.col("submodel").cast("string").alias("submodel"),
        F.lit(1).alias("part_no"),
        *[F.col(c).alias(m) for c, m in zip(order, marks, strict=True)],
        F.inline(lines),
    )
    blocks = [
        block(tops, 0, 0, *header(model, F.lit("0 !LDRAW_ORG Model"))),
        block(subs, 1, 0, reference),
        block(tops, 1, 1, F.lit("0 NOFILE")).withColumn("submodel", F.lit("~")),
        block(subs, 2, 0, F.lit(""), *header(sub)),
        body,
        block(subs, 2, 2, F.lit("0 STEP"), F.lit("0 NOFILE")),
    ]
    out = blocks[0]
    for b in blocks[1:]:
        out = out.unionByName(b)
    return out
