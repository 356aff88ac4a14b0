"""Quality rules with robust multivariate outliers, built from Spark's own functions alone.

A document's statistics give a short vector of transformed values.  For every language and
source the minimum-covariance-determinant estimate is sought: the centre and scatter of the
share ``core`` of the rows whose scatter has the least determinant.  Concentration steps
(distances to the current estimate, the closest rows, their mean and scatter) start from two
fixed points, the medians and the plain moments, and the smaller determinant wins.  The scatter of a core is
widened by the factor that makes it that of all rows of a normal sample, and rows farther from the
centre than a chi-square bound are rejected.

Vectors are fixed-point integers, so sums are exact and the verdict does not depend on the
order of rows.  Ranks of distances come from counts over a logarithmic scale, whose number of
levels does not grow with the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mortarline.llm.text import SPACE, WORD
from mortarline.session import cut_lineage

SYMBOLS = "#*$%&|<>"
#: Units per 1.0 of a vector's values.
SCALE = 1024
#: Steps per power of e on the scale of distances.
LEVELS = 64
#: Names of the vector's values and the least spread each is taken to have.
SPREADS = {"x_length": 0.35, "x_word": 0.10, "x_symbol": 0.08, "x_line": 0.15, "x_repeat": 0.12}
AXES = tuple(SPREADS)
#: A single symbol, repeated line or repeated window is at least so many spreads wide, so it rejects nothing alone.
EVENT_SPREADS = 3.0


def text_facts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long) to the rows.

    A null text has no word and one line.  Windows of five words are compared by hash first; only texts
    in which two hashes agree compare the words themselves.
    """
    # arrays pass through one-row generators, so that each is computed once and not once per use
    words = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD), F.lit(0))
    base = docs.select("*", F.explode(F.array(F.struct(words.alias("words")))).alias("_a"))
    w = F.col("_a.words")
    last = F.size(w) - 4
    starts = F.sequence(F.lit(0), last - 1)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(5)]))
    hashes = F.when(last > 0, hashes).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = base.select("*", F.explode(F.array(F.struct(hashes.alias("h"), lines.alias("lines")))).alias("_b"))
    h = F.col("_b.h")
    keyed = F.array_sort(
        F.transform(starts, lambda i: F.struct(F.concat_ws(" ", *[F.get(w, i + k) for k in range(5)]).alias("k"), i.alias("i")))
    )
    keyed = F.when(F.size(h) > F.size(F.array_distinct(h)), keyed)
    base = base.select("*", F.explode(F.array(F.struct(keyed.alias("s")))).alias("_c"))
    s = F.col("_c.s")
    twice = F.filter(
        s, lambda x, i: (F.get(s, i + 1)["k"] == x["k"]) | (F.get(s, i - 1)["k"] == x["k"])
    )
    found = F.array_sort(F.transform(twice, lambda x: x["i"]))
    base = base.select("*", F.explode(F.array(F.struct(found.alias("p")))).alias("_d"))
    p = F.col("_d.p")
    covered = F.aggregate(
        p,
        F.struct(F.lit(0).alias("n"), F.lit(-5).alias("at")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(5), i - acc["at"])).alias("n"), i.alias("at")),
    )["n"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    return base.select(
        *[F.col(c) for c in docs.columns],
        F.size(w).cast("long").alias("n_words"),
        F.length(F.regexp_replace(text, SPACE + "+", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_b.lines").cast("long").alias("n_lines"),
        (F.size("_b.lines") - F.size(F.array_distinct("_b.lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def _vector() -> list[Column]:
    """Transformed statistics in units of 1 / SCALE; small counts are drawn to usual values."""
    n, chars = F.col("n_words"), F.col("word_chars")
    values = {
        "x_length": F.log1p(F.log1p(n.cast("double"))) * 2,
        "x_word": F.log((chars + 60.0) / (n + 12.0)),
        "x_symbol": F.sqrt(F.col("n_symbols") / (chars + 60.0)),
        "x_line": F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 8.0)),
        "x_repeat": F.sqrt(F.col("n_repeat_words") / (n + 12.0)),
    }
    # squares of what one symbol, one repeated line and one repeated window (ten words, in two places) make
    events = {"v_2": 1.0 / (chars + 60.0), "v_3": 1.0 / (F.col("n_lines") + 8.0), "v_4": 10.0 / (n + 12.0)}
    return [
        *[F.round(values[a] * SCALE).cast("long").alias(a) for a in AXES],
        *[F.round(v * SCALE * SCALE).cast("long").alias(k) for k, v in events.items()],
    ]


#: Columns of ``_vector`` beside the axes, by the place of their axis.
EVENTS = {2: "v_2", 3: "v_3", 4: "v_4"}


def _root(cov: dict[tuple[int, int], Column]) -> list[Column]:
    """Entries of the lower triangular root (Cholesky) of a symmetric matrix, row by row."""
    low: dict[tuple[int, int], Column] = {}
    out = []
    for i in range(len(AXES)):
        for j in range(i + 1):
            rest = cov[j, i]
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            low[i, j] = F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l_{j}_{j}")
            out.append(low[i, j].alias(f"l_{i}_{j}"))
    return out


def _core_factor(core: float) -> float:
    """Variance of a normal sample over that of its share ``core`` of least distance, in five dimensions."""
    def below(x: float, more: float = 0.0) -> float:
        # chi-square distribution with five degrees of freedom, or seven with ``more`` 1
        return math.erf(math.sqrt(x / 2)) - math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * (1 + x / 3 + more * x * x / 15)

    low, high = 0.0, 100.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < core else (low, middle)
    return core / below(high, 1.0)


def _with_root(moments: DataFrame, group: list[str], prior_rows: float, widen: float = 1.0) -> DataFrame:
    """Centre, root and log determinant from sums; the least spreads count as ``prior_rows`` more rows.

    Scatter is multiplied by ``widen``.  What stays at any size is the resolution: rounding, and for counted axes the mean
    square of one event over ``EVENT_SPREADS`` squared.
    """
    d, n = len(AXES), F.col("n").cast("double")
    centre = [(F.col(f"s_{i}") / n / SCALE).alias(f"m_{i}") for i in range(d)]
    keep = n / (n + prior_rows)
    cov = {}
    for j in range(d):
        for i in range(j, d):
            c = (F.col(f"q_{j}_{i}") / n - F.col(f"s_{j}") / n * F.col(f"s_{i}") / n) / SCALE / SCALE
            cov[j, i] = c * widen * keep
            if i == j:
                event = F.col(EVENTS[i]) / n / EVENT_SPREADS**2 if i in EVENTS else F.lit(1.0)
                cov[j, i] = F.greatest(cov[j, i] + (1 - keep) * list(SPREADS.values())[i] ** 2, event / SCALE / SCALE)
    out = moments.select(*group, *centre, *[c.alias(f"c_{j}_{i}") for (j, i), c in cov.items()])
    named = {k: F.col(f"c_{k[0]}_{k[1]}") for k in cov}
    # each entry needs the ones before it
    for entry in _root(named):
        out = out.select("*", entry)
    logs = sum((F.log(f"l_{i}_{i}") for i in range(d)), F.lit(0.0))
    return out.select(*group, *[f"m_{i}" for i in range(d)], *[f"l_{i}_{j}" for i in range(d) for j in range(i + 1)], logs.alias("log_det"))


def _distance(rows: DataFrame) -> DataFrame:
    """Add ``d2``, the squared Mahalanobis distance, by forward substitution."""
    for i, a in enumerate(AXES):
        z = F.col(a) / SCALE - F.col(f"m_{i}")
        for k in range(i):
            z = z - F.col(f"l_{i}_{k}") * F.col(f"z_{k}")
        rows = rows.withColumn(f"z_{i}", z / F.col(f"l_{i}_{i}"))
    return rows.withColumn("d2", sum((F.col(f"z_{i}") * F.col(f"z_{i}") for i in range(len(AXES))), F.lit(0.0)))


def _moments(rows: DataFrame, group: list[str]) -> DataFrame:
    d = len(AXES)
    return rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(a).alias(f"s_{i}") for i, a in enumerate(AXES)],
        *[F.sum(F.col(AXES[j]) * F.col(AXES[i])).alias(f"q_{j}_{i}") for j in range(d) for i in range(j, d)],
        *[F.sum(v).alias(v) for v in EVENTS.values()],
    )


def _joined(rows: DataFrame, estimate: DataFrame, group: list[str]) -> DataFrame:
    named = estimate.select(*[F.col(g).alias(f"_{g}") for g in group], *[c for c in estimate.columns if c not in group])
    on = F.lit(True)
    for g in group:
        if g in rows.columns:
            on = on & F.col(g).eqNullSafe(F.col(f"_{g}"))
    keep_new = [F.col(f"_{g}").alias(g) for g in group if g not in rows.columns]
    joined = rows.join(named, on)
    return joined.select(*rows.columns, *keep_new, *[c for c in estimate.columns if c not in group])


def _levels() -> Column:
    return F.floor(F.log(F.col("d2") + 1e-6) * LEVELS).cast("int")


def robust_estimates(rows: DataFrame, group: list[str], core: float, steps: int, prior_rows: float) -> DataFrame:
    """(group, centre, root, log_det): the estimate of least determinant per group."""
    q = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(v).alias(v) for v in EVENTS.values()],
        *[F.percentile(a, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"p_{i}") for i, a in enumerate(AXES)]
    )
    d = len(AXES)
    # sums that give the medians and quartile spreads back as moments
    medians = q.select(
        *group, F.lit(0).alias("start"), "n",
        *[(F.col(f"p_{i}")[1] * F.col("n")).alias(f"s_{i}") for i in range(d)],
        *[
            (F.col("n") * (F.col(f"p_{j}")[1] * F.col(f"p_{i}")[1]
                           + (F.pow((F.col(f"p_{i}")[2] - F.col(f"p_{i}")[0]) / 1.349, 2) if i == j else F.lit(0.0)))).alias(f"q_{j}_{i}")
            for j in range(d) for i in range(j, d)
        ],
        *EVENTS.values(),
    )
    plain = _moments(rows, group).withColumn("start", F.lit(1))
    keys = [*group, "start"]
    estimate = cut_lineage(_with_root(medians.unionByName(plain), keys, prior_rows))
    for _ in range(steps):
        measured = _distance(_joined(rows, estimate, keys)).withColumn("level", _levels())
        edge = measured.groupBy(*keys).agg(F.percentile("level", F.lit(core)).alias("edge"))
        close = _joined(measured.select(*keys, *AXES, *EVENTS.values(), "level"), edge, keys).where("level <= edge")
        estimate = cut_lineage(_with_root(_moments(close, keys), keys, prior_rows, _core_factor(core)))
    values = F.struct(*[c for c in estimate.columns if c not in keys])
    best = estimate.groupBy(*group).agg(F.min_by(values, F.struct("log_det", "start")).alias("e"))
    return best.select(*group, "e.*")


#: 99.9 % of the chi-square distribution with five degrees of freedom.
CHI2_FAR = 20.515


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_cols: tuple[str, ...] = ("lang", "source"),
    core: float = 0.75,
    steps: int = 4,
    prior_rows: float = 30.0,
    far: float = CHI2_FAR,
) -> DataFrame:
    """Rows (id, groups, facts, base_failed, distance2, kept), one per document.

    ``kept`` is false where the base rules fail (under 10 words, or over 20 % of the words in repeated
    windows) or the squared distance is over ``far``.  Estimates use rows
    that pass the base rules; a group with none rejects nothing further.  Null languages and sources are
    groups of their own.  Small groups lean on the least spreads, by a weight that falls with their rows,
    so a group of one row keeps it.  Null and empty texts fail the base rules.  Repeated rows count as
    often as they occur.  An empty table gives an empty result.
    """
    groups = [f"g_{i}" for i in range(len(group_cols))]
    named = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(g) for c, g in zip(group_cols, groups, strict=True)]
    )
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    facts = text_facts(named, "id", "text").drop("text").withColumn("base_failed", failed)
    facts = cut_lineage(facts.select("*", *_vector()))
    estimates = robust_estimates(facts.where("NOT base_failed").select(*groups, *AXES, *EVENTS.values()), groups, core, steps, prior_rows)
    on = F.lit(True)
    for g in groups:
        on = on & F.col(g).eqNullSafe(F.col(f"_{g}"))
    joined = facts.join(estimates.select(*[F.col(g).alias(f"_{g}") for g in groups], *[c for c in estimates.columns if c not in groups]), on, "left")
    return _distance(joined).withColumnRenamed("d2", "distance2").select(
        "id", *[F.col(g).alias(f"group_{i}") for i, g in enumerate(groups)],
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "distance2",
        (~F.col("base_failed") & (F.coalesce("distance2", F.lit(0.0)) <= far)).alias("kept"),
    )
