"""Pattern checks on generated text as column expressions.

Patterns stay inside the subset Java and RE2 share.  ``d`` makes ``.`` stop only at a
line feed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mortarline import dims as D

Check = Callable[[Column], tuple[Column, Column]]


def matches(text: Column, pattern: str) -> Column:
    return text.rlike(f"(?id){pattern}")


def guarded(text: Column, low: Column, pattern: str) -> Column:
    """Pattern match tried only where a literal it needs occurs in the lower-case text."""
    needed = D.PATTERN_LITERALS.get(pattern)
    if not needed:
        return matches(text, pattern)
    near = F.lit(False)
    for literal in needed:
        near = near | F.contains(low, F.lit(literal))
    return near & matches(text, pattern)


def any_match(text: Column, low: Column, patterns: Sequence[str]) -> Column:
    hit = F.lit(False)
    for p in patterns:
        hit = hit | guarded(text, low, p)
    return hit


def count_matches(text: Column, low: Column, patterns: Sequence[str]) -> Column:
    n = F.lit(0)
    for p in patterns:
        n = n + guarded(text, low, p).cast("int")
    return n


def first_match(text: Column, low: Column, patterns: Sequence[str]) -> Column:
    """Matched text of the first pattern that matches, in the given order."""
    return F.coalesce(
        *[F.when(guarded(text, low, p), F.regexp_extract(text, f"(?id)({p})", 1)) for p in patterns]
    )


def found_keywords(low: Column, keywords: Column | Sequence[str]) -> Column:
    """Keywords contained in a lower-case text, ignoring their case."""
    words = keywords if isinstance(keywords, Column) else F.array(*[F.lit(k) for k in keywords])
    return F.filter(words, lambda w: F.contains(low, F.lower(w)))


def collect_facts(df: DataFrame, response: str = "response", name: str = "_facts") -> DataFrame:
    """Everything the checks need from the text, read once per row.

    The one-element explode is a barrier: later uses of a fact read the struct field
    instead of running the patterns again.
    """
    text, low = F.col(response), F.col("_low")
    facts = F.struct(
        any_match(text, low, D.DIMENSION_PATTERNS).alias("dimensions"),
        F.regexp_extract_all(text, F.lit(D.PART_NUMBER_PATTERN), F.lit(1)).alias("numbers"),
        found_keywords(low, D.PART_KEYWORDS).alias("words"),
        any_match(text, low, D.COLOR_PATTERNS).alias("palette"),
        first_match(text, low, D.RED_FLAG_PATTERNS).alias("flag"),
        count_matches(text, low, D.SECTION_PATTERNS).alias("sections"),
    )
    return (
        df.withColumn("_low", F.lower(response))
        .select(*df.columns, F.explode(F.array(facts)).alias(name))
    )


def check_dimensions(facts: Column) -> tuple[Column, Column]:
    ok = facts["dimensions"]
    return ok, F.when(ok, "Measures are given.").otherwise(
        "No width, depth, height or number of storeys is given."
    )


def check_parts(facts: Column) -> tuple[Column, Column]:
    valid = F.array_sort(F.array_intersect(facts["numbers"], F.array(*[F.lit(p) for p in D.VALID_PARTS])))
    words = facts["words"]
    ok = (F.size(valid) > 0) | (F.size(words) >= 2)
    reason = (
        F.when(F.size(valid) > 0, F.concat(F.lit("Known parts: "), F.array_join(valid, ", "), F.lit(".")))
        .when(F.size(words) >= 2, F.concat(F.lit("Words for parts: "), F.array_join(words, ", "), F.lit(".")))
        .otherwise("Neither known parts nor enough words for parts.")
    )
    return ok, reason


def check_palette(facts: Column) -> tuple[Column, Column]:
    ok = facts["palette"]
    return ok, F.when(ok, "Colours are given.").otherwise(
        "No colours are given."
    )


def check_structure(facts: Column) -> tuple[Column, Column]:
    flag = facts["flag"]
    return flag.isNull(), F.coalesce(
        F.concat(F.lit("Doubtful structure: '"), flag, F.lit("'.")), F.lit("Nothing doubtful in the structure.")
    )


def check_format(facts: Column) -> tuple[Column, Column]:
    ok = facts["sections"] >= 2
    return ok, F.when(ok, "The text has sections or lists.").otherwise(
        "The text has too few sections or lists."
    )


BUILDABILITY_CHECKS: list[tuple[str, Check]] = [
    ("dimensions_present", check_dimensions),
    ("brick_part_references", check_parts),
    ("color_palette_specified", check_palette),
    ("structural_feasibility", check_structure),
    ("format_compliance", check_format),
]


def run_checks(facts: Column, checks: Sequence[tuple[str, Check]] = BUILDABILITY_CHECKS) -> Column:
    """Array of (name, passed, reason), one entry per check in order."""
    entries = []
    for name, check in checks:
        passed, reason = check(facts)
        entries.append(F.struct(F.lit(name).alias("name"), passed.alias("passed"), reason.alias("reason")))
    return F.array(*entries)


def checks_score(facts: Column, checks: Sequence[tuple[str, Check]] = BUILDABILITY_CHECKS) -> Column:
    """Share of passed checks, 4 places."""
    passed = F.lit(0)
    for _, check in checks:
        passed = passed + check(facts)[0].cast("int")
    return F.round(passed / F.lit(float(len(checks))), 4)


def unknown_colors(text: Column, valid: Sequence[int] = D.VALID_COLORS) -> Column:
    """Colour codes named in the text that the palette does not have, sorted."""
    named = F.regexp_extract_all(F.lower(text), F.lit(r"color\s+(?:code\s+)?(\d+)"), F.lit(1))
    codes = F.array_distinct(F.transform(named, lambda c: c.try_cast("int")))
    return F.array_sort(F.array_except(codes, F.array(*[F.lit(c) for c in valid])))


# Evaluators take the fact struct of a response and give a struct(score, details).
Evaluator = Callable[[Column], Column]
_EVALUATORS: dict[str, Evaluator] = {}


def evaluator(name: str) -> Callable[[Evaluator], Evaluator]:
    def keep(fn: Evaluator) -> Evaluator:
        _EVALUATORS[name] = fn
        return fn

    return keep


def registered_evaluators() -> dict[str, Evaluator]:
    return dict(_EVALUATORS)


@evaluator("buildability")
def buildability(facts: Column) -> Column:
    return F.struct(checks_score(facts).alias("score"), run_checks(facts).alias("details"))


def evaluate(df: DataFrame, evaluators: Mapping[str, Evaluator], response: str = "response") -> DataFrame:
    """Add one struct column per evaluator; all share one reading of the text."""
    with_facts = collect_facts(df, response)
    return with_facts.withColumns({name: fn(F.col("_facts")) for name, fn in evaluators.items()}).drop("_facts")
