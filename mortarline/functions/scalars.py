"""Small scalar helpers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def render(template: Column, values: Mapping[str, Column]) -> Column:
    """Literal substitution of ``{{ name }}`` and ``{{name}}``."""
    out = template
    for name, value in values.items():
        for mark in (f"{{{{ {name} }}}}", f"{{{{{name}}}}}"):
            out = F.replace(out, F.lit(mark), value)
    return out


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def context_block(title: Column, style: Column, content: Column) -> Column:
    return F.concat(F.lit("Title: "), title, F.lit("\nStyle: "), style, F.lit("\nContent: "), content)


def message_json(system: Column, user: Column, assistant: Column) -> Column:
    """One chat training line."""
    turns = [("system", system), ("user", user), ("assistant", assistant)]
    return F.to_json(
        F.struct(F.array(*[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in turns]).alias("messages"))
    )
