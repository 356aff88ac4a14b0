"""Registry of named queries: a Spark callable and, where SQL can say it, its check query."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

AREAS = (
    "telemetry", "drift", "quality", "models", "experiments", "retrieval", "layout", "learning", "rollout", "streams",
)

_QUERIES: dict[str, Query] = {}
_CHECKS: dict[str, str] = {}


def register(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = fn
        if check is not None:
            _CHECKS[name] = check
        return fn

    return keep


def check_of(name: str) -> str:
    """The check SQL of a query that is registered already."""
    return _CHECKS[name]


def _load() -> None:
    for area in AREAS:
        importlib.import_module(f"mortarline.plans.{area}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def all_checks() -> dict[str, str]:
    _load()
    return dict(_CHECKS)
