"""Registry of named queries and, where SQL can say the same thing, their SQL form."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from loanloom.sources import views

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None


_QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, over: str = "") -> Callable[[Build], Build]:
    """Register ``build`` under ``name``; ``over`` names the views that ``sql`` needs as CTEs."""

    def register(build: Build) -> Build:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = Query(name, build, views.with_views(sql, over.split()) if sql else None)
        return build

    return register


def registered() -> dict[str, Query]:
    return dict(_QUERIES)
