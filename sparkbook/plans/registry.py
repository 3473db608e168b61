"""Query registry: each named query keeps its Spark builder and, where the
semantics are SQL-expressible, the DuckDB oracle text side by side."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    doc: str


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql, (fn.__doc__ or "").strip())
        return fn

    return deco
