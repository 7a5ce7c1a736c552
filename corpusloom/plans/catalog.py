"""Registry of named queries and of the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

MODULES = (
    "cleaning",
    "tokens",
    "terms",
    "stats",
    "relational",
    "evaluation",
    "vectors",
    "graph",
    "models",
    "textclass",
)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is already registered")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def load() -> None:
    for module in MODULES:
        import_module(f"corpusloom.plans.{module}")
