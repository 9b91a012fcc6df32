"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from tallyfield.catalog.views import Tables, with_views

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_SQL: dict[str, str] = {}
_MODULES = (
    "files",
    "columns",
    "relations",
    "summaries",
    "ordered",
    "samples",
    "learning",
    "metrics",
    "analyses",
)


def query(name: str, sql: str | None = None):
    """Register a function of the tables; ``sql`` may use the views by name."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = with_views(sql)
        return fn

    return add


def _load() -> None:
    for module in _MODULES:
        import_module(f"tallyfield.catalog.{module}")


def query_functions() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name to a function of (session, table folder)."""
    _load()

    def bind(fn: Callable[[Tables], DataFrame]):
        return lambda spark, folder: fn(Tables(spark, folder))

    return {name: bind(fn) for name, fn in _QUERIES.items()}


def oracle_texts() -> dict[str, str]:
    """Name to SQL, for the queries that SQL can express."""
    _load()
    return dict(_SQL)
