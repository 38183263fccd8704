"""All registered queries, collected from the themed modules."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = [
    "data", "checks", "relations", "questions", "tests", "clusters", "learning", "scoring",
]


class Book:
    """Queries of one theme with their oracle SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracle: dict[str, str] = {}

    def add(self, name: str, query: Query, sql: str | None = None) -> None:
        if name in self.queries:
            raise KeyError(f"query {name!r} registered twice")
        self.queries[name] = query
        if sql is not None:
            self.oracle[name] = sql


def _books() -> list[Book]:
    return [import_module(f"saldora.catalog.{m}_queries").BOOK for m in _MODULES]


def _merge(field: str) -> dict:
    out: dict = {}
    for book in _books():
        part = getattr(book, field)
        clash = set(out) & set(part)
        if clash:
            raise KeyError(f"registered twice: {sorted(clash)}")
        out.update(part)
    return out


def queries() -> dict[str, Query]:
    return _merge("queries")


def oracle_sql() -> dict[str, str]:
    return _merge("oracle")
