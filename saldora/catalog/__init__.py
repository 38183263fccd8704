"""Registered queries on the test tables and their SQL twins."""

from __future__ import annotations

from saldora.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
