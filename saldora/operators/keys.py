"""Null-safe key handling shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL = "__all"


def keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """With no keys, group everything under one constant key."""
    if keys:
        return df, list(keys)
    return df.withColumn(ALL, F.lit(0)), [ALL]


def quote(name: str) -> str:
    """Column name as an SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def sql_list(names: Sequence[str]) -> str:
    return ", ".join(quote(n) for n in names)


def join_keys(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    never_null: Sequence[str] = (),
) -> DataFrame:
    """Equi-join in which NULL keys match, as they do in GROUP BY.

    Key columns of the left side are kept. Keys named in ``never_null`` are compared
    plainly, so that an existing partitioning by them can be used.
    """
    names = {k: f"__r_{k}" for k in keys}
    same = " AND ".join(
        f"{quote(k)} {'=' if k in never_null else '<=>'} {quote(r)}" for k, r in names.items()
    )
    return left.join(right.withColumnsRenamed(names), F.expr(same), how).drop(*names.values())
