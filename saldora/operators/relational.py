"""Grouping, filtering, joining and ordering helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldora.functions.expr import round_to
from saldora.functions.metrics import metric
from saldora.operators.keys import join_keys


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[quoted(c) for c in cols])


def quoted(name: str) -> Column:
    """Column by literal name, also when the name holds dots or is reserved."""
    return F.col("`" + name.replace("`", "``") + "`")


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.select(*[quoted(c).alias(names.get(c, c)) for c in df.columns])


def rate_by(
    df: DataFrame,
    keys: Sequence[str | Column],
    metrics: Mapping[str, str | Column] | Sequence[str],
) -> DataFrame:
    """Metrics at the grain of ``keys``; no keys gives the one global row."""
    if not isinstance(metrics, Mapping):
        metrics = {m: m for m in metrics}
    aggs = [
        (metric(m) if isinstance(m, str) else m).alias(alias) for alias, m in metrics.items()
    ]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def keep_groups(
    groups: DataFrame,
    count: str,
    min_n: int,
    value: str | None = None,
    above: DataFrame | None = None,
) -> DataFrame:
    """HAVING: enough rows, and optionally ``value`` above a one-row frame's value.

    The one-row frame enters as a scalar subquery: evaluated once, no join.
    """
    out = groups.filter(F.col(count) >= min_n)
    if above is not None:
        out = out.filter(F.col(value) > above.scalar())
    return out


def with_overall(df: DataFrame, overall: DataFrame, out: str) -> DataFrame:
    """Attach the single value of a one-row frame to every row."""
    return df.withColumn(out, overall.scalar())


def top_k(df: DataFrame, by: Column, k: int, ties: Sequence[str | Column]) -> DataFrame:
    """First k rows of an order made total by ``ties`` (TakeOrderedAndProject)."""
    tie_cols = [F.col(t).asc_nulls_last() if isinstance(t, str) else t for t in ties]
    return df.orderBy(by, *tie_cols).limit(k)


def sort_by_abs(df: DataFrame, col: str, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.abs(F.col(col)).desc_nulls_last(), *ties)


def best(df: DataFrame, by: str, value: str) -> DataFrame:
    """(value, by) of the row with the largest ``by``; the smallest value wins a tie."""
    low = F.min(F.struct((-F.col(by)).alias("__neg"), F.col(value).alias("__val")))
    return df.agg(low.alias("__m")).select(
        F.col("__m.__val").alias(value), (-F.col("__m.__neg")).alias(by)
    )


def attach(df: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Bring labels back onto rows by key, never by position."""
    return df.join(labels, key, "inner")


def contingency(df: DataFrame, a: str | Column, b: str | Column) -> DataFrame:
    """Non-empty cells (a, b, n); NULL levels are dropped, as in a crosstab."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return (
        df.select(a.alias("a"), b.alias("b"))
        .dropna()
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def long_values(df: DataFrame, cols: Sequence[str], cast: str = "string") -> DataFrame:
    """Unpivot columns into (column, value)."""
    return df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), quoted(c).cast(cast).alias("value"))
                    for c in cols
                ]
            )
        ).alias("__e")
    ).select("__e.*")


def mode_of(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, mode): most frequent non-null level, the smallest one on a tie.

    Counts levels in the map-side combine, so a dominant level costs one row per task.
    """
    counts = (
        long_values(df, cols)
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    first = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("level")))
    return counts.groupBy("column").agg(first["level"].alias("mode"))


def mean_std(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Mean and population standard deviation, e.g. over folds or repeats."""
    aggs = [F.avg(col).alias("mean"), F.stddev_pop(col).alias("std")]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col(col).asc_nulls_last())


def pct_of_total(groups: DataFrame, count: str, total: DataFrame, digits: int = 1) -> DataFrame:
    """Add ``pct``: share of the one-row ``total`` in percent."""
    return groups.withColumn(
        "pct", round_to(F.col(count) / total.scalar() * F.lit(100.0), digits)
    )


def with_group_values(groups: DataFrame, extra: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join two aggregates of the same grain; a NULL group matches itself."""
    return join_keys(groups, extra, keys, "left") if keys else groups.withColumn(
        extra.columns[0], extra.scalar()
    )
