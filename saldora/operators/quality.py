"""Declarative expectations and profiling.

``expect`` evaluates all row-level checks of a frame in one aggregation; uniqueness and
duplicate checks add one hash aggregate each. Results are data, ``enforce`` raises.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldora.operators.cleaning import duplicate_count, key_is_unique
from saldora.operators.relational import quoted
from saldora.session import local_frame

Result = tuple[str, Column, str, Column]


@dataclass(frozen=True)
class RowCount:
    expected: int

    def name(self) -> str:
        return "row_count"

    def aggregate(self, df: DataFrame) -> Column:
        return F.count(F.lit(1))

    def verdict(self, seen: Column) -> tuple[str, Column]:
        return str(self.expected), seen == self.expected


@dataclass(frozen=True)
class Columns:
    """All names present (more are fine)."""

    names: tuple[str, ...]

    def name(self) -> str:
        return "columns_present"

    def aggregate(self, df: DataFrame) -> Column:
        return F.max(F.lit(len(set(self.names) - set(df.columns))).cast("long"))

    def verdict(self, seen: Column) -> tuple[str, Column]:
        return "0", F.coalesce(seen, F.lit(0)) == 0


@dataclass(frozen=True)
class NotNull:
    column: str

    def name(self) -> str:
        return f"not_null:{self.column}"

    def aggregate(self, df: DataFrame) -> Column:
        return F.count_if(quoted(self.column).isNull())

    def verdict(self, seen: Column) -> tuple[str, Column]:
        return "0", seen == 0


@dataclass(frozen=True)
class Domain:
    column: str
    values: tuple

    def name(self) -> str:
        return f"domain:{self.column}"

    def aggregate(self, df: DataFrame) -> Column:
        c = quoted(self.column)
        return F.count_if(c.isNotNull() & ~c.isin(*self.values))

    def verdict(self, seen: Column) -> tuple[str, Column]:
        return "0", seen == 0


@dataclass(frozen=True)
class MaxValue:
    column: str
    cap: int

    def name(self) -> str:
        return f"max_value:{self.column}"

    def aggregate(self, df: DataFrame) -> Column:
        return F.count_if(quoted(self.column) > self.cap)

    def verdict(self, seen: Column) -> tuple[str, Column]:
        return "0", seen == 0


@dataclass(frozen=True)
class Absent:
    """The marker text occurs nowhere in the column."""

    column: str
    marker: str

    def name(self) -> str:
        return f"absent:{self.column}"

    def aggregate(self, df: DataFrame) -> Column:
        return F.count_if(quoted(self.column).cast("string") == self.marker)

    def verdict(self, seen: Column) -> tuple[str, Column]:
        return "0", seen == 0


@dataclass(frozen=True)
class OfType:
    column: str
    type: str

    def name(self) -> str:
        return f"type:{self.column}"

    def aggregate(self, df: DataFrame) -> Column:
        wrong = df.schema[self.column].dataType.simpleString() != self.type
        return F.max(F.lit(int(wrong)).cast("long"))

    def verdict(self, seen: Column) -> tuple[str, Column]:
        return "0", F.coalesce(seen, F.lit(0)) == 0


@dataclass(frozen=True)
class Implies:
    """Rows that meet ``when`` must meet ``then`` (SQL conditions)."""

    label: str
    when: str
    then: str

    def name(self) -> str:
        return f"implies:{self.label}"

    def aggregate(self, df: DataFrame) -> Column:
        return F.count_if(F.expr(self.when) & ~F.coalesce(F.expr(self.then), F.lit(False)))

    def verdict(self, seen: Column) -> tuple[str, Column]:
        return "0", seen == 0


@dataclass(frozen=True)
class Unique:
    key: str

    def name(self) -> str:
        return f"unique:{self.key}"

    def frame(self, df: DataFrame) -> DataFrame:
        u = key_is_unique(df.select(self.key), self.key)
        return u.select((F.col("rows") - F.col("distinct_keys")).alias("observed"))


@dataclass(frozen=True)
class NoDuplicates:
    def name(self) -> str:
        return "no_duplicates"

    def frame(self, df: DataFrame) -> DataFrame:
        return duplicate_count(df).select(F.col("duplicates").alias("observed"))


def balance_not_null(df: DataFrame) -> list[NotNull]:
    """A NOT NULL check for every column whose name contains 'balance'."""
    return [NotNull(c) for c in df.columns if "balance" in c]


def expect(df: DataFrame, checks: Sequence) -> DataFrame:
    """(check, observed, expected, passed), one row per check.

    ``observed`` counts violations, except for the row count, where it is the count.
    """
    in_row = [c for c in checks if hasattr(c, "aggregate")]
    own = [c for c in checks if hasattr(c, "frame")]
    parts = []
    if in_row:
        seen = df.agg(
            *[c.aggregate(df).cast("long").alias(f"c{i}") for i, c in enumerate(in_row)]
        )
        rows = []
        for i, c in enumerate(in_row):
            expected, ok = c.verdict(F.col(f"c{i}"))
            rows.append(
                F.struct(
                    F.lit(c.name()).alias("check"),
                    F.coalesce(F.col(f"c{i}"), F.lit(0)).alias("observed"),
                    F.lit(expected).alias("expected"),
                    ok.alias("passed"),
                )
            )
        parts.append(seen.select(F.inline(F.array(*rows))))
    for c in own:
        parts.append(
            c.frame(df).select(
                F.lit(c.name()).alias("check"),
                F.col("observed").cast("long").alias("observed"),
                F.lit("0").alias("expected"),
                (F.col("observed") == 0).alias("passed"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


class ExpectationError(AssertionError):
    pass


def enforce(results: DataFrame) -> None:
    """Raise with all failed checks; the caller's process then exits non-zero."""
    failed = results.filter(~F.col("passed")).collect()
    if failed:
        text = "; ".join(
            f"{r['check']}: observed {r['observed']}, expected {r['expected']}" for r in failed
        )
        raise ExpectationError(f"{len(failed)} check(s) failed: {text}")


# ------------------------------------------------------------ track separation

_TRACK_KEYS = {"a": "customer_id", "b": "observation_id"}


def track_of(df: DataFrame) -> str | None:
    """Track a frame belongs to, told by its key column; None for anything else."""
    found = [t for t, k in _TRACK_KEYS.items() if k in df.columns]
    return found[0] if len(found) == 1 else None


def assert_same_track(*dfs: DataFrame) -> str:
    """Refuse to combine frames of the two tracks: they share no customer identity."""
    mixed = any(all(k in df.columns for k in _TRACK_KEYS.values()) for df in dfs)
    tracks = {track_of(df) for df in dfs}
    if mixed or len(tracks) != 1 or None in tracks:
        raise ValueError("frames of different or unknown tracks must not be combined")
    return tracks.pop()


# ------------------------------------------------------------------- profiling


def inventory(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(dataset, rows, columns)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).cast("long").alias("columns")
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """(column, type, missing_pct, distinct_count, min_value, max_value).

    Minimum and maximum are given for numeric columns. Exact distinct counts group the long
    form (column, value), whose copies combine map-side; ``approx=True`` counts with a
    sketch in the pass of the other measures.
    """
    aggs, rows = [F.count(F.lit(1)).alias("__rows")], []
    for i, f in enumerate(df.schema):
        c = quoted(f.name)
        numeric = isinstance(f.dataType, T.NumericType)
        sketch = F.hll_sketch_agg(c.cast("string"), 14)
        distinct = F.hll_sketch_estimate(sketch) if approx else F.lit(None).cast("long")
        aggs += [F.count(c).alias(f"n{i}"), distinct.alias(f"d{i}")]
        if numeric:
            aggs += [
                F.min(c).cast("double").alias(f"lo{i}"),
                F.max(c).cast("double").alias(f"hi{i}"),
            ]
        empty = F.lit(None).cast("double")
        rows.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                (
                    F.try_divide(F.col("__rows") - F.col(f"n{i}"), F.col("__rows")) * 100.0
                ).alias("missing_pct"),
                F.col(f"d{i}").alias("distinct_count"),
                (F.col(f"lo{i}") if numeric else empty).alias("min_value"),
                (F.col(f"hi{i}") if numeric else empty).alias("max_value"),
            )
        )
    measures = df.agg(*aggs).select(F.inline(F.array(*rows)))
    if approx:
        return measures
    counted = distinct_counts(df, df.columns).withColumnRenamed("distinct_count", "__d")
    order = measures.columns
    return (
        measures.join(counted, "column", "left")
        .withColumn("distinct_count", F.coalesce("__d", F.lit(0).cast("long")))
        .select(*order)
    )


# Standard error of a distinct-count sketch of 2^14 registers, relative to the count.
SKETCH_ERROR = 1.04 / 2**7


def sketch_check(df: DataFrame, errors: float = 4.0) -> DataFrame:
    """(column, distinct_count, estimate, within): the sketches of the approximate profile against
    exact counts; ``within`` tells that they differ by no more than ``errors`` standard errors."""
    estimates = profile(df, approx=True).select("column", F.col("distinct_count").alias("estimate"))
    exact = distinct_counts(df, df.columns)
    both = estimates.join(exact, "column", "left").withColumn("distinct_count", F.coalesce("distinct_count", F.lit(0).cast("long")))
    bound = F.col("distinct_count") * (errors * SKETCH_ERROR) + 1
    return both.select("column", "distinct_count", "estimate", (F.abs(F.col("estimate") - F.col("distinct_count")) <= bound).alias("within"))


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, distinct_count) of the columns that hold a value; values by their text."""
    from saldora.operators.relational import long_values

    seen = long_values(df, cols).filter(F.col("value").isNotNull()).distinct()
    return seen.groupBy("column").agg(F.count(F.lit(1)).alias("distinct_count"))


def level_shares(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    """(level, n, pct) of all rows; a NULL level is a level."""
    groups = df.groupBy(quoted(col).alias("level")).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).cast("double"))
    shares = groups.withColumn("pct", F.col("n") / total.scalar() * 100.0)
    if top is None:
        return shares
    return shares.orderBy(F.desc("n"), F.asc_nulls_last("level")).limit(top)


def sentinel_share(df: DataFrame, col: str, value) -> DataFrame:
    return df.agg(F.avg((F.col(col) == F.lit(value)).cast("double")).alias("share"))


def negative_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, negatives)."""
    seen = df.agg(*[F.count_if(quoted(c) < 0).alias(f"c{i}") for i, c in enumerate(cols)])
    return seen.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("negatives"))
                    for i, c in enumerate(cols)
                ]
            )
        )
    )


def skew_audit(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.5, 0.999)
) -> DataFrame:
    """(column, median, p999, max_value): exact quantiles of all columns at once."""
    from saldora.operators.rank import group_quantiles
    from saldora.operators.relational import long_values

    long = long_values(df, cols, cast="double")
    q = group_quantiles(long, "value", ["column"], probs)
    wide = q.groupBy("column").agg(
        F.max(F.when(F.col("prob") == probs[0], F.col("value"))).alias("median"),
        F.max(F.when(F.col("prob") == probs[1], F.col("value"))).alias("p999"),
    )
    tops = long.groupBy("column").agg(F.max("value").alias("max_value"))
    return wide.join(tops, "column")


def high_cardinality(df: DataFrame, cols: Sequence[str], threshold: int) -> DataFrame:
    """(column, distinct_count) of the columns with more levels than the threshold."""
    return distinct_counts(df, cols).filter(F.col("distinct_count") > threshold)


def target_balance(frames: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """(dataset, positive_rate) from a 0/1 target column per dataset."""
    parts = [
        df.agg(F.avg(target.cast("double")).alias("positive_rate")).select(
            F.lit(name).alias("dataset"), "positive_rate"
        )
        for name, (df, target) in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def schema_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """(column, in_a, in_b) over the union of the column names; reads no data."""
    names = sorted(set(a.columns) | set(b.columns))
    rows = [(n, n in a.columns, n in b.columns) for n in names]
    return local_frame(a.sparkSession, rows, "column string, in_a boolean, in_b boolean")


def is_subset(part: DataFrame, whole: DataFrame) -> DataFrame:
    """(same_columns, rows_outside): does every row of ``part`` occur in ``whole``?"""
    same = set(part.columns) == set(whole.columns)
    cols = part.columns
    # Collapse copies on both sides first, so that a row repeated a billion times is
    # one row of the anti join.
    outside = part.groupBy(*[quoted(c) for c in cols]).agg(F.count(F.lit(1)).alias("__n"))
    if same:
        known = whole.select(
            *[quoted(c).alias(f"__w{i}") for i, c in enumerate(cols)]
        ).dropDuplicates()
        match = [quoted(c).eqNullSafe(F.col(f"__w{i}")) for i, c in enumerate(cols)]
        outside = outside.join(known, reduce(lambda x, y: x & y, match), "left_anti")
    return outside.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("rows_outside")).select(
        F.lit(same).alias("same_columns"), "rows_outside"
    )
