"""Hypothesis tests as aggregations.

A test reduces the rows to a contingency table or to distinct values with counts; the
p-values are column expressions on the one result row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saldora.functions.expr import chi2_tail, normal_two_sided
from saldora.operators.rank import (
    group_median, rank_edges, running_sums, values_at_ranks,
)
from saldora.operators.relational import contingency
from saldora.session import local_frame, small

Z95 = 1.959964


def chi2_sf(x: float, dof: int) -> float:
    """Upper tail of the chi-square distribution for integer degrees of freedom."""
    if dof <= 0:
        return 1.0
    if x <= 0:
        return 1.0
    h = x / 2.0
    if dof % 2 == 0:
        terms = [i * math.log(h) - math.lgamma(i + 1) for i in range(dof // 2)]
        return min(1.0, sum(math.exp(t - h) for t in terms))
    terms = [
        (i - 0.5) * math.log(h) - math.lgamma(i + 0.5) for i in range(1, (dof - 1) // 2 + 1)
    ]
    return min(1.0, math.erfc(math.sqrt(h)) + sum(math.exp(t - h) for t in terms))


# ------------------------------------------------------------------ chi-square


def chi_square_cells(cells: DataFrame, correction: bool = True) -> DataFrame:
    """(statistic, dof, n, cramers_v) from non-empty cells (a, b, n).

    Works on the cross-classification of levels, so its size is that of the table, not
    of the data. Empty cells need no row: each adds its expected count E, and the
    expected counts of all cells sum to n. With one degree of freedom |O - E| is equal
    in all four cells, so the Yates statistic needs only that gap and the margins.
    """
    of_a, of_b = Window.partitionBy("a"), Window.partitionBy("b")
    cells = cells.withColumn("n", F.col("n").cast("double"))
    wide = cells.select(
        "a",
        "b",
        "n",
        F.sum("n").over(of_a).alias("ra"),
        F.count(F.lit(1)).over(of_a).alias("ka"),
        F.sum("n").over(of_b).alias("cb"),
        F.count(F.lit(1)).over(of_b).alias("kb"),
        cells.agg(F.sum("n")).scalar().alias("total"),
    ).withColumn("e", F.col("ra") * (F.col("cb") / F.col("total")))
    gap = F.abs(F.col("n") - F.col("e"))
    sums = wide.agg(
        F.max("total").alias("n"),
        F.count_distinct("a").alias("r"),
        F.count_distinct("b").alias("c"),
        F.count(F.lit(1)).alias("cells"),
        F.sum(gap * gap / F.col("e")).alias("plain"),
        F.sum("e").alias("expected"),
        F.max(gap).alias("gap"),
        # each margin once: spread evenly over the cells of its level
        F.sum(F.lit(1.0) / (F.col("ra") * F.col("ka"))).alias("inv_r"),
        F.sum(F.lit(1.0) / (F.col("cb") * F.col("kb"))).alias("inv_c"),
    )
    dof = (F.col("r") - 1) * (F.col("c") - 1)
    empty = F.when(
        F.col("cells") < F.col("r") * F.col("c"), F.col("n") - F.col("expected")
    ).otherwise(F.lit(0.0))
    shifted = F.greatest(F.col("gap") - 0.5, F.lit(0.0))
    yates = shifted * shifted * F.col("n") * F.col("inv_r") * F.col("inv_c")
    stat = F.when(dof == 0, F.lit(0.0))
    if correction:
        stat = stat.when(dof == 1, yates)
    stat = stat.otherwise(F.col("plain") + empty)
    smaller = F.least(F.col("r"), F.col("c")) - 1
    return sums.select(
        stat.alias("statistic"),
        dof.cast("long").alias("dof"),
        F.col("n").cast("long").alias("n"),
        F.sqrt(F.try_divide(stat, F.col("n") * smaller)).alias("cramers_v"),
    )


def chi_square(
    df: DataFrame, a: str | Column, b: str | Column, correction: bool = True
) -> DataFrame:
    """(statistic, dof, n, cramers_v, p): independence of two categorical columns."""
    return chi_square_cells(contingency(df, a, b), correction).withColumn(
        "p", chi2_tail(F.col("statistic"), F.col("dof"))
    )


# --------------------------------------------------------------- Mann-Whitney U


def mann_whitney(df: DataFrame, value: str, group: str | Column, positive) -> DataFrame:
    """(u, n1, n2, rank_biserial, z, p); group 1 holds the rows equal to ``positive``.

    Ties get mid-ranks. ``rank_biserial`` is positive when group 1 is the lower one.
    The p-value is the two-sided normal one with tie and continuity correction.
    """
    g = F.col(group) if isinstance(group, str) else group
    rows = df.select(
        F.col(value).cast("double").alias("v"), (g == F.lit(positive)).alias("one")
    ).filter(F.col("one").isNotNull())
    ranked = running_sums(
        rows, "v",
        {"n1": F.count_if(F.col("one")), "n2": F.count_if(~F.col("one"))},
    )
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    t = n1 + n2
    sums = ranked.agg(
        F.sum(n1 * (F.col("before_n2") + n2 / 2.0)).alias("u"),
        F.max("all_n1").alias("n1"),
        F.max("all_n2").alias("n2"),
        F.sum(t * t * t - t).alias("ties"),
    )
    a, b = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = a + b
    variance = a * b / 12.0 * ((n + 1.0) - F.try_divide(F.col("ties"), n * (n - 1.0)))
    larger = F.greatest(F.col("u"), a * b - F.col("u"))
    return sums.select(
        "u",
        "n1",
        "n2",
        (F.lit(1.0) - F.try_divide(F.col("u") * 2.0, a * b)).alias("rank_biserial"),
        F.try_divide(larger - a * b / 2.0 - 0.5, F.sqrt(variance)).alias("z"),
    ).withColumn("p", normal_two_sided(F.col("z")))


# ------------------------------------------------------------ medians, bootstrap


def median_by_group(df: DataFrame, value: str, group: str, positive) -> DataFrame:
    """(m1, m2, diff): medians of the rows equal and not equal to ``positive``."""
    flagged = df.select(F.col(value), (F.col(group) == F.lit(positive)).alias("__one"))
    medians = group_median(flagged.filter("__one IS NOT NULL"), value, ["__one"], "m")
    one = F.max(F.when(F.col("__one"), F.col("m")))
    two = F.max(F.when(~F.col("__one"), F.col("m")))
    return medians.agg(one.alias("m1"), two.alias("m2")).withColumn(
        "diff", F.col("m1") - F.col("m2")
    )


def bootstrap_median_ranks(
    n: int, resamples: int, rng: np.random.Generator
) -> tuple[np.ndarray, np.ndarray]:
    """Ranks (from 1) whose values average to the median of each bootstrap resample.

    The k-th smallest of n draws with replacement is the value at rank ceil(n U) with
    U the k-th smallest of n uniforms, which is Beta(k, n - k + 1). For even n the next
    uniform order statistic, given the first, is U + (1 - U) Beta(1, n - k).
    """
    k = (n + 1) // 2
    u1 = rng.beta(k, n - k + 1, resamples)
    u2 = u1 if n % 2 else u1 + (1.0 - u1) * rng.beta(1, n - k, resamples)

    def rank(u: np.ndarray) -> np.ndarray:
        return np.clip(np.ceil(n * u), 1, n).astype(np.int64)

    return rank(u1), rank(u2)


def median_diff(
    df: DataFrame,
    value: str,
    group: str,
    positive,
    resamples: int = 1000,
    seed: int = 42,
    level: float = 0.95,
) -> DataFrame:
    """(m1, m2, diff, lo, hi): median difference with a percentile bootstrap interval.

    No resample is built: the driver draws the ranks the resamples' medians have, and
    one selection pass fetches the values at those ranks, which all lie within a few
    sqrt(n) of the middle.
    """
    spark = df.sparkSession
    rows = df.select(
        (F.col(group) == F.lit(positive)).alias("one"), F.col(value).cast("double").alias("v")
    ).filter("one IS NOT NULL")
    edges = small(rank_edges(rows, "v", ["one"]))
    counts = {r["one"]: r["n"] for r in edges.select("one", "n").collect()}
    if set(counts) != {True, False}:
        raise ValueError("both groups need at least one value")
    rng = np.random.default_rng(seed)
    drawn: dict[bool, tuple[np.ndarray, np.ndarray]] = {}
    for g in (True, False):
        n = counts[g]
        r1, r2 = bootstrap_median_ranks(n, resamples, rng)
        # position 0 carries the sample's own median
        drawn[g] = (
            np.concatenate([[(n + 1) // 2], r1]),
            np.concatenate([[n // 2 + 1], r2]),
        )

    def bound(pick) -> str:
        ends = {g: int(pick(np.concatenate(drawn[g]))) for g in drawn}
        return f"CASE WHEN one THEN {ends[True]}L ELSE {ends[False]}L END"

    span = f"array(struct(1 AS slot, {bound(np.min)} AS rmin, {bound(np.max)} AS rmax))"
    needed = [
        (g, int(r)) for g in drawn for r in np.unique(np.concatenate(drawn[g]))
    ]  # at most 2 (resamples + 1) ranks per group
    wanted = local_frame(spark, needed, "one boolean, rank long")
    found = values_at_ranks(rows, "v", ["one"], edges, span).join(
        F.broadcast(wanted), ["one", "rank"]
    )
    at = {(r["one"], r["rank"]): r["value"] for r in found.select("one", "rank", "value").collect()}

    def medians(g: bool) -> np.ndarray:
        low, high = drawn[g]
        return np.array([(at[g, int(a)] + at[g, int(b)]) / 2.0 for a, b in zip(low, high)])

    m1, m2 = medians(True), medians(False)
    diffs = (m1 - m2)[1:]
    tail = (1.0 - level) / 2.0
    lo, hi = np.quantile(diffs, [tail, 1.0 - tail])
    out = [(float(m1[0]), float(m2[0]), float(m1[0] - m2[0]), float(lo), float(hi))]
    return local_frame(spark, out, "m1 double, m2 double, diff double, lo double, hi double")


# ---------------------------------------------------------------- proportions


def two_proportion(
    df: DataFrame, flag: str | Column, outcome: str | Column, z: float = Z95
) -> DataFrame:
    """(p1, p2, n1, n2, diff, lo, hi): rate where the flag holds against where it does not.

    Wald interval with unpooled variance.
    """
    f = F.col(flag) if isinstance(flag, str) else flag
    o = (F.col(outcome) if isinstance(outcome, str) else outcome).cast("double")
    sums = df.agg(
        F.avg(F.when(f, o)).alias("p1"),
        F.avg(F.when(~f, o)).alias("p2"),
        F.count(F.when(f, o)).alias("n1"),
        F.count(F.when(~f, o)).alias("n2"),
    )
    spread = F.sqrt(
        F.col("p1") * (1.0 - F.col("p1")) / F.col("n1")
        + F.col("p2") * (1.0 - F.col("p2")) / F.col("n2")
    )
    diff = F.col("p1") - F.col("p2")
    return sums.select(
        "p1", "p2", "n1", "n2",
        diff.alias("diff"),
        (diff - F.lit(z) * spread).alias("lo"),
        (diff + F.lit(z) * spread).alias("hi"),
    )


# ------------------------------------------------------------------- reporting

# Effect sizes have no published cut-offs; these are the usual ones and a parameter.
EFFECT_CUTS = ((0.1, "negligible"), (0.3, "small"), (0.5, "moderate"))


def effect_label(c: Column | str, cuts: Sequence[tuple[float, str]] = EFFECT_CUTS) -> Column:
    size = F.abs(F.col(c) if isinstance(c, str) else c)
    out = F
    for limit, label in cuts:
        out = out.when(size < limit, F.lit(label))
    return out.when(size.isNotNull(), F.lit("large"))


def chi_row(name: str, test: DataFrame) -> DataFrame:
    return test.select(
        F.lit(name).alias("analysis"),
        F.lit("chi-square").alias("test"),
        "statistic",
        F.lit("cramers_v").alias("effect"),
        F.col("cramers_v").alias("effect_size"),
        F.lit(None).cast("double").alias("ci_low"),
        F.lit(None).cast("double").alias("ci_high"),
        "p",
    )


def rank_row(name: str, test: DataFrame, interval: DataFrame | None = None) -> DataFrame:
    empty = F.lit(None).cast("double")
    return test.select(
        F.lit(name).alias("analysis"),
        F.lit("mann-whitney").alias("test"),
        F.col("u").alias("statistic"),
        F.lit("rank_biserial").alias("effect"),
        F.col("rank_biserial").alias("effect_size"),
        (interval.select("lo").scalar() if interval is not None else empty).alias("ci_low"),
        (interval.select("hi").scalar() if interval is not None else empty).alias("ci_high"),
        "p",
    )


def test_summary(rows: Sequence[DataFrame]) -> DataFrame:
    """One labelled row per analysis."""
    return reduce(DataFrame.unionByName, rows).withColumn(
        "effect_label", effect_label("effect_size")
    )
