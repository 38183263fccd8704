"""Preparation of all cross-validation folds from one set of mergeable statistics.

One pass over the training rows gives counts, means, squared deviations, level counts and a
quantile sketch per fold and column. What a model sees that leaves a fold out is a merge of
the other folds' statistics; nothing is fitted again. Medians are exact: the merged sketches
only bracket them, a second pass counts the few distinct values inside the brackets, per fold,
and the counts say whether a bracket held its median (if not it is widened).
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldora.operators.features import FeatureError, TrackSpec
from saldora.operators.rank import running_sums
from saldora.operators.relational import quoted
from saldora.session import materialise

# Size of a quantile sketch: rank errors of a fraction of a percent.
SKETCH = 1000
# Half width of the first bracket, in ranks relative to the number of values.
BRACKET = 0.01


@dataclass(frozen=True)
class Prepared:
    """Fills, scales and levels learnt from some training rows, as column expressions.

    ``medians`` and ``scales`` (mean, deviation) by numeric column, ``modes`` and ``levels`` by
    categorical one. A missing number is the median, a missing category the most frequent one;
    a level never seen in training encodes to zeros.
    """

    numeric: list[str]
    categorical: list[str]
    medians: dict[str, float]
    modes: dict[str, str]
    scales: dict[str, tuple[float, float]]
    levels: dict[str, list[str]]

    @property
    def feature_names(self) -> list[str]:
        return [*self.numeric, *[f"{c}_{x}" for c in self.categorical for x in self.levels[c]]]

    def columns(self) -> list[Column]:
        """One expression per feature, in the order of ``feature_names``."""
        out = []
        for c in self.numeric:
            mean, spread = self.scales[c]
            filled = F.coalesce(quoted(c).cast("double"), F.lit(self.medians[c]))
            out.append((filled - F.lit(mean)) / F.lit(spread))
        for c in self.categorical:
            filled = F.coalesce(quoted(c), F.lit(self.modes[c]))
            out += [F.when(filled == F.lit(x), 1.0).otherwise(0.0) for x in self.levels[c]]
        return out

    def vector(self) -> Column:
        """The array of ``columns``, the levels of a category looked up at once: written out one by one
        they make a method that the JVM does not compile."""
        numbers = len(self.numeric)
        parts = [F.array(*self.columns()[:numbers])] if numbers else []
        for c in self.categorical:
            n = len(self.levels[c])
            own = [x for i, x in enumerate(self.levels[c]) for x in (F.lit(x), F.array(*[F.lit(float(i == j)) for j in range(n)]))]
            filled = F.coalesce(quoted(c), F.lit(self.modes[c]))
            parts.append(F.coalesce(F.try_element_at(F.create_map(*own), filled), F.array(*[F.lit(0.0)] * n)))
        return F.concat(*parts)

    def transform(self, df: DataFrame, out: str = "features") -> DataFrame:
        return df.withColumn(out, array_to_vector(self.vector()))

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> Prepared:
        found = json.loads(text)
        return cls(**{**found, "scales": {c: tuple(x) for c, x in found["scales"].items()}})


def fold_statistics(folded: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """(fold, column, level, n, filled, mean, variance, sketch): one aggregation over the rows.

    Numeric columns have one row a fold (level null, sketch of their values); categorical
    columns one row for each level, null among them.
    """
    none = F.lit(None)
    cells = [
        F.struct(F.lit(c).alias("column"), none.cast("string").alias("level"), quoted(c).cast("double").alias("value"))
        for c in numeric
    ] + [
        F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("level"), none.cast("double").alias("value"))
        for c in categorical
    ]
    return (
        folded.select("fold", F.inline(F.array(*cells)))
        .groupBy("fold", "column", "level")
        .agg(
            F.count(F.lit(1)).alias("n"), F.count("value").alias("filled"), F.avg("value").alias("mean"),
            F.var_pop("value").alias("variance"), F.kll_sketch_agg_double("value", F.lit(SKETCH)).alias("sketch"),
        )
    )


def _brackets(stats: DataFrame, numeric: Sequence[str], left_out: Sequence[int | None], half: float) -> dict[str, tuple[float, float]]:
    """Per column, bounds that should hold the median of every set of folds."""
    sets = F.array(*[F.lit(-1 if f is None else f) for f in left_out])
    merged = (
        stats.where(F.col("column").isin(list(numeric)) & (F.col("filled") > 0))
        .select("column", "fold", "sketch", F.explode(sets).alias("out")).where("out != fold")
        .groupBy("column", "out").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    )
    at = lambda q: F.kll_sketch_get_quantile_double("sketch", F.lit(q))
    bounds = merged.select("column", at(max(0.0, 0.5 - half)).alias("lo"), at(min(1.0, 0.5 + half)).alias("hi"))
    rows = bounds.groupBy("column").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()
    return {r["column"]: (r["lo"], r["hi"]) for r in rows}


def _medians(
    folded: DataFrame, brackets: dict[str, tuple[float, float]], counts: dict, folds: int, left_out: Sequence[int | None]
) -> dict:
    """{(left out, column): median} as far as the brackets hold them: one pass."""
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("column"), quoted(c).cast("double").alias("value"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")
        )
        for c, (lo, hi) in brackets.items()
    ])
    side = F.when(F.col("value") < F.col("lo"), -1).when(F.col("value") > F.col("hi"), 1).otherwise(0)
    # everything outside a bracket is one row a side, from the map side on
    seen = materialise(
        folded.select("fold", F.inline(cells)).where("value is not null")
        .select("fold", "column", side.alias("side"), "value")
        .groupBy("column", "side", F.when(F.col("side") == 0, F.col("value")).alias("v"))
        .agg(*[F.count_if(F.col("fold") == f).alias(f"n{f}") for f in range(folds)])
    )
    below = {r["column"]: r for r in seen.where("side = -1").collect()}
    inside = running_sums(
        seen.where("side = 0"), "v", {f"n{f}": F.sum(f"n{f}") for f in range(folds)}, ["column"]
    )
    wanted = []
    for out in left_out:
        own = [f for f in range(folds) if f != out]
        for c in brackets:
            n = sum(counts[f, c] for f in own)
            under = sum(below[c][f"n{f}"] for f in own) if c in below else 0
            if n:
                wanted.append((c, -1 if out is None else out, (n - 1) // 2 - under, n // 2 - under))
    asked = F.array(*[F.struct(*map(F.lit, w)) for w in wanted])
    each = inside.select("*", F.explode(asked).alias("w")).where(F.col("w.col1") == F.col("column"))
    left_in = lambda name: sum(
        (F.when(F.col("w.col2") == f, 0).otherwise(F.col(f"{name}{f}")) for f in range(folds)), F.lit(0)
    )
    before, own = left_in("before_n"), left_in("n")
    holds = lambda rank: (before <= F.col(rank)) & (before + own > F.col(rank))
    found = (
        each.groupBy("column", F.col("w.col2").alias("out"))
        .agg(F.max(F.when(holds("w.col3"), F.col("v"))).alias("a"), F.max(F.when(holds("w.col4"), F.col("v"))).alias("b"))
        .where("a is not null and b is not null").collect()
    )
    return {(None if r["out"] < 0 else r["out"], r["column"]): (r["a"] + r["b"]) / 2.0 for r in found}


def _merged(parts: Sequence[tuple[int, float, float]]) -> tuple[int, float, float]:
    """Count, mean and sum of squared deviations of several sets together."""
    n, mean, dev = 0, 0.0, 0.0
    for m, x, d in parts:
        if m:
            gap, total = x - mean, n + m
            dev += d + gap * gap * n * m / total
            mean += gap * m / total
            n = total
    return n, mean, dev


def prepare_folds(
    folded: DataFrame, spec: TrackSpec, folds: int, left_out: Sequence[int | None] | None = None
) -> dict[int | None, Prepared]:
    """What is learnt without each fold, and (under None) from all of them.

    ``folded`` needs the columns of ``spec`` and ``fold`` from 0 to ``folds`` - 1, and should be
    stored: it is read once for the statistics and once for the exact medians. ``left_out`` may
    name the wanted preparations only.
    """
    left_out = [None, *range(folds)] if left_out is None else list(left_out)
    numeric, categorical = [*spec.numeric, *spec.binary], list(spec.categorical)
    stats = materialise(fold_statistics(folded.select("fold", *map(quoted, spec.features)), numeric, categorical))
    rows = stats.drop("sketch").collect()  # folds x (numeric columns + levels)
    counts = {(f, c): 0 for f in range(folds) for c in numeric}
    counts |= {(r["fold"], r["column"]): r["filled"] for r in rows if r["column"] in set(numeric)}
    medians: dict = {}
    half = BRACKET
    asked = set(numeric)
    while asked:
        if half < 0.5:
            brackets = {c: b for c, b in _brackets(stats, numeric, left_out, half).items() if c in asked}
        else:
            brackets = {c: (float("-inf"), float("inf")) for c in asked}
        medians |= _medians(folded, brackets, counts, folds, left_out) if brackets else {}
        enough = {c for c in asked if all(
            (out, c) in medians or not sum(counts[f, c] for f in range(folds) if f != out) for out in left_out
        )}
        asked -= enough
        if half >= 0.5:
            break
        half *= 8
    out: dict[int | None, Prepared] = {}
    for left in left_out:
        own = [r for r in rows if r["fold"] != left]
        empty = sorted(c for c in numeric if (left, c) not in medians)
        if empty:
            raise FeatureError(f"no value to impute from: {empty}")
        scales, modes, levels = {}, {}, {}
        for c in numeric:
            mine = [r for r in own if r["column"] == c]
            given = [(r["filled"], r["mean"], r["variance"] * r["filled"]) for r in mine if r["filled"]]
            filled = sum(r["n"] - r["filled"] for r in mine), medians[left, c], 0.0
            n, mean, dev = _merged([*given, filled])
            scales[c] = (mean, (max(dev, 0.0) / n) ** 0.5 or 1.0)
        for c in categorical:
            n_level: dict[str, int] = {}
            for r in own:
                if r["column"] == c and r["level"] is not None:
                    n_level[r["level"]] = n_level.get(r["level"], 0) + r["n"]
            if not n_level:
                raise FeatureError(f"no value to impute from: {[c]}")
            modes[c] = min(n_level, key=lambda x: (-n_level[x], x.encode()))
            levels[c] = sorted(n_level, key=str.encode)
        out[left] = Prepared(
            numeric, categorical, {c: medians[left, c] for c in numeric}, modes, scales, levels
        )
    return out


def prepare(train: DataFrame, spec: TrackSpec) -> Prepared:
    """What is learnt from all rows of ``train``."""
    whole = train.select(F.lit(0).alias("fold"), *map(quoted, spec.features))
    return prepare_folds(whole, spec, 1, [None])[None]
