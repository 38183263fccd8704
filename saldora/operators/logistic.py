"""Class-weighted logistic regression with an L2 penalty, by Newton steps for many models at once.

Every model sees the rows of its folds with its own preparation. A step is one pass over the
rows for all models: a task adds up objective, gradient and Hessian of its rows, the sums of
tasks are added up in two levels, and the driver solves one small system a model. A handful of
passes reaches an optimum that first-order methods need hundreds for; the last pass returns
the certificate: the largest component of the gradient and a bound on what the objective lacks.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldora.operators.folds import Prepared
from saldora.operators.forest import swap_features
from saldora.operators.relational import quoted

MAX_STEPS = 60
# The gradient's largest component relative to the number of rows.
TOLERANCE = 1e-10
_FAN_IN = 64  # sums of tasks that meet in one task


@dataclass
class LinearModel:
    """Coefficients by feature of ``prep`` and the certificate of the fit."""

    prep: Prepared
    weights: np.ndarray
    intercept: float
    objective: float
    gradient: float
    gap: float
    steps: int

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.weights)

    def margin(self) -> Column:
        out = F.lit(float(self.intercept))
        for w, x in zip(self.weights, self.prep.columns()):
            out = out + F.lit(float(w)) * x
        return out

    def probability(self) -> Column:
        """The fitted pipeline, from raw columns to the probability, as one expression."""
        return _logistic(self.margin())

    def packed(self, df: DataFrame, features: Column, keep: Sequence[str]) -> DataFrame:
        """``keep`` columns and ``x``, the features."""
        return df.select(*keep, features.alias("x"))

    def score_swapped(self, df: DataFrame, column: Sequence[int], columns: int, keep: Sequence[str]) -> DataFrame:
        """``keep`` columns, ``column`` and ``prob`` of the row in ``x`` with that column's features from
        ``donor``, a row each; the argument ``column`` says which column each feature comes from."""
        weights, intercept = self.weights, self.intercept

        def swapped(own: np.ndarray, donor: np.ndarray) -> np.ndarray:
            # term by term in the order of ``margin``, so that equal rows score alike to the last bit
            out = np.full((columns, own.shape[1]), float(intercept))
            for w, c, x, y in zip(weights, column, own, donor):
                other = out[c] + w * y if c >= 0 else None
                out += w * x
                if c >= 0:
                    out[c] = other
            return out

        read = lambda x: x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
        margins = swap_features(df, read, swapped, columns, keep)
        return margins.select(*keep, "column", _logistic(F.col("value")).alias("prob"))


def _logistic(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def certificate(model: LinearModel, rows: DataFrame, penalty: float = 1.0) -> DataFrame:
    """(feature, gradient) at the model's coefficients, the intercept last, and on every row the
    (objective, gap): one aggregation of the compiled pipeline over the weighted training rows.

    Independent of how the model was fitted. The objective is strongly convex in the penalised
    coefficients: once the intercept's own gradient is nought, it lacks at most the squared
    gradient over twice the penalty.
    """
    names = [*model.prep.feature_names, "intercept"]
    features = [*model.prep.columns(), F.lit(1.0)]
    p, w, y = model.probability(), F.col("weight"), F.col("label").cast("double")
    margin = model.margin()
    loss = w * (F.when(margin > 0, margin).otherwise(0.0) + F.log1p(F.exp(-F.abs(margin))) - y * margin)
    beta = [*map(float, model.weights), 0.0]
    sums = [F.sum(w * (p - y) * x).alias(f"g{i}") for i, x in enumerate(features)]
    wide = rows.agg(F.sum(loss).alias("loss"), *sums)
    gradient = [F.col(f"g{i}") + F.lit(penalty * b) for i, b in enumerate(beta)]
    gap = sum((g * g for g in gradient[:-1]), F.lit(0.0)) / F.lit(2.0 * penalty)
    cells = F.array(*[F.struct(F.lit(n).alias("feature"), g.alias("gradient")) for n, g in zip(names, gradient)])
    objective = F.col("loss") + F.lit(0.5 * penalty * sum(b * b for b in beta))
    return wide.select(F.inline(cells), objective.alias("objective"), gap.alias("gap"))


def _raw(folded: DataFrame, preps: Mapping[int | None, Prepared]) -> tuple[DataFrame, dict[str, list[str]]]:
    """fold, label, numbers (missing: NaN) and categories (place among all levels, -1 else)."""
    some = next(iter(preps.values()))
    levels = {c: sorted({x for p in preps.values() for x in p.levels[c]}) for c in some.categorical}
    numbers = [F.coalesce(quoted(c).cast("double"), F.lit(float("nan"))) for c in some.numeric]
    # -2: missing, to be filled with each model's mode
    codes = [
        F.when(quoted(c).isNull(), -2)
        .otherwise(F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, levels[c])), quoted(c)), F.lit(0)), F.lit(0)) - 1)
        .cast("int")
        for c in some.categorical
    ]
    none = F.array().cast("array<int>")
    return folded.select(
        F.col("fold").cast("int").alias("fold"), F.col("label").cast("double").alias("label"),
        F.array(*numbers).alias("numbers"), (F.array(*codes) if codes else none).alias("codes"),
    ), levels


def _design(prep: Prepared, levels: Mapping[str, list[str]], numbers: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Feature matrix of a model, its intercept as the last column."""
    median = np.array([prep.medians[c] for c in prep.numeric])
    mean = np.array([prep.scales[c][0] for c in prep.numeric])
    spread = np.array([prep.scales[c][1] for c in prep.numeric])
    parts = [(np.where(np.isnan(numbers), median, numbers) - mean) / spread] if prep.numeric else []
    for j, c in enumerate(prep.categorical):
        own = np.array([levels[c].index(x) for x in prep.levels[c]])
        code = np.where(codes[:, j] == -2, levels[c].index(prep.modes[c]), codes[:, j])
        parts.append((code[:, None] == own[None, :]).astype(float))
    return np.concatenate([*parts, np.ones((len(numbers), 1))], axis=1)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    group = 0
    for batch in batches:
        for model, sums in zip(batch["model"].to_pylist(), batch["sums"]):
            own = sums.values.to_numpy()
            total[model] = total[model] + own if model in total else own
        group = batch["part"][0].as_py() if batch.num_rows else group
    if total:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(total), pa.string()), pa.array([group] * len(total), pa.int32()),
                pa.array(list(total.values()), pa.list_(pa.float64())),
            ],
            names=["model", "part", "sums"],
        )


_SUMS = "model string, part int, sums array<double>"


def _pass(
    rows: DataFrame, preps: dict, levels: dict, class_weights: dict, beta: dict[int | None, np.ndarray]
) -> dict[int | None, np.ndarray]:
    """Per model: objective, gradient and Hessian of the weighted losses, without the penalty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            fold, label = batch["fold"].to_numpy(), batch["label"].to_numpy()
            shape = (batch.num_rows, -1)
            numbers = batch["numbers"].flatten().to_numpy(zero_copy_only=False).reshape(shape)
            codes = batch["codes"].flatten().to_numpy(zero_copy_only=False).reshape(shape)
            for left, prep in preps.items():
                if left not in beta:
                    continue
                own = np.flatnonzero(fold != left) if left is not None else np.arange(len(fold))
                x = _design(prep, levels, numbers[own], codes[own])
                y = label[own]
                weight = np.where(y == 1, class_weights[left][1], class_weights[left][0])
                z = x @ beta[left]
                loss = weight @ (np.logaddexp(0, z) - y * z)
                p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                gradient = x.T @ (weight * (p - y))
                hessian = (x * (weight * p * (1 - p))[:, None]).T @ x
                sums = np.concatenate([[loss], gradient, hessian.ravel()])
                total[left] = total[left] + sums if left in total else sums
        if total:
            from pyspark import TaskContext

            part = TaskContext.get().partitionId() // _FAN_IN
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(["all" if k is None else str(k) for k in total], pa.string()),
                    pa.array([part] * len(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64())),
                ],
                names=["model", "part", "sums"],
            )

    sums = rows.mapInArrow(run, _SUMS).groupBy("part", "model").agg(F.collect_list("sums").alias("x"))
    sums = sums.select("model", "part", F.explode("x").alias("sums")).mapInArrow(_add, _SUMS)
    found: dict = {}
    for r in sums.collect():  # one row per model and _FAN_IN tasks at most
        left = None if r["model"] == "all" else int(r["model"])
        own = np.array(r["sums"])
        found[left] = found[left] + own if left in found else own
    return found


def fit_logistic(
    folded: DataFrame, preps: Mapping[int | None, Prepared], counts: Mapping[tuple[int, int], int],
    penalty: float = 1.0,
) -> dict[int | None, LinearModel]:
    """One model per entry of ``preps`` (the fold it leaves out, None: none), all fitted together.

    ``folded`` has fold, label and the raw features and should be stored by the caller; ``counts``
    the rows by (fold, label). Classes are weighted to balance; the intercept is free of penalty.
    """
    preps = dict(preps)
    rows, levels = _raw(folded, preps)
    class_weights, size = {}, {}
    for left in preps:
        per_class = {y: sum(n for (f, label), n in counts.items() if label == y and f != left) for y in (0, 1)}
        size[left] = sum(per_class.values())
        class_weights[left] = {y: size[left] / (2 * n) if n else 0.0 for y, n in per_class.items()}
    dims = {left: len(p.feature_names) + 1 for left, p in preps.items()}
    at = {left: np.zeros(d) for left, d in dims.items()}
    best: dict = {left: (np.inf, None, None, None) for left in preps}
    step = {left: None for left in preps}
    done: dict[int | None, LinearModel] = {}
    for passes in range(1, MAX_STEPS + 1):
        going = {left: b for left, b in at.items() if left not in done}
        if not going:
            break
        found = _pass(rows, {k: preps[k] for k in going}, levels, class_weights, going)
        for left in going:
            d = dims[left]
            ridge = np.append(np.full(d - 1, penalty), 0.0)
            sums = found[left]
            value = sums[0] + 0.5 * float(ridge @ (at[left] ** 2))
            gradient = sums[1 : d + 1] + ridge * at[left]
            hessian = sums[d + 1 :].reshape(d, d) + np.diag(ridge)
            slack = 1e-12 * max(1.0, abs(value))
            if value > best[left][0] + slack and step[left] is not None:  # too far: half the way
                step[left] = step[left] / 2
                at[left] = best[left][1] + step[left]
                continue
            best[left] = (value, at[left], gradient, hessian)
            move = np.linalg.lstsq(hessian, -gradient, rcond=None)[0]
            largest, decrement = float(np.abs(gradient).max()), float(-gradient @ move) / 2
            if largest <= TOLERANCE * size[left] or passes == MAX_STEPS:
                w = at[left]
                done[left] = LinearModel(preps[left], w[:-1], float(w[-1]), value, largest, max(decrement, 0.0), passes)
            else:
                step[left] = move
                at[left] = at[left] + move
    for left in preps:  # no pass was left to confirm the last move
        if left not in done:
            value, w, gradient, _ = best[left]
            done[left] = LinearModel(preps[left], w[:-1], float(w[-1]), value, float(np.abs(gradient).max()), float("inf"), MAX_STEPS)
    return done
