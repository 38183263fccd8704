"""Class-weighted models of both tracks: cross-validation, scoring, interpretation."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from saldora.operators.evaluate import (
    BLOCK_ROWS, average_precision, best_model, comparison, evaluate, shuffled_donors, threshold_sweep,
)
from saldora.operators.features import (
    SEED, TrackSpec, leaky_spec, stratified_folds, stratified_split, with_test_flag,
)
from saldora.operators.folds import Prepared, prepare, prepare_folds
from saldora.operators.forest import ForestModel, fit_forest
from saldora.operators.logistic import LinearModel, fit_logistic
from saldora.operators.rank import value_splits
from saldora.operators.relational import mean_std, quoted, sort_by_abs
from saldora.operators.resume import Run
from saldora.operators.rules import Node, export_nodes, one_tree, tree_forest, tree_probability
from saldora.session import local_frame, materialise, scratch_path, small, spread
from saldora.sources import write_csv

# Model names and settings.
LOGISTIC = "Logistic Regression"
TREE = "Decision Tree"
FOREST = "Random Forest"
TREE_DEPTH = 6
FOREST_DEPTH = 10
FOREST_TREES = 300
FOLDS = 5
REPEATS = 10
MAX_BINS = 128


# Fits that run side by side; each keeps its own executors' cores busy only in part.
PARALLEL = 8
# Rows a task of a tree fit has at least and at most.
ROWS_PER_TASK = (2_000, 250_000)


@dataclass
class Fitted:
    """A model with the preparation it was trained behind.

    The linear model and the single tree score by one expression over the raw columns; the
    forest in batches of rows, tree by tree.
    """

    name: str
    prep: Prepared
    model: LinearModel | ForestModel | Model
    key: str
    nodes: dict[int, Node] = field(default_factory=dict)

    def probability(self) -> Column:
        """The whole pipeline as an expression, without the forest."""
        if isinstance(self.model, LinearModel):
            return self.model.probability()
        return tree_probability(self.nodes, self.prep.columns())

    def score(self, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
        """``keep`` columns plus ``prob``, the probability of the positive class."""
        keep = keep or [self.key, "label"]
        if isinstance(self.model, LinearModel) or self.nodes:
            return df.select(*keep, self.probability().alias("prob"))
        if isinstance(self.model, ForestModel):
            return self.model.score(df, self.prep.vector(), keep)
        return self.score_by_model(df, keep)

    def score_by_model(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        prob = F.get(vector_to_array("probability"), F.lit(1))
        return self.model.transform(self.prep.transform(df)).select(*keep, prob.alias("prob"))


def class_counts(folded: DataFrame) -> dict[tuple[int, int], int]:
    """Rows by (fold, label)."""
    return {(r["fold"], r["label"]): r["count"] for r in folded.groupBy("fold", "label").count().collect()}


def side_by_side(spark: SparkSession, jobs: Sequence[Callable[[], Any]]) -> list:
    """Results of independent jobs that are submitted together."""
    carry = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=PARALLEL) as pool:
        return list(pool.map(lambda job: job(), [carry(j) for j in jobs]))


def weight_of(counts: Mapping[tuple[int, int], int], left: int | None = None) -> tuple[dict[int, float], int]:
    """The balanced weight of each class outside a fold, and how many rows there are."""
    per_class: dict[int, int] = {}
    for (f, label), n in counts.items():
        if f != left:
            per_class[label] = per_class.get(label, 0) + n
    rows = sum(per_class.values())
    return {y: rows / (len(per_class) * n) for y, n in per_class.items()}, rows


def weighted_rows(folded: DataFrame, counts: Mapping[tuple[int, int], int], left: int | None = None) -> tuple[DataFrame, int]:
    """The rows outside a fold with their balanced class weight, and how many they are."""
    weights, rows = weight_of(counts, left)
    weight = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    own = folded if left is None else folded.filter(F.col("fold") != left)
    return own.withColumn("weight", weight[F.col("label")]), rows


def fit_tree(folded: DataFrame, prep: Prepared, counts: Mapping[tuple[int, int], int], left: int | None, seed: int) -> Model:
    """The single tree of the rows outside fold ``left``."""
    own, rows = weighted_rows(folded, counts, left)
    vectors = prep.transform(own).select("features", "label", "weight")
    vectors = spread(vectors, rows, *ROWS_PER_TASK).persist()
    try:
        return DecisionTreeClassifier(
            featuresCol="features", labelCol="label", weightCol="weight", maxDepth=TREE_DEPTH, maxBins=MAX_BINS, seed=seed,
        ).fit(vectors)
    finally:
        vectors.unpersist()


def fit_trees(
    folded: DataFrame, prep: Prepared, counts: Mapping[tuple[int, int], int], left: int | None,
    trees: int, seed: int, names: Sequence[str], key: str,
) -> dict[str, Model | ForestModel]:
    """The tree models of the rows outside fold ``left``."""
    out: dict[str, Model | ForestModel] = {}
    if TREE in names:
        out[TREE] = fit_tree(folded, prep, counts, left, seed)
    if FOREST in names:
        weight, rows = weight_of(counts, left)
        own = folded if left is None else folded.filter(F.col("fold") != left)
        out[FOREST] = fit_forest(
            own, prep.vector(), "label", weight, rows, [key, "label", *prep.numeric, *prep.categorical],
            trees, FOREST_DEPTH, MAX_BINS, seed)
    return out


def as_fitted(name: str, prep: Prepared, model: LinearModel | ForestModel | Model, key: str, spark: SparkSession) -> Fitted:
    nodes = one_tree(export_nodes(model, spark)) if isinstance(model, DecisionTreeClassificationModel) else {}
    return Fitted(name, prep, model, key, nodes)


def _wanted(names: Sequence[str] | None) -> list[str]:
    return [n for n in (LOGISTIC, TREE, FOREST) if names is None or n in names]


def fit_models(
    train: DataFrame, spec: TrackSpec, trees: int = FOREST_TREES, seed: int = SEED,
    names: Sequence[str] | None = None,
) -> dict[str, Fitted]:
    """Fit preparation and models on the same training rows."""
    wanted = _wanted(names)
    rows = train.select(spec.key, "label", *map(quoted, spec.features), F.lit(0).alias("fold")).persist()
    try:
        prep, counts = prepare(rows, spec), class_counts(rows)
        models: dict[str, Any] = {}
        if LOGISTIC in wanted:
            models[LOGISTIC] = fit_logistic(rows, {None: prep}, counts)[None]
        if set(wanted) - {LOGISTIC}:
            models |= fit_trees(rows, prep, counts, None, trees, seed, wanted, spec.key)
    finally:
        rows.unpersist()
    return {n: as_fitted(n, prep, models[n], spec.key, train.sparkSession) for n in wanted}


def fold_scores(
    folded: DataFrame, spec: TrackSpec, preps: Mapping[int | None, Prepared], linear: Mapping[int | None, LinearModel],
    counts: Mapping[tuple[int, int], int], left: int, trees: int, seed: int, names: Sequence[str],
) -> DataFrame:
    """(model, fold, label, prob): the rows of a fold scored by models that have not seen it."""
    models: dict[str, Any] = {LOGISTIC: linear[left]} if LOGISTIC in names else {}
    if set(names) - {LOGISTIC}:
        models |= fit_trees(folded, preps[left], counts, left, trees, seed, names, spec.key)
    held_out = folded.filter(F.col("fold") == left)
    parts = [
        as_fitted(n, preps[left], m, spec.key, folded.sparkSession).score(held_out, ["label"])
        .select(F.lit(n).alias("model"), F.lit(left).alias("fold"), "label", "prob")
        for n, m in models.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def cross_validate(
    train: DataFrame, spec: TrackSpec, folds: int = FOLDS, trees: int = FOREST_TREES,
    seed: int = SEED, names: Sequence[str] | None = None,
) -> DataFrame:
    """(model, fold, average_precision); every fold has its own preparation.

    The preparations are merges of one set of statistics, the logistic models of all folds are
    fitted in the same passes, and the tree models of several folds side by side.
    """
    wanted, spark = _wanted(names), train.sparkSession
    folded = stratified_folds(train, "label", spec.key, folds, seed).persist()
    try:
        preps, counts = prepare_folds(folded, spec, folds, range(folds)), class_counts(folded)
        linear = fit_logistic(folded, preps, counts) if LOGISTIC in wanted else {}
        parts = side_by_side(spark, [
            lambda f=f: fold_scores(folded, spec, preps, linear, counts, f, trees, seed, wanted) for f in range(folds)
        ])
        scores = reduce(DataFrame.unionByName, parts).persist()
        rows = average_precision(scores, ["model", "fold"]).collect()
        scores.unpersist()
    finally:
        folded.unpersist()
    return local_frame(
        spark, [(r["model"], r["fold"], r["pr_auc"]) for r in rows],
        "model string, fold int, average_precision double",
    )


def cv_summary(scores: DataFrame) -> DataFrame:
    """(model, mean, std) over folds."""
    return mean_std(scores, ["model"], "average_precision")


# ---------------------------------------------------------------- interpretation


def _named(spark, names: Sequence[str], values: Sequence[float], column: str) -> DataFrame:
    return local_frame(
        spark,
        [(n, float(v)) for n, v in zip(names, values, strict=True)],
        f"feature string, {column} double",
    )


def coefficients(fitted: Fitted, spark) -> DataFrame:
    """(feature, coefficient), largest magnitude first."""
    out = _named(spark, fitted.prep.feature_names, fitted.model.coefficients.toArray(), "coefficient")
    return sort_by_abs(out, "coefficient", ["feature"])


def impurity_importance(fitted: Fitted, spark) -> DataFrame:
    """(feature, importance), largest first."""
    values = fitted.model.featureImportances.toArray()
    out = _named(spark, fitted.prep.feature_names, values, "importance")
    return out.orderBy(F.desc("importance"), "feature")


def permutation_importance(
    fitted: Fitted, test: DataFrame, columns: Sequence[str], repeats: int = REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """(feature, importance_mean, importance_std): drop of average precision when one raw
    column is shuffled among the test rows.

    A repeat draws one random permutation of the rows; each row is then scored once per
    column with that column taken from its donor, and all average precisions come from
    one grouped aggregation. Rows go to the model once a repeat, their donor's features
    beside their own.
    """
    spark, columns, prep = test.sparkSession, list(columns), fitted.prep
    model = tree_forest(fitted.nodes, len(prep.feature_names)) if fitted.nodes else fitted.model
    place = {c: i for i, c in enumerate(columns)}
    of = [place.get(c, -1) for c in prep.numeric] + [place.get(c, -1) for c in prep.categorical for _ in prep.levels[c]]
    test = test.select(fitted.key, "label", *columns).persist()
    try:
        # stored for good: over a cached table Spark would not share the shuffle of the scores, and score twice
        rows = materialise(model.packed(test, prep.vector(), [fitted.key, "label"]))
        plain = fitted.score(test, ["label"])
        splits = value_splits(plain, "prob")
        base = average_precision(plain, splits=splits).first()["pr_auc"]
        blocks = max(1, -(-rows.count() // BLOCK_ROWS))
        parts = [
            shuffled_donors(rows, ["x"], fitted.key, seed + r, blocks)
            .select("label", F.lit(r).alias("repeat"), "x", F.col("donor.x").alias("donor"))
            for r in range(repeats)
        ]
        # Many scores per row, so they are aggregated as they come and never stored.
        scores = model.score_swapped(reduce(DataFrame.unionByName, parts), of, len(columns), ["label", "repeat"])
        areas = average_precision(scores, ["column", "repeat"], splits).collect()
        drops = [(columns[x["column"]], x["repeat"], base - x["pr_auc"]) for x in areas]
    finally:
        test.unpersist()
    frame = local_frame(spark, drops, "feature string, repeat int, drop double")
    return (
        mean_std(frame, ["feature"], "drop")
        .withColumnsRenamed({"mean": "importance_mean", "std": "importance_std"})
        .orderBy(F.desc("importance_mean"), "feature")
    )


# --------------------------------------------------------------------- whole track


def score_models(fitted: dict[str, Fitted], test: DataFrame) -> DataFrame:
    """(model, key, label, prob) of all models on the test rows."""
    parts = [
        m.score(test).select(F.lit(n).alias("model"), m.key, "label", "prob")
        for n, m in fitted.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _linear_json(models: Mapping[int | None, LinearModel]) -> str:
    return json.dumps([
        [left, list(m.weights), m.intercept, m.objective, m.gradient, m.gap, m.steps] for left, m in models.items()
    ])


def _linear_from(text: str, preps: Mapping[int | None, Prepared]) -> dict[int | None, LinearModel]:
    return {
        left: LinearModel(preps[left], np.array(w), *rest) for left, w, *rest in json.loads(text)
    }


def run_track(
    features: DataFrame, spec: TrackSpec, trees: int = FOREST_TREES, folds: int = FOLDS,
    repeats: int = REPEATS, seed: int = SEED, names: Sequence[str] | None = None, folder: str | None = None,
) -> dict[str, DataFrame]:
    """Split, cross-validate, fit, compare, sweep thresholds and interpret one track.

    Every split, fold, model and table is a step below ``folder`` (by default a new one in the
    shared scratch space). A run that stopped continues when it is called again with the same
    folder, rows and settings; finished steps are read, not made again.

    Returns result-sized frames: cv, comparison, best, thresholds, permutation, sizes,
    and coefficients and importance of the logistic and forest models.
    """
    spark, wanted = features.sparkSession, _wanted(names)
    seen = features.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*map(quoted, features.columns)).cast("decimal(38,0)")).alias("x")
    ).first()
    run = Run(spark, folder or scratch_path(spark, spec.name), {
        "track": spec.name, "features": spec.features, "trees": trees, "folds": folds, "repeats": repeats,
        "seed": seed, "models": wanted, "rows": seen["n"], "content": str(seen["x"]),
    })
    rows = run.table("rows", lambda: with_test_flag(features, "label", spec.key, seed=seed))
    folded = run.table("folds", lambda: stratified_folds(
        rows.filter(~F.col("is_test")).drop("is_test"), "label", spec.key, folds, seed
    ))
    test, counts = rows.filter("is_test").drop("is_test"), class_counts(folded)
    preps = {
        None if k == "all" else int(k): Prepared.from_json(p) for k, p in json.loads(run.value("preparation", lambda: json.dumps(
            {"all" if k is None else str(k): p.to_json() for k, p in prepare_folds(folded, spec, folds).items()}
        ))).items()
    }
    linear: dict[int | None, LinearModel] = {}
    if LOGISTIC in wanted:
        linear = _linear_from(run.value("logistic", lambda: _linear_json(fit_logistic(folded, preps, counts))), preps)
    jobs = [
        lambda f=f: run.table(f"scores-fold-{f}", lambda: fold_scores(
            folded, spec, preps, linear, counts, f, trees, seed, wanted
        )) for f in range(folds)
    ]
    tree_names = [n for n in wanted if n != LOGISTIC]
    fit = lambda n: fit_trees(folded, preps[None], counts, None, trees, seed, [n], spec.key)[n]
    load = {
        TREE: lambda: run.model("model-tree", lambda: fit(TREE), DecisionTreeClassificationModel.load),
        FOREST: lambda: ForestModel.from_nodes(
            run.table("model-forest", lambda: fit(FOREST).nodes(spark)), len(preps[None].feature_names)),
    }
    jobs += [load[n] for n in tree_names]
    done = side_by_side(spark, jobs)
    areas = run.table("areas", lambda: average_precision(reduce(DataFrame.unionByName, done[:folds]), ["model", "fold"]))
    cv = cv_summary(areas.withColumnRenamed("pr_auc", "average_precision"))
    models = ({LOGISTIC: linear[None]} if LOGISTIC in wanted else {}) | dict(zip(tree_names, done[folds:]))
    fitted = {n: as_fitted(n, preps[None], models[n], spec.key, spark) for n in wanted}
    scores = run.table("scores-test", lambda: score_models(fitted, test))
    evaluated = run.table("evaluation", lambda: evaluate(scores))
    best = best_model(evaluated).first()["model"]
    sweep = run.table("thresholds", lambda: threshold_sweep(scores.filter(F.col("model") == best)))
    permutation = run.table(
        "permutation", lambda: permutation_importance(fitted[best], test, spec.features, repeats, seed)
    )
    n_train = sum(counts.values())
    out = {
        "cv": cv,
        "comparison": comparison(evaluated).withColumn("leaky", F.lit(spec.leaky)),
        "best": local_frame(spark, [(best,)], "model string"),
        "thresholds": sweep.orderBy("threshold"),
        "permutation": permutation.orderBy(F.desc("importance_mean"), "feature"),
        "sizes": local_frame(spark, [(n_train, seen["n"] - n_train)], "n_train long, n_test long"),
        "steps": local_frame(spark, [(x,) for x in run.made], "made string"),
    }
    if LOGISTIC in fitted:
        out["coefficients"] = coefficients(fitted[LOGISTIC], spark)
    if FOREST in fitted:
        out["importance"] = impurity_importance(fitted[FOREST], spark)
    return out


# The result tables of a track run and what their rows are about.
RESULT_KEYS = {
    "cv": "model", "comparison": "model", "thresholds": "threshold", "coefficients": "feature",
    "importance": "feature", "permutation": "feature",
}


def write_results(results: dict[str, DataFrame], folder: str) -> str:
    """The result tables of ``run_track`` as CSV files with a header, one folder each."""
    for name in RESULT_KEYS:
        if name in results:
            write_csv(results[name], f"{folder}/{name}")
    return folder


def read_results(spark, folder: str) -> dict[str, DataFrame]:
    """What ``write_results`` has written; values keep their written form."""
    return {
        name: spark.read.option("header", True).csv(f"{folder}/{name}") for name in RESULT_KEYS
    }


def long_results(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, row, measure, value) of all tables, values as doubles (true is 1)."""
    parts = []
    for name, table in tables.items():
        key = RESULT_KEYS[name]
        measures = [c for c in table.columns if c != key]
        cells = F.array(*[
            F.struct(F.lit(c).alias("measure"), quoted(c).alias("value")) for c in measures
        ])
        parts.append(
            table.select(F.lit(name).alias("table"), F.col(key).cast("string").alias("row"), F.inline(cells))
        )
    value = F.when(F.lower("value") == "true", 1.0).when(F.lower("value") == "false", 0.0)
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("value", F.coalesce(value, F.col("value").try_cast("double")))


def leaky_benchmark(
    features: DataFrame, spec: TrackSpec, column: str, trees: int = FOREST_TREES,
    seed: int = SEED, names: Sequence[str] | None = None,
) -> DataFrame:
    """Comparison table with a leaking column admitted, marked ``leaky``.

    ``features`` must hold that column (``track_b_features(clean, leaky_spec(...))``).
    """
    open_spec = leaky_spec(spec, column)
    train, test = stratified_split(features, "label", spec.key, seed=seed)
    train, test = train.persist(), test.persist()
    try:
        fitted = fit_models(train, open_spec, trees, seed, names)
        out = small(evaluate(materialise(score_models(fitted, test))))
    finally:
        train.unpersist()
        test.unpersist()
    return comparison(out).withColumn("leaky", F.lit(True))
