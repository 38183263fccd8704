from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from saldora.operators import evaluate as ev
from saldora.operators import features as ft
from saldora.operators import models as md
from saldora.operators import rules
from saldora.operators.folds import Prepared, prepare_folds
from saldora.operators.resume import Run, RunError
from saldora.session import local_frame, materialise, spread

RNG = np.random.default_rng(3)
SPEC = ft.TrackSpec("toy", "k", ("x1", "x2", "flat"), ("flag",), ("c",))


def _toy(spark, n=400):
    x1, x2 = RNG.normal(0, 1, n), RNG.normal(5, 3, n)
    y = (x1 + 0.3 * x2 + RNG.normal(0, 1, n) > 2.2).astype(int)
    rows = [
        (i, int(y[i]), None if i % 11 == 0 else float(x1[i]), float(x2[i]), 4.0, bool(i % 2),
         None if i % 13 == 0 else "abc"[i % 3])
        for i in range(n)
    ]
    return local_frame(spark, rows, "k long, label int, x1 double, x2 double, flat double, flag boolean, c string")


def test_split_and_folds_are_exact(spark):
    df = _toy(spark)
    train, test = ft.stratified_split(df, "label", "k")
    assert (train.count(), test.count()) == (320, 80)
    assert train.join(test, "k").count() == 0
    pos = df.filter("label = 1").count()
    assert abs(test.filter("label = 1").count() - 0.2 * pos) <= 1
    folds = ft.stratified_folds(train, "label", "k").groupBy("label").pivot("fold", list(range(5))).count().collect()
    for r in folds:
        sizes = [r[str(f)] for f in range(5)]
        assert max(sizes) - min(sizes) <= 1
    assert ft.class_quotas({(0,): 10, (1,): 1}, 0.2) == {(0,): 3, (1,): 0}


def test_preprocessing(spark):
    df = _toy(spark)
    prep = ft.Preprocessor(SPEC).fit(df)
    pdf = df.toPandas()
    assert prep.medians["x1"] == pytest.approx(pdf.x1.median())
    assert prep.modes["c"] == pdf.c.mode()[0]
    assert prep.feature_names == ["x1", "x2", "flat", "flag", "c_a", "c_b", "c_c"]
    out = prep.transform(df).select(vector_to_array("features").alias("f")).toPandas()
    x = np.array(out.f.tolist())
    assert x[:, :2].mean(0) == pytest.approx([0, 0], abs=1e-9)
    assert x[:, :2].std(0) == pytest.approx([1, 1], abs=1e-9)
    assert set(x[:, 2]) == {0.0}
    assert (x[:, 4:].sum(1) == 1).all()
    odd = local_frame(
        spark, [(1, 0, None, None, None, None, "new"), (2, 1, 0.0, 0.0, 4.0, True, None)],
        "k long, label int, x1 double, x2 double, flat double, flag boolean, c string")
    enc = {r["k"]: list(r["f"]) for r in prep.transform(odd).select("k", vector_to_array("features").alias("f")).collect()}
    assert enc[1][4:] == [0.0, 0.0, 0.0]
    assert enc[2][4 + "abc".index(prep.modes["c"])] == 1.0


def test_logistic_matches_newton(spark):
    df = _toy(spark)
    fitted = md.fit_models(df, SPEC, names=[md.LOGISTIC])[md.LOGISTIC]
    pdf = fitted.prep.transform(ft.with_weights(df)).select(
        vector_to_array("features").alias("f"), "label", "weight").toPandas()
    x = np.column_stack([np.array(pdf.f.tolist()), np.ones(len(pdf))])
    y, w = pdf.label.to_numpy(float), pdf.weight.to_numpy()
    ridge = np.ones(x.shape[1])
    ridge[-1] = 0.0
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        grad = x.T @ (w * (p - y)) + ridge * beta
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + np.diag(ridge) + 1e-12 * np.eye(len(beta))
        beta -= np.linalg.solve(hess, grad)
    got = np.append(fitted.model.coefficients.toArray(), fitted.model.intercept)
    assert got[[0, 1, 3]] == pytest.approx(beta[[0, 1, 3]], abs=1e-7)
    assert w.sum() == pytest.approx(len(pdf))


def test_auc_against_spark_ml(spark):
    n = 700
    pdf = pd.DataFrame({"prob": RNG.integers(0, 40, n) / 40.0, "label": RNG.integers(0, 2, n)})
    df = spark.createDataFrame(pdf)
    want = BinaryClassificationEvaluator(rawPredictionCol="prob", numBins=0).evaluate(
        df.withColumn("label", F.col("label").cast("double")))
    assert ev.roc_auc(df).first()[0] == pytest.approx(want, abs=1e-12)
    levels = pdf.groupby("prob").label.agg(["sum", "size"]).sort_index(ascending=False)
    precision = levels["sum"].cumsum() / levels["size"].cumsum()
    ap = (levels["sum"] / levels["sum"].sum() * precision).sum()
    assert ev.average_precision(df).first()[0] == pytest.approx(ap, abs=1e-12)


def test_confusion_edges(spark):
    every = [(1, 0.5), (1, 0.2)]
    df = local_frame(spark, every, "label int, prob double")
    row = ev.add_rates(ev.confusion(df, 0.5)).first()
    assert (row["tp"], row["fn"], row["specificity"], row["sensitivity"]) == (1, 1, None, 0.5)
    assert row["balanced_accuracy"] == 0.5
    none = local_frame(spark, [(0, 0.9), (0, 0.1)], "label int, prob double")
    row = ev.add_rates(ev.confusion(none, 0.95)).first()
    assert (row["precision"], row["recall"], row["f1"], row["sensitivity"]) == (0.0, 0.0, 0.0, None)
    assert ev.threshold_sweep(df).count() == 17


def test_donors_permute_all_rows(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("x"))
    out = ev.shuffled_donors(df, ["k", "x"], "k", seed=1, blocks=10)
    pdf = out.select("k", F.col("donor.k").alias("d"), F.col("donor.x").alias("x")).toPandas()
    assert sorted(pdf.d) == list(range(5000)) and (pdf.x == 3 * pdf.d).all()
    assert abs(np.corrcoef(pdf.k, pdf.d)[0, 1]) < 0.06


def test_no_row_is_its_own_donor(spark):
    """Three hundred rows in two hundred shuffle partitions, and in any number of blocks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        df = spark.range(300).select(F.col("id").alias("k"))
        found = []
        for blocks in (None, 1, 7, 200, 5000):
            out = {r["k"]: r["donor"]["k"] for r in ev.shuffled_donors(df, ["k"], "k", seed=3, blocks=blocks).collect()}
            assert sorted(out.values()) == list(range(300)) and all(k != d for k, d in out.items())
            found.append(out)
        assert all(f == found[0] for f in found)
        assert ev.shuffled_donors(df.limit(1), ["k"], "k", seed=3).first()["donor"]["k"] == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_importance_of_a_constant_is_zero(spark):
    df = _toy(spark)
    fitted = md.fit_models(df, SPEC, names=[md.TREE])[md.TREE]
    out = {r["feature"]: r for r in md.permutation_importance(fitted, df, SPEC.features, repeats=2).collect()}
    assert out["flat"]["importance_mean"] == 0.0 and out["flat"]["importance_std"] == 0.0
    assert out["x1"]["importance_mean"] > 0.05
    assert set(out) == set(SPEC.features)


@pytest.mark.parametrize("name", [md.LOGISTIC, md.TREE, md.FOREST])
def test_importance_equals_scores_of_rows_with_a_donors_column(spark, name):
    df = _toy(spark).persist()
    fitted = md.fit_models(df, SPEC, trees=4, names=[name])[name]
    found = {r["feature"]: r for r in md.permutation_importance(fitted, df, SPEC.features, repeats=2).collect()}
    base = ev.average_precision(fitted.score(df)).first()["pr_auc"]
    moved = [materialise(ev.shuffled_donors(df, SPEC.features, "k", ft.SEED + r)) for r in range(2)]
    for c in SPEC.features:
        drops = [base - ev.average_precision(fitted.score(m.withColumn(c, F.col(f"donor.{c}")))).first()["pr_auc"] for m in moved]
        assert found[c]["importance_mean"] == pytest.approx(np.mean(drops), abs=1e-12)
        assert found[c]["importance_std"] == pytest.approx(np.std(drops), abs=1e-9)
    df.unpersist()


def test_average_precision_reads_its_scores_once(spark):
    """Scores cost far more than their order: the two sides of the running sums share them."""
    seen = spark.sparkContext.accumulator(0)

    def score(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    scores = spark.range(2000).select(
        (F.col("id") % 3).cast("int").alias("m"), (F.col("id") % 2).cast("int").alias("label"), (F.col("id") * 7 % 100 / 100.0).alias("prob"))
    out = ev.average_precision(scores.mapInArrow(score, scores.schema), ["m"], [0.2, 0.5, 0.8]).collect()
    assert len(out) == 3 and seen.value == 2000


def test_whole_track_run(spark):
    out = md.run_track(_toy(spark), SPEC, trees=5, folds=2, repeats=1)
    assert out["sizes"].first()["n_train"] == 320
    assert out["comparison"].count() == 3 and out["thresholds"].count() == 17
    best = out["best"].first()["model"]
    table = {r["model"]: r["pr_auc"] for r in out["comparison"].collect()}
    assert table[best] == max(table.values())
    assert out["cv"].count() == 3
    assert [r["feature"] for r in out["coefficients"].collect()][0] in ("x1", "x2")
    assert abs(sum(r["importance"] for r in out["importance"].collect()) - 1) < 1e-6


def test_feature_guard(spark):
    with pytest.raises(ft.FeatureError, match="leaking"):
        ft.check_features(ft.TrackSpec("t", "k", ("duration",), (), (), ("duration",)), ["duration"])
    spec = ft.leaky_spec(ft.TRACK_B, "duration")
    assert "duration" in ft.check_features(spec, [*spec.features])


def test_stopped_run_continues(spark, tmp_path, monkeypatch):
    """A run that broke late is finished from its folder, without fitting anything again."""
    toy, folder = _toy(spark).persist(), str(tmp_path / "run")
    call = lambda: md.run_track(toy, SPEC, trees=3, folds=2, repeats=1, folder=folder)
    whole = md.permutation_importance

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(md, "permutation_importance", broken)
    with pytest.raises(RuntimeError, match="lost"):
        call()
    monkeypatch.setattr(md, "permutation_importance", whole)
    for name in ("fit_trees", "fit_logistic", "prepare_folds", "stratified_folds", "evaluate"):
        monkeypatch.setattr(md, name, broken)
    out = call()
    assert [r["made"] for r in out["steps"].collect()] == ["permutation"]
    assert out["comparison"].count() == 3 and out["permutation"].count() == len(SPEC.features)
    assert call()["steps"].count() == 0
    with pytest.raises(RunError, match="other settings"):
        md.run_track(toy, SPEC, trees=4, folds=2, repeats=1, folder=folder)
    toy.unpersist()


def test_half_written_steps_are_made_again(spark, tmp_path):
    run = Run(spark, str(tmp_path), {"a": 1})
    spark.range(3).write.parquet(run.path("t"))  # files without an entry
    assert run.table("t", lambda: spark.range(5)).count() == 5
    assert Run(spark, str(tmp_path), {"a": 1}).table("t", lambda: spark.range(9)).count() == 5


def test_fold_preparation_equals_a_fit_without_the_fold(spark):
    folded = _toy(spark).withColumn("fold", (F.col("k") % 4).cast("int")).persist()
    merged = prepare_folds(folded, SPEC, 4)
    for left in (None, 0, 3):
        own = folded if left is None else folded.filter(F.col("fold") != left)
        plain, got = ft.Preprocessor(SPEC).fit(own), merged[left]
        assert got.medians == plain.medians and got.modes == plain.modes
        assert got.feature_names == plain.feature_names
        for c in got.numeric:
            assert got.scales[c] == pytest.approx(plain.stats[c], rel=1e-12, abs=1e-12)
    assert Prepared.from_json(merged[0].to_json()) == merged[0]
    folded.unpersist()


def test_fold_medians_of_skewed_folds(spark):
    """Folds that lie apart: the brackets of their merged sketches differ, some miss and are widened."""
    rows = [(i, i % 2, float(i % 3 * 1000 + i % 7), 1.0 if i % 5 else None, 2.0, True, "a", i % 3) for i in range(600)]
    df = local_frame(spark, rows, "k long, label int, x1 double, x2 double, flat double, flag boolean, c string, fold int")
    merged = prepare_folds(df, SPEC, 3)
    for left, got in merged.items():
        own = sorted(r[2] for r in rows if r[7] != left)
        assert got.medians["x1"] == (own[(len(own) - 1) // 2] + own[len(own) // 2]) / 2
        assert got.medians["x2"] == 1.0


def test_compiled_pipelines_score_like_spark_models(spark):
    df = _toy(spark).persist()
    odd = df.withColumn("c", F.when(F.col("k") % 7 == 0, "new").otherwise(F.col("c")))
    fitted = md.fit_models(df, SPEC, trees=3)
    tree = fitted[md.TREE]
    pairs = tree.score(odd).join(tree.score_by_model(odd, ["k"]).withColumnRenamed("prob", "p"), "k")
    assert pairs.filter(F.abs(F.col("prob") - F.col("p")) > 1e-12).count() == 0
    line = fitted[md.LOGISTIC]
    vectors = line.prep.transform(odd).select("k", vector_to_array("features").alias("x"))
    x = {r["k"]: np.array(r["x"]) for r in vectors.collect()}
    for r in line.score(odd).collect():
        assert r["prob"] == pytest.approx(1 / (1 + np.exp(-(x[r["k"]] @ line.model.weights + line.model.intercept))), abs=1e-12)
    plan = line.score(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "UDF" not in plan
    df.unpersist()


def test_split_replay_and_importance(spark):
    df = _toy(spark).withColumn("fold", F.lit(0)).persist()
    fitted = md.fit_models(df, SPEC, trees=4)
    rows, _ = md.weighted_rows(df, md.class_counts(df))
    tree = fitted[md.TREE]
    found = rules.replay_splits(rows, rules.export_nodes(tree.model, spark), tree.prep.columns()).collect()
    assert len(found) > 10
    for r in found:
        assert r["rows"] == r["rows_again"] and r["weights_gap"] < 1e-6
        assert r["impurity"] == pytest.approx(r["impurity_again"], abs=1e-9)
        assert r["gain"] == pytest.approx(r["gain_again"], abs=1e-9)
    again = rules.importance_of(rules.export_nodes(fitted[md.FOREST].model, spark)).collect()
    want = fitted[md.FOREST].model.featureImportances.toArray()
    assert {r["feature"]: r["importance"] for r in again} == pytest.approx({i: x for i, x in enumerate(want) if x > 0}, abs=1e-9)
    df.unpersist()


def _contacts(spark, n=300):
    """Rows with the features of track B."""
    spec = ft.TRACK_B
    cells = [F.rand(i).alias(c) for i, c in enumerate(spec.numeric)]
    cells += [(F.rand(50 + i) < 0.5).alias(c) for i, c in enumerate(spec.binary)]
    cells += [F.when(F.rand(80 + i) < 0.4, "a").otherwise("b").alias(c) for i, c in enumerate(spec.categorical)]
    frame = spark.range(n).select(
        F.col("id").alias("observation_id"), (F.col("id") % 3 == 0).cast("int").alias("label"), *cells)
    return materialise(frame)


@pytest.mark.parametrize("query", ["f11_optimality_b", "f12_split_replay_b"])
def test_fit_and_check_share_one_split(spark, monkeypatch, query):
    from saldora.catalog import learning_queries as lq

    rows, made, split = _contacts(spark), [], ft.stratified_split
    monkeypatch.setattr(lq, "b_features", lambda s, d: rows)
    monkeypatch.setattr(lq.ft, "stratified_split", lambda *a, **k: made.append(a) or split(*a, **k))
    found = lq.BOOK.queries[query](spark, "").collect()
    assert len(made) == 1
    if query.startswith("f11"):
        assert all(r["gradient"] == 0 and r["closed"] for r in found)
    else:
        assert found[0].asDict() == {
            "rows": 240, "rows_in_leaves": 240, "other_rows": 0, "other_weights": 0, "other_impurity": 0, "other_gain": 0}


def test_tasks_of_a_tree_fit_do_not_grow_with_the_rows(spark):
    for n in (2_000, 20_000):
        sizes = spread(spark.range(n), n, 10, 100).groupBy(F.spark_partition_id()).count().select(F.max("count")).scalar()
        assert spark.range(1).select(sizes).first()[0] <= 110
