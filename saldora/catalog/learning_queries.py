"""Features, splits, preprocessing, models and their interpretation (F1..F18, E10..E13).

Registered model queries use the library's published settings and whole tables.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from saldora.catalog.registry import Book
from saldora.catalog.roles import REF_DATE, track_a, track_b
from saldora.catalog.roles_sql import A, B, key_hash, r, with_roles
from saldora.functions.expr import round_to
from saldora.operators import evaluate as ev
from saldora.operators import features as ft
from saldora.operators import logistic, rules
from saldora.operators import models as md
from saldora.operators.folds import prepare_folds
from saldora.operators.relational import mode_of
from saldora.session import local_frame, materialise, scratch_path

BOOK = Book()
add = BOOK.add


def _r(df, digits, *cols):
    return df.withColumns({c: round_to(c, digits) for c in cols})


def a_features(s, d):
    return ft.track_a_features(track_a(s, d), REF_DATE)


def b_features(s, d):
    return ft.track_b_features(track_b(s, d))


A_NUM = [*ft.TRACK_A.numeric, *ft.TRACK_A.binary]
A_CAT = list(ft.TRACK_A.categorical)
B_NUM = [*ft.TRACK_B.numeric, *ft.TRACK_B.binary]
B_CAT = list(ft.TRACK_B.categorical)

A_FEAT = A + """,
x AS (SELECT *, churn AS label, (last_transaction IS NULL)::INT AS last_transaction_missing_flag FROM a)"""
B_FEAT = B + ",\nx AS (SELECT *, (y = 'yes')::INT AS label FROM b)"


def _numbers(cols, digits=4):
    return ", ".join(f"{r(c if not c.endswith('flag') else c + '::INT', digits)} AS {c}" for c in cols)


def _as_numbers(df, cols, digits=4):
    return df.withColumns({c: round_to(F.col(c).cast("double"), digits) for c in cols})


add("f1_track_a_features", lambda s, d: _as_numbers(a_features(s, d), A_NUM),
    with_roles(A_FEAT, f"SELECT customer_id, label, {_numbers(A_NUM)}, {', '.join(A_CAT)} FROM x"))
add("f2_track_b_features", lambda s, d: _as_numbers(b_features(s, d), B_NUM),
    with_roles(B_FEAT, f"SELECT observation_id, label, {_numbers(B_NUM)}, {', '.join(B_CAT)} FROM x"))


def _split_ctes(key):
    """Exact stratified split and train/test relations."""
    return f""",
  hh AS (SELECT *, {key_hash(key)} AS h FROM x),
  cls AS (SELECT label, count(*)::DOUBLE AS n, (SELECT ceil(0.2::DOUBLE * count(*) - 1e-9) FROM x) AS nt, (SELECT count(*)::DOUBLE FROM x) AS total FROM x GROUP BY 1),
  qf AS (SELECT label, floor(nt * n / total) AS f, nt * n / total - floor(nt * n / total) AS rest, nt FROM cls),
  qq AS (SELECT label, (f + CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= nt - sum(f) OVER () THEN 1 ELSE 0 END)::BIGINT AS quota FROM qf),
  sp AS (SELECT hh.*, row_number() OVER (PARTITION BY hh.label ORDER BY h, {key}) <= quota AS is_test FROM hh JOIN qq USING (label)),
  train AS (SELECT * FROM sp WHERE NOT is_test), test AS (SELECT * FROM sp WHERE is_test)"""


A_SPLIT = A_FEAT + _split_ctes("customer_id")
B_SPLIT = B_FEAT + _split_ctes("observation_id")


def a_split(s, d):
    return ft.stratified_split(a_features(s, d), "label", "customer_id")


def b_split(s, d):
    return ft.stratified_split(b_features(s, d), "label", "observation_id")


add("f3_median_fill", lambda s, d: _r(ft.median_fill(a_split(s, d)[0], A_NUM), 4, "median"),
    with_roles(A_SPLIT, "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {r(f'median({c}::DOUBLE)' if not c.endswith('flag') else f'median({c}::INT)', 4)} AS median FROM train" for c in A_NUM)))
add("f3_median_fill_sparse", lambda s, d: _r(ft.median_fill(b_split(s, d)[0], ["days_since_previous_contact"]), 4, "median"),
    with_roles(B_SPLIT, f"SELECT 'days_since_previous_contact' AS \"column\", {r('median(days_since_previous_contact)', 4)} AS median FROM train"))
add("f4_mode_fill", lambda s, d: mode_of(a_split(s, d)[0], A_CAT),
    with_roles(A_SPLIT, "\nUNION ALL ".join(
        f"(SELECT '{c}' AS \"column\", {c} AS mode FROM train WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)" for c in A_CAT)))


def f5(s, d):
    """Test rows filled and scaled with statistics of the training rows."""
    train, test = a_split(s, d)
    return _r(ft.Preprocessor(ft.TRACK_A).fit(train).scaled(test), 6, *A_NUM).select("customer_id", *A_NUM)


def _f5_sql():
    num = {c: (f"{c}::INT::DOUBLE" if c.endswith("flag") else f"{c}::DOUBLE") for c in A_NUM}
    meds = "md AS (SELECT " + ", ".join(f"median({e}) AS {c}" for c, e in num.items()) + " FROM train)"
    fill = lambda t, name: f"{name} AS (SELECT customer_id, " + ", ".join(
        f"coalesce({t}.{e}, md.{c}) AS {c}" for c, e in num.items()) + f" FROM {t}, md)"
    stats = "st AS (SELECT " + ", ".join(
        f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}" for c in A_NUM) + " FROM ftrain)"
    out = ", ".join(r(f"({c} - m_{c}) / s_{c}", 6) + f" AS {c}" for c in A_NUM)
    return with_roles(A_SPLIT + f",\n{meds},\n{fill('train', 'ftrain')},\n{fill('test', 'ftest')},\n{stats}",
                      f"SELECT customer_id, {out} FROM ftest, st")


add("f5_scaling_with_train_statistics", f5, _f5_sql())


def f6(s, d):
    """Ones per encoded level among the test rows."""
    train, test = a_split(s, d)
    prep = ft.Preprocessor(ft.TRACK_A).fit(train)
    names = F.array(*[F.lit(n) for n in prep.feature_names])
    values = vector_to_array("features")
    cells = prep.transform(test).select(F.explode(F.arrays_zip(names.alias("name"), values.alias("value"))).alias("c"))
    return cells.groupBy(F.col("c.name").alias("feature")).agg(F.sum("c.value").alias("total")).filter(
        F.col("feature").rlike("^(" + "|".join(A_CAT) + ")_"))


MODES_SQL = ", ".join(f"(SELECT {c} FROM train WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS {c}" for c in A_CAT)
add("f6_one_hot", f6, with_roles(A_SPLIT + f", mo AS (SELECT {MODES_SQL})", "\nUNION ALL ".join(
    f"""SELECT '{c}_' || l.{c} AS feature, count(t.v)::DOUBLE AS total FROM (SELECT DISTINCT {c} FROM train WHERE {c} IS NOT NULL) l
    LEFT JOIN (SELECT coalesce(test.{c}, mo.{c}) AS v FROM test, mo) t ON t.v = l.{c} GROUP BY 1""" for c in A_CAT)))
add("f7_stratified_split",
    lambda s, d: ft.with_test_flag(a_features(s, d), "label", "customer_id").select("customer_id", "label", "is_test"),
    with_roles(A_SPLIT, "SELECT customer_id, label, is_test FROM sp"))
add("f7_stratified_split_campaign",
    lambda s, d: ft.with_test_flag(b_features(s, d), "label", "observation_id").select("observation_id", "label", "is_test"),
    with_roles(B_SPLIT, "SELECT observation_id, label, is_test FROM sp"))
add("f8_stratified_folds",
    lambda s, d: ft.stratified_folds(a_split(s, d)[0], "label", "customer_id").select("customer_id", "label", "fold"),
    with_roles(A_SPLIT, "SELECT customer_id, label, (ntile(5) OVER (PARTITION BY label ORDER BY h, customer_id) - 1)::INT AS fold FROM train"))
add("f9_cross_validation", lambda s, d: md.cv_summary(md.cross_validate(a_split(s, d)[0], ft.TRACK_A)))
FOLDED = ", fo AS (SELECT *, (ntile(5) OVER (PARTITION BY label ORDER BY h, {key}) - 1)::INT AS fold FROM train)"


def _fold_preparation(split, spec):
    """(left_out, column, median, mean, deviation, mode, levels) learnt without each fold; -1: all."""
    def run(s, d):
        folded = ft.stratified_folds(split(s, d)[0], "label", spec.key).persist()
        try:
            found = prepare_folds(folded, spec, md.FOLDS)
        finally:
            folded.unpersist()
        rows = []
        for left, p in found.items():
            out = -1 if left is None else left
            rows += [(out, c, p.medians[c], *p.scales[c], None, None) for c in p.numeric]
            rows += [(out, c, None, None, None, p.modes[c], len(p.levels[c])) for c in p.categorical]
        frame = local_frame(s, rows, "left_out int, column string, median double, mean double, deviation double, mode string, levels long")
        # means of values with a few digits lie on ties of any rounding; both sides step off them
        return _r(frame.withColumn("mean", F.col("mean") + 1.7e-8), 6, "median", "mean", "deviation")
    return run


def _fold_preparation_sql(split, spec):
    num = [*spec.numeric, *spec.binary]
    value = lambda c: f"{c}::INT::DOUBLE" if c.endswith("flag") else f"{c}::DOUBLE"
    numbers = " UNION ALL ".join(f"SELECT fold, '{c}' AS c, {value(c)} AS v FROM fo" for c in num)
    levels = " UNION ALL ".join(f"SELECT fold, '{c}' AS c, {c} AS v FROM fo" for c in spec.categorical)
    return with_roles(split + FOLDED.format(key=spec.key) + f"""
  , sets AS (SELECT unnest(range(-1, 5))::INT AS left_out),
  nu AS (SELECT left_out, c, v FROM sets JOIN ({numbers}) ON fold <> left_out),
  me AS (SELECT left_out, c, median(v) AS m FROM nu GROUP BY ALL),
  st AS (SELECT left_out, c, m, avg(coalesce(v, m)) AS a, stddev_pop(coalesce(v, m)) AS s FROM nu JOIN me USING (left_out, c) GROUP BY ALL),
  ca AS (SELECT left_out, c, v, count(*) AS n FROM sets JOIN ({levels}) ON fold <> left_out WHERE v IS NOT NULL GROUP BY ALL)""", f"""
  SELECT left_out, c AS "column", {r('m', 6)} AS median, {r('a + 1.7e-8', 6)} AS mean, {r('CASE WHEN s = 0 THEN 1 ELSE s END', 6)} AS deviation,
    NULL::VARCHAR AS mode, NULL::BIGINT AS levels FROM st
  UNION ALL SELECT left_out, c, NULL, NULL, NULL, first(v ORDER BY n DESC, v), count(*) FROM ca GROUP BY left_out, c""")


add("f9_fold_preparation", _fold_preparation(a_split, ft.TRACK_A), _fold_preparation_sql(A_SPLIT, ft.TRACK_A))
add("f9_fold_preparation_campaign", _fold_preparation(b_split, ft.TRACK_B), _fold_preparation_sql(B_SPLIT, ft.TRACK_B))
add("f10_class_weights", lambda s, d: _r(ft.class_weights(a_split(s, d)[0]), 8, "weight"),
    with_roles(A_SPLIT, f"SELECT label, count(*) AS n, {r('(SELECT count(*) FROM train)::DOUBLE / ((SELECT count(DISTINCT label) FROM train) * count(*))', 8)} AS weight FROM train GROUP BY 1"))


def _split_of(s, d, track):
    return (a_split if track == "a" else b_split)(s, d)


def _fit(train, names, track):
    return md.fit_models(train, ft.TRACK_A if track == "a" else ft.TRACK_B, names=names)


def _fitted(s, d, names=None, track="a"):
    train, test = _split_of(s, d, track)
    return _fit(train, names, track), test


def _quality(name, track="a"):
    def run(s, d):
        fitted, test = _fitted(s, d, [name], track)
        return ev.comparison(ev.evaluate(materialise(md.score_models(fitted, test))))
    return run


add("f11_logistic_regression", _quality(md.LOGISTIC))
add("f12_decision_tree", _quality(md.TREE))
add("f13_random_forest", _quality(md.FOREST))
add("f13_random_forest_campaign", _quality(md.FOREST, "b"))


def _names_sql(spec):
    """Feature names in vector order, as a relation n (g, l, feature) over train."""
    num, cat = [*spec.numeric, *spec.binary], spec.categorical
    fixed = ", ".join(f"({i}, '', '{c}')" for i, c in enumerate(num))
    return f", n AS (SELECT * FROM (VALUES {fixed}) t(g, l, feature) " + " ".join(
        f"UNION ALL SELECT {len(num) + j}, {c}, '{c}_' || {c} FROM train WHERE {c} IS NOT NULL GROUP BY {c}" for j, c in enumerate(cat)) + ")"


def _weighted(train):
    """Training rows with fold 0 and their class weights."""
    train = train.withColumn("fold", F.lit(0))
    return md.weighted_rows(train, md.class_counts(train))[0]


def _optimality(track):
    """Every component of the gradient at the fitted coefficients, which is nought, and whether the
    bound on what the objective lacks is below a millionth of it."""
    def run(s, d):
        train, _ = _split_of(s, d, track)
        found = logistic.certificate(_fit(train, [md.LOGISTIC], track)[md.LOGISTIC].model, _weighted(train))
        return found.select(
            "feature", round_to(F.abs("gradient"), 5).alias("gradient"), (F.col("gap") < 1e-6 * F.col("objective")).alias("closed"))
    return run


for _t, _split, _spec in (("a", A_SPLIT, ft.TRACK_A), ("b", B_SPLIT, ft.TRACK_B)):
    add(f"f11_optimality_{_t}", _optimality(_t), with_roles(_split + _names_sql(_spec), """
  SELECT feature, 0.0::DOUBLE AS gradient, true AS closed FROM n UNION ALL SELECT 'intercept', 0.0, true"""))


def _replay(track):
    """Every node of the fitted tree against the training rows that reach it."""
    def run(s, d):
        train, _ = _split_of(s, d, track)
        tree = _fit(train, [md.TREE], track)[md.TREE]
        found = rules.replay_splits(_weighted(train), rules.export_nodes(tree.model, s), tree.prep.columns())
        differs = lambda a, b: F.count_if(F.abs(F.col(a) - F.col(b)) > 1e-6)
        root = F.max(F.when(F.col("id") == 0, F.col("rows_again")))
        leaves = F.sum(F.when(F.col("gain_again") < 0, F.col("rows_again")).otherwise(0))
        return found.agg(
            root.alias("rows"), leaves.alias("rows_in_leaves"), F.count_if(F.expr("rows != rows_again")).alias("other_rows"),
            F.count_if(F.expr("weights_gap > 1e-6 * rows")).alias("other_weights"), differs("impurity", "impurity_again").alias("other_impurity"),
            differs("gain", "gain_again").alias("other_gain"))
    return run


for _t, _split in (("a", A_SPLIT), ("b", B_SPLIT)):
    add(f"f12_split_replay_{_t}", _replay(_t), with_roles(_split, """
  SELECT count(*) AS rows, count(*) AS rows_in_leaves, 0::BIGINT AS other_rows, 0::BIGINT AS other_weights,
    0::BIGINT AS other_impurity, 0::BIGINT AS other_gain FROM train"""))


def _compiled(name, track):
    """Every test row scored by the compiled pipeline and by the model or the vector of features."""
    def run(s, d):
        fitted, test = _fitted(s, d, [name], track)
        one = fitted[name]
        both = one.prep.transform(test).withColumn("prob", one.probability())
        if name == md.LOGISTIC:
            weights = F.array(*[F.lit(float(w)) for w in one.model.weights])
            margin = F.aggregate(
                F.zip_with(vector_to_array("features"), weights, lambda x, w: x * w), F.lit(float(one.model.intercept)), lambda a, x: a + x)
            again = 1.0 / (1.0 + F.exp(-margin))
        else:
            both = one.model.transform(both)
            again = F.get(vector_to_array("probability"), F.lit(1))
        return both.select(one.key, "label", (F.abs(F.col("prob") - again) < 1e-12).alias("agrees"))
    return run


add("f14_compiled_tree", _compiled(md.TREE, "a"), with_roles(A_SPLIT, "SELECT customer_id, label, true AS agrees FROM test"))
add("f14_compiled_tree_campaign", _compiled(md.TREE, "b"), with_roles(B_SPLIT, "SELECT observation_id, label, true AS agrees FROM test"))
add("f15_compiled_pipeline", _compiled(md.LOGISTIC, "a"), with_roles(A_SPLIT, "SELECT customer_id, label, true AS agrees FROM test"))
add("f15_compiled_pipeline_campaign", _compiled(md.LOGISTIC, "b"), with_roles(B_SPLIT, "SELECT observation_id, label, true AS agrees FROM test"))


def f14(s, d):
    fitted, test = _fitted(s, d, [md.TREE])
    return fitted[md.TREE].score(test)


add("f14_probabilities", f14)


def f15(s, d):
    """Preprocessing and classifier applied as one unit to raw test rows, both tracks."""
    parts = []
    for t in "ab":
        fitted, test = _fitted(s, d, [md.LOGISTIC], t)
        parts.append(fitted[md.LOGISTIC].score(test).agg(
            F.count(F.lit(1)).alias("scored"), F.avg("prob").alias("avg_prob")).select(F.lit(t).alias("track"), "scored", "avg_prob"))
    return parts[0].unionByName(parts[1])


add("f15_preprocess_and_score", f15)


def f16(s, d):
    """All models compared, the best one by average precision marked."""
    fitted, test = _fitted(s, d)
    table = ev.evaluate(materialise(md.score_models(fitted, test)))
    return ev.comparison(table).withColumn("best", F.col("model") == ev.best_model(table).select("model").scalar())


add("f16_model_selection", f16)


def f17(s, d):
    """Three broken feature lists and what the guard says, next to the rows it protects."""
    names = track_b(s, d).columns
    broken = {
        "leak": replace(ft.TRACK_B, numeric=(*ft.TRACK_B.numeric, "duration")),
        "drift": replace(ft.TRACK_B, numeric=ft.TRACK_B.numeric[1:]),
        "missing": replace(ft.TRACK_B, numeric=(*ft.TRACK_B.numeric, "no_such"), allowed=None),
    }
    found = []
    for case, spec in broken.items():
        try:
            ft.check_features(spec, names)
            found.append((case, False))
        except ft.FeatureError:
            found.append((case, True))
    cases = F.array(*[F.struct(F.lit(c).alias("case"), F.lit(x).alias("refused")) for c, x in found])
    return b_features(s, d).agg(F.count(F.lit(1)).alias("rows")).select("rows", F.inline(cases))


add("f17_feature_guard", f17, with_roles(B, """
  SELECT c AS "case", true AS refused, (SELECT count(*) FROM b) AS rows FROM (VALUES ('leak'), ('drift'), ('missing')) t(c)"""))


def f18(s, d):
    spec = ft.leaky_spec(ft.TRACK_B, "duration")
    return md.leaky_benchmark(ft.track_b_features(track_b(s, d), spec), ft.TRACK_B, "duration")


add("f18_leaky_benchmark", f18)


def e10(s, d):
    """Feature names in vector order."""
    prep = ft.Preprocessor(ft.TRACK_A).fit(a_split(s, d)[0])
    names = F.posexplode(F.array(*[F.lit(n) for n in prep.feature_names]))
    rows = a_features(s, d).agg(F.count(F.lit(1)).alias("rows"))
    return rows.select("rows", names).select((F.col("pos") + 1).cast("long").alias("position"), F.col("col").alias("feature"), "rows")


add("e10_feature_names", e10, with_roles(A_SPLIT, f"""
  , n AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{c}', '')" for i, c in enumerate(A_NUM))}) t(g, c, l)
    UNION ALL SELECT {len(A_NUM)}, 'gender', gender FROM train WHERE gender IS NOT NULL GROUP BY 3
    UNION ALL SELECT {len(A_NUM) + 1}, 'occupation', occupation FROM train WHERE occupation IS NOT NULL GROUP BY 3)
  SELECT row_number() OVER (ORDER BY g, l) AS position, CASE WHEN l = '' THEN c ELSE c || '_' || l END AS feature,
    (SELECT count(*) FROM x) AS rows FROM n"""))


def e11(s, d):
    return md.coefficients(_fitted(s, d, [md.LOGISTIC])[0][md.LOGISTIC], s)


def e12(s, d):
    return md.impurity_importance(_fitted(s, d, [md.FOREST])[0][md.FOREST], s)


def e12_replay(s, d):
    """Importances recomputed from the gains of all splits, against the model's."""
    forest = _fitted(s, d, [md.FOREST])[0][md.FOREST]
    again = rules.importance_of(rules.export_nodes(forest.model, s))
    kept = list(enumerate(zip(forest.prep.feature_names, forest.model.featureImportances.toArray())))
    have = local_frame(s, [(i, n, float(x)) for i, (n, x) in kept], "feature int, name string, importance double")
    both = have.join(F.broadcast(again.withColumnRenamed("importance", "again")), "feature", "left")
    return both.select(F.col("name").alias("feature"), (F.abs(F.coalesce("again", F.lit(0.0)) - F.col("importance")) < 1e-9).alias("agrees"))


add("e12_importance_replay", e12_replay, with_roles(A_SPLIT + _names_sql(ft.TRACK_A), "SELECT feature, true AS agrees FROM n"))


def e13(s, d):
    fitted, test = _fitted(s, d, [md.FOREST])
    return md.permutation_importance(fitted[md.FOREST], test, ft.TRACK_A.features)


add("e11_logistic_coefficients", e11)
add("e12_impurity_importance", e12)
add("e13_permutation_importance", e13)


def e13_donors(s, d):
    """Every value is handed on exactly once: sums before and after a shuffle agree."""
    rows = a_features(s, d).select("customer_id", "age", "vintage")
    moved = ev.shuffled_donors(rows, ["age", "vintage"], "customer_id", 7)
    return moved.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("age").alias("age_before"), F.sum("donor.age").alias("age_after"),
        F.sum(F.col("age") * F.col("age")).alias("sq_before"), F.sum(F.col("donor.age") * F.col("donor.age")).alias("sq_after"))


add("e13_shuffled_donors", e13_donors, with_roles(A, """
  SELECT count(*) AS rows, sum(age)::BIGINT AS age_before, sum(age)::BIGINT AS age_after,
    sum(age * age)::BIGINT AS sq_before, sum(age * age)::BIGINT AS sq_after FROM a"""))


def _track_run(features, spec):
    """A whole track in one go, its result tables written as CSV and read back in long form.

    Columns: "table", "row" (what the row is about), measure, value.
    """
    def run(s, d):
        tables = md.read_results(s, md.write_results(md.run_track(features(s, d), spec), scratch_path(s, spec.name)))
        return md.long_results(tables)
    return run


add("f16_track_a_run", _track_run(a_features, ft.TRACK_A))
add("f16_track_b_run", _track_run(b_features, ft.TRACK_B))
