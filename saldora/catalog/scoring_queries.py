"""Evaluation of scores E1..E9, E14..E16 on a deterministic stand-in score."""

from __future__ import annotations

from pyspark.sql import functions as F

from saldora.catalog.registry import Book
from saldora.catalog.roles import stand_in_scores, track_b
from saldora.catalog.roles_sql import B, SCORES, r, with_roles
from saldora.functions.expr import Band, round_to
from saldora.operators import evaluate as ev

BOOK = Book()
add = BOOK.add


def _r(df, digits, *cols):
    return df.withColumns({c: round_to(c, digits) for c in cols})


def _rates_sql(digits=6):
    return f"""{r('coalesce(tp / nullif(tp + fp, 0), 0)', digits)} AS precision, {r('coalesce(tp / nullif(tp + fn, 0), 0)', digits)} AS recall,
      {r('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)', digits)} AS f1, {r('tp / nullif(tp + fn, 0)', digits)} AS sensitivity,
      {r('tn / nullif(tn + fp, 0)', digits)} AS specificity,
      {r('(tp / nullif(tp + fn, 0) + tn / nullif(tn + fp, 0)) / 2', digits)} AS balanced_accuracy"""


COUNTS = """count(*) FILTER (prob < t AND label = 0)::DOUBLE AS tn, count(*) FILTER (prob >= t AND label = 0)::DOUBLE AS fp,
  count(*) FILTER (prob < t AND label = 1)::DOUBLE AS fn, count(*) FILTER (prob >= t AND label = 1)::DOUBLE AS tp"""
TS = "(VALUES " + ", ".join(f"({t}::DOUBLE)" for t in ev.THRESHOLDS) + ") th(t)"
SWEEP = f"c AS (SELECT t, {COUNTS} FROM s, {TS} GROUP BY t)"
INTS = "tn::BIGINT AS tn, fp::BIGINT AS fp, fn::BIGINT AS fn, tp::BIGINT AS tp"

add("e1_confusion", lambda s, d: ev.confusion(stand_in_scores(s, d), 0.5),
    with_roles(SCORES, f"SELECT t AS threshold, {INTS} FROM (SELECT t, {COUNTS} FROM s, (SELECT 0.5::DOUBLE AS t) GROUP BY t)"))
AUC = """, ranked AS (SELECT label, prob, rank() OVER (ORDER BY prob) + (count(*) OVER (PARTITION BY prob) - 1) / 2.0 AS rk FROM s),
  auc AS (SELECT (sum(rk) FILTER (label = 1) - p * (p + 1) / 2) / (p * q) AS roc_auc FROM ranked,
    (SELECT count(*) FILTER (label = 1)::DOUBLE AS p, count(*) FILTER (label = 0)::DOUBLE AS q FROM s) GROUP BY p, q)"""
AP = """, lv AS (SELECT prob, count(*) FILTER (label = 1)::DOUBLE AS k, count(*)::DOUBLE AS n FROM s GROUP BY 1),
  cum AS (SELECT k, sum(k) OVER w AS ck, sum(n) OVER w AS cn, sum(k) OVER () AS allk FROM lv WINDOW w AS (ORDER BY prob DESC)),
  ap AS (SELECT sum(k * ck / cn) / max(allk) AS pr_auc FROM cum)"""
add("e2_roc_auc", lambda s, d: _r(ev.roc_auc(stand_in_scores(s, d)), 8, "roc_auc"),
    with_roles(SCORES, AUC + f" SELECT {r('roc_auc', 8)} AS roc_auc FROM auc"))
add("e3_average_precision", lambda s, d: _r(ev.average_precision(stand_in_scores(s, d)), 8, "pr_auc"),
    with_roles(SCORES, AP + f" SELECT {r('pr_auc', 8)} AS pr_auc FROM ap"))
add("e4_precision_recall_f1",
    lambda s, d: _r(ev.add_rates(ev.confusion(stand_in_scores(s, d), 0.6)), 6, "precision", "recall", "f1").select("precision", "recall", "f1"),
    with_roles(SCORES, f"SELECT precision, recall, f1 FROM (SELECT {_rates_sql()} FROM (SELECT {COUNTS} FROM s, (SELECT 0.6::DOUBLE AS t)))"))
add("e5_sensitivity_specificity",
    lambda s, d: _r(ev.add_rates(ev.confusion(stand_in_scores(s, d), 0.6)), 6, "sensitivity", "specificity").select("sensitivity", "specificity"),
    with_roles(SCORES, f"SELECT sensitivity, specificity FROM (SELECT {_rates_sql()} FROM (SELECT {COUNTS} FROM s, (SELECT 0.6::DOUBLE AS t)))"))
add("e6_balanced_accuracy",
    lambda s, d: _r(ev.add_rates(ev.confusion(stand_in_scores(s, d), 0.6)), 6, "balanced_accuracy").select("balanced_accuracy"),
    with_roles(SCORES, f"SELECT balanced_accuracy FROM (SELECT {_rates_sql()} FROM (SELECT {COUNTS} FROM s, (SELECT 0.6::DOUBLE AS t)))"))


def named(s, d):
    """The score and its complement as two 'models'."""
    base = stand_in_scores(s, d)
    both = F.array(
        F.struct(F.lit("forward").alias("model"), F.col("prob").alias("p")),
        F.struct(F.lit("reverse").alias("model"), (F.lit(1.0) - F.col("prob")).alias("p")),
    )
    return base.select("customer_id", "label", F.explode(both).alias("m")).select(
        "customer_id", "label", "m.model", F.col("m.p").alias("prob"))


def _evaluated_sql(digits):
    def one(name, p):
        return f"""SELECT '{name}' AS model, {r('roc_auc', digits)} AS roc_auc, {r('pr_auc', digits)} AS pr_auc, {_rates_sql(digits)}, tn, fp, fn, tp
          FROM (SELECT {COUNTS} FROM s2, (SELECT 0.5::DOUBLE AS t) WHERE m = '{name}'), auc2, ap2 WHERE auc2.m = '{name}' AND ap2.m = '{name}'"""
    return SCORES + f""", s2 AS (SELECT 'forward' AS m, label, prob FROM s UNION ALL SELECT 'reverse', label, 1.0::DOUBLE - prob FROM s),
      rk2 AS (SELECT m, label, rank() OVER (PARTITION BY m ORDER BY prob) + (count(*) OVER (PARTITION BY m, prob) - 1) / 2.0 AS rk FROM s2),
      pq AS (SELECT count(*) FILTER (label = 1)::DOUBLE AS p, count(*) FILTER (label = 0)::DOUBLE AS q FROM s),
      auc2 AS (SELECT m, (sum(rk) FILTER (label = 1) - p * (p + 1) / 2) / (p * q) AS roc_auc FROM rk2, pq GROUP BY m, p, q),
      lv2 AS (SELECT m, prob, count(*) FILTER (label = 1)::DOUBLE AS k, count(*)::DOUBLE AS n FROM s2 GROUP BY 1, 2),
      cum2 AS (SELECT m, k, sum(k) OVER w AS ck, sum(n) OVER w AS cn FROM lv2 WINDOW w AS (PARTITION BY m ORDER BY prob DESC)),
      ap2 AS (SELECT m, sum(k * ck / cn) / sum(k) AS pr_auc FROM cum2 GROUP BY 1)""", \
        one("forward", "prob") + "\nUNION ALL " + one("reverse", "1 - prob")


add("e7_model_evaluation",
    lambda s, d: _r(ev.evaluate(named(s, d)), 6, "roc_auc", "pr_auc", *ev.RATE_COLUMNS).drop("threshold"),
    with_roles(_evaluated_sql(6)[0], f"SELECT * REPLACE ({INTS}) FROM ({_evaluated_sql(6)[1]})"))
add("e8_threshold_sweep",
    lambda s, d: _r(ev.threshold_sweep(stand_in_scores(s, d)), 6, *ev.RATE_COLUMNS),
    with_roles(SCORES + "," + SWEEP, f"SELECT t AS threshold, {_rates_sql()}, {INTS} FROM c"))
add("e9_comparison_table", lambda s, d: ev.comparison(ev.evaluate(named(s, d))),
    with_roles(_evaluated_sql(4)[0], f"SELECT * EXCLUDE (tn, fp, fn, tp) FROM ({_evaluated_sql(4)[1]})"))
add("e14_chosen_thresholds",
    lambda s, d: _r(ev.operating_points(ev.threshold_sweep(stand_in_scores(s, d)), [0.35, 0.5]), 6, *ev.RATE_COLUMNS),
    with_roles(SCORES + "," + SWEEP, f"SELECT t AS threshold, {_rates_sql()}, {INTS} FROM c WHERE t IN (0.35::DOUBLE, 0.5::DOUBLE)"))
add("e14_best_f1",
    lambda s, d: _r(ev.best_f1(ev.threshold_sweep(stand_in_scores(s, d))), 6, "f1").select("threshold", "f1"),
    with_roles(SCORES + "," + SWEEP, f"""SELECT threshold, f1 FROM (SELECT t AS threshold, {_rates_sql()}, tp / (2 * tp + fp + fn) AS o FROM c)
      ORDER BY o DESC, threshold LIMIT 1"""))
SIZES = [50, 200, 500, 1000]
add("e15_capacity",
    lambda s, d: _r(ev.capacity(stand_in_scores(s, d), "customer_id", SIZES), 6, "precision", "recall"),
    with_roles(SCORES, f"""
      , o AS (SELECT label, row_number() OVER (ORDER BY prob DESC, customer_id) AS rn FROM s)
      SELECT asked::BIGINT AS asked, count(*) AS contacted, count(*) FILTER (label = 1) AS hits,
        {r('count(*) FILTER (label = 1)::DOUBLE / count(*)', 6)} AS precision,
        {r('count(*) FILTER (label = 1)::DOUBLE / (SELECT count(*) FROM s WHERE label = 1)', 6)} AS recall
      FROM o, (VALUES {', '.join(f'({n})' for n in SIZES)}) v(asked) WHERE rn <= asked GROUP BY 1"""))
RATE_BANDS = [Band("below 1", below=1.0), Band("1 to 2", 1.0, below=2.0), Band("2 to 3", 2.0, below=3.0)]


def e16(s, d):
    """Predicted adoption by interest-rate band, on a deterministic contact score."""
    scores = track_b(s, d).select(
        "observation_id", "euribor3m", F.when(F.col("y") == "yes", 1).otherwise(0).alias("label"),
        F.expr("((observation_id * 7919) % 10007 % 100) / 125.0D").alias("prob"))
    return _r(ev.scores_by_band(scores, "euribor3m", RATE_BANDS, "3 and more"), 6, "avg_prob", "observed_rate")


add("e16_adoption_by_rate_band", e16, with_roles(B, f"""
  SELECT CASE WHEN euribor3m < 1 THEN 'below 1' WHEN euribor3m < 2 THEN '1 to 2' WHEN euribor3m < 3 THEN '2 to 3' ELSE '3 and more' END AS band,
    count(*) AS n, {r('avg((observation_id * 7919) % 10007 % 100 / 125.0::DOUBLE)', 6)} AS avg_prob,
    {r("avg((y = 'yes')::INT)", 6)} AS observed_rate FROM b GROUP BY 1"""))
