"""Projections, scalar functions, predicates, joins, aggregates, order and tiles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from saldora.catalog.data_queries import saved_star
from saldora.catalog.questions_queries import (
    AGE_BAND_SQL, AGE_GROUP_SQL, PROFILE_COLS, PROFILE_MONEY, RECENCY_SQL, YES, profile,
)
from saldora.catalog.registry import Book
from saldora.catalog.roles import (
    REF_DATE, stand_in_scores, stand_in_segments, track_a, track_a_raw, track_b, track_b_keyed,
    track_b_raw,
)
from saldora.catalog.roles_sql import A, A_RAW, B, B_RAW, SCORES, SEGMENTS, key_hash, r, with_roles
from saldora.functions import expr as ex
from saldora.functions.metrics import adopted
from saldora.operators import rank as rk
from saldora.operators import relational as rel
from saldora.operators.evaluate import risk_by_segment
from saldora.operators.features import TRACK_B, check_features, track_b_features
from saldora.plans import track_a as qa
from saldora.sources import CAMPAIGN_NAMES

BOOK = Book()
add = BOOK.add


def _r(df, digits, *cols):
    return df.withColumns({c: ex.round_to(c, digits) for c in cols})


# -------------------------------------------------- projection and scalars

add("p_1_projection",
    lambda s, d: rel.project(track_b(s, d), ["observation_id", "job", "y"]),
    with_roles(B, "SELECT observation_id, job, y FROM b"))
add("p_2_rename",
    lambda s, d: _r(rel.rename(track_b_keyed(s, d), CAMPAIGN_NAMES).select(
        "observation_id", "default_credit", "emp_var_rate", "nr_employed"), 4, "emp_var_rate", "nr_employed"),
    with_roles(B, f"SELECT observation_id, default_credit, {r('emp_var_rate', 4)} AS emp_var_rate, {r('nr_employed', 4)} AS nr_employed FROM b"))
add("p_3_cast_to_date",
    lambda s, d: track_a_raw(s, d).select(
        "customer_id", F.col("last_transaction").try_cast("date").alias("last_transaction")),
    with_roles(A_RAW, "SELECT customer_id, try_cast(last_transaction AS DATE) AS last_transaction FROM a_raw"))
add("p_4_days_to_reference",
    lambda s, d: track_a(s, d).select("customer_id", ex.days_since("last_transaction", REF_DATE).alias("days")),
    with_roles(A, "SELECT customer_id, days_since_last_transaction AS days FROM a"))


def p_5(s, d):
    """Reference date taken from the data as a scalar subquery."""
    a = track_a(s, d)
    ref = a.agg(F.max("last_transaction")).scalar()
    return a.select("customer_id", ref.alias("reference"), ex.days_since("last_transaction", ref).alias("days"))


add("p_5_observed_reference_date", p_5, with_roles(A, """
  SELECT customer_id, (SELECT max(last_transaction) FROM a) AS reference,
    date_diff('day', last_transaction, (SELECT max(last_transaction) FROM a))::INT AS days FROM a"""))
add("p_6_age_group", lambda s, d: track_a(s, d).select("customer_id", ex.age_group().alias("age_group")),
    with_roles(A, f"SELECT customer_id, {AGE_GROUP_SQL} AS age_group FROM a"))
add("p_7_age_band", lambda s, d: track_b(s, d).select("observation_id", ex.age_band().alias("age_band")),
    with_roles(B, f"SELECT observation_id, {AGE_BAND_SQL} AS age_band FROM b"))
add("p_8_recency_band", lambda s, d: profile(s, d).select("customer_id", ex.recency_band().alias("recency_band")),
    with_roles(A, f"SELECT customer_id, {RECENCY_SQL} AS recency_band FROM a"))
add("p_9_indicator", lambda s, d: track_b(s, d).select("observation_id", ex.indicator("y", "yes").alias("adopted")),
    with_roles(B, "SELECT observation_id, CASE WHEN y = 'yes' THEN 1 ELSE 0 END AS adopted FROM b"))
add("p_10_rounding",
    lambda s, d: track_a(s, d).select("customer_id", *[
        ex.round_to(F.col("current_balance") / 7, n).alias(f"r{n}") for n in (1, 2, 4)]),
    with_roles(A, "SELECT customer_id, " + ", ".join(f"{r('current_balance / 7', n)} AS r{n}" for n in (1, 2, 4)) + " FROM a"))
add("p_11_missing_flag", lambda s, d: track_a(s, d).select("customer_id", ex.missing_flag("last_transaction").alias("missing")),
    with_roles(A, "SELECT customer_id, (last_transaction IS NULL)::INT AS missing FROM a"))
add("p_12_arcsinh",
    lambda s, d: track_a(s, d).select("customer_id", ex.round_to(ex.safe_asinh("current_balance"), 8).alias("v")),
    with_roles(A, f"SELECT customer_id, {r('sign(current_balance) * asinh(abs(current_balance))', 8)} AS v FROM a"))
add("p_13_balance_growth",
    lambda s, d: track_a(s, d).select(
        "customer_id", ex.round_to(ex.difference("current_month_balance", "previous_month_balance"), 6).alias("growth")),
    with_roles(A, f"SELECT customer_id, {r('current_month_balance - previous_month_balance', 6)} AS growth FROM a"))


def p_14(s, d):
    a = track_a(s, d)
    return rel.pct_of_total(
        rel.rate_by(a, ["customer_nw_category"], {"n": "customers"}), "n", a.agg(F.count(F.lit(1))))


add("p_14_percent_of_total", p_14, with_roles(A, f"""SELECT customer_nw_category, count(*) AS n,
  {r('count(*)::DOUBLE / (SELECT count(*) FROM a) * 100.0::DOUBLE', 1)} AS pct FROM a GROUP BY 1"""))
add("p_15_mask_and_dropna",
    lambda s, d: track_a(s, d).dropna(subset=["dependents", "last_transaction"]).filter(F.col("dependents") <= 2)
    .select("customer_id", "dependents"),
    with_roles(A, "SELECT customer_id, dependents FROM a WHERE last_transaction IS NOT NULL AND dependents <= 2"))
add("p_16_groups_by_size",
    lambda s, d: rel.keep_groups(rel.rate_by(track_a(s, d), ["occupation", "customer_nw_category"], {"n": "customers"}), "n", 100),
    with_roles(A, "SELECT occupation, customer_nw_category, count(*) AS n FROM a GROUP BY 1, 2 HAVING count(*) >= 100"))


def p_17(s, d):
    a = track_a(s, d)
    groups = rel.rate_by(a, ["occupation"], {"n": "customers", "avg_balance": "avg_current_balance"})
    return _r(rel.keep_groups(groups, "n", 1, "avg_balance", a.agg(F.avg("current_balance"))), 4, "avg_balance")


add("p_17_groups_above_overall_mean", p_17, with_roles(A, f"""
  SELECT occupation, count(*) AS n, {r('avg(current_balance)', 4)} AS avg_balance FROM a GROUP BY 1
  HAVING avg(current_balance) > (SELECT avg(current_balance) FROM a)"""))


def p_18(s, d):
    b = track_b(s, d)
    groups = rel.with_overall(
        rel.rate_by(b, ["education"], ["observation_count", "adoption_rate"]), b.agg(F.avg(adopted())), "overall_rate")
    return _r(groups.filter("adoption_rate > overall_rate"), 6, "adoption_rate", "overall_rate")


add("p_18_groups_against_one_row_frame", p_18, with_roles(B, f"""
  , o AS (SELECT avg({YES}) AS overall_rate FROM b)
  SELECT education, count(*) AS observation_count, {r(f'avg({YES})', 6)} AS adoption_rate, {r('max(overall_rate)', 6)} AS overall_rate
  FROM b, o GROUP BY 1 HAVING avg({YES}) > max(overall_rate)"""))
add("p_19_feature_exclusion",
    lambda s, d: track_b_features(track_b(s, d)).agg(
        F.count(F.lit(1)).alias("rows"), F.first(F.lit(len(check_features(TRACK_B, track_b(s, d).columns)))).alias("features"),
        F.first(F.lit("duration" in track_b_features(track_b(s, d)).columns)).alias("has_duration")),
    with_roles(B, "SELECT count(*) AS rows, 20 AS features, false AS has_duration FROM b"))

# ------------------------------------------------------------------- joins


def j1(s, d):
    """Four-way star join over tables bucketed by the join key: no exchange."""
    t = saved_star(s, d)
    return _r(qa.customer_profile(*[t[f"track_a.{n}"] for n in (
        "dim_customer", "fact_customer_balance", "fact_customer_activity", "fact_customer_churn")], REF_DATE), 4, *PROFILE_MONEY)


add("j1_star_join", j1, with_roles(A, f"SELECT {PROFILE_COLS}, "
    + ", ".join(f"{r(c, 4)} AS {c}" for c in PROFILE_MONEY) + " FROM a"))


def j2(s, d):
    b = track_b(s, d)
    return _r(rel.with_overall(b.select("observation_id", "y"), b.agg(F.avg(adopted())), "overall_rate"), 6, "overall_rate")


add("j2_rows_with_one_row_relation", j2, with_roles(B, f"""
  , o AS (SELECT {r(f'avg({YES})', 6)} AS overall_rate FROM b) SELECT observation_id, y, overall_rate FROM b, o"""))


def j3(s, d):
    a = track_a(s, d)
    return a.filter(F.col("current_balance") > a.agg(F.avg("current_balance")).scalar()).select("customer_id", "current_balance")


add("j3_scalar_subquery", j3, with_roles(A, """SELECT customer_id, current_balance FROM a
  WHERE current_balance > (SELECT avg(current_balance) FROM a)"""))
add("j4_labels_by_key",
    lambda s, d: rel.attach(track_a(s, d).select("customer_id", "churn"),
                            stand_in_segments(s, d).select("customer_id", "segment"), "customer_id"),
    with_roles(SEGMENTS, "SELECT customer_id, churn, segment FROM g"))
add("j5_risk_by_segment",
    lambda s, d: _r(risk_by_segment(stand_in_scores(s, d), stand_in_segments(s, d).select("customer_id", "segment"), "customer_id"),
                    6, "avg_prob", "observed_rate"),
    with_roles(SEGMENTS + "," + SCORES[len(A) + 2:], f"""SELECT segment, count(*) AS n, {r('avg(prob)', 6)} AS avg_prob,
      {r('avg(label)', 6)} AS observed_rate FROM s JOIN g USING (customer_id) GROUP BY 1"""))

# -------------------------------------------------------------- aggregates

add("g1_global_aggregate",
    lambda s, d: _r(rel.rate_by(track_a(s, d), [], ["customers", "churn_rate", "avg_current_balance"]), 4, "churn_rate", "avg_current_balance"),
    with_roles(A, f"SELECT count(*) AS customers, {r('avg(churn)', 4)} AS churn_rate, {r('avg(current_balance)', 4)} AS avg_current_balance FROM a"))
add("g2_group_by_expression",
    lambda s, d: _r(rel.rate_by(track_b(s, d), [F.floor(F.col("age") / 10).alias("decade")], ["observation_count", "adoption_rate"]), 6, "adoption_rate"),
    with_roles(B, f"SELECT (age // 10)::BIGINT AS decade, count(*) AS observation_count, {r(f'avg({YES})', 6)} AS adoption_rate FROM b GROUP BY 1"))
add("g3_group_by_two_keys",
    lambda s, d: _r(rel.rate_by(track_b(s, d), ["job", "poutcome"], ["observation_count", "adoption_rate"]), 6, "adoption_rate"),
    with_roles(B, f"SELECT job, poutcome, count(*) AS observation_count, {r(f'avg({YES})', 6)} AS adoption_rate FROM b GROUP BY 1, 2"))
add("g4_count", lambda s, d: track_b(s, d).groupBy("month").agg(F.count(F.lit(1)).alias("n")),
    with_roles(B, "SELECT month, count(*) AS n FROM b GROUP BY 1"))
add("g5_average", lambda s, d: _r(track_a(s, d).groupBy("gender").agg(
        F.avg("age").alias("avg_age"), F.avg(F.col("churn").cast("double")).alias("churn_rate")), 6, "avg_age", "churn_rate"),
    with_roles(A, f"SELECT gender, {r('avg(age)', 6)} AS avg_age, {r('avg(churn)', 6)} AS churn_rate FROM a GROUP BY 1"))
add("g6_median", lambda s, d: _r(rk.group_median(track_a(s, d), "current_balance", ["occupation", "gender"], "median_balance"), 4, "median_balance"),
    with_roles(A, f"SELECT occupation, gender, {r('median(current_balance)', 4)} AS median_balance FROM a GROUP BY 1, 2"))
add("g6_median_global", lambda s, d: _r(rk.group_median(track_b(s, d), "duration", (), "median_duration"), 4, "median_duration"),
    with_roles(B, f"SELECT {r('median(duration)', 4)} AS median_duration FROM b"))
add("g7_min_max", lambda s, d: track_a(s, d).groupBy("customer_nw_category").agg(
        F.min("current_balance").alias("lo"), F.max("current_balance").alias("hi"), F.max("last_transaction").alias("last")),
    with_roles(A, """SELECT customer_nw_category, min(current_balance) AS lo, max(current_balance) AS hi,
      max(last_transaction) AS last FROM a GROUP BY 1"""))


def g8(s, d):
    b = track_b(s, d)
    carried = rel.with_overall(b, b.agg(F.avg(adopted())), "overall_rate")
    return _r(carried.groupBy("job").agg(F.max("overall_rate").alias("overall_rate")), 6, "overall_rate")


add("g8_max_of_carried_constant", g8, with_roles(B, f"""
  , o AS (SELECT avg({YES}) AS v FROM b) SELECT job, {r('max(v)', 6)} AS overall_rate FROM b, o GROUP BY 1"""))
add("g9_named_aggregates",
    lambda s, d: _r(stand_in_segments(s, d).groupBy("segment").agg(
        F.count("dependents").alias("with_dependents"), F.avg("age").alias("avg_age"), F.avg("vintage").alias("avg_vintage")),
        6, "avg_age", "avg_vintage"),
    with_roles(SEGMENTS, f"""SELECT segment, count(dependents) AS with_dependents, {r('avg(age)', 6)} AS avg_age,
      {r('avg(vintage)', 6)} AS avg_vintage FROM g GROUP BY 1"""))
add("g10_value_counts", lambda s, d: rel.value_counts(stand_in_segments(s, d), "segment"),
    with_roles(SEGMENTS, "SELECT segment, count(*) AS n FROM g GROUP BY 1"))
add("g11_count_distinct", lambda s, d: track_a(s, d).groupBy("gender").agg(
        F.count_distinct("customer_id").alias("customers"), F.count_distinct("branch_code").alias("branches")),
    with_roles(A, "SELECT gender, count(DISTINCT customer_id) AS customers, count(DISTINCT branch_code) AS branches FROM a GROUP BY 1"))
MODES = ["job", "marital", "education", "housing", "contact", "month"]
add("g12_mode", lambda s, d: rel.mode_of(track_b(s, d), MODES),
    with_roles(B, "\nUNION ALL ".join(
        f"(SELECT '{c}' AS \"column\", {c} AS mode FROM b GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)" for c in MODES)))
add("g13_mean_and_population_std", lambda s, d: _r(rel.mean_std(track_a(s, d), ["occupation"], "current_balance"), 4, "mean", "std"),
    with_roles(A, f"SELECT occupation, {r('avg(current_balance)', 4)} AS mean, {r('stddev_pop(current_balance)', 4)} AS std FROM a GROUP BY 1"))
add("g14_contingency", lambda s, d: rel.contingency(track_a(s, d), "occupation", "churn"),
    with_roles(A, "SELECT occupation AS a, churn AS b, count(*) AS n FROM a WHERE occupation IS NOT NULL GROUP BY 1, 2"))

# --------------------------------------------------------- order and tiles

add("w1_ntile",
    lambda s, d: rk.with_ntile(track_a(s, d).select("customer_id", "current_balance"), 7, "current_balance", "customer_id"),
    with_roles(A, "SELECT customer_id, current_balance, ntile(7) OVER (ORDER BY current_balance, customer_id) AS tile FROM a"))
add("w1_ntile_with_ties",
    lambda s, d: rk.with_ntile(track_b(s, d).select("observation_id", "age"), 5, "age", "observation_id"),
    with_roles(B, "SELECT observation_id, age, ntile(5) OVER (ORDER BY age, observation_id) AS tile FROM b"))
add("w1_ntile_by_class",
    lambda s, d: rk.with_ntile(track_b(s, d).select("observation_id", "campaign", "y"), 4, "campaign", "observation_id", "tile", ["y"]),
    with_roles(B, """SELECT observation_id, campaign, y,
      ntile(4) OVER (PARTITION BY y ORDER BY campaign, observation_id) AS tile FROM b"""))
add("w2_row_number_by_order",
    lambda s, d: rk.with_rank(track_b(s, d).select("observation_id", "age"), ["age"], "observation_id", "row_id"),
    with_roles(B, "SELECT observation_id, age, row_number() OVER (ORDER BY age, observation_id) AS row_id FROM b"))


def w2(s, d):
    """Surrogate ids in scan order: dense from 1, each used once."""
    ids = rk.with_row_number(track_b_raw(s, d), "row_id")
    return ids.agg(F.count_distinct("row_id").alias("ids"), F.min("row_id").alias("lowest"), F.max("row_id").alias("highest"))


add("w2_surrogate_ids", w2, with_roles(B_RAW, "SELECT count(*) AS ids, 1::BIGINT AS lowest, count(*) AS highest FROM b_raw"))
add("w3_order_by", lambda s, d: track_a(s, d).groupBy("occupation").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), F.asc_nulls_last("occupation")),
    with_roles(A, "SELECT occupation, count(*) AS n FROM a GROUP BY 1 ORDER BY n DESC, occupation"))
add("w4_top_k", lambda s, d: rel.top_k(track_a(s, d).select("customer_id", "current_balance"), F.desc("current_balance"), 10, ["customer_id"]),
    with_roles(A, "SELECT customer_id, current_balance FROM a ORDER BY current_balance DESC, customer_id LIMIT 10"))
add("w5_order_by_magnitude", lambda s, d: rel.sort_by_abs(
        track_a(s, d).groupBy("branch_code").agg(F.sum("current_balance").alias("total")), "total", ["branch_code"])
    .withColumn("total", ex.round_to("total", 4)),
    with_roles(A, f"SELECT branch_code, {r('sum(current_balance)', 4)} AS total FROM a GROUP BY 1 ORDER BY abs(total) DESC"))
add("w6_head", lambda s, d: rel.sort_by_abs(track_a(s, d).select("customer_id", "current_balance"), "current_balance", ["customer_id"]).limit(10),
    with_roles(A, "SELECT customer_id, current_balance FROM a ORDER BY abs(current_balance) DESC, customer_id LIMIT 10"))
add("w7_best_row", lambda s, d: rel.best(track_b(s, d).groupBy("month").agg(F.count(F.lit(1)).alias("n")), "n", "month"),
    with_roles(B, "SELECT month, count(*) AS n FROM b GROUP BY 1 ORDER BY n DESC, month LIMIT 1"))
