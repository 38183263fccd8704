"""Views, business questions, metrics and dashboard extracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from saldora.catalog.registry import Book
from saldora.catalog.roles import (
    REF_DATE, stand_in_segments, track_a, track_b, track_b_secondary,
)
from saldora.catalog.roles_sql import A, B, B2, SEGMENTS, r, with_roles
from saldora.functions.expr import round_to
from saldora.functions.metrics import metric
from saldora.operators.rank import group_median
from saldora.operators.relational import rate_by, with_group_values
from saldora.operators.segment import segment_profile
from saldora.plans import dashboards as dash
from saldora.plans import track_a as qa
from saldora.plans import track_b as qb
from saldora.plans.warehouse import star_track_a

BOOK = Book()
add = BOOK.add


def profile(spark, sf):
    """Profile without the star join: the same columns from the wide clean table."""
    return qa.with_recency(track_a(spark, sf), REF_DATE)


def star_profile(spark, sf):
    t = star_track_a(track_a(spark, sf))
    return qa.customer_profile(
        t["track_a.dim_customer"],
        t["track_a.fact_customer_balance"],
        t["track_a.fact_customer_activity"],
        t["track_a.fact_customer_churn"],
        REF_DATE,
    )


def _rounded(df, digits, *cols):
    return df.withColumns({c: round_to(c, digits) for c in cols})


# Edges and labels of the published bands.
AGE_GROUP_SQL = """CASE WHEN age < 18 THEN 'under 18' WHEN age BETWEEN 18 AND 25 THEN '18-25'
  WHEN age BETWEEN 26 AND 35 THEN '26-35' WHEN age BETWEEN 36 AND 45 THEN '36-45'
  WHEN age BETWEEN 46 AND 55 THEN '46-55' WHEN age BETWEEN 56 AND 65 THEN '56-65' ELSE '66+' END"""
AGE_BAND_SQL = """CASE WHEN age < 25 THEN 'under 25' WHEN age BETWEEN 25 AND 34 THEN '25-34'
  WHEN age BETWEEN 35 AND 44 THEN '35-44' WHEN age BETWEEN 45 AND 54 THEN '45-54'
  WHEN age BETWEEN 55 AND 64 THEN '55-64' ELSE '65+' END"""
RECENCY_SQL = """CASE WHEN days_since_last_transaction IS NULL THEN 'no valid last_transaction date'
  WHEN days_since_last_transaction <= 30 THEN '0-30 days'
  WHEN days_since_last_transaction <= 90 THEN '31-90 days'
  WHEN days_since_last_transaction <= 180 THEN '91-180 days' ELSE '180+ days' END"""
YES = "CASE WHEN y = 'yes' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
CHURN = r("avg(churn)", 4) + " AS churn_rate"
ADOPT = r(f"avg({YES})", 4) + " AS adoption_rate"

# ----------------------------------------------------------------- track A

PROFILE_COLS = ", ".join(c for c in qa.PROFILE_COLUMNS if not c.startswith(("current_month", "average", "previous_month")))
PROFILE_MONEY = ["average_monthly_balance_prevq", "previous_month_end_balance", "current_month_credit", "current_month_debit"]
add(
    "qa0_customer_profile",
    lambda s, d: _rounded(star_profile(s, d), 4, *PROFILE_MONEY),
    with_roles(A, f"SELECT {PROFILE_COLS}, "
               + ", ".join(f"{r(c, 4)} AS {c}" for c in PROFILE_MONEY) + " FROM a"),
)
SUMMARY_SQL = f"""SELECT {AGE_GROUP_SQL} AS age_group, customer_nw_category, count(*) AS customer_count,
  {CHURN}, {r('avg(current_balance)', 2)} AS avg_current_balance,
  {r('median(current_balance)', 2)} AS median_current_balance FROM a GROUP BY 1, 2"""
add(
    "qa0b_churn_summary",
    lambda s, d: qa.churn_summary(profile(s, d)),
    with_roles(A, SUMMARY_SQL),
)
add(
    "qa1_overall_churn",
    lambda s, d: qa.overall_churn(profile(s, d)),
    with_roles(A, f"SELECT count(*) AS customers, {CHURN} FROM a"),
)
add(
    "qa2_churn_by_age_group",
    lambda s, d: qa.churn_by_age_group(profile(s, d)),
    with_roles(A, f"SELECT {AGE_GROUP_SQL} AS age_group, count(*) AS customer_count, {CHURN} FROM a GROUP BY 1"),
)
add(
    "qa3_churn_by_tier",
    lambda s, d: qa.churn_by_tier(profile(s, d)),
    with_roles(A, f"SELECT customer_nw_category, count(*) AS customer_count, {CHURN} FROM a GROUP BY 1"),
)
QUARTILE_SQL = f"""SELECT balance_quartile, count(*) AS customer_count, {r('min(current_balance)', 2)} AS min_balance,
  {r('max(current_balance)', 2)} AS max_balance, {CHURN}
  FROM (SELECT *, ntile(4) OVER (ORDER BY current_balance, customer_id) AS balance_quartile FROM a) GROUP BY 1"""
add(
    "qa4_churn_by_balance_quartile",
    lambda s, d: qa.churn_by_balance_quartile(profile(s, d)),
    with_roles(A, QUARTILE_SQL),
)
RECENCY_QUERY = f"SELECT {RECENCY_SQL} AS recency_band, count(*) AS customer_count, {CHURN} FROM a GROUP BY 1"
add(
    "qa5_churn_by_recency",
    lambda s, d: qa.churn_by_recency(profile(s, d)),
    with_roles(A, RECENCY_QUERY),
)
add(
    "qa6_highest_balance_groups",
    lambda s, d: qa.highest_balance_groups(profile(s, d)),
    with_roles(A, f"""SELECT occupation, customer_nw_category, count(*) AS customer_count,
      {r('avg(current_balance)', 2)} AS avg_balance FROM a GROUP BY 1, 2 HAVING count(*) >= 100
      ORDER BY avg_balance DESC, occupation, customer_nw_category LIMIT 10"""),
)
add(
    "qa7_high_balance_high_churn",
    lambda s, d: qa.high_balance_high_churn(profile(s, d)),
    with_roles(A, f"""SELECT occupation, customer_nw_category, count(*) AS customer_count,
      {r('avg(current_balance)', 2)} AS avg_balance, {CHURN} FROM a GROUP BY 1, 2
      HAVING count(*) >= 100 AND avg(current_balance) > (SELECT avg(current_balance) FROM a)
      ORDER BY churn_rate DESC, occupation, customer_nw_category LIMIT 10"""),
)

# ----------------------------------------------------------------- track B

add(
    "qb0_campaign_summary",
    lambda s, d: qb.campaign_summary(track_b(s, d)),
    with_roles(B, f"SELECT month, day_of_week, count(*) AS observation_count, {ADOPT} FROM b GROUP BY 1, 2"),
)
add(
    "qb0b_adoption_summary",
    lambda s, d: qb.adoption_summary(track_b(s, d)),
    with_roles(B, """SELECT job, education, housing, loan, poutcome, previous_contact_flag,
      CASE WHEN y = 'yes' THEN 1 ELSE 0 END AS adopted FROM b"""),
)
add(
    "qb1_overall_adoption",
    lambda s, d: qb.overall_adoption(track_b(s, d)),
    with_roles(B, f"SELECT count(*) AS observations, {ADOPT} FROM b"),
)
AGE_BAND_QUERY = f"SELECT {AGE_BAND_SQL} AS age_band, count(*) AS observation_count, {ADOPT} FROM b GROUP BY 1"
add("qb2_adoption_by_age_band", lambda s, d: qb.adoption_by_age_band(track_b(s, d)), with_roles(B, AGE_BAND_QUERY))


def _by_sql(c):
    return with_roles(B, f"SELECT {c}, count(*) AS observation_count, {ADOPT} FROM b GROUP BY 1")


add("qb3_adoption_by_job", lambda s, d: qb.adoption_by_job(track_b(s, d)), _by_sql("job"))
add("qb4_adoption_by_education", lambda s, d: qb.adoption_by_education(track_b(s, d)), _by_sql("education"))
add("qb5_adoption_by_housing", lambda s, d: qb.adoption_by_housing(track_b(s, d)), _by_sql("housing"))
add("qb6_adoption_by_outcome", lambda s, d: qb.adoption_by_outcome(track_b(s, d)), _by_sql("poutcome"))
add(
    "qb7_adoption_by_previous_contact",
    lambda s, d: qb.adoption_by_previous_contact(track_b(s, d)),
    _by_sql("previous_contact_flag"),
)
add(
    "qb8_above_average_groups",
    lambda s, d: qb.above_average_groups(track_b(s, d)),
    with_roles(B, f"""SELECT job, education, count(*) AS observation_count, {ADOPT} FROM b GROUP BY 1, 2
      HAVING count(*) >= 200 AND avg({YES}) > (SELECT avg({YES}) FROM b)
      ORDER BY adoption_rate DESC, job, education LIMIT 10"""),
)
BALANCE_TILES_SQL = f"""SELECT balance_quartile, count(*) AS observation_count, {r('min(balance)', 2)} AS min_balance,
  {r('max(balance)', 2)} AS max_balance, {ADOPT}
  FROM (SELECT *, ntile(4) OVER (ORDER BY balance, observation_id) AS balance_quartile FROM b2) GROUP BY 1"""
add(
    "qb9_adoption_by_balance_quartile",
    lambda s, d: qb.adoption_by_balance_quartile(track_b_secondary(s, d)),
    with_roles(B2, BALANCE_TILES_SQL),
)

# ----------------------------------------------------------------- metrics


def _metric_row(frame, names, digits=4):
    def run(s, d):
        out = rate_by(frame(s, d), [], names)
        return out.select(*[round_to(n, digits).alias(n) for n in names])

    return run


add("m1_customer_count", _metric_row(profile, ["customer_count"]),
    with_roles(A, f"SELECT {r('count(DISTINCT customer_id)', 4)} AS customer_count FROM a"))
add(
    "m2_mean_and_median_balance",
    lambda s, d: with_group_values(
        rate_by(profile(s, d), ["occupation"], ["avg_current_balance"]),
        group_median(profile(s, d), "current_balance", ["occupation"], "median_current_balance"),
        ["occupation"],
    ).select("occupation", round_to("avg_current_balance", 4).alias("avg_current_balance"),
             round_to("median_current_balance", 4).alias("median_current_balance")),
    with_roles(A, f"""SELECT occupation, {r('avg(current_balance)', 4)} AS avg_current_balance,
      {r('median(current_balance)', 4)} AS median_current_balance FROM a GROUP BY 1"""),
)
for _name, _metric, _expr in [
    ("m3_avg_monthly_balance_prevq", "avg_monthly_balance_prevq", "avg(average_monthly_balance_prevq)"),
    ("m4_balance_growth", "balance_growth", "avg(current_month_balance - previous_month_balance)"),
    ("m5_churn_rate", "churn_rate", "avg(churn)"),
    ("m7_transaction_recency", "avg_recency_days", "avg(days_since_last_transaction)"),
]:
    add(_name, _metric_row(profile, [_metric]), with_roles(A, f"SELECT {r(_expr, 4)} AS {_metric} FROM a"))
add(
    "m6_monthly_credit_and_debit",
    _metric_row(profile, ["avg_month_credit", "avg_month_debit"]),
    with_roles(A, f"""SELECT {r('avg(current_month_credit)', 4)} AS avg_month_credit,
      {r('avg(current_month_debit)', 4)} AS avg_month_debit FROM a"""),
)
for _name, _metric, _expr in [
    ("m8_observation_count", "observation_count", "count(*)"),
    ("m9_adoption_rate", "adoption_rate", f"avg({YES})"),
    ("m10_previous_contact_rate", "previous_contact_rate", "avg(previous_contact_flag::INT)"),
]:
    add(_name, _metric_row(track_b, [_metric]), with_roles(B, f"SELECT {r(_expr, 4)} AS {_metric} FROM b"))
add(
    "m11_adoption_by_outcome",
    lambda s, d: _rounded(rate_by(track_b(s, d), ["poutcome"], ["observation_count", "adoption_rate"]), 6, "adoption_rate"),
    with_roles(B, f"SELECT poutcome, count(*) AS observation_count, {r(f'avg({YES})', 6)} AS adoption_rate FROM b GROUP BY 1"),
)
M12_A = ["customer_count", "avg_current_balance", "avg_monthly_balance_prevq", "balance_growth",
         "churn_rate", "avg_month_credit", "avg_month_debit", "avg_recency_days"]
M12_EXPR = {
    "customer_count": "count(DISTINCT customer_id)", "avg_current_balance": "avg(current_balance)",
    "avg_monthly_balance_prevq": "avg(average_monthly_balance_prevq)",
    "balance_growth": "avg(current_month_balance - previous_month_balance)", "churn_rate": "avg(churn)",
    "avg_month_credit": "avg(current_month_credit)", "avg_month_debit": "avg(current_month_debit)",
    "avg_recency_days": "avg(days_since_last_transaction)",
}
add(
    "m12_metrics_by_segment_and_occupation",
    lambda s, d: _rounded(
        rate_by(qa.with_recency(stand_in_segments(s, d), REF_DATE), ["segment", "occupation"], M12_A), 6, *M12_A),
    with_roles(SEGMENTS, "SELECT segment, occupation, " + ", ".join(f"{r(e, 6)} AS {n}" for n, e in M12_EXPR.items())
               + " FROM g GROUP BY 1, 2"),
)
add(
    "m12_metrics_by_month",
    lambda s, d: _rounded(
        rate_by(track_b(s, d), ["month"], ["observation_count", "adoption_rate", "previous_contact_rate"]),
        4, "adoption_rate", "previous_contact_rate"),
    with_roles(B, f"""SELECT month, count(*) AS observation_count, {ADOPT},
      {r('avg(previous_contact_flag::INT)', 4)} AS previous_contact_rate FROM b GROUP BY 1"""),
)

GRAINS = [[], ["segment"], ["occupation"], ["segment", "occupation"]]
MEASURES = ["customers", *M12_A[1:]]


def m12_extract(s, d):
    """All grains and filters of track A's measures in one scan, with exact medians."""
    tier = F.col("customer_nw_category")
    out = dash.grain_extract(
        qa.with_recency(stand_in_segments(s, d), REF_DATE), GRAINS,
        {"all": None, "tier 2": tier == 2, "high balance": F.col("current_balance") > 10_000, "tier 3": tier == 3},
        MEASURES, "current_balance")
    return _rounded(out, 6, *MEASURES[1:], "median")


def _grains_sql(frame, dims, filters, measures):
    """Grouping sets over the rows of each filter."""
    rows = " UNION ALL ".join(f"SELECT '{n}' AS filter, * FROM {frame} WHERE {c}" for n, c in filters.items())
    sets = ", ".join("(" + ", ".join(["filter", *g]) + ")" for g in dims)
    names = list(dict.fromkeys(x for g in dims for x in g))
    grain = "concat_ws(',', " + ", ".join(f"CASE WHEN grouping({x}) = 0 THEN '{x}' END" for x in names) + ")"
    return f"SELECT filter, {grain} AS grain, {', '.join(names)}, {measures} FROM ({rows}) GROUP BY GROUPING SETS ({sets})"


add("m12_all_grains_and_filters", m12_extract, with_roles(SEGMENTS, _grains_sql(
    "g", GRAINS, {"all": "true", "tier 2": "customer_nw_category = 2", "high balance": "current_balance > 10000", "tier 3": "customer_nw_category = 3"},
    "count(*) AS customers, " + ", ".join(f"{r(M12_EXPR[n], 6)} AS {n}" for n in M12_A[1:]) + f", {r('median(current_balance)', 6)} AS median")))

# -------------------------------------------------------------- dashboards

add(
    "d1_executive_kpis",
    lambda s, d: dash.executive_kpis(profile(s, d), track_b(s, d)),
    with_roles(A + "," + B, f"""
      SELECT 'A' AS track, 'customer_count' AS metric, {r('count(DISTINCT customer_id)', 4)} AS value FROM a
      UNION ALL SELECT 'A', 'churn_rate', {r('avg(churn)', 4)} FROM a
      UNION ALL SELECT 'B', 'observation_count', {r('count(*)', 4)} FROM b
      UNION ALL SELECT 'B', 'adoption_rate', {r(f'avg({YES})', 4)} FROM b
      UNION ALL SELECT 'B', 'previous_contact_rate', {r('avg(previous_contact_flag::INT)', 4)} FROM b"""),
)
D2 = f"""SELECT balance_quartile, n AS customer_count, {r('k::DOUBLE / n', 4)} AS churn_rate,
  {r('(sum(k) OVER () - k)::DOUBLE / (sum(n) OVER () - n)', 4)} AS rest_churn_rate
  FROM (SELECT balance_quartile, count(*) AS n, sum(churn) AS k
        FROM (SELECT *, ntile(4) OVER (ORDER BY current_balance, customer_id) AS balance_quartile FROM a {{w}}) GROUP BY 1)"""
add("d2_churn_by_quartile", lambda s, d: dash.churn_by_quartile(profile(s, d)), with_roles(A, D2.format(w="")))
add(
    "d3_segment_comparison",
    lambda s, d: dash.segment_comparison(segment_profile(stand_in_segments(s, d))).withColumn("value", round_to("value", 2)),
    with_roles(SEGMENTS, f"""
      , p AS (SELECT segment, count(customer_id)::DOUBLE AS customer_count, avg(age) AS avg_age, avg(vintage) AS avg_vintage_days,
        avg(current_balance) AS avg_current_balance, median(current_balance) AS median_current_balance,
        avg(current_month_credit) AS avg_month_credit, avg(current_month_debit) AS avg_month_debit,
        avg(churn) AS churn_rate, {r('count(*) * 100.0 / (SELECT count(*) FROM g)', 1)} AS pct_of_customers FROM g GROUP BY 1)
      SELECT segment, measure, {r('value', 2)} AS value
      FROM (UNPIVOT p ON customer_count, avg_age, avg_vintage_days, avg_current_balance, median_current_balance,
            avg_month_credit, avg_month_debit, churn_rate, pct_of_customers INTO NAME measure VALUE value)"""),
)
add(
    "d4_adoption_by_contact",
    lambda s, d: dash.adoption_by_contact(track_b(s, d)),
    with_roles(B, f"""
      , t AS (SELECT avg({YES}) FILTER (previous_contact_flag) AS p1, avg({YES}) FILTER (NOT previous_contact_flag) AS p2,
        count(*) FILTER (previous_contact_flag) AS n1, count(*) FILTER (NOT previous_contact_flag) AS n2 FROM b),
      u AS (SELECT p1 - p2 AS diff, 1.959964::DOUBLE * sqrt(p1 * (1 - p1) / n1 + p2 * (1 - p2) / n2) AS w FROM t)
      SELECT previous_contact_flag, count(*) AS observation_count, {ADOPT},
        (SELECT {r('diff', 6)} FROM u) AS diff, (SELECT {r('diff - w', 6)} FROM u) AS lo, (SELECT {r('diff + w', 6)} FROM u) AS hi
      FROM b GROUP BY 1"""),
)
add("d5_adoption_by_job", lambda s, d: dash.adoption_by_job(track_b(s, d)), _by_sql("job"))
add("d6_adoption_by_age_band", lambda s, d: dash.adoption_by_age_band(track_b(s, d)), with_roles(B, AGE_BAND_QUERY))
add("d7_churn_by_recency", lambda s, d: dash.churn_by_recency(profile(s, d)), with_roles(A, RECENCY_QUERY))
add("d8_balance_context", lambda s, d: dash.balance_context(track_b_secondary(s, d)), with_roles(B2, BALANCE_TILES_SQL))
add(
    "d9_filtered_churn_by_quartile",
    lambda s, d: dash.churn_by_quartile(profile(s, d), "customer_nw_category = 2"),
    with_roles(A, D2.format(w="WHERE customer_nw_category = 2")),
)
add(
    "d9_filtered_adoption_by_job",
    lambda s, d: dash.adoption_by_job(track_b(s, d), F.col("month") == "may"),
    with_roles(B, f"SELECT job, count(*) AS observation_count, {ADOPT} FROM b WHERE month = 'may' GROUP BY 1"),
)
add(
    "d9_adoption_extract",
    lambda s, d: _rounded(dash.grain_extract(
        track_b(s, d), [["job"], ["month"], ["job", "month"], []],
        {"all": None, "may": F.col("month") == "may", "contacted": F.col("previous_contact_flag")},
        ["observation_count", "adoption_rate", "previous_contact_rate"]), 4, "adoption_rate", "previous_contact_rate"),
    with_roles(B, _grains_sql("b", [["job"], ["month"], ["job", "month"], []], {"all": "true", "may": "month = 'may'", "contacted": "previous_contact_flag"},
        f"count(*) AS observation_count, {ADOPT}, {r('avg(previous_contact_flag::INT)', 4)} AS previous_contact_rate")),
)
