"""The role mapping as DuckDB SQL: common table expressions for the oracle queries."""

A_RAW = """
a_orders AS (
  SELECT o_custkey, min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS last_day,
    0.01::DOUBLE + sum(CASE WHEN o_orderdate >= DATE '2001-05-01' THEN o_totalprice ELSE 0 END) AS current_month_credit,
    0.01::DOUBLE + sum(CASE WHEN o_orderdate >= DATE '2001-02-01' AND o_orderdate < DATE '2001-05-01' THEN o_totalprice ELSE 0 END) AS previous_month_credit,
    0.01::DOUBLE + sum(CASE WHEN o_orderdate >= DATE '2001-05-01' AND o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) AS current_month_debit,
    0.01::DOUBLE + sum(CASE WHEN o_orderdate >= DATE '2001-02-01' AND o_orderdate < DATE '2001-05-01' AND o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) AS previous_month_debit
  FROM orders GROUP BY 1),
a_raw AS (
  SELECT c_custkey AS customer_id,
    date_diff('day', first_day, DATE '2001-08-01')::INT AS vintage,
    (1 + (c_custkey * 37) % 90)::INT AS age,
    CASE WHEN c_custkey % 53 = 0 THEN NULL WHEN c_custkey % 5 < 3 THEN 'Male' ELSE 'Female' END AS gender,
    (CASE WHEN c_custkey % 12 = 0 THEN NULL WHEN c_custkey % 211 = 7 THEN 25 + c_custkey % 28 ELSE c_custkey % 4 END)::DOUBLE AS dependents,
    CASE WHEN c_custkey % 350 = 0 THEN NULL ELSE c_mktsegment END AS occupation,
    ((c_custkey * 31) % 1600)::DOUBLE AS city,
    (1 + c_nationkey % 3)::INT AS customer_nw_category,
    ((c_custkey * 17) % 3185)::INT AS branch_code,
    c_acctbal AS current_balance,
    c_acctbal * 0.9::DOUBLE + c_custkey % 100 AS previous_month_end_balance,
    c_acctbal * 0.8::DOUBLE + c_custkey % 200 AS average_monthly_balance_prevq,
    c_acctbal * 0.7::DOUBLE - c_custkey % 300 AS average_monthly_balance_prevq2,
    current_month_credit, previous_month_credit, current_month_debit, previous_month_debit,
    c_acctbal * 0.95::DOUBLE + c_custkey % 50 AS current_month_balance,
    c_acctbal * 0.85::DOUBLE + c_custkey % 70 AS previous_month_balance,
    (CASE WHEN (c_custkey * 7919) % 10007 % 100 < (CASE WHEN c_acctbal < 1800 THEN 40 ELSE 11 END) THEN 1 ELSE 0 END)::INT AS churn,
    CASE WHEN c_custkey % 9 = 0 THEN 'NaT' ELSE strftime(last_day, '%Y-%m-%d') END AS last_transaction
  FROM customer JOIN a_orders ON c_custkey = o_custkey)"""

A = A_RAW + """,
a AS (
  SELECT * REPLACE (
      CASE WHEN dependents > 9 THEN NULL ELSE dependents END AS dependents,
      try_cast(nullif(last_transaction, 'NaT') AS DATE) AS last_transaction),
    coalesce(age < 18, false) AS age_under_18_flag,
    date_diff('day', try_cast(nullif(last_transaction, 'NaT') AS DATE), DATE '2001-08-01')::INT AS days_since_last_transaction
  FROM a_raw)"""

_B_BASE = """
b_base AS (
  SELECT *, date_diff('day', lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)::DATE, o_orderdate::DATE) AS gap,
    (year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS m
  FROM orders JOIN customer ON o_custkey = c_custkey),
b_wide AS (
  SELECT o_orderkey AS observation_id,
    (17 + (o_custkey * 37) % 82)::INT AS age,
    CASE WHEN o_custkey % 120 = 0 THEN 'unknown' ELSE c_mktsegment END AS job,
    CASE WHEN o_custkey % 500 = 0 THEN 'unknown' WHEN o_custkey % 3 = 0 THEN 'married' WHEN o_custkey % 3 = 1 THEN 'single' ELSE 'divorced' END AS marital,
    o_orderpriority AS education,
    CASE WHEN o_orderkey % 5 = 0 THEN 'unknown' WHEN o_orderkey % 997 = 1 THEN 'yes' ELSE 'no' END AS default_credit,
    floor(c_acctbal)::INT AS balance,
    CASE WHEN o_orderkey % 41 = 0 THEN 'unknown' WHEN o_orderkey % 2 = 0 THEN 'yes' ELSE 'no' END AS housing,
    CASE WHEN o_orderkey % 41 = 0 THEN 'unknown' WHEN o_orderkey % 7 = 0 THEN 'yes' ELSE 'no' END AS loan,
    CASE WHEN o_orderkey % 3 = 0 THEN 'telephone' ELSE 'cellular' END AS contact,
    day(o_orderdate)::INT AS day,
    lower(strftime(o_orderdate, '%b')) AS month,
    lower(strftime(o_orderdate, '%a')) AS day_of_week,
    (10 + (o_orderkey * 53) % 4900)::INT AS duration,
    (1 + o_orderkey % 6)::INT AS campaign,
    (CASE WHEN gap <= 30 THEN gap END)::INT AS pdays,
    (CASE WHEN gap <= 30 THEN 1 + o_orderkey % 6 ELSE 0 END)::INT AS previous,
    CASE WHEN gap <= 30 THEN CASE WHEN o_orderstatus = 'F' THEN 'success' ELSE 'failure' END ELSE 'nonexistent' END AS poutcome,
    -3.4::DOUBLE + 0.2::DOUBLE * (m % 25) AS emp_var_rate,
    92.2::DOUBLE + 0.1::DOUBLE * (m % 26) AS cons_price_idx,
    -50.8::DOUBLE + 0.5::DOUBLE * (m % 48) AS cons_conf_idx,
    0.634::DOUBLE + 0.05::DOUBLE * (m % 80) AS euribor3m,
    4963.6::DOUBLE + 5::DOUBLE * (m % 53) AS nr_employed,
    CASE WHEN (o_orderkey * 7919) % 10007 % 100 < (CASE WHEN gap <= 30 AND o_orderstatus = 'F' THEN 65 WHEN gap <= 30 THEN 30 WHEN m % 80 < 20 THEN 18 ELSE 7 END) THEN 'yes' ELSE 'no' END AS y
  FROM b_base)"""

_COPIES = "SELECT * FROM {t} UNION ALL SELECT * FROM {t} WHERE observation_id % 1000 = 3"

# raw contacts: pdays holds the sentinel, no key, some rows twice
B_RAW = _B_BASE + f""",
b_keyed AS (SELECT * EXCLUDE (balance, day) REPLACE (coalesce(pdays, 999)::INT AS pdays) FROM b_wide),
b_raw AS (SELECT * EXCLUDE (observation_id) FROM ({_COPIES.format(t="b_keyed")}))"""

B2_RAW = _B_BASE + f""",
b2_keyed AS (SELECT * EXCLUDE (day_of_week, emp_var_rate, cons_price_idx, cons_conf_idx, euribor3m, nr_employed)
             REPLACE (coalesce(pdays, -1)::INT AS pdays) FROM b_wide),
b2_raw AS (SELECT * EXCLUDE (observation_id) FROM ({_COPIES.format(t="b2_keyed")}))"""

_SPLIT = """
  SELECT *, pdays <> {s} AS previous_contact_flag,
    (CASE WHEN pdays <> {s} THEN pdays END)::DOUBLE AS days_since_previous_contact
  FROM {t}"""

B = B_RAW + f",\nb AS ({_SPLIT.format(s=999, t='b_keyed')})"
B2 = B2_RAW + f",\nb2 AS ({_SPLIT.format(s=-1, t='b2_keyed')})"
B_CLEAN = B_RAW + f",\nb_clean AS ({_SPLIT.format(s=999, t='(SELECT DISTINCT * FROM b_raw)')})"
B2_CLEAN = B2_RAW + f",\nb2_clean AS ({_SPLIT.format(s=-1, t='b2_raw')})"

SCORES = A + """,
s AS (
  SELECT customer_id, churn AS label,
    ((customer_id * 7919) % 10007 % 100 * 7 % 100 + CASE WHEN churn = 1 THEN 25 ELSE 0 END) / 125.0::DOUBLE AS prob
  FROM a)"""

SEGMENTS = A + """,
g AS (
  SELECT *, CASE WHEN current_balance >= 6000 THEN 0 WHEN vintage < 2000 THEN 1
                 WHEN current_month_credit > 1 THEN 2 ELSE 3 END AS segment
  FROM a)"""


def with_roles(ctes: str, query: str) -> str:
    return f"WITH {ctes.strip()}\n{query.strip()}"


def r(expr: str, digits: int) -> str:
    """Rounding as the Spark side does it: scale, round, unscale."""
    s = f"{10**digits}.0::DOUBLE"
    return f"round(({expr})::DOUBLE * {s}) / {s}"


# uniform hash of a key, same digits as functions.expr.key_hash
def key_hash(key: str, seed: int = 42) -> str:
    return f"('0x' || substr(md5('{seed}|' || {key}), 1, 15))::BIGINT"
