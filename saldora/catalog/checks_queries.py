"""Validation and data audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from saldora.catalog.registry import Book
from saldora.catalog.roles import (
    cleaned_b, cleaned_b_secondary, table, track_a, track_a_raw, track_b, track_b_raw,
    track_b_secondary, track_b_secondary_raw,
)
from saldora.catalog.roles_sql import A, A_RAW, B, B2, B2_RAW, B_CLEAN, B_RAW, r, with_roles
from saldora.functions.expr import indicator, round_to
from saldora.operators import quality as q
from saldora.operators.cleaning import duplicate_count, marker_rates
from saldora.operators.relational import rename
from saldora.sources import CAMPAIGN_NAMES

BOOK = Book()
add = BOOK.add

CHURN_REQUIRED = (
    "customer_id", "vintage", "age", "gender", "dependents", "occupation", "city",
    "customer_nw_category", "branch_code", "current_balance", "churn", "last_transaction",
    "age_under_18_flag",
)


def _customers(s, d):
    """Customers with orders: the rows track A must have."""
    return table(s, d, "orders").select("o_custkey").distinct().count()


def _contacts(s, d):
    """Rows track B must have: the raw ones less exact copies. The raw file has no key, so in larger
    tables different orders give equal rows, and those are one contact."""
    raw = track_b_raw(s, d)
    return raw.count() - duplicate_count(raw).first()["duplicates"]


def _check_sql(name, observed, expected="0", passed=None):
    passed = passed or f"({observed}) = 0"
    return f"SELECT '{name}' AS \"check\", ({observed})::BIGINT AS observed, '{expected}' AS expected, {passed} AS passed"


def _union(*rows):
    return "\nUNION ALL ".join(rows)


def churn_checks(df, rows: int):
    return [
        q.RowCount(rows), q.Columns(CHURN_REQUIRED), q.NotNull("customer_id"),
        q.Domain("churn", (0, 1)), q.MaxValue("dependents", 9),
        q.Absent("last_transaction", "NaT"), q.OfType("age_under_18_flag", "boolean"),
        *q.balance_not_null(df), q.Unique("customer_id"),
    ]


def campaign_checks(sentinel: int, rows: int):
    return [
        q.RowCount(rows), q.Columns(("previous_contact_flag", "duration")),
        q.Domain("y", ("yes", "no")),
        q.Implies("sentinel_absent", "previous_contact_flag", f"pdays <> {sentinel}"),
        q.Implies("value_missing", "NOT previous_contact_flag", "days_since_previous_contact IS NULL"),
        q.NoDuplicates(),
    ]


def v1(s, d):
    """Row count against an expected number: here the number of customers with orders."""
    return q.expect(track_a(s, d), [q.RowCount(_customers(s, d))]).select("check", "observed", "passed")


add("v1_row_count", v1, with_roles(A, """SELECT 'row_count' AS "check", count(*) AS observed,
  count(*) = (SELECT count(DISTINCT o_custkey) FROM orders) AS passed FROM a"""))
add("v2_columns_present", lambda s, d: q.expect(track_a(s, d), [q.Columns(CHURN_REQUIRED)]),
    with_roles(A, _check_sql("columns_present", "SELECT 0 * count(*) FROM a")))
add("v3_key_unique", lambda s, d: q.expect(track_a(s, d), [q.Unique("customer_id")]),
    with_roles(A, _check_sql("unique:customer_id", "SELECT count(*) - count(DISTINCT customer_id) FROM a")))
BALANCES = ["current_balance", "previous_month_end_balance", "average_monthly_balance_prevq",
            "average_monthly_balance_prevq2", "current_month_balance", "previous_month_balance"]
add("v4_not_null",
    lambda s, d: q.expect(track_a(s, d), [q.NotNull("customer_id"), q.NotNull("gender"), *q.balance_not_null(track_a(s, d))]),
    with_roles(A, _union(*[_check_sql(f"not_null:{c}", f"SELECT count(*) - count({c}) FROM a")
                           for c in ["customer_id", "gender", *BALANCES]])))
add("v5_domain",
    lambda s, d: q.expect(track_a(s, d), [q.Domain("churn", (0, 1)), q.Domain("gender", ("Male",))]),
    with_roles(A, _union(
        _check_sql("domain:churn", "SELECT count(*) FILTER (churn NOT IN (0, 1)) FROM a"),
        _check_sql("domain:gender", "SELECT count(*) FILTER (gender NOT IN ('Male')) FROM a"))))
add("v6_upper_bound",
    lambda s, d: q.expect(track_a_raw(s, d), [q.MaxValue("dependents", 9)]),
    with_roles(A_RAW, _check_sql("max_value:dependents", "SELECT count(*) FILTER (dependents > 9) FROM a_raw")))
add("v7_marker_absent",
    lambda s, d: q.expect(track_a_raw(s, d), [q.Absent("last_transaction", "NaT")]).unionByName(
        q.expect(track_a(s, d), [q.Absent("last_transaction", "NaT")])),
    with_roles(A, _union(
        _check_sql("absent:last_transaction", "SELECT count(*) FILTER (last_transaction = 'NaT') FROM a_raw"),
        _check_sql("absent:last_transaction", "SELECT 0 * count(*) FROM a"))))
add("v8_column_type", lambda s, d: q.expect(track_a(s, d), [q.OfType("age_under_18_flag", "boolean")]),
    with_roles(A, _check_sql("type:age_under_18_flag", "SELECT 0 * count(*) FROM a")))
_DUP = "SELECT (SELECT count(*) FROM {t}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t}))"
add("v9_no_duplicates",
    lambda s, d: q.expect(track_b_raw(s, d), [q.NoDuplicates()]).unionByName(
        q.expect(cleaned_b(s, d).data, [q.NoDuplicates()])),
    with_roles(B_CLEAN, _union(_check_sql("no_duplicates", _DUP.format(t="b_raw")),
                               _check_sql("no_duplicates", _DUP.format(t="b_clean")))))
add("v10_implication",
    lambda s, d: q.expect(track_b(s, d), campaign_checks(999, 0)[3:5]),
    with_roles(B, _union(
        _check_sql("implies:sentinel_absent", "SELECT count(*) FILTER (previous_contact_flag AND pdays = 999) FROM b"),
        _check_sql("implies:value_missing",
                   "SELECT count(*) FILTER (NOT previous_contact_flag AND days_since_previous_contact IS NOT NULL) FROM b"))))
add("v11_churn_summary",
    lambda s, d: track_a(s, d).agg(
        F.count(F.lit(1)).alias("rows"), round_to(F.avg(F.col("churn").cast("double")), 4).alias("churn_rate"),
        F.count_if(F.col("dependents").isNull()).alias("missing_dependents"),
        F.count_if(F.col("last_transaction").isNull()).alias("missing_last_transaction")),
    with_roles(A, f"""SELECT count(*) AS rows, {r('avg(churn)', 4)} AS churn_rate,
      count(*) - count(dependents) AS missing_dependents, count(*) - count(last_transaction) AS missing_last_transaction FROM a"""))
add("v11_campaign_summary",
    lambda s, d: track_b(s, d).agg(
        F.count(F.lit(1)).alias("rows"), round_to(F.avg(indicator("y", "yes").cast("double")), 4).alias("target_yes_rate"),
        round_to(F.avg(F.col("previous_contact_flag").cast("double")), 4).alias("previously_contacted_rate")),
    with_roles(B, f"""SELECT count(*) AS rows, {r("avg((y = 'yes')::INT)", 4)} AS target_yes_rate,
      {r('avg(previous_contact_flag::INT)', 4)} AS previously_contacted_rate FROM b"""))


def v12(s, d):
    """All expectations of the cleaned datasets; enforced, so a failure raises."""
    a, b = track_a(s, d), cleaned_b(s, d).data
    results = q.expect(a, churn_checks(a, _customers(s, d))).withColumn("dataset", F.lit("churn")).unionByName(
        q.expect(b, campaign_checks(999, _contacts(s, d))).withColumn("dataset", F.lit("campaign")))
    q.enforce(results)
    return results.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("checks"), F.count_if("passed").alias("passed"))


add("v12_enforced_expectations", v12, with_roles(A, """
  SELECT * FROM (VALUES ('churn', 14::BIGINT, 14::BIGINT), ('campaign', 6::BIGINT, 6::BIGINT)) t(dataset, checks, passed)
  WHERE (SELECT count(*) FROM a) > 0"""))


def v12_secondary(s, d):
    """The secondary extract keeps its duplicates: that check fails and is reported."""
    b2 = cleaned_b_secondary(s, d).data
    return q.expect(b2, campaign_checks(-1, 0)[1:])


add("v12_secondary_expectations", v12_secondary, with_roles(B2_RAW, _union(
    _check_sql("columns_present", "SELECT 0 * count(*) FROM b2_raw"),
    _check_sql("domain:y", "SELECT count(*) FILTER (y NOT IN ('yes', 'no')) FROM b2_raw"),
    _check_sql("implies:sentinel_absent", "SELECT 0 * count(*) FROM b2_raw"),
    _check_sql("implies:value_missing", "SELECT 0 * count(*) FROM b2_raw"),
    _check_sql("no_duplicates", _DUP.format(t="b2_raw")))))


def v13(s, d):
    """The guard passes frames of one track and refuses a mix; rows seen per track."""
    a, b = track_a(s, d), track_b(s, d)
    try:
        q.assert_same_track(a, b)
        refused = False
    except ValueError:
        refused = True
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(q.assert_same_track(df, df)).alias("track"), "rows", F.lit(refused).alias("mix_refused"))
        for df in (a, b)
    ]
    return parts[0].unionByName(parts[1])


add("v13_track_separation", v13, with_roles(A + "," + B, """
  SELECT 'a' AS track, count(*) AS rows, true AS mix_refused FROM a
  UNION ALL SELECT 'b', count(*), true FROM b"""))

# ------------------------------------------------------------------- audit

add("a1_inventory",
    lambda s, d: q.inventory({"churn": track_a_raw(s, d), "campaign": track_b_raw(s, d), "campaign_secondary": track_b_secondary_raw(s, d)}),
    with_roles(A_RAW + "," + B_RAW + "," + B2_RAW.split("b_wide AS")[1].split("FROM b_base),", 1)[1].strip(), """
      SELECT 'churn' AS dataset, count(*) AS rows, 21::BIGINT AS columns FROM a_raw
      UNION ALL SELECT 'campaign', count(*), 21 FROM b_raw
      UNION ALL SELECT 'campaign_secondary', count(*), 17 FROM b2_raw"""))


def _profile_sql(frame, cols):
    rows = []
    for name, kind in cols:
        numeric = kind not in ("string", "date", "boolean")
        lo, hi = (f"min({name})::DOUBLE", f"max({name})::DOUBLE") if numeric else ("NULL::DOUBLE", "NULL::DOUBLE")
        rows.append(
            f"SELECT '{name}' AS \"column\", '{kind}' AS type, {r(f'(count(*) - count({name})) * 100.0::DOUBLE / count(*)', 6)} AS missing_pct, "
            f"count(DISTINCT {name}) AS distinct_count, {r(lo, 4)} AS min_value, {r(hi, 4)} AS max_value FROM {frame}")
    return _union(*rows)


A_PROFILE = [
    ("customer_id", "bigint"), ("vintage", "int"), ("age", "int"), ("gender", "string"), ("dependents", "double"),
    ("occupation", "string"), ("city", "double"), ("customer_nw_category", "int"), ("branch_code", "int"),
    ("current_balance", "double"), ("churn", "int"), ("last_transaction", "string"),
]


def _shown(p):
    return p.withColumns({"missing_pct": round_to("missing_pct", 6), "min_value": round_to("min_value", 4),
                          "max_value": round_to("max_value", 4)})


add("a2_column_profile",
    lambda s, d: _shown(q.profile(track_a_raw(s, d).select(*[c for c, _ in A_PROFILE]))),
    with_roles(A_RAW, _profile_sql("a_raw", A_PROFILE)))
add("a2_column_profile_approx",
    lambda s, d: _shown(q.profile(rename(track_b_raw(s, d), CAMPAIGN_NAMES), approx=True)))
add("a2_sketch_bounds",
    lambda s, d: q.sketch_check(track_a_raw(s, d).select(*[c for c, _ in A_PROFILE])).drop("estimate"),
    with_roles(A_RAW, _union(*[
        f"SELECT '{name}' AS \"column\", count(DISTINCT {name}) AS distinct_count, true AS within FROM a_raw" for name, _ in A_PROFILE])))
add("a3_level_shares",
    lambda s, d: q.level_shares(track_a_raw(s, d), "occupation").withColumn("pct", round_to("pct", 4)),
    with_roles(A_RAW, f"""SELECT occupation AS level, count(*) AS n,
      {r('count(*) * 100.0::DOUBLE / (SELECT count(*) FROM a_raw)', 4)} AS pct FROM a_raw GROUP BY 1"""))
add("a3_top_levels",
    lambda s, d: q.level_shares(track_a_raw(s, d), "branch_code", top=5).withColumn("pct", round_to("pct", 4)),
    with_roles(A_RAW, f"""SELECT branch_code AS level, count(*) AS n,
      {r('count(*) * 100.0::DOUBLE / (SELECT count(*) FROM a_raw)', 4)} AS pct FROM a_raw GROUP BY 1
      ORDER BY n DESC, branch_code LIMIT 5"""))
add("a4_marker_audit",
    lambda s, d: marker_rates(rename(track_b_secondary_raw(s, d), CAMPAIGN_NAMES)).withColumn("rate", round_to("rate", 6)),
    with_roles(B2_RAW, "SELECT * FROM (" + _union(*[
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} = 'unknown') AS n, "
        f"{r(f'count(*) FILTER ({c} = {chr(39)}unknown{chr(39)})::DOUBLE / count(*)', 6)} AS rate FROM b2_raw"
        for c in ["job", "marital", "education", "default_credit", "housing", "loan", "contact", "month", "poutcome"]]) + ") WHERE n > 0"))
add("a5_sentinel_share",
    lambda s, d: q.sentinel_share(track_b_raw(s, d), "pdays", 999).withColumn("share", round_to("share", 6)),
    with_roles(B_RAW, f"SELECT {r('avg((pdays = 999)::INT)', 6)} AS share FROM b_raw"))
add("a6_negative_counts",
    lambda s, d: q.negative_counts(track_a(s, d), BALANCES),
    with_roles(A, _union(*[f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} < 0) AS negatives FROM a" for c in BALANCES])))
SKEW = ["current_balance", "current_month_credit", "current_month_debit"]
add("a7_skew_audit",
    lambda s, d: q.skew_audit(track_a(s, d), SKEW).withColumns({c: round_to(c, 4) for c in ("median", "p999", "max_value")}),
    with_roles(A, _union(*[
        f"SELECT '{c}' AS \"column\", {r(f'quantile_cont({c}, 0.5)', 4)} AS median, {r(f'quantile_cont({c}, 0.999)', 4)} AS p999, "
        f"{r(f'max({c})', 4)} AS max_value FROM a" for c in SKEW])))
add("a8_high_cardinality",
    lambda s, d: q.high_cardinality(track_a(s, d), ["city", "branch_code", "occupation", "gender"], 50),
    with_roles(A, "SELECT * FROM (" + _union(*[
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_count FROM a" for c in ("city", "branch_code", "occupation", "gender")])
        + ") WHERE distinct_count > 50"))
add("a9_target_balance",
    lambda s, d: q.target_balance({
        "churn": (track_a(s, d), F.col("churn")), "campaign": (track_b(s, d), indicator("y", "yes")),
        "campaign_secondary": (track_b_secondary(s, d), indicator("y", "yes")),
    }).withColumn("positive_rate", round_to("positive_rate", 6)),
    with_roles(A + "," + B, f"""SELECT 'churn' AS dataset, {r('avg(churn)', 6)} AS positive_rate FROM a
      UNION ALL SELECT 'campaign', {r("avg((y = 'yes')::INT)", 6)} FROM b
      UNION ALL SELECT 'campaign_secondary', {r("avg((y = 'yes')::INT)", 6)} FROM b_wide"""))


def a10(s, d):
    """Column difference of the two campaign extracts, with both row counts."""
    a, b = track_b(s, d), track_b_secondary(s, d)
    counts = {k: df.agg(F.count(F.lit(1))).scalar() for k, df in (("rows_a", a), ("rows_b", b))}
    return q.schema_diff(a, b).filter("in_a <> in_b").withColumns(counts)


add("a10_schema_difference", a10, with_roles(B, """
  SELECT c AS "column", c NOT IN ('balance', 'day') AS in_a, c IN ('balance', 'day') AS in_b,
    (SELECT count(*) FROM b) AS rows_a, (SELECT count(*) FROM b) AS rows_b
  FROM (VALUES ('balance'), ('day'), ('day_of_week'), ('emp_var_rate'), ('cons_price_idx'), ('cons_conf_idx'),
               ('euribor3m'), ('nr_employed')) t(c)"""))


def a11(s, d):
    """Is the cleaned extract a subset of the raw one, and the other way round?"""
    raw = rename(track_b_raw(s, d), CAMPAIGN_NAMES)
    part = rename(cleaned_b(s, d).data, CAMPAIGN_NAMES).select(*raw.columns)
    return q.is_subset(part, raw)


add("a11_subset_check", a11, with_roles(B_RAW, "SELECT true AS same_columns, 0 * count(*) AS rows_outside FROM b_raw"))
