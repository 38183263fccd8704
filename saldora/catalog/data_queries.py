"""Sources, sinks and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from saldora.catalog.registry import Book
from saldora.catalog.roles import (
    REF_DATE, cleaned_b, cleaned_b_secondary, table, track_a, track_a_raw, track_b, track_b_keyed,
    track_b_raw, track_b_secondary, track_b_secondary_raw,
)
from saldora.catalog.roles_sql import A, A_RAW, B, B2, B2_CLEAN, B2_RAW, B_CLEAN, B_RAW, r, with_roles
from saldora.functions.expr import round_to
from saldora.operators import cleaning as cl
from saldora.operators.relational import rename
from saldora.plans import track_a as qa
from saldora.plans import track_b as qb
from saldora.plans.warehouse import (
    create_namespaces, load_tables, register_views, save_tables, star_track_a, star_track_b,
)
from saldora.session import scratch_path
from saldora.sources import (
    CAMPAIGN_NAMES, CAMPAIGN_RAW, CHURN_NAMES, CHURN_RAW, override, read_csv, write_csv,
    write_report,
)

BOOK = Book()
add = BOOK.add

CHURN_FILE_MONEY = [
    "current_balance", "previous_month_end_balance", "average_monthly_balance_prevq",
    "average_monthly_balance_prevq2", "current_month_credit", "previous_month_credit",
    "current_month_debit", "previous_month_debit", "current_month_balance",
    "previous_month_balance",
]
CHURN_FILE_PLAIN = [
    "customer_id", "vintage", "age", "gender", "dependents", "occupation", "city",
    "customer_nw_category", "branch_code", "churn",
]


def _round4(df, cols):
    return df.withColumns({c: round_to(c, 4) for c in cols})


def _sql_cols(plain, money, digits=4):
    return ", ".join([*plain, *[f"{r(c, digits)} AS {c}" for c in money]])


# ------------------------------------------------------------------ scans


def s1(spark, sf):
    """Comma CSV with header, written by Spark from the whole table and read back."""
    path = write_csv(track_a_raw(spark, sf), scratch_path(spark, "churn_csv"))
    return _round4(read_csv(spark, path, CHURN_RAW, names=CHURN_NAMES), CHURN_FILE_MONEY)


add("s1_csv_scan", s1, with_roles(
    A_RAW, f"SELECT {_sql_cols([*CHURN_FILE_PLAIN, 'last_transaction'], CHURN_FILE_MONEY)} FROM a_raw"))


CAMPAIGN_PLAIN = [
    "age", "job", "marital", "education", "default_credit", "housing", "loan", "contact",
    "month", "day_of_week", "duration", "campaign", "pdays", "previous", "poutcome", "y",
]
CAMPAIGN_MACRO = ["emp_var_rate", "cons_price_idx", "cons_conf_idx", "euribor3m", "nr_employed"]


def s2(spark, sf):
    """Semicolon CSV with quoted, dotted and reserved header names."""
    path = write_csv(track_b_raw(spark, sf), scratch_path(spark, "campaign_csv"), sep=";")
    df = read_csv(spark, path, CAMPAIGN_RAW, sep=";", names=CAMPAIGN_NAMES)
    return _round4(df, CAMPAIGN_MACRO)


add("s2_semicolon_csv_scan", s2,
    with_roles(B_RAW, f"SELECT {_sql_cols(CAMPAIGN_PLAIN, CAMPAIGN_MACRO)} FROM b_raw"))


def s3(spark, sf):
    """CSV with a date column read as a date."""
    path = write_csv(
        track_a(spark, sf).select("customer_id", "last_transaction"),
        scratch_path(spark, "dates_csv"),
    )
    schema = override(CHURN_RAW, {"last_transaction": "date"})
    wanted = type(schema)([schema["customer_id"], schema["last_transaction"]])
    return read_csv(spark, path, wanted)


add("s3_csv_scan_with_dates", s3, with_roles(A, "SELECT customer_id, last_transaction FROM a"))


def s4(spark, sf):
    """The clean file scanned once with its declared types, no sniffing."""
    path = write_csv(track_a(spark, sf), scratch_path(spark, "churn_clean_csv"))
    schema = override(CHURN_RAW, {"last_transaction": "date"}).add("age_under_18_flag", "boolean")
    df = read_csv(spark, path, schema, names=CHURN_NAMES)
    return _round4(df, CHURN_FILE_MONEY)


add("s4_typed_csv_scan", s4, with_roles(
    A, f"SELECT {_sql_cols([*CHURN_FILE_PLAIN, 'last_transaction', 'age_under_18_flag'], CHURN_FILE_MONEY)} FROM a"))


def s5(spark, sf):
    """A per-column type override: y stays text, codes become long."""
    path = write_csv(track_b_raw(spark, sf), scratch_path(spark, "override_csv"), sep=";")
    df = read_csv(
        spark, path, CAMPAIGN_RAW, sep=";", types={"y": "string", "duration": "bigint"},
        names=CAMPAIGN_NAMES,
    )
    kinds = F.lit(dict(df.dtypes)["y"] + "/" + dict(df.dtypes)["duration"])
    return df.groupBy("y").agg(
        F.count(F.lit(1)).alias("n"), F.sum("duration").alias("total_duration")
    ).withColumn("types", kinds)


add("s5_csv_scan_type_override", s5, with_roles(
    B_RAW, "SELECT y, count(*) AS n, sum(duration)::BIGINT AS total_duration, 'string/bigint' AS types FROM b_raw GROUP BY 1"))

# ----------------------------------------------------------- star schema


def _star(spark, sf):
    return {
        **star_track_a(track_a(spark, sf)),
        **star_track_b(track_b(spark, sf), track_b_secondary(spark, sf)),
    }


def s6(spark, sf):
    """The six typed tables, written and read back: (table, column, type, rows)."""
    tables, path = _star(spark, sf), scratch_path(spark, "star")
    save_tables(tables, path)
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(n).alias("table_name"),
            F.explode(F.array(*[
                F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type"))
                for f in df.schema
            ])).alias("c"),
            "rows",
        ).select("table_name", "c.*", "rows")
        for n, df in load_tables(spark, path, list(tables)).items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _s6_sql():
    from saldora.sources import STAR

    counts = {"track_a": "(SELECT count(*) FROM a)", "track_b": "(SELECT count(*) FROM b)"}
    rows = [
        f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS type, "
        f"{counts[t.split('.')[0]]} AS rows"
        for t, s in STAR.items() for f in s
    ]
    return with_roles(A + "," + B, "\nUNION ALL ".join(rows))


add("s6_typed_tables", s6, _s6_sql())


def saved_star(spark, sf):
    """Track A star tables in their namespace, bucketed by customer."""
    path = scratch_path(spark, "namespaces")
    create_namespaces(spark, path)
    tables = star_track_a(track_a(spark, sf))
    save_tables(tables, path, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return {n: spark.table(n) for n in tables}


def s7(spark, sf):
    """Namespaces hold the tables of their track; rows per table."""
    rows = None
    for n, df in saved_star(spark, sf).items():
        part = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(n.split(".")[0]).alias("namespace"), F.lit(n.split(".")[1]).alias("table_name"), "rows"
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows


add("s7_namespaces", s7, with_roles(A, "\nUNION ALL ".join(
    f"SELECT 'track_a' AS namespace, '{t}' AS table_name, count(*) AS rows FROM a"
    for t in ("dim_customer", "fact_customer_balance", "fact_customer_activity", "fact_customer_churn"))))

OBS_PLAIN = [
    "observation_id", "age", "job", "marital", "education", "default_credit", "housing", "loan",
    "contact", "month", "day_of_week", "duration", "campaign", "previous_contact_flag",
    "days_since_previous_contact", "previous", "poutcome", "y",
]


def s8(spark, sf):
    """Observation table loaded with projection, renaming and casts."""
    tables, path = star_track_b(track_b(spark, sf), track_b_secondary(spark, sf)), scratch_path(spark, "load")
    name = "track_b.marketing_observation"
    save_tables({name: tables[name]}, path)
    return _round4(load_tables(spark, path, [name])[name], CAMPAIGN_MACRO)


add("s8_insert_select_load", s8, with_roles(B, f"SELECT {_sql_cols(OBS_PLAIN, CAMPAIGN_MACRO)} FROM b"))


def s9(spark, sf):
    """The registered views, queried by name."""
    names = register_views(
        qa.with_recency(track_a(spark, sf), REF_DATE).select(*qa.PROFILE_COLUMNS), track_b(spark, sf)
    )
    parts = [
        spark.table(n).agg(F.count(F.lit(1)).alias("rows")).withColumn("view_name", F.lit(n)) for n in names
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


add("s9_views", s9, with_roles(A + "," + B, """
  SELECT 'track_a_customer_profile' AS view_name, count(*) AS rows FROM a
  UNION ALL SELECT 'track_a_churn_summary', count(*) FROM (SELECT DISTINCT
    CASE WHEN age < 18 THEN 0 WHEN age <= 25 THEN 1 WHEN age <= 35 THEN 2 WHEN age <= 45 THEN 3
         WHEN age <= 55 THEN 4 WHEN age <= 65 THEN 5 ELSE 6 END, customer_nw_category FROM a)
  UNION ALL SELECT 'track_b_campaign_summary', count(*) FROM (SELECT DISTINCT month, day_of_week FROM b)
  UNION ALL SELECT 'track_b_adoption_summary', count(*) FROM b"""))


def s10(spark, sf):
    """CSV sink: the report file holds a header and the rows, nothing else."""
    path = write_csv(qb.adoption_by_job(track_b(spark, sf)), scratch_path(spark, "report_csv"))
    return read_csv(
        spark, path, spark.range(0).selectExpr(
            "'' AS job", "0L AS observation_count", "0D AS adoption_rate").schema)


ADOPT_JOB = f"""SELECT job, count(*) AS observation_count,
  {r("avg(CASE WHEN y = 'yes' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)", 4)} AS adoption_rate FROM b GROUP BY 1"""
add("s10_csv_sink", s10, with_roles(B, ADOPT_JOB))


def s11(spark, sf):
    """Cleaning report as JSON, read back."""
    report = cl.clean_churn(track_a_raw(spark, sf)).report
    path = write_report(report, scratch_path(spark, "report_json"))
    return spark.read.schema(report.schema).json(path)


CHURN_REPORT = """SELECT count(*) AS original_rows,
  count(*) FILTER (last_transaction = 'NaT') AS last_transaction_marker_count,
  count(*) FILTER (try_cast(nullif(last_transaction, 'NaT') AS DATE) IS NULL) - count(*) FILTER (last_transaction = 'NaT') AS last_transaction_unparseable,
  count(try_cast(nullif(last_transaction, 'NaT') AS DATE)) AS last_transaction_valid_dates,
  count(*) FILTER (dependents > 9) AS dependents_invalid_count,
  count(*) FILTER (age < 18) AS age_under_18_count,
  count(DISTINCT customer_id) = count(*) AS key_unique_after_cleaning,
  count(*) AS final_rows FROM a_raw"""
add("s11_report_json", s11, with_roles(A_RAW, CHURN_REPORT))

# --------------------------------------------------------------- cleaning

add("c1_marker_to_null",
    lambda s, d: cl.null_marker(track_a_raw(s, d), "last_transaction", "NaT").select("customer_id", "last_transaction"),
    with_roles(A_RAW, "SELECT customer_id, nullif(last_transaction, 'NaT') AS last_transaction FROM a_raw"))
add("c2_marker_count",
    lambda s, d: track_a_raw(s, d).agg(cl.date_audit("last_transaction")["marker_count"].alias("marker_count")),
    with_roles(A_RAW, "SELECT count(*) FILTER (last_transaction = 'NaT') AS marker_count FROM a_raw"))
add("c3_lenient_dates",
    lambda s, d: cl.parse_date(track_a_raw(s, d), "last_transaction").select("customer_id", "last_transaction"),
    with_roles(A_RAW, "SELECT customer_id, try_cast(last_transaction AS DATE) AS last_transaction FROM a_raw"))
add("c4_date_audit",
    lambda s, d: track_a_raw(s, d).agg(*[c.alias(n) for n, c in cl.date_audit("last_transaction").items()]),
    with_roles(A_RAW, """SELECT count(*) FILTER (last_transaction = 'NaT') AS marker_count,
      count(*) FILTER (try_cast(last_transaction AS DATE) IS NULL) - count(*) FILTER (last_transaction = 'NaT') AS unparseable,
      count(try_cast(last_transaction AS DATE)) AS valid_dates FROM a_raw"""))
add("c5_implausible_to_null",
    lambda s, d: cl.null_above(track_a_raw(s, d), "dependents", cl.DEPENDENTS_CAP).select("customer_id", "dependents"),
    with_roles(A_RAW, "SELECT customer_id, CASE WHEN dependents > 9 THEN NULL ELSE dependents END AS dependents FROM a_raw"))
add("c6_minor_flag",
    lambda s, d: cl.flag_below(track_a_raw(s, d), "age", cl.ADULT_AGE, "age_under_18_flag")
    .select("customer_id", "age", "age_under_18_flag"),
    with_roles(A_RAW, "SELECT customer_id, age, coalesce(age < 18, false) AS age_under_18_flag FROM a_raw"))
add("c7_duplicate_count",
    lambda s, d: cl.duplicate_count(track_b_raw(s, d)),
    with_roles(B_RAW, "SELECT (SELECT count(*) FROM b_raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM b_raw)) AS duplicates"))
add("c8_duplicates_removed",
    lambda s, d: _round4(rename(cl.drop_duplicates(track_b_raw(s, d)), CAMPAIGN_NAMES), CAMPAIGN_MACRO),
    with_roles(B_RAW, f"SELECT {_sql_cols(CAMPAIGN_PLAIN, CAMPAIGN_MACRO)} FROM (SELECT DISTINCT * FROM b_raw)"))
add("c9_sentinel_split",
    lambda s, d: track_b(s, d).select("observation_id", "pdays", "previous_contact_flag", "days_since_previous_contact"),
    with_roles(B, "SELECT observation_id, pdays, previous_contact_flag, days_since_previous_contact FROM b"))
add("c10_flag_counts",
    lambda s, d: track_b(s, d).agg(
        F.count_if("previous_contact_flag").alias("contacted"), F.count_if(~F.col("previous_contact_flag")).alias("never")),
    with_roles(B, """SELECT count(*) FILTER (previous_contact_flag) AS contacted,
      count(*) FILTER (NOT previous_contact_flag) AS never FROM b"""))

UNKNOWN_COLS = ["job", "marital", "education", "default_credit", "housing", "loan", "contact", "month", "day_of_week", "poutcome", "y"]


def _unknown_sql(frame, cols):
    rows = "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} = 'unknown') AS n, "
        f"{r(f'avg(CASE WHEN {c} = {chr(39)}unknown{chr(39)} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)', 6)} AS rate FROM {frame}"
        for c in cols)
    return f"SELECT * FROM ({rows}) WHERE n > 0"


def _marker_rates(df):
    return cl.marker_rates(df).withColumn("rate", round_to("rate", 6))


add("c11_marker_columns",
    lambda s, d: cl.marker_rates(rename(track_b_raw(s, d), CAMPAIGN_NAMES)).select("column"),
    with_roles(B_RAW, f"SELECT \"column\" FROM ({_unknown_sql('b_raw', UNKNOWN_COLS)})"))
add("c12_marker_rates",
    lambda s, d: _marker_rates(rename(track_b_raw(s, d), CAMPAIGN_NAMES)),
    with_roles(B_RAW, _unknown_sql("b_raw", UNKNOWN_COLS)))
add("c13_unknown_kept",
    lambda s, d: cleaned_b(s, d).data.filter("job = 'unknown'").agg(F.count(F.lit(1)).alias("unknown_jobs")),
    with_roles(B_CLEAN, "SELECT count(*) AS unknown_jobs FROM b_clean WHERE job = 'unknown'"))
add("c14_key_unique",
    lambda s, d: cl.key_is_unique(track_a(s, d), "customer_id"),
    with_roles(A, """SELECT count(*) AS rows, count(DISTINCT customer_id) AS distinct_keys,
      count(*) = count(DISTINCT customer_id) AS is_unique FROM a"""))
add("c15_row_accounting",
    lambda s, d: cl.row_accounting(track_b_raw(s, d), cleaned_b(s, d).data),
    with_roles(B_CLEAN, """SELECT (SELECT count(*) FROM b_raw) AS rows_in, (SELECT count(*) FROM b_clean) AS rows_out,
      (SELECT count(*) FROM b_raw) - (SELECT count(*) FROM b_clean) AS rows_removed"""))


def outside_roles(s, d):
    """What the roles' definition leaves out: customers without orders, orders without a customer."""
    customers, orders = table(s, d, "customer"), table(s, d, "orders")
    lone = customers.join(orders, F.expr("c_custkey = o_custkey"), "left_anti")
    orphans = orders.join(customers, F.expr("c_custkey = o_custkey"), "left_anti")
    return lone.agg(F.count(F.lit(1)).alias("customers_without_orders")).withColumn(
        "orders_without_customer", orphans.agg(F.count(F.lit(1)).alias("n")).scalar())


add("c15_rows_outside_roles", outside_roles, """SELECT
  (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)) AS customers_without_orders,
  (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) AS orders_without_customer""")
add("c16_clean_churn",
    lambda s, d: _round4(track_a(s, d), CHURN_FILE_MONEY),
    with_roles(A, f"SELECT {_sql_cols([*CHURN_FILE_PLAIN, 'last_transaction', 'age_under_18_flag'], CHURN_FILE_MONEY)} FROM a"))
add("c16_clean_churn_report", lambda s, d: cl.clean_churn(track_a_raw(s, d)).report, with_roles(A_RAW, CHURN_REPORT))
add("c17_clean_campaign",
    lambda s, d: _round4(rename(cleaned_b(s, d).data, CAMPAIGN_NAMES), CAMPAIGN_MACRO),
    with_roles(B_CLEAN, "SELECT " + _sql_cols(
        [*CAMPAIGN_PLAIN, "previous_contact_flag", "days_since_previous_contact"], CAMPAIGN_MACRO) + " FROM b_clean"))
add("c17_clean_campaign_report",
    lambda s, d: cleaned_b(s, d).report,
    with_roles(B_CLEAN, """SELECT (SELECT count(*) FROM b_raw) AS original_rows, count(*) AS rows_after_dedup,
      (SELECT count(*) FROM b_raw) - count(*) AS duplicate_rows_removed,
      count(*) FILTER (previous_contact_flag) AS previously_contacted_count,
      count(*) FILTER (NOT previous_contact_flag) AS never_contacted_count FROM b_clean"""))
B2_PLAIN = ["age", "job", "marital", "education", "default_credit", "balance", "housing", "loan", "contact", "day",
            "month", "duration", "campaign", "pdays", "previous", "poutcome", "y", "previous_contact_flag",
            "days_since_previous_contact"]
add("c18_clean_campaign_secondary",
    lambda s, d: rename(cleaned_b_secondary(s, d).data, CAMPAIGN_NAMES).select(*B2_PLAIN),
    with_roles(B2_CLEAN, f"SELECT {', '.join(B2_PLAIN)} FROM b2_clean"))
add("c18_clean_campaign_secondary_report",
    lambda s, d: cleaned_b_secondary(s, d).report,
    with_roles(B2_CLEAN, """SELECT count(*) AS final_rows, count(*) FILTER (previous_contact_flag) AS previously_contacted_count,
      count(*) FILTER (NOT previous_contact_flag) AS never_contacted_count,
      (SELECT count(*) FROM b2_raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM b2_raw)) AS duplicate_rows_found
      FROM b2_clean"""))
