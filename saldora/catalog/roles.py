"""Test tables seen as bank data: the role mapping of FIXTURES.md.

Customers with their orders play the churn file, orders play the campaign contacts.
Everything is derived from whole tables; nothing here belongs to the library proper.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldora.operators.cleaning import (
    NEVER_PRIMARY, NEVER_SECONDARY, clean_campaign, clean_campaign_secondary, clean_churn,
    split_sentinel,
)
from saldora.operators.relational import rename
from saldora.sources.schemas import CAMPAIGN_NAMES, CHURN_NAMES, CHURN_RAW

# Latest order date in the tables; plays the role of the latest transaction date.
REF_DATE = "2001-08-01"


def planned(build):
    """Build a role's logical plan once per session and directory (no data is kept)."""
    plans: dict = {}

    @functools.wraps(build)
    def get(spark: SparkSession, sf_dir: str):
        key = (id(spark), spark.sparkContext.applicationId, sf_dir)
        if key not in plans:
            plans[key] = build(spark, sf_dir)
        return plans[key]

    return get


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --------------------------------------------------------------------- track A


@planned
def track_a_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw churn file: text dates with markers, implausible dependents."""
    this = "o_orderdate >= date'2001-05-01'"
    prev = "o_orderdate >= date'2001-02-01' AND o_orderdate < date'2001-05-01'"
    debit = "o_orderstatus = 'F'"

    def money(cond: str, name: str):
        return F.expr(f"0.01D + sum(CASE WHEN {cond} THEN o_totalprice ELSE 0D END) AS {name}")

    activity = (
        table(spark, sf_dir, "orders")
        .groupBy(F.expr("o_custkey AS customer_id"))
        .agg(
            F.expr("min(cast(o_orderdate AS date)) AS first_day"),
            F.expr("max(cast(o_orderdate AS date)) AS last_day"),
            money(this, "current_month_credit"),
            money(prev, "previous_month_credit"),
            money(f"{this} AND {debit}", "current_month_debit"),
            money(f"{prev} AND {debit}", "previous_month_debit"),
        )
    )
    k = "c_custkey"
    rows = table(spark, sf_dir, "customer").join(activity, F.expr("c_custkey = customer_id"))
    exprs = {
        "vintage": f"datediff(date'{REF_DATE}', first_day)",
        "age": f"1 + ({k} * 37) % 90",
        "gender": f"CASE WHEN {k} % 53 = 0 THEN NULL WHEN {k} % 5 < 3 THEN 'Male' ELSE 'Female' END",
        "dependents": f"""CASE WHEN {k} % 12 = 0 THEN NULL WHEN {k} % 211 = 7 THEN 25 + {k} % 28
                          ELSE {k} % 4 END""",
        "occupation": f"CASE WHEN {k} % 350 = 0 THEN NULL ELSE c_mktsegment END",
        "city": f"({k} * 31) % 1600",
        "customer_nw_category": "1 + c_nationkey % 3",
        "branch_code": f"({k} * 17) % 3185",
        "current_balance": "c_acctbal",
        "previous_month_end_balance": f"c_acctbal * 0.9D + {k} % 100",
        "average_monthly_balance_prevQ": f"c_acctbal * 0.8D + {k} % 200",
        "average_monthly_balance_prevQ2": f"c_acctbal * 0.7D - {k} % 300",
        "current_month_balance": f"c_acctbal * 0.95D + {k} % 50",
        "previous_month_balance": f"c_acctbal * 0.85D + {k} % 70",
        "churn": f"""CASE WHEN ({k} * 7919) % 10007 % 100 <
                     CASE WHEN c_acctbal < 1800 THEN 40 ELSE 11 END THEN 1 ELSE 0 END""",
        "last_transaction": f"CASE WHEN {k} % 9 = 0 THEN 'NaT' ELSE cast(last_day AS string) END",
    }
    return rows.selectExpr(
        *[
            f"cast({exprs.get(f.name, f.name)} AS {f.dataType.simpleString()}) AS `{f.name}`"
            for f in CHURN_RAW
        ]
    )


@planned
def track_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned churn table."""
    return rename(clean_churn(track_a_raw(spark, sf_dir)).data, CHURN_NAMES)


# --------------------------------------------------------------------- track B


def _contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with customer attributes and ``gap``: days since the previous order.

    The lag runs over a customer's distinct order dates and not over the orders: order
    dates are calendar days here, so a customer with a third of all orders still has
    only a few thousand rows there. Orders that share their date with an earlier one of
    the customer have gap 0.
    """
    orders = table(spark, sf_dir, "orders")
    dates = (
        orders.groupBy("o_custkey", "o_orderdate")
        .agg(F.expr("min(o_orderkey) AS first_key"))
        .selectExpr(
            "*", "lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS prev"
        )
        .join(
            table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"),
            F.expr("o_custkey = c_custkey"),
        )
        .drop("c_custkey")
    )
    return orders.join(dates, ["o_custkey", "o_orderdate"]).selectExpr(
        "*",
        "cast(o_orderdate AS date) AS day",
        """CASE WHEN o_orderkey = first_key
           THEN datediff(cast(o_orderdate AS date), cast(prev AS date)) ELSE 0 END AS gap""",
        "(year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS m",
    )


_B_EXPRS = {
    "observation_id": "o_orderkey",
    "age": "cast(17 + (o_custkey * 37) % 82 AS int)",
    "job": "CASE WHEN o_custkey % 120 = 0 THEN 'unknown' ELSE c_mktsegment END",
    "marital": """CASE WHEN o_custkey % 500 = 0 THEN 'unknown'
                  ELSE element_at(array('married', 'single', 'divorced'),
                                  cast(o_custkey % 3 + 1 AS int)) END""",
    "education": "o_orderpriority",
    "default": """CASE WHEN o_orderkey % 5 = 0 THEN 'unknown' WHEN o_orderkey % 997 = 1 THEN 'yes'
                  ELSE 'no' END""",
    "balance": "cast(floor(c_acctbal) AS int)",
    "housing": """CASE WHEN o_orderkey % 41 = 0 THEN 'unknown' WHEN o_orderkey % 2 = 0 THEN 'yes'
                  ELSE 'no' END""",
    "loan": """CASE WHEN o_orderkey % 41 = 0 THEN 'unknown' WHEN o_orderkey % 7 = 0 THEN 'yes'
               ELSE 'no' END""",
    "contact": "CASE WHEN o_orderkey % 3 = 0 THEN 'telephone' ELSE 'cellular' END",
    "day": "dayofmonth(day)",
    "month": "lower(date_format(day, 'MMM'))",
    "day_of_week": "lower(date_format(day, 'E'))",
    "duration": "cast(10 + (o_orderkey * 53) % 4900 AS int)",
    "campaign": "cast(1 + o_orderkey % 6 AS int)",
    "previous": "CASE WHEN gap <= 30 THEN cast(1 + o_orderkey % 6 AS int) ELSE 0 END",
    "poutcome": """CASE WHEN gap <= 30 THEN CASE WHEN o_orderstatus = 'F' THEN 'success'
                   ELSE 'failure' END ELSE 'nonexistent' END""",
    "emp.var.rate": "-3.4D + 0.2D * (m % 25)",
    "cons.price.idx": "92.2D + 0.1D * (m % 26)",
    "cons.conf.idx": "-50.8D + 0.5D * (m % 48)",
    "euribor3m": "0.634D + 0.05D * (m % 80)",
    "nr.employed": "4963.6D + 5D * (m % 53)",
    "y": """CASE WHEN (o_orderkey * 7919) % 10007 % 100 <
            CASE WHEN gap <= 30 AND o_orderstatus = 'F' THEN 65 WHEN gap <= 30 THEN 30
                 WHEN m % 80 < 20 THEN 18 ELSE 7 END THEN 'yes' ELSE 'no' END""",
}

_B_PRIMARY = [
    "observation_id", "age", "job", "marital", "education", "default", "housing", "loan",
    "contact", "month", "day_of_week", "duration", "campaign", "pdays", "previous",
    "poutcome", "emp.var.rate", "cons.price.idx", "cons.conf.idx", "euribor3m",
    "nr.employed", "y",
]
_B_SECONDARY = [
    "observation_id", "age", "job", "marital", "education", "default", "balance", "housing",
    "loan", "contact", "day", "month", "duration", "campaign", "pdays", "previous",
    "poutcome", "y",
]


def _campaign(spark: SparkSession, sf_dir: str, names: list[str], never: int) -> DataFrame:
    exprs = {**_B_EXPRS, "pdays": f"CASE WHEN gap <= 30 THEN gap ELSE {never} END"}
    return _contacts(spark, sf_dir).selectExpr(*[f"{exprs[n]} AS `{n}`" for n in names])


@planned
def track_b_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw primary contacts with their key, names still dotted."""
    return _campaign(spark, sf_dir, _B_PRIMARY, 999)


@planned
def track_b_secondary_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _campaign(spark, sf_dir, _B_SECONDARY, -1)


def _with_copies(df: DataFrame) -> DataFrame:
    """The raw file: no key, some rows twice."""
    doubled = df.select(
        "*",
        F.explode(
            F.when(F.col("observation_id") % 1000 == 3, F.array(F.lit(1), F.lit(2))).otherwise(
                F.array(F.lit(1))
            )
        ).alias("__copy"),
    )
    return doubled.drop("__copy", "observation_id")


@planned
def track_b_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_copies(track_b_keyed(spark, sf_dir))


@planned
def track_b_secondary_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_copies(track_b_secondary_keyed(spark, sf_dir))


@planned
def track_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned primary contacts, keyed by ``observation_id``, plain names."""
    keyed = rename(track_b_keyed(spark, sf_dir), CAMPAIGN_NAMES)
    return split_sentinel(
        keyed, "pdays", NEVER_PRIMARY, "previous_contact_flag", "days_since_previous_contact"
    )


@planned
def track_b_secondary(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = rename(track_b_secondary_keyed(spark, sf_dir), CAMPAIGN_NAMES)
    return split_sentinel(
        keyed, "pdays", NEVER_SECONDARY, "previous_contact_flag", "days_since_previous_contact"
    )


@planned
def cleaned_b(spark: SparkSession, sf_dir: str):
    return clean_campaign(track_b_raw(spark, sf_dir))


@planned
def cleaned_b_secondary(spark: SparkSession, sf_dir: str):
    return clean_campaign_secondary(track_b_secondary_raw(spark, sf_dir))


# ------------------------------------------------- stand-ins with a SQL twin


@planned
def stand_in_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customer_id, label, prob): a deterministic score with ties."""
    h = "(customer_id * 7919) % 10007 % 100"
    return track_a(spark, sf_dir).select(
        "customer_id",
        F.col("churn").alias("label"),
        F.expr(
            f"({h} * 7 % 100 + CASE WHEN churn = 1 THEN 25 ELSE 0 END) / 125.0D"
        ).alias("prob"),
    )


@planned
def stand_in_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Track A with a deterministic ``segment``."""
    return track_a(spark, sf_dir).withColumn(
        "segment",
        F.expr(
            """CASE WHEN current_balance >= 6000 THEN 0 WHEN vintage < 2000 THEN 1
               WHEN current_month_credit > 1 THEN 2 ELSE 3 END"""
        ),
    )
