"""Explicit schemas of the raw files, the clean tables and the star schema.

Column names and types are fixed values of the data sources.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import types as T

from saldora.ddl import data_type, struct


CHURN_RAW = struct(
    """customer_id bigint, vintage int, age int, gender string, dependents double,
    occupation string, city double, customer_nw_category int, branch_code int,
    current_balance double, previous_month_end_balance double,
    average_monthly_balance_prevQ double, average_monthly_balance_prevQ2 double,
    current_month_credit double, previous_month_credit double,
    current_month_debit double, previous_month_debit double,
    current_month_balance double, previous_month_balance double,
    churn int, last_transaction string"""
)

CAMPAIGN_RAW = struct(
    """age int, job string, marital string, education string, `default` string,
    housing string, loan string, contact string, month string, day_of_week string,
    duration int, campaign int, pdays int, previous int, poutcome string,
    `emp.var.rate` double, `cons.price.idx` double, `cons.conf.idx` double,
    euribor3m double, `nr.employed` double, y string"""
)

CAMPAIGN_SECONDARY_RAW = struct(
    """age int, job string, marital string, education string, `default` string,
    balance int, housing string, loan string, contact string, day int, month string,
    duration int, campaign int, pdays int, previous int, poutcome string, y string"""
)

# raw name -> name in the clean and star tables
CHURN_NAMES = {
    "average_monthly_balance_prevQ": "average_monthly_balance_prevq",
    "average_monthly_balance_prevQ2": "average_monthly_balance_prevq2",
}
CAMPAIGN_NAMES = {
    "default": "default_credit",
    "emp.var.rate": "emp_var_rate",
    "cons.price.idx": "cons_price_idx",
    "cons.conf.idx": "cons_conf_idx",
    "nr.employed": "nr_employed",
}

STAR: dict[str, T.StructType] = {
    "track_a.dim_customer": struct(
        """customer_id bigint, vintage int, age int, age_under_18_flag boolean,
        gender string, dependents double, occupation string, city double,
        customer_nw_category int, branch_code int"""
    ),
    "track_a.fact_customer_balance": struct(
        """customer_id bigint, current_balance double, previous_month_end_balance double,
        average_monthly_balance_prevq double, average_monthly_balance_prevq2 double,
        current_month_balance double, previous_month_balance double"""
    ),
    "track_a.fact_customer_activity": struct(
        """customer_id bigint, current_month_credit double, previous_month_credit double,
        current_month_debit double, previous_month_debit double, last_transaction date"""
    ),
    "track_a.fact_customer_churn": struct("customer_id bigint, churn int"),
    "track_b.marketing_observation": struct(
        """observation_id bigint, age int, job string, marital string, education string,
        default_credit string, housing string, loan string, contact string, month string,
        day_of_week string, duration int, campaign int, previous_contact_flag boolean,
        days_since_previous_contact double, previous int, poutcome string,
        emp_var_rate double, cons_price_idx double, cons_conf_idx double,
        euribor3m double, nr_employed double, y string"""
    ),
    "track_b.marketing_observation_bank_full": struct(
        """observation_id bigint, age int, job string, marital string, education string,
        default_credit string, balance int, housing string, loan string, contact string,
        day int, month string, duration int, campaign int, previous_contact_flag boolean,
        days_since_previous_contact double, previous int, poutcome string, y string"""
    ),
}


def override(schema: T.StructType, types: Mapping[str, str | T.DataType]) -> T.StructType:
    """Schema with the type of single columns replaced; unknown names are an error."""
    unknown = set(types) - set(schema.names)
    if unknown:
        raise KeyError(f"no such column: {sorted(unknown)}")
    parsed = {
        n: data_type(t) if isinstance(t, str) else t for n, t in types.items()
    }
    return T.StructType(
        [T.StructField(f.name, parsed.get(f.name, f.dataType), f.nullable) for f in schema]
    )
