"""Track A: customer profile, churn summary and the churn questions.

Every function takes the profile (or the star tables) and returns a lazy frame; row
order is left to the caller except for top-k reports, where it is the feature.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldora.functions.expr import age_group, days_since, recency_band, round_to
from saldora.operators.rank import group_median, with_ntile
from saldora.operators.relational import keep_groups, rate_by, top_k, with_group_values

# Latest observed transaction date, size limit and length of the reports.
REFERENCE_DATE = dt.date(2019, 12, 31)
MIN_GROUP = 100
TOP = 10

PROFILE_COLUMNS = [
    "customer_id", "age", "age_under_18_flag", "gender", "dependents", "occupation",
    "customer_nw_category", "current_balance", "previous_month_end_balance",
    "average_monthly_balance_prevq", "current_month_credit", "current_month_debit",
    "last_transaction", "days_since_last_transaction", "churn",
]


def with_recency(df: DataFrame, ref_date: dt.date | str = REFERENCE_DATE) -> DataFrame:
    return df.withColumn("days_since_last_transaction", days_since("last_transaction", ref_date))


def customer_profile(
    dim: DataFrame,
    balance: DataFrame,
    activity: DataFrame,
    churn: DataFrame,
    ref_date: dt.date | str = REFERENCE_DATE,
) -> DataFrame:
    """Star join of the four customer tables, one row per customer.

    All four are keyed by customer_id, so the join costs one exchange per table, or
    none if the tables are bucketed by it (``warehouse.save_tables(buckets=...)``).
    """
    joined = (
        dim.join(balance, "customer_id").join(activity, "customer_id").join(churn, "customer_id")
    )
    return with_recency(joined, ref_date).select(*PROFILE_COLUMNS)


def churn_summary(profile: DataFrame) -> DataFrame:
    """Age group x tier: count, churn rate, mean and exact median balance."""
    grouped = profile.select(
        age_group().alias("age_group"), "customer_nw_category", "churn", "current_balance"
    )
    keys = ["age_group", "customer_nw_category"]
    rates = rate_by(
        grouped, keys, {"customer_count": "customers", "churn_rate": "churn_rate",
                        "avg_current_balance": "avg_current_balance"},
    )
    medians = group_median(grouped, "current_balance", keys, "median_current_balance")
    return with_group_values(rates, medians, keys).select(
        *keys,
        "customer_count",
        round_to("churn_rate", 4).alias("churn_rate"),
        round_to("avg_current_balance", 2).alias("avg_current_balance"),
        round_to("median_current_balance", 2).alias("median_current_balance"),
    ).orderBy(*keys)


def _churn_by(profile: DataFrame, key, name: str, largest_first: bool = False) -> DataFrame:
    """Report rows by name, or by falling count and then name."""
    out = rate_by(profile, [key], {"customer_count": "customers", "churn_rate": "churn_rate"})
    return out.select(
        name, "customer_count", round_to("churn_rate", 4).alias("churn_rate")
    ).orderBy(*([F.desc("customer_count")] if largest_first else []), name)


def overall_churn(profile: DataFrame) -> DataFrame:
    return rate_by(profile, [], {"customers": "customers", "churn_rate": "churn_rate"}).select(
        "customers", round_to("churn_rate", 4).alias("churn_rate")
    )


def churn_by_age_group(profile: DataFrame) -> DataFrame:
    return _churn_by(profile, age_group().alias("age_group"), "age_group")


def churn_by_tier(profile: DataFrame) -> DataFrame:
    return _churn_by(profile, "customer_nw_category", "customer_nw_category")


def churn_by_balance_quartile(profile: DataFrame, tiles: int = 4) -> DataFrame:
    tiled = with_ntile(
        profile.select("customer_id", "current_balance", "churn"),
        tiles, "current_balance", "customer_id", "balance_quartile",
    )
    return tiled.groupBy("balance_quartile").agg(
        F.count(F.lit(1)).alias("customer_count"),
        round_to(F.min("current_balance"), 2).alias("min_balance"),
        round_to(F.max("current_balance"), 2).alias("max_balance"),
        round_to(F.avg(F.col("churn").cast("double")), 4).alias("churn_rate"),
    ).orderBy("balance_quartile")


def churn_by_recency(profile: DataFrame) -> DataFrame:
    return _churn_by(profile, recency_band().alias("recency_band"), "recency_band", largest_first=True)


def _occupation_tier(profile: DataFrame) -> DataFrame:
    return rate_by(
        profile,
        ["occupation", "customer_nw_category"],
        {"customer_count": "customers", "avg_balance": "avg_current_balance",
         "churn_rate": "churn_rate"},
    )


def highest_balance_groups(
    profile: DataFrame, min_n: int = MIN_GROUP, limit: int = TOP
) -> DataFrame:
    """Occupation x tier groups with the highest mean balance."""
    groups = keep_groups(_occupation_tier(profile), "customer_count", min_n).select(
        "occupation", "customer_nw_category", "customer_count",
        round_to("avg_balance", 2).alias("avg_balance"),
    )
    return top_k(
        groups, F.desc("avg_balance"), limit, ["occupation", "customer_nw_category"]
    )


def high_balance_high_churn(
    profile: DataFrame, min_n: int = MIN_GROUP, limit: int = TOP
) -> DataFrame:
    """Groups above the overall mean balance, ordered by churn."""
    overall = profile.agg(F.avg("current_balance"))
    groups = keep_groups(
        _occupation_tier(profile), "customer_count", min_n, "avg_balance", overall
    ).select(
        "occupation", "customer_nw_category", "customer_count",
        round_to("avg_balance", 2).alias("avg_balance"),
        round_to("churn_rate", 4).alias("churn_rate"),
    )
    return top_k(
        groups, F.desc("churn_rate"), limit, ["occupation", "customer_nw_category"]
    )
