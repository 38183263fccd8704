"""Metric registry: name -> aggregate expression.

Every metric is one algebraic aggregate (partial + final, no state per row), so a
report at any grain is ``groupBy(keys).agg(...)``.  Exact medians are not here:
they need a selection over the data, see ``operators.rank.group_quantiles``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from saldora.functions.expr import difference, indicator


def adopted(c: Column | str = "y") -> Column:
    """0/1 adoption as double, so that averages never become decimals."""
    return indicator(c, "yes").cast("double")


METRICS: dict[str, Callable[[], Column]] = {
    # track A
    "customer_count": lambda: F.count_distinct("customer_id"),
    "customers": lambda: F.count(F.lit(1)),
    "avg_current_balance": lambda: F.avg("current_balance"),
    "avg_monthly_balance_prevq": lambda: F.avg("average_monthly_balance_prevq"),
    "balance_growth": lambda: F.avg(
        difference("current_month_balance", "previous_month_balance")
    ),
    "churn_rate": lambda: F.avg(F.col("churn").cast("double")),
    "avg_month_credit": lambda: F.avg("current_month_credit"),
    "avg_month_debit": lambda: F.avg("current_month_debit"),
    "avg_recency_days": lambda: F.avg("days_since_last_transaction"),
    # track B
    "observation_count": lambda: F.count(F.lit(1)),
    "adoption_rate": lambda: F.avg(adopted()),
    "previous_contact_rate": lambda: F.avg(F.col("previous_contact_flag").cast("double")),
}


def metric(name: str) -> Column:
    if name not in METRICS:
        raise KeyError(f"unknown metric {name!r}; known: {sorted(METRICS)}")
    return METRICS[name]().alias(name)
