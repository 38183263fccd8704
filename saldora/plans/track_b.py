"""Track B: campaign views and adoption questions, one row per contact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldora.functions.expr import age_band, indicator, round_to
from saldora.functions.metrics import adopted
from saldora.operators.rank import with_ntile
from saldora.operators.relational import keep_groups, rate_by, top_k

# Size limit and length of the reports.
MIN_GROUP = 200
TOP = 10


def _adoption_by(
    df: DataFrame, keys: list[str | Column], names: list[str], order: str | None = "adoption_rate"
) -> DataFrame:
    """Report rows by falling ``order``, equal ones by name; by name alone without it."""
    out = rate_by(df, keys, ["observation_count", "adoption_rate"]).select(
        *names, "observation_count", round_to("adoption_rate", 4).alias("adoption_rate")
    )
    return out.orderBy(*([F.desc(order)] if order else []), *names)


def campaign_summary(contacts: DataFrame) -> DataFrame:
    """Month x weekday."""
    return _adoption_by(contacts, ["month", "day_of_week"], ["month", "day_of_week"], "observation_count")


def adoption_summary(contacts: DataFrame) -> DataFrame:
    """Row-level attributes with the adoption indicator."""
    return contacts.select(
        "job", "education", "housing", "loan", "poutcome", "previous_contact_flag",
        indicator("y", "yes").alias("adopted"),
    )


def overall_adoption(contacts: DataFrame) -> DataFrame:
    return rate_by(
        contacts, [], {"observations": "observation_count", "adoption_rate": "adoption_rate"}
    ).select("observations", round_to("adoption_rate", 4).alias("adoption_rate"))


def adoption_by_age_band(contacts: DataFrame) -> DataFrame:
    return _adoption_by(contacts, [age_band().alias("age_band")], ["age_band"], None)


def adoption_by(contacts: DataFrame, attribute: str) -> DataFrame:
    """Adoption by any one attribute: job, education, housing, outcome, ..."""
    return _adoption_by(contacts, [attribute], [attribute])


def adoption_by_job(contacts: DataFrame) -> DataFrame:
    return adoption_by(contacts, "job")


def adoption_by_education(contacts: DataFrame) -> DataFrame:
    return adoption_by(contacts, "education")


def adoption_by_housing(contacts: DataFrame) -> DataFrame:
    return adoption_by(contacts, "housing")


def adoption_by_outcome(contacts: DataFrame) -> DataFrame:
    return adoption_by(contacts, "poutcome")


def adoption_by_previous_contact(contacts: DataFrame) -> DataFrame:
    return _adoption_by(contacts, ["previous_contact_flag"], ["previous_contact_flag"], None)


def above_average_groups(
    contacts: DataFrame, min_n: int = MIN_GROUP, limit: int = TOP
) -> DataFrame:
    """Job x education groups of some size that adopt more than average."""
    overall = contacts.agg(F.avg(adopted()))
    groups = rate_by(contacts, ["job", "education"], ["observation_count", "adoption_rate"])
    kept = keep_groups(groups, "observation_count", min_n, "adoption_rate", overall).select(
        "job", "education", "observation_count",
        round_to("adoption_rate", 4).alias("adoption_rate"),
    )
    return top_k(kept, F.desc("adoption_rate"), limit, ["job", "education"])


def adoption_by_balance_quartile(secondary: DataFrame, tiles: int = 4) -> DataFrame:
    """Secondary extract only: it alone has a balance."""
    tiled = with_ntile(
        secondary.select("observation_id", "balance", "y"),
        tiles, "balance", "observation_id", "balance_quartile",
    )
    return tiled.groupBy("balance_quartile").agg(
        F.count(F.lit(1)).alias("observation_count"),
        round_to(F.min("balance"), 2).alias("min_balance"),
        round_to(F.max("balance"), 2).alias("max_balance"),
        round_to(F.avg(adopted()), 4).alias("adoption_rate"),
    ).orderBy("balance_quartile")
