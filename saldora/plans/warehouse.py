"""Star-schema load: typed tables, surrogate keys, views, namespaces of the two tracks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from saldora.operators.quality import assert_same_track
from saldora.operators.rank import with_rank, with_row_number
from saldora.operators.relational import rename
from saldora.plans import track_a, track_b
from saldora.sources.io import conform
from saldora.sources.schemas import CAMPAIGN_NAMES, CHURN_NAMES, STAR


def star_track_a(clean: DataFrame) -> dict[str, DataFrame]:
    """Split the clean churn table into a dimension and three fact tables."""
    clean = rename(clean, CHURN_NAMES)
    return {n: conform(clean, s) for n, s in STAR.items() if n.startswith("track_a.")}


def _observation(clean: DataFrame, name: str, key: str, order: str | None) -> DataFrame:
    plain = rename(clean, CAMPAIGN_NAMES)
    if key not in plain.columns:
        plain = with_rank(plain, [order], out=key) if order else with_row_number(plain, key)
    return conform(plain, STAR[name])


def star_track_b(
    clean: DataFrame, secondary: DataFrame, order: str | None = None
) -> dict[str, DataFrame]:
    """Observation tables; a surrogate key is added where the data has none.

    The key follows scan order, or ``order`` if a column is named.
    """
    names = [n for n in STAR if n.startswith("track_b.")]
    return {
        n: _observation(df, n, "observation_id", order)
        for n, df in zip(names, (clean, secondary))
    }


def save_tables(tables: Mapping[str, DataFrame], path: str, buckets: int | None = None) -> None:
    """Write the star tables below ``path``.

    With ``buckets`` they are saved as catalog tables bucketed and sorted by their key,
    so that joins on the key need no exchange.
    """
    for name, df in tables.items():
        target = f"{path.rstrip('/')}/{name}"
        writer = df.write.mode("overwrite").format("parquet")
        if buckets is None:
            writer.save(target)
            continue
        key = df.columns[0]
        # One file per bucket: hash-partition by the key as bucketBy does.
        writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet")
        writer.bucketBy(buckets, key).sortBy(key).option("path", target).saveAsTable(name)


def load_tables(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    root = path.rstrip("/")
    return {n: spark.read.schema(STAR[n]).parquet(f"{root}/{n}") for n in names}


def create_namespaces(spark: SparkSession, path: str) -> list[str]:
    """One schema per track; a cross-track join then needs two visible prefixes."""
    names = ["track_a", "track_b"]
    for n in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {n} LOCATION '{path.rstrip('/')}/{n}.db'")
    return names


def register_views(profile: DataFrame, contacts: DataFrame) -> list[str]:
    """The four reporting views as session temp views."""
    assert_same_track(profile)
    assert_same_track(contacts)
    views = {
        "track_a_customer_profile": profile,
        "track_a_churn_summary": track_a.churn_summary(profile),
        "track_b_campaign_summary": track_b.campaign_summary(contacts),
        "track_b_adoption_summary": track_b.adoption_summary(contacts),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
