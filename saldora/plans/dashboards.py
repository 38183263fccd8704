"""Dashboard extracts. ``where`` is an optional predicate applied before aggregation.

Track A and track B extracts never share a filter: each takes the frame of its track.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldora.functions.expr import round_to
from saldora.functions.metrics import adopted, metric
from saldora.operators.keys import join_keys
from saldora.operators.rank import group_median
from saldora.operators.stats import two_proportion
from saldora.plans import track_a, track_b


def _where(df: DataFrame, where: Column | str | None) -> DataFrame:
    return df if where is None else df.filter(where)


def executive_kpis(profile: DataFrame, contacts: DataFrame) -> DataFrame:
    """(track, metric, value): two separate headline sections, never summed."""
    parts = []
    for track, df, names in (
        ("A", profile, ["customer_count", "churn_rate"]),
        ("B", contacts, ["observation_count", "adoption_rate", "previous_contact_rate"]),
    ):
        row = df.agg(*[metric(m).cast("double") for m in names])
        entries = [
            F.struct(
                F.lit(track).alias("track"), F.lit(m).alias("metric"),
                round_to(F.col(c), 4).alias("value"),
            )
            for m, c in zip(names, row.columns)
        ]
        parts.append(row.select(F.inline(F.array(*entries))))
    return parts[0].unionByName(parts[1])


def churn_by_quartile(profile: DataFrame, where: Column | str | None = None) -> DataFrame:
    """Quartile rows with the rate of the other quartiles beside them."""
    tiles = track_a.with_ntile(
        _where(profile, where).select("customer_id", "current_balance", "churn"),
        4, "current_balance", "customer_id", "balance_quartile",
    )
    groups = tiles.groupBy("balance_quartile").agg(
        F.count(F.lit(1)).alias("customer_count"), F.sum("churn").alias("churned")
    )
    all_n, all_churned = (
        groups.agg(F.sum(c)).scalar() for c in ("customer_count", "churned")
    )
    rest = F.try_divide(all_churned - F.col("churned"), all_n - F.col("customer_count"))
    return groups.select(
        "balance_quartile",
        "customer_count",
        round_to(F.col("churned") / F.col("customer_count"), 4).alias("churn_rate"),
        round_to(rest, 4).alias("rest_churn_rate"),
    )


def segment_comparison(profile_rows: DataFrame, label: str = "segment") -> DataFrame:
    """Segment profile in long form: (segment, measure, value)."""
    measures = [c for c in profile_rows.columns if c != label]
    entries = [
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value"))
        for m in measures
    ]
    return profile_rows.select(label, F.inline(F.array(*entries)))


def adoption_by_contact(contacts: DataFrame, where: Column | str | None = None) -> DataFrame:
    """Two bars and, on both, the difference with its confidence interval."""
    df = _where(contacts, where)
    bars = track_b.adoption_by_previous_contact(df)
    test = two_proportion(df, "previous_contact_flag", adopted())
    return bars.withColumns(
        {c: round_to(test.select(c).scalar(), 6) for c in ("diff", "lo", "hi")}
    )


def adoption_by_job(contacts: DataFrame, where: Column | str | None = None) -> DataFrame:
    return track_b.adoption_by_job(_where(contacts, where)).orderBy(
        F.desc("adoption_rate"), "job"
    )


def adoption_by_age_band(contacts: DataFrame, where: Column | str | None = None) -> DataFrame:
    return track_b.adoption_by_age_band(_where(contacts, where))


def churn_by_recency(profile: DataFrame, where: Column | str | None = None) -> DataFrame:
    return track_a.churn_by_recency(_where(profile, where))


def balance_context(secondary: DataFrame, where: Column | str | None = None) -> DataFrame:
    return track_b.adoption_by_balance_quartile(_where(secondary, where))


def grain_extract(
    df: DataFrame, grains: Sequence[Sequence[str]], filters: Mapping[str, Column | None],
    measures: Sequence[str], median: str | None = None,
) -> DataFrame:
    """(filter, grain, dimensions, measures[, median]) for every filter and grain in one scan.

    ``grains`` are lists of dimensions (the empty one is the total), ``filters`` named conditions
    (None: all rows). A row counts in every filter it meets; all grains are grouping sets of one
    aggregation, whose partial states combine on the map side. Dimensions that a grain does not
    have are null; ``grain`` names those it has. The median is exact: sketches of all groups in
    one pass bracket it, one more pass selects it.
    """
    dims = list(dict.fromkeys(d for g in grains for d in g))
    names = F.array_compact(F.array(*[
        F.lit(n) if c is None else F.when(c, F.lit(n)) for n, c in filters.items()
    ]))
    rows = df.withColumn("filter", F.explode(names))
    has = F.array(*[F.when(F.grouping(d) == 0, F.lit(d)) for d in dims]) if dims else F.array().cast("array<string>")
    sets = [[F.col("filter"), *map(F.col, g)] for g in grains]
    out = rows.groupingSets(sets, "filter", *dims).agg(
        F.array_join(F.array_compact(has), ",").alias("grain"), *[metric(m) for m in measures]
    )
    if median is None:
        return out.select("filter", "grain", *dims, *measures)
    each = F.array(*[
        F.struct(
            F.lit(",".join(d for d in dims if d in g)).alias("grain"),
            *[(F.col(d) if d in g else F.lit(None).cast(df.schema[d].dataType)).alias(f"__{i}") for i, d in enumerate(dims)],
        )
        for g in grains
    ])
    keys = ["filter", "grain", *[f"__{i}" for i in range(len(dims))]]
    found = group_median(rows.select("filter", median, F.inline(each)), median, keys, "median")
    found = found.withColumnsRenamed({f"__{i}": d for i, d in enumerate(dims)})
    return join_keys(out, found, ["filter", "grain", *dims], "left").select("filter", "grain", *dims, *measures, "median")
