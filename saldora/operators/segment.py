"""Customer segmentation: features, scaling, k-means, quality indices, profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldora.functions.expr import key_hash, round_to, safe_asinh
from saldora.operators.clusters import Run, fit_all, nearest
from saldora.operators.rank import group_median
from saldora.operators.relational import with_group_values
from saldora.session import local_frame, materialise, right_size, small

# Inputs of the segmentation and the chosen number of segments.
FEATURES = [
    "vintage", "age", "current_balance", "average_monthly_balance_prevq",
    "current_month_credit", "current_month_debit",
]
SKEWED = [
    "current_balance", "average_monthly_balance_prevq", "current_month_credit",
    "current_month_debit",
]
FINAL_K = 4
RESTARTS = 10
SEED = 42
SILHOUETTE_SAMPLE = 5000


def segment_features(
    df: DataFrame,
    key: str = "customer_id",
    cols: Sequence[str] = tuple(FEATURES),
    skewed: Sequence[str] = tuple(SKEWED),
) -> DataFrame:
    """Key and clustering inputs, skewed columns on the arcsinh scale."""
    return df.select(
        key,
        *[(safe_asinh(c) if c in skewed else F.col(c).cast("double")).alias(c) for c in cols],
    )


def assert_complete(df: DataFrame, cols: Sequence[str]) -> int:
    """Refuse missing values; returns the number of rows."""
    row = df.agg(
        F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    ).first()
    missing = {c: row[c] for c in cols if row[c]}
    if missing:
        raise ValueError(f"missing values in clustering inputs: {missing}")
    return row["__n"]


def scale_stats(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """{column: (mean, population std)}; a constant column gets std 1."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(cols)}


def standardise(
    df: DataFrame, cols: Sequence[str], stats: Mapping[str, tuple[float, float]] | None = None
) -> tuple[DataFrame, Mapping[str, tuple[float, float]]]:
    """Subtract the mean, divide by the population std; the statistics are returned."""
    stats = stats or scale_stats(df, cols)
    scaled = {c: (F.col(c) - F.lit(stats[c][0])) / F.lit(stats[c][1]) for c in cols}
    return df.withColumns(scaled), stats


def as_vector(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


# --------------------------------------------------------------------- k-means


@dataclass
class Clustering:
    """The best run; cluster i is segment i, segment 0 the largest."""

    centres: np.ndarray
    sizes: list[int]
    cost: float
    costs: list[float]
    steps: int

    def label(self, df: DataFrame, out: str = "segment", point: Column | None = None) -> DataFrame:
        """Add the segment, an expression over ``point`` (by default the ``features`` vector)."""
        return df.withColumn(out, nearest(vector_to_array("features") if point is None else point, self.centres))


def best_of(runs: Sequence[Run]) -> Clustering:
    """The run of least cost, with cluster ids made stable by size."""
    best = min(runs, key=lambda r: r.cost)
    order = sorted(range(len(best.sizes)), key=lambda c: (-best.sizes[c], tuple(best.centres[c])))
    return Clustering(
        best.centres[order], [int(best.sizes[c]) for c in order], best.cost, [r.cost for r in runs],
        max(r.steps for r in runs),
    )


def kmeans(
    vectors: DataFrame, k: int, restarts: int = RESTARTS, seed: int = SEED, max_iter: int = 300,
    key: str | None = None,
) -> Clustering:
    """Best of several seeded k-means runs, all of them in the same passes.

    ``vectors`` needs a ``features`` column and should be persisted by the caller.
    """
    return best_of(fit_all(vectors, vector_to_array("features"), [k], restarts, seed, max_iter, key)[k])


def evaluate_k(
    scaled: DataFrame,
    cols: Sequence[str],
    key: str = "customer_id",
    k_min: int = 2,
    k_max: int = 6,
    restarts: int = RESTARTS,
    seed: int = SEED,
) -> DataFrame:
    """(k, silhouette, davies_bouldin, silhouette_squared, cost, cluster_sizes) per k.

    All restarts for all k share their passes over the rows.
    """
    spark = scaled.sparkSession
    rows = assert_complete(scaled, cols)
    vectors = right_size(as_vector(scaled.select(key, *cols), cols), rows).persist()
    try:
        out = []
        found = fit_all(vectors, vector_to_array("features"), range(k_min, k_max + 1), restarts, seed, key=key)
        for k, runs in found.items():
            best = best_of(runs)
            labelled = best.label(vectors, "label")
            sil = silhouette(labelled, cols, "label", key).first()["silhouette"]
            db = davies_bouldin(labelled, cols, "label").first()["davies_bouldin"]
            # squared-Euclidean variant over all rows, linear in the data
            squared = ClusteringEvaluator(predictionCol="label").evaluate(labelled)
            out.append((k, sil, db, float(squared), best.cost, best.sizes))
    finally:
        vectors.unpersist()
    return local_frame(
        spark,
        out,
        "k int, silhouette double, davies_bouldin double, silhouette_squared double, "
        "cost double, cluster_sizes array<bigint>",
    )


def segment_customers(
    df: DataFrame, k: int = FINAL_K, restarts: int = RESTARTS, seed: int = SEED,
    key: str = "customer_id",
) -> DataFrame:
    """(key, segment) for every row: features, scaling, best k-means, stable labels."""
    feats = materialise(segment_features(df, key))
    rows = assert_complete(feats, FEATURES)
    scaled, _ = standardise(feats, FEATURES)
    vectors = as_vector(scaled, FEATURES).select(key, "features")
    vectors = right_size(vectors, rows).persist()
    try:
        best = kmeans(vectors, k, restarts, seed, key=key)
    finally:
        vectors.unpersist()
    return best.label(vectors, "segment").select(key, "segment")


# -------------------------------------------------------------- quality indices


def silhouette(
    df: DataFrame,
    cols: Sequence[str],
    label: str,
    key: str,
    sample: int = SILHOUETTE_SAMPLE,
    seed: int = SEED,
) -> DataFrame:
    """(silhouette): mean Euclidean silhouette of a fixed-size random sample.

    The sample is the operator's definition: ``sample`` rows with the smallest key hash.
    That bounded set is shipped to the tasks once; each task scores its share of the
    sampled rows against it with matrix arithmetic, so no pair ever becomes a row.
    """
    spark = df.sparkSession
    hashed = df.select(
        key,
        F.col(label).alias("label"),
        *[F.col(c).cast("double") for c in cols],
        key_hash(key, seed=seed).alias("__h"),
    )
    n = hashed.count()
    # The hash is uniform below 2^60, so the smallest ones lie under a bound that about
    # twice the sample meets: all other rows drop out where they are read.
    near = hashed.filter(F.col("__h") < int(min(1.0, 2.0 * sample / max(n, 1)) * (1 << 60)))
    pdf = _first_by_hash(near, key, sample)
    if len(pdf) < min(sample, n):
        pdf = _first_by_hash(hashed, key, sample)
    points = pdf[list(cols)].to_numpy(dtype=float)
    labels = pdf["label"].to_numpy()
    levels, codes = np.unique(labels, return_inverse=True)
    if len(levels) < 2:
        raise ValueError("a silhouette needs at least two clusters in the sample")
    sizes = np.bincount(codes)
    shared = spark.sparkContext.broadcast((points, codes, sizes))

    def score(batches):
        pts, code, size = shared.value
        member = np.eye(len(size))[code]
        norms = (pts**2).sum(axis=1)
        for batch in batches:
            at = batch["i"].to_numpy()
            x = pts[at]
            sq = norms[at][:, None] + norms[None, :] - 2.0 * (x @ pts.T)
            dist = np.sqrt(np.maximum(sq, 0.0))
            dist[np.arange(len(at)), at] = 0.0
            total = dist @ member
            own = code[at]
            row = np.arange(len(at))
            alone = size[own] == 1
            a = total[row, own] / np.maximum(size[own] - 1, 1)
            mean = total / size
            mean[row, own] = np.inf
            b = mean.min(axis=1)
            top = np.maximum(a, b)
            s = np.where(alone | (top == 0), 0.0, (b - a) / np.where(top == 0, 1.0, top))
            yield pd.DataFrame({"s": s})

    parts = max(1, min(len(pdf) // 250, spark.sparkContext.defaultParallelism))
    ids = spark.range(0, len(pdf), numPartitions=parts).select(F.col("id").alias("i"))
    return ids.mapInPandas(score, "s double").agg(F.avg("s").alias("silhouette"))


def _first_by_hash(hashed: DataFrame, key: str, sample: int) -> pd.DataFrame:
    return hashed.orderBy("__h", key).limit(sample).drop("__h").toPandas()


def _distance(a: Sequence[Column], b: Sequence[Column]) -> Column:
    squares = [(x - y) * (x - y) for x, y in zip(a, b)]
    return F.sqrt(reduce(lambda p, q: p + q, squares))


def davies_bouldin(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """(davies_bouldin): mean over clusters of the worst (s_i + s_j) / d_ij.

    Two aggregations over the rows; the arithmetic between clusters works on one row
    that holds the k centroids.
    """
    rows = df.select(F.col(label).alias("l"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    dims = range(len(cols))
    centres = rows.groupBy("l").agg(*[F.avg(f"x{i}").alias(f"c{i}") for i in dims])
    spread = (
        rows.join(small(centres), "l")  # one row per cluster
        .groupBy("l")
        .agg(
            F.avg(
                _distance([F.col(f"x{i}") for i in dims], [F.col(f"c{i}") for i in dims])
            ).alias("s"),
            *[F.first(f"c{i}").alias(f"c{i}") for i in dims],
        )
    )
    entry = F.struct("l", "s", F.array(*[F.col(f"c{i}") for i in dims]).alias("c"))
    table = spread.agg(F.collect_list(entry).alias("all"))
    each = table.select(F.explode("all").alias("i"), "all")

    def ratio(j: Column) -> Column:
        gap = F.sqrt(
            F.aggregate(
                F.zip_with(F.col("i.c"), j["c"], lambda x, y: (x - y) * (x - y)),
                F.lit(0.0), lambda acc, v: acc + v,
            )
        )
        return F.try_divide(F.col("i.s") + j["s"], gap)

    worst = F.array_max(F.transform(F.filter("all", lambda j: j["l"] != F.col("i.l")), ratio))
    return each.agg(F.avg(worst).alias("davies_bouldin"))


# --------------------------------------------------------------------- profiles


def segment_profile(df: DataFrame, label: str = "segment") -> DataFrame:
    """Named measures per segment and its share of all customers, unrounded."""
    rows = df.groupBy(label).agg(
        F.count("customer_id").alias("customer_count"),
        F.avg("age").alias("avg_age"),
        F.avg("vintage").alias("avg_vintage_days"),
        F.avg("current_balance").alias("avg_current_balance"),
        F.avg("current_month_credit").alias("avg_month_credit"),
        F.avg("current_month_debit").alias("avg_month_debit"),
        F.avg(F.col("churn").cast("double")).alias("churn_rate"),
        F.count(F.lit(1)).alias("__rows"),
    )
    total = df.agg(F.count(F.lit(1))).scalar()
    medians = group_median(df, "current_balance", [label], "median_current_balance")
    return with_group_values(rows, medians, [label]).select(
        label,
        "customer_count",
        "avg_age",
        "avg_vintage_days",
        "avg_current_balance",
        "median_current_balance",
        "avg_month_credit",
        "avg_month_debit",
        "churn_rate",
        round_to(F.col("customer_count") / total * 100.0, 1).alias("pct_of_customers"),
    )


def display_profile(profile: DataFrame, label: str = "segment") -> DataFrame:
    """The published form: measures rounded to two digits."""
    measures = [c for c in profile.columns if c not in (label, "customer_count", "pct_of_customers")]
    return profile.withColumns({c: round_to(c, 2) for c in measures})


def segment_mix(df: DataFrame, label: str, attr: str) -> DataFrame:
    """(segment, level, n, share, base_share): attribute mix of each segment."""
    cells = df.groupBy(F.col(label).alias("segment"), F.col(attr).alias("level")).agg(
        F.count(F.lit(1)).alias("n")
    )
    by_segment = cells.groupBy("segment").agg(F.sum("n").alias("__seg"))
    by_level = cells.groupBy("level").agg(F.sum("n").alias("__lvl"))
    total = cells.agg(F.sum("n")).scalar()
    joined = with_group_values(with_group_values(cells, by_segment, ["segment"]), by_level, ["level"])
    return joined.select(
        "segment",
        "level",
        "n",
        (F.col("n") / F.col("__seg")).alias("share"),
        (F.col("__lvl") / total).alias("base_share"),
    )


def smallest_segment(df: DataFrame, label: str = "segment") -> DataFrame:
    """(smallest, total, share)."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.min("n").alias("smallest"), F.sum("n").alias("total")).withColumn(
        "share", F.col("smallest") / F.col("total")
    )


# Wording of the segment labels.
HIGH_BALANCE = "High Balance, Low Activity"
HIGH_ACTIVITY = "High Activity, High Churn"
NEWER = "Newer Customers"
MASS = "Mass Retail"


def segment_names(profile: DataFrame, label: str = "segment") -> DataFrame:
    """(segment, name) from the profile's extremes.

    Highest mean balance, then highest credit of the rest, then shortest tenure of the
    rest; all others are mass retail.
    """
    one = profile.agg(F.max_by(label, "avg_current_balance")).scalar()
    step1 = profile.withColumn("__one", one)
    two = step1.filter(F.col(label) != F.col("__one")).agg(
        F.max_by(label, "avg_month_credit")
    ).scalar()
    step2 = step1.withColumn("__two", two)
    three = step2.filter(
        (F.col(label) != F.col("__one")) & (F.col(label) != F.col("__two"))
    ).agg(F.min_by(label, "avg_vintage_days")).scalar()
    named = step2.withColumn("__three", three)
    name = (
        F.when(F.col(label) == F.col("__one"), F.lit(HIGH_BALANCE))
        .when(F.col(label) == F.col("__two"), F.lit(HIGH_ACTIVITY))
        .when(F.col(label) == F.col("__three"), F.lit(NEWER))
        .otherwise(F.lit(MASS))
    )
    return named.select(label, name.alias("name"))
