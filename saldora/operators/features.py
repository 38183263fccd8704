"""Feature sets, leakage guard, exact stratified splits, preprocessing with train statistics."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.ml.feature import (
    OneHotEncoder, OneHotEncoderModel, StringIndexer, StringIndexerModel, VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldora.functions.expr import indicator, key_hash, missing_flag
from saldora.operators.quality import assert_same_track
from saldora.operators.rank import cut_points, group_quantiles, passed_cuts, with_ntile
from saldora.operators.relational import long_values, mode_of, quoted
from saldora.operators.segment import scale_stats
from saldora.plans.track_a import REFERENCE_DATE, with_recency
from saldora.session import materialise

SEED = 42


class FeatureError(ValueError):
    """A leaking, missing or drifted feature."""


@dataclass(frozen=True)
class TrackSpec:
    """What a track's models see. ``allowed`` is the enforced feature list."""

    name: str
    key: str
    numeric: tuple[str, ...]
    binary: tuple[str, ...]
    categorical: tuple[str, ...]
    leakage: tuple[str, ...] = ()
    allowed: frozenset[str] | None = None
    leaky: bool = field(default=False)

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.binary, *self.categorical]


# The feature sets of the two tracks.
TRACK_A = TrackSpec(
    name="track_a",
    key="customer_id",
    numeric=(
        "vintage", "age", "dependents", "customer_nw_category", "current_balance",
        "previous_month_end_balance", "average_monthly_balance_prevq",
        "average_monthly_balance_prevq2", "current_month_credit", "previous_month_credit",
        "current_month_debit", "previous_month_debit", "current_month_balance",
        "previous_month_balance", "days_since_last_transaction",
    ),
    binary=("age_under_18_flag", "last_transaction_missing_flag"),
    categorical=("gender", "occupation"),
)
# The admissible contact columns and the one that leaks.
CAMPAIGN_FEATURES = (
    "age", "job", "marital", "education", "default_credit", "housing", "loan", "contact",
    "month", "day_of_week", "duration", "campaign", "previous_contact_flag",
    "days_since_previous_contact", "previous", "poutcome", "emp_var_rate",
    "cons_price_idx", "cons_conf_idx", "euribor3m", "nr_employed",
)
CAMPAIGN_LEAKAGE = ("duration",)
TRACK_B = TrackSpec(
    name="track_b",
    key="observation_id",
    numeric=(
        "age", "campaign", "days_since_previous_contact", "previous", "emp_var_rate",
        "cons_price_idx", "cons_conf_idx", "euribor3m", "nr_employed",
    ),
    binary=("previous_contact_flag",),
    categorical=(
        "job", "marital", "education", "default_credit", "housing", "loan", "contact",
        "month", "day_of_week", "poutcome",
    ),
    leakage=CAMPAIGN_LEAKAGE,
    allowed=frozenset(CAMPAIGN_FEATURES) - frozenset(CAMPAIGN_LEAKAGE),
)


def check_features(spec: TrackSpec, available: Sequence[str]) -> list[str]:
    """The feature list, or FeatureError on a leak, a drift or a missing column."""
    leaks = sorted(set(spec.features) & set(spec.leakage))
    if leaks and not spec.leaky:
        raise FeatureError(f"leaking features: {leaks}")
    if spec.allowed is not None and not spec.leaky and set(spec.features) != spec.allowed:
        raise FeatureError(
            f"feature list drifted: {sorted(set(spec.features) ^ spec.allowed)}"
        )
    missing = sorted(set(spec.features) - set(available))
    if missing:
        raise FeatureError(f"features not in the data: {missing}")
    return spec.features


def select_features(df: DataFrame, spec: TrackSpec, label: Column) -> DataFrame:
    """Key, label and features only, so that excluded columns are never even read."""
    assert_same_track(df)
    names = check_features(spec, df.columns)
    return df.select(spec.key, label.cast("int").alias("label"), *[quoted(n) for n in names])


def track_a_features(clean: DataFrame, ref_date=REFERENCE_DATE) -> DataFrame:
    df = with_recency(clean, ref_date).withColumn(
        "last_transaction_missing_flag", missing_flag("last_transaction")
    )
    return select_features(df, TRACK_A, F.col("churn"))


def track_b_features(clean: DataFrame, spec: TrackSpec = TRACK_B) -> DataFrame:
    return select_features(clean, spec, indicator("y", "yes"))


def leaky_spec(spec: TrackSpec, column: str) -> TrackSpec:
    """The same models with a leaking column, for a benchmark labelled as such."""
    return replace(spec, numeric=(*spec.numeric, column), leaky=True)


# ------------------------------------------------------------- splits and folds


def class_quotas(counts: Mapping[tuple, int], share: float) -> dict[tuple, int]:
    """Test rows per class: ceil(share * n) in all, largest remainders first."""
    total = sum(counts.values())
    n_test = math.ceil(share * total - 1e-9)
    ideal = {g: n_test * n / total for g, n in counts.items()}
    quota = {g: math.floor(x) for g, x in ideal.items()}
    by_rest = sorted(counts, key=lambda g: (quota[g] - ideal[g], str(g)))
    for g in by_rest[: n_test - sum(quota.values())]:
        quota[g] += 1
    return quota


def with_test_flag(
    df: DataFrame, label: str, key: str, test: float = 0.2, seed: int = SEED
) -> DataFrame:
    """Add boolean ``is_test``: in each class the quota rows with the smallest key hash.

    Exact sizes without moving a row: the hash at the quota's rank is found by
    selection, the flag is a comparison with it.
    """
    # stored once: selection reads the hashes more than once, the caller the rows again
    hashed = materialise(df.withColumn("__h", key_hash(key, seed=seed)))
    quotas: dict[tuple, int] = {}

    def ranks(counts: Mapping[tuple, int]) -> dict[tuple, list[int]]:
        quotas.update(class_quotas(counts, test))
        return {g: [q] for g, q in quotas.items()}

    cuts = cut_points(hashed, "__h", key, ranks, [label])
    before = passed_cuts(cuts, "__h", key, [label]) == 0
    none = [g[0] for g, q in quotas.items() if q == 0]
    if none:
        before = before & ~F.col(label).isin(none)
    return hashed.withColumn("is_test", before).drop("__h")


def stratified_split(
    df: DataFrame, label: str, key: str, test: float = 0.2, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    flagged = with_test_flag(df, label, key, test, seed)
    return (
        flagged.filter(~F.col("is_test")).drop("is_test"),
        flagged.filter("is_test").drop("is_test"),
    )


def stratified_folds(
    df: DataFrame, label: str, key: str, k: int = 5, seed: int = SEED
) -> DataFrame:
    """Add ``fold`` 0..k-1; within a class, fold sizes differ by one row at most."""
    hashed = df.withColumn("__h", key_hash(key, seed=seed))
    tiled = with_ntile(hashed, k, "__h", key, "__t", [label])
    return tiled.withColumn("fold", (F.col("__t") - 1).cast("int")).drop("__h", "__t")


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, n, weight): n / (classes * n_class), so weights average to one."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total, classes = counts.agg(F.sum("n")).scalar(), counts.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", total / (classes * F.col("n")).cast("double"))


def with_weights(df: DataFrame, label: str = "label") -> DataFrame:
    weights = {r[label]: r["weight"] for r in class_weights(df, label).collect()}
    w = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    return df.withColumn("weight", w[F.col(label)])


# ----------------------------------------------------------------- preprocessing


def median_fill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, median) of the non-missing values, all columns in one selection."""
    q = group_quantiles(long_values(df, cols, "double"), "value", ["column"], (0.5,))
    return q.select("column", F.col("value").alias("median"))


@dataclass
class FittedPreprocessor:
    numeric: list[str]
    categorical: list[str]
    medians: dict[str, float]
    modes: dict[str, str]
    stats: dict[str, tuple[float, float]]
    indexer: StringIndexerModel
    encoder: OneHotEncoderModel

    @property
    def feature_names(self) -> list[str]:
        """Order of the assembled vector; a level's column is ``<column>_<level>``."""
        levels = [
            f"{c}_{level}"
            for c, labels in zip(self.categorical, self.indexer.labelsArray)
            for level in labels
        ]
        return [*self.numeric, *levels]

    def imputed(self, df: DataFrame) -> DataFrame:
        num = {
            c: F.coalesce(F.col(c).cast("double"), F.lit(self.medians[c])) for c in self.numeric
        }
        cat = {c: F.coalesce(F.col(c), F.lit(self.modes[c])) for c in self.categorical}
        return df.withColumns({**num, **cat})

    def scaled(self, df: DataFrame) -> DataFrame:
        return self.imputed(df).withColumns(
            {
                c: (F.col(c) - F.lit(self.stats[c][0])) / F.lit(self.stats[c][1])
                for c in self.numeric
            }
        )

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``features``; the raw feature columns are replaced by their fills."""
        coded = self.encoder.transform(self.indexer.transform(self.scaled(df)))
        wide = VectorAssembler(
            inputCols=[*self.numeric, *[f"__o_{c}" for c in self.categorical]],
            outputCol="features",
        ).transform(coded)
        return wide.drop(*[f"__{p}_{c}" for p in "io" for c in self.categorical])


class Preprocessor:
    """Median fill and scaling for numbers, mode fill and one-hot levels for categories.

    Everything is learnt from the frame given to ``fit``; levels unseen there, and
    missing ones after a fill, encode to zeros.
    """

    def __init__(self, spec: TrackSpec) -> None:
        self.numeric = [*spec.numeric, *spec.binary]
        self.categorical = list(spec.categorical)

    def fit(self, train: DataFrame) -> FittedPreprocessor:
        medians = {r["column"]: r["median"] for r in median_fill(train, self.numeric).collect()}
        empty = sorted(set(self.numeric) - set(medians))
        if empty:
            raise FeatureError(f"no value to impute from: {empty}")
        modes = {r["column"]: r["mode"] for r in mode_of(train, self.categorical).collect()}
        draft = FittedPreprocessor(
            self.numeric, self.categorical, medians, modes, {}, None, None
        )
        filled = draft.imputed(train)
        draft.stats = scale_stats(filled, self.numeric)
        # Alphabetical levels; the slot kept for unseen ones is the last, dropped one.
        draft.indexer = StringIndexer(
            inputCols=self.categorical,
            outputCols=[f"__i_{c}" for c in self.categorical],
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ).fit(filled)
        draft.encoder = OneHotEncoder(
            inputCols=[f"__i_{c}" for c in self.categorical],
            outputCols=[f"__o_{c}" for c in self.categorical],
            dropLast=True,
        ).fit(draft.indexer.transform(filled))
        return draft
