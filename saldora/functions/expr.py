"""Scalar column expressions. All are native Catalyst expressions, no UDF."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Band:
    """One labelled range; ``low``/``high`` are inclusive, ``below`` is exclusive."""

    label: str
    low: float | None = None
    high: float | None = None
    below: float | None = None

    def holds(self, c: Column) -> Column:
        parts = []
        if self.low is not None:
            parts.append(c >= F.lit(self.low))
        if self.high is not None:
            parts.append(c <= F.lit(self.high))
        if self.below is not None:
            parts.append(c < F.lit(self.below))
        test = parts[0]
        for p in parts[1:]:
            test = test & p
        return test


# Band edges and labels of the published reports.
AGE_GROUP = (
    [
        Band("under 18", below=18),
        Band("18-25", 18, 25),
        Band("26-35", 26, 35),
        Band("36-45", 36, 45),
        Band("46-55", 46, 55),
        Band("56-65", 56, 65),
    ],
    "66+",
)
AGE_BAND = (
    [
        Band("under 25", below=25),
        Band("25-34", 25, 34),
        Band("35-44", 35, 44),
        Band("45-54", 45, 54),
        Band("55-64", 55, 64),
    ],
    "65+",
)
RECENCY = (
    [
        Band("0-30 days", high=30),
        Band("31-90 days", high=90),
        Band("91-180 days", high=180),
    ],
    "180+ days",
)
NO_DATE_LABEL = "no valid last_transaction date"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band(
    c: Column | str,
    bands: Iterable[Band],
    default: str,
    null_label: str | None = None,
) -> Column:
    """Label of the first range that holds.

    A NULL satisfies no range and so gets ``default``, unless ``null_label`` is
    given, in which case NULL is tested first.
    """
    c = _col(c)
    out = F
    if null_label is not None:
        out = out.when(c.isNull(), F.lit(null_label))
    for b in bands:
        out = out.when(b.holds(c), F.lit(b.label))
    return out.otherwise(F.lit(default))


def age_group(c: Column | str = "age") -> Column:
    return band(c, *AGE_GROUP)


def age_band(c: Column | str = "age") -> Column:
    return band(c, *AGE_BAND)


def recency_band(c: Column | str = "days_since_last_transaction") -> Column:
    return band(c, *RECENCY, null_label=NO_DATE_LABEL)


def indicator(c: Column | str, value) -> Column:
    """1 where the column equals ``value``, else 0; NULL counts as 0."""
    return F.when(_col(c) == F.lit(value), F.lit(1)).otherwise(F.lit(0))


def round_to(c: Column | str, digits: int) -> Column:
    """Round half away from zero on the binary double.

    ``round(double, n)`` in Spark rounds the shortest decimal text of the value,
    which turns 1.005 into 1.01; scaling first keeps binary semantics.
    """
    scale = float(10**digits)
    return F.round(_col(c).cast("double") * F.lit(scale)) / F.lit(scale)


def days_since(c: Column | str, ref: dt.date | str | Column) -> Column:
    """Calendar days from the column's date to the reference date."""
    if not isinstance(ref, Column):
        ref = F.lit(ref).cast("date")
    return F.datediff(ref, _col(c).cast("date"))


def missing_flag(c: Column | str) -> Column:
    return _col(c).isNull().cast("int")


def safe_asinh(c: Column | str) -> Column:
    """arcsinh that stays accurate for large negative input.

    Spark evaluates log(x + sqrt(x^2 + 1)), which cancels to -Infinity for large
    negative x; arcsinh is odd, so evaluate on |x| and restore the sign.
    """
    c = _col(c).cast("double")
    return F.signum(c) * F.asinh(F.abs(c))


def difference(a: Column | str, b: Column | str) -> Column:
    return _col(a) - _col(b)


def key_hash(*keys: Column | str, seed: int = 42) -> Column:
    """Uniform, engine-independent 60-bit hash of a key.

    The first 15 hex digits of an MD5 are non-negative as a long, spread evenly
    over [0, 2^60), and any SQL engine can recompute them, so random splits and
    samples are reproducible outside Spark too.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[_col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


# ------------------------------------------------------------------ tail probabilities

# Terms of the series and of the continued fraction of erfc; either reaches double accuracy on
# its side of ``_ERFC_CUT``.
ERFC_TERMS = 60
_ERFC_CUT = 2.0
_ROOT_PI = math.sqrt(math.pi)


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0.

    Below the cut one minus Kummer's series, innermost bracket first; above it the continued
    fraction, innermost fraction first. Both are folds over a fixed number of terms.
    """
    down = F.sequence(F.lit(ERFC_TERMS), F.lit(1), F.lit(-1))
    square = F.least(x, F.lit(_ERFC_CUT)) * F.least(x, F.lit(_ERFC_CUT))
    series = F.aggregate(down, F.lit(1.0), lambda inner, n: F.lit(1.0) + F.lit(2.0) * square / (F.lit(2.0) * n + 1.0) * inner)
    low = F.lit(1.0) - F.lit(2.0 / _ROOT_PI) * x * F.exp(-x * x) * series
    wide = F.greatest(x, F.lit(_ERFC_CUT))
    fraction = F.aggregate(down, wide, lambda inner, n: wide + (n / F.lit(2.0)) / inner)
    high = F.exp(-x * x) / (F.lit(_ROOT_PI) * fraction)
    return F.when(x < _ERFC_CUT, low).otherwise(high)


def normal_two_sided(z: Column) -> Column:
    """Two-sided p-value of a standard normal statistic, at most 1."""
    tail = erfc(F.abs(z) / F.lit(math.sqrt(2.0)))
    return F.when(z.isNotNull(), F.when(z <= 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), tail)))


def chi2_tail(stat: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution for whole degrees of freedom.

    With h half the statistic, an even number gives exp(-h) times the sum of h^i / i! for i
    below half of it; an odd one erfc(sqrt(h)) and the same sum over halves. The sum is taken
    relative to its last term, whose logarithm is exact where the term itself would overflow.
    """
    h = stat / F.lit(2.0)
    odd = dof % 2 == 1
    terms = F.floor(dof / 2).cast("int")  # of the sum
    # last term h^a / gamma(a + 1) with a = terms - 1, and terms - 1/2 for an odd number
    shift = F.when(odd, 0.5).otherwise(0.0)
    steps = F.when(terms > 1, F.sequence(F.lit(1), F.greatest(terms - 1, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    # bracket of ratios of a term to the next one, innermost first: 1 + a/h (1 + (a-1)/h (...))
    ratios = F.aggregate(steps, F.lit(1.0), lambda inner, i: F.lit(1.0) + (i + shift) / h * inner)
    start = F.when(odd, F.lit(0.5) * F.log(h) - F.lit(math.log(_ROOT_PI / 2))).otherwise(F.lit(0.0))
    last = F.aggregate(steps, start, lambda have, i: have + F.log(h) - F.log(i + shift))
    rest = F.when(terms > 0, F.exp(last - h) * ratios).otherwise(0.0)
    tail = rest + F.when(odd, erfc(F.sqrt(h))).otherwise(0.0)
    return F.when(stat.isNotNull() & dof.isNotNull(), F.when((dof <= 0) | (stat <= 0), F.lit(1.0)).otherwise(F.least(F.lit(1.0), tail)))
