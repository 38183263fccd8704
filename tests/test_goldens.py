"""Published figures that can be recomputed without the raw data (fixed values)."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from saldora.functions.expr import round_to
from saldora.operators import evaluate as ev
from saldora.operators import stats as st
from saldora.operators.features import class_quotas
from saldora.session import local_frame

# Confusion counts at threshold 0.50 and the rates published for them.
CONFUSIONS = [
    ((4139, 486, 406, 646), (0.5707, 0.6141, 0.5916, 0.6141, 0.8949, 0.7545)),
    ((6498, 810, 343, 585), (0.4194, 0.6304, 0.5037, 0.6304, 0.8892, 0.7598)),
]


@pytest.mark.parametrize("counts,rates", CONFUSIONS)
def test_rates_from_confusion(spark, counts, rates):
    df = local_frame(spark, [counts], "tn long, fp long, fn long, tp long")
    row = ev.add_rates(df).select(*[round_to(c, 4).alias(c) for c in ev.RATE_COLUMNS]).first()
    assert tuple(row) == pytest.approx(rates, abs=1e-9)


def _cells(spark):
    # contacted/adopted, contacted/not, never/adopted, never/not
    rows = [("c", "y", 967), ("c", "n", 548), ("n", "y", 3672), ("n", "n", 35989)]
    return local_frame(spark, rows, "a string, b string, n long")


def test_prior_contact_chi_square(spark):
    row = st.chi_square_cells(_cells(spark)).first()
    assert row["statistic"] == pytest.approx(4341.34, abs=0.005)
    assert row["dof"] == 1 and row["n"] == 41176
    assert row["cramers_v"] == pytest.approx(0.325, abs=5e-4)
    plain = st.chi_square_cells(_cells(spark), correction=False).first()
    assert plain["statistic"] == pytest.approx(4346.80, abs=0.005)


def test_prior_contact_difference(spark):
    rows = _cells(spark).select(
        (F.col("a") == "c").alias("flag"),
        (F.col("b") == "y").cast("double").alias("hit"),
        F.explode(F.expr("sequence(1, cast(n AS int))")).alias("i"),
    )
    row = st.two_proportion(rows, "flag", "hit").first()
    assert [100 * row[c] for c in ("diff", "lo", "hi")] == pytest.approx([54.57, 52.13, 57.01], abs=0.01)


@pytest.mark.parametrize(
    "u,n1,n2,effect",
    [(35267327.5, 5260, 23122, 0.42005), (124589983.5, 5289, 39922, -0.18012)],
)
def test_rank_biserial(u, n1, n2, effect):
    assert 1 - 2 * u / (n1 * n2) == pytest.approx(effect, abs=5e-6)


@pytest.mark.parametrize(
    "chi2,n,v",
    [(59.35, 28382, 0.046), (7.96, 28382, 0.017), (327.08, 28382, 0.107),
     (4230.14, 41176, 0.321), (961.74, 41176, 0.153), (1214.05, 41176, 0.172)],
)
def test_cramers_v(chi2, n, v):
    assert math.sqrt(chi2 / n) == pytest.approx(v, abs=5e-4)


def test_tail_probability():
    assert st.chi2_sf(7.96, 2) == pytest.approx(0.0187, abs=5e-5)
    # tabulated 5% points
    for dof, x in [(1, 3.841459), (2, 5.991465), (3, 7.814728), (4, 9.487729), (11, 19.675138)]:
        assert st.chi2_sf(x, dof) == pytest.approx(0.05, abs=1e-6)


def test_split_sizes():
    for n, positive, test in [(28382, 5260, 5677), (41176, 4640, 8236)]:
        quota = class_quotas({(0,): n - positive, (1,): positive}, 0.2)
        assert sum(quota.values()) == test


def test_segment_shares():
    sizes = [5429, 11813, 7101, 4039]
    assert [round(100 * n / sum(sizes), 1) for n in sizes] == [19.1, 41.6, 25.0, 14.2]


def test_best_f1_threshold(spark):
    # Three rows of a published sweep around its maximum.
    rows = [(0.55, 0.5142), (0.60, 0.5225), (0.65, 0.5222)]
    sweep = local_frame(spark, rows, "threshold double, f1 double")
    assert ev.best_f1(sweep).first()["threshold"] == 0.60
