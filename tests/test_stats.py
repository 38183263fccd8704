from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from saldora.functions.expr import chi2_tail, erfc, normal_two_sided
from saldora.operators import stats as st
from saldora.session import local_frame

RNG = np.random.default_rng(11)


def _two(spark, one, two):
    rows = [(1, float(v)) for v in one] + [(0, float(v)) for v in two]
    return local_frame(spark, rows, "g int, v double")


def test_separated_groups(spark):
    row = st.mann_whitney(_two(spark, [1, 2, 3], [10, 11]), "v", "g", 1).first()
    assert (row["u"], row["rank_biserial"]) == (0.0, 1.0)


def test_all_tied(spark):
    row = st.mann_whitney(_two(spark, [5] * 4, [5] * 6), "v", "g", 1).first()
    assert row["u"] == 12.0 and row["rank_biserial"] == 0.0 and row["z"] is None


def test_u_against_pairs(spark):
    one, two = RNG.integers(0, 9, 150), RNG.integers(2, 12, 260)
    row = st.mann_whitney(_two(spark, one, two), "v", "g", 1).first()
    gap = one[:, None] - two[None, :]
    assert row["u"] == (gap > 0).sum() + 0.5 * (gap == 0).sum()
    assert 0 <= row["p"] <= 1 and (row["n1"], row["n2"]) == (150, 260)


def test_chi_square_with_an_empty_cell(spark):
    rows = [("a", "x", 10.0), ("a", "y", 20.0), ("b", "x", 30.0), ("c", "x", 5.0), ("c", "y", 9.0)]
    got = st.chi_square_cells(local_frame(spark, rows, "a string, b string, n double")).first()
    o = np.array([[10, 20], [30, 0], [5, 9]], float)
    e = o.sum(1, keepdims=True) * o.sum(0) / o.sum()
    assert got["statistic"] == pytest.approx(((o - e) ** 2 / e).sum(), rel=1e-12)
    assert got["dof"] == 2


def test_chi_square_of_one_row(spark):
    got = st.chi_square_cells(local_frame(spark, [("a", "x", 3), ("a", "y", 4)], "a string, b string, n long"))
    row = got.withColumn("p", chi2_tail(F.col("statistic"), F.col("dof"))).first()
    assert (row["statistic"], row["dof"], row["p"], row["cramers_v"]) == (0.0, 0, 1.0, None)


def test_chi_square_against_spark_ml(spark):
    a, b = RNG.integers(0, 4, 900), RNG.integers(0, 3, 900)
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": b}))
    got = st.chi_square(df, "a", "b").first()
    vec = VectorAssembler(inputCols=["a"], outputCol="f").transform(df)
    vec = StringIndexer(inputCol="b", outputCol="l").fit(vec).transform(vec)
    ref = ChiSquareTest.test(vec, "f", "l").first()
    assert got["statistic"] == pytest.approx(ref["statistics"][0], rel=1e-9)
    assert got["p"] == pytest.approx(ref["pValues"][0], rel=1e-9)


@pytest.mark.parametrize("n1,n2", [(401, 900), (400, 901)])
def test_bootstrap_interval_against_resampling(spark, n1, n2):
    one, two = RNG.exponential(2.0, n1), RNG.exponential(1.0, n2)
    row = st.median_diff(_two(spark, one, two), "v", "g", 1, resamples=4000).first()
    assert row["m1"] == pytest.approx(np.median(one)) and row["m2"] == pytest.approx(np.median(two))
    diffs = [
        np.median(RNG.choice(one, n1)) - np.median(RNG.choice(two, n2)) for _ in range(4000)
    ]
    lo, hi = np.quantile(diffs, [0.025, 0.975])
    width = hi - lo
    assert row["lo"] == pytest.approx(lo, abs=0.12 * width)
    assert row["hi"] == pytest.approx(hi, abs=0.12 * width)
    again = st.median_diff(_two(spark, one, two), "v", "g", 1, resamples=4000).first()
    assert tuple(again) == tuple(row)


def test_effect_labels(spark):
    df = local_frame(spark, [(0.05,), (-0.2,), (0.4,), (-0.8,), (None,)], "x double")
    got = [r[0] for r in df.select(st.effect_label("x")).collect()]
    assert got == ["negligible", "small", "moderate", "large", None]


def test_tail_probabilities(spark):
    """Against the standard library and the sums over logarithms, from the middle far into the tails."""
    xs = [0.0, 1e-9, 0.3, 1.0, 1.99, 2.0, 2.01, 3.5, 8.0, 20.0, 26.0]
    rows = local_frame(spark, [(x,) for x in xs], "x double")
    for r in rows.select("x", erfc(F.col("x")).alias("e"), normal_two_sided(F.col("x")).alias("p")).collect():
        assert r["e"] == pytest.approx(math.erfc(r["x"]), rel=1e-11)
        assert r["p"] == pytest.approx(math.erfc(r["x"] / math.sqrt(2)), rel=1e-11)
    cases = [(s, d) for d in (0, 1, 2, 3, 4, 7, 10, 11, 60, 301) for s in (0.0, 0.5, 3.0, 12.0, 59.35, 327.0, 1400.0)]
    rows = local_frame(spark, [*cases, (None, 3), (2.0, None)], "s double, d long")
    out = rows.select("s", "d", chi2_tail(F.col("s"), F.col("d")).alias("p")).collect()
    for r in out:
        if r["s"] is None or r["d"] is None:
            assert r["p"] is None
        else:
            assert r["p"] == pytest.approx(st.chi2_sf(r["s"], r["d"]), rel=1e-9, abs=1e-300)


def test_p_values_need_no_python(spark):
    df = local_frame(spark, [(i % 3, i % 2, float(i)) for i in range(50)], "a int, b int, v double")
    for out in (st.chi_square(df, "a", "b"), st.mann_whitney(df, "v", "b", 1)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
