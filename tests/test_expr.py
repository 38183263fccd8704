from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from saldora.functions import expr as ex
from saldora.session import local_frame


def _col(spark, kind, values, build):
    rows = list(enumerate(values))
    df = local_frame(spark, rows, f"i int, x {kind}")
    return [r["y"] for r in df.withColumn("y", build).orderBy("i").collect()]


def test_age_group_edges(spark):
    ages = [17, 18, 25, 26, 35, 36, 45, 46, 55, 56, 65, 66, None]
    assert _col(spark, "int", ages, ex.age_group("x")) == [
        "under 18", "18-25", "18-25", "26-35", "26-35", "36-45", "36-45", "46-55", "46-55",
        "56-65", "56-65", "66+", "66+",
    ]


def test_age_band_edges(spark):
    assert _col(spark, "int", [24, 25, 34, 35, 64, 65, None], ex.age_band("x")) == [
        "under 25", "25-34", "25-34", "35-44", "55-64", "65+", "65+",
    ]


def test_recency_tests_null_first(spark):
    days = [None, -1, 0, 30, 31, 90, 91, 180, 181]
    assert _col(spark, "int", days, ex.recency_band("x")) == [
        ex.NO_DATE_LABEL, "0-30 days", "0-30 days", "0-30 days", "31-90 days", "31-90 days",
        "91-180 days", "91-180 days", "180+ days",
    ]


def test_indicator_counts_null_as_zero(spark):
    assert _col(spark, "string", ["yes", "no", None], ex.indicator("x", "yes")) == [1, 0, 0]


def test_asinh_of_large_negatives(spark):
    values = [-1e9, -5503.96, 0.0, 5905904.03]
    got = _col(spark, "double", values, ex.safe_asinh("x"))
    assert got == pytest.approx([math.asinh(v) for v in values], rel=1e-12)


def test_rounding_is_binary(spark):
    got = _col(spark, "double", [1.005, 2.675, 0.125, None], ex.round_to("x", 2))
    assert got[:3] == pytest.approx([1.0, 2.68, 0.13]) and got[3] is None


def test_days_since(spark):
    df = spark.sql("SELECT timestamp_ntz'2019-12-30 23:00:00' AS t UNION ALL SELECT NULL")
    got = {r[0] for r in df.select(ex.days_since("t", "2019-12-31")).collect()}
    assert got == {1, None}


def test_key_hash_is_uniform(spark):
    parts = spark.range(20000).select((ex.key_hash("id") / F.lit(float(1 << 60)) * 10).cast("int").alias("b"))
    counts = [r["count"] for r in parts.groupBy("b").count().collect()]
    assert len(counts) == 10 and min(counts) > 1800
