"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from saldora.catalog.roles import REF_DATE, track_a, track_b
from saldora.operators import rank as rk
from saldora.operators.evaluate import average_precision
from saldora.operators.features import track_b_features
from saldora.operators.stats import mann_whitney
from saldora.plans import track_a as qa
from saldora.plans.warehouse import create_namespaces, save_tables, star_track_a
from saldora.session import scratch_path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tiles_move_no_row(spark, sf_dir):
    path = scratch_path(spark, "plan_tiles")
    track_a(spark, sf_dir).select("customer_id", "current_balance").write.parquet(path)
    text = plan(rk.with_ntile(spark.read.parquet(path), 4, "current_balance", "customer_id"))
    assert "Exchange" not in text and "Window" not in text and "Join" not in text


def test_no_single_partition_of_rows(spark):
    df = spark.range(100_000).select((F.col("id") % 977 / 977.0).alias("prob"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    for out in (average_precision(df), mann_whitney(df, "prob", "label", 1)):
        for line in plan(out).split("\n"):
            # windows without a partition may only order buckets, never values
            if "Window" in line and "prob" in line:
                assert "__b" in line


def test_no_pairwise_join_in_selection(spark):
    df = spark.range(10_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    text = plan(rk.group_median(df, "k", ["v"], "m")) + plan(rk.group_median(df, "k", (), "m"))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_leaking_column_is_never_read(spark, sf_dir):
    path = scratch_path(spark, "plan_leak")
    track_b(spark, sf_dir).write.parquet(path)
    text = plan(track_b_features(spark.read.parquet(path)))
    scans = re.findall(r"ReadSchema: \S+", text)
    assert scans and not any("duration" in s for s in scans)


def test_bucketed_star_join_needs_no_exchange(spark, sf_dir):
    path = scratch_path(spark, "plan_star")
    create_namespaces(spark, path)
    tables = star_track_a(track_a(spark, sf_dir))
    save_tables(tables, path, buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        profile = qa.customer_profile(*[spark.table(n) for n in tables], REF_DATE)
        text = plan(profile)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("SortMergeJoin") == 3 and "Exchange" not in text


def test_filter_reaches_the_scan(spark, sf_dir):
    path = scratch_path(spark, "plan_filter")
    qa.with_recency(track_a(spark, sf_dir), REF_DATE).write.parquet(path)
    df = qa.churn_by_recency(spark.read.parquet(path).filter("customer_nw_category = 2"))
    text = plan(df)
    assert "EqualTo(customer_nw_category,2)" in text
    assert "current_balance" not in re.findall(r"ReadSchema: \S+", text)[0]


@pytest.mark.parametrize("name", ["qa7_high_balance_high_churn", "qb8_above_average_groups"])
def test_overall_value_is_a_scalar_subquery(spark, sf_dir, name):
    from saldora import catalog

    text = plan(catalog.queries()[name](spark, sf_dir))
    assert "Subquery" in text and "NestedLoop" not in text and "TakeOrderedAndProject" in text


@pytest.mark.parametrize("name, keys", [
    ("qa5_churn_by_recency", [("customer_count", -1), ("recency_band", 1)]),
    ("qb0_campaign_summary", [("observation_count", -1), ("month", 1), ("day_of_week", 1)]),
    ("qb3_adoption_by_job", [("adoption_rate", -1), ("job", 1)]),
    ("qa4_churn_by_balance_quartile", [("balance_quartile", 1)]),
])
def test_reports_come_in_order(spark, sf_dir, name, keys):
    from saldora import catalog

    rows = [r.asDict() for r in catalog.queries()[name](spark, sf_dir).collect()]
    expected = rows
    for key, sign in reversed(keys):
        expected = sorted(expected, key=lambda r: r[key], reverse=sign < 0)
    assert len(rows) > 1 and rows == expected


def test_selection_reads_its_input_once(spark, sf_dir):
    from saldora import catalog

    text = plan(catalog.queries()["qb9_adoption_by_balance_quartile"](spark, sf_dir))
    assert "FileScan" not in text and "Join" not in text  # the stored rows, not the join again
