from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from saldora.operators import cleaning as cl
from saldora.operators import quality as q
from saldora.session import local_frame


def test_dates(spark):
    rows = [(t,) for t in ["2019-05-21", "NaT", "", None, "2019-13-45"]]
    df = local_frame(spark, rows, "d string")
    out = cl.parse_date(cl.null_marker(df, "d", "NaT"), "d").collect()
    assert [r["d"] for r in out] == [dt.date(2019, 5, 21), None, None, None, None]
    audit = df.agg(*[c.alias(n) for n, c in cl.date_audit("d").items()]).first()
    assert tuple(audit) == (1, 3, 1)


def test_sentinel_split(spark):
    df = local_frame(spark, [(999,), (0,), (5,), (-1,), (None,)], "pdays int")
    out = cl.split_sentinel(df, "pdays", 999, "flag", "value").collect()
    assert [r["flag"] for r in out] == [False, True, True, True, False]
    assert [r["value"] for r in out] == [None, 0.0, 5.0, -1.0, None]


def test_duplicates_treat_nulls_as_equal(spark):
    rows = [(1, None), (1, None), (1, "x"), (2, None), (1, None)]
    df = local_frame(spark, rows, "a int, b string")
    assert cl.duplicate_count(df).first()[0] == 2
    assert cl.drop_duplicates(df).count() == 3
    assert cl.duplicate_count(df.filter("a > 5")).first()[0] == 0


def test_flag_and_cap_on_missing(spark):
    df = local_frame(spark, [(17, 10.0), (18, 9.0), (None, None)], "age int, dependents double")
    out = cl.null_above(cl.flag_below(df, "age", 18, "minor"), "dependents", 9).collect()
    assert [(r["minor"], r["dependents"]) for r in out] == [(True, None), (False, 9.0), (False, None)]


def test_key_uniqueness_counts_null_once(spark):
    one = local_frame(spark, [(1,), (2,), (None,)], "k int")
    two = local_frame(spark, [(1,), (None,), (None,)], "k int")
    assert cl.key_is_unique(one, "k").first()["is_unique"]
    assert not cl.key_is_unique(two, "k").first()["is_unique"]


def test_marker_rates_name_only_affected_columns(spark):
    df = local_frame(spark, [("unknown", "a", 1), ("b", "c", 2)], "x string, y string, z int")
    assert [tuple(r) for r in cl.marker_rates(df).collect()] == [("x", 1, 0.5)]


def test_enforce_lists_failures(spark):
    df = local_frame(spark, [(1, 5, None), (1, 50, "NaT")], "k int, d int, t string")
    res = q.expect(df, [
        q.RowCount(2), q.Columns(("k", "zz")), q.Unique("k"), q.MaxValue("d", 9),
        q.Absent("t", "NaT"), q.NotNull("t"), q.OfType("d", "int"), q.Domain("k", (1,)),
        q.Implies("big", "d > 9", "t IS NULL"), q.NoDuplicates(),
    ])
    failed = {r["check"] for r in res.filter(~F.col("passed")).collect()}
    assert failed == {
        "columns_present", "unique:k", "max_value:d", "absent:t", "not_null:t", "implies:big",
    }
    with pytest.raises(q.ExpectationError, match="6 check"):
        q.enforce(res)
    q.enforce(res.filter("passed"))


def test_expectations_of_an_empty_frame(spark):
    df = local_frame(spark, [], "k int, t string")
    res = q.expect(df, [q.RowCount(0), q.Unique("k"), q.MaxValue("k", 1), q.Columns(("k",))])
    assert res.filter(~F.col("passed")).count() == 0


def test_tracks_stay_apart(spark):
    a = local_frame(spark, [(1,)], "customer_id int")
    b = local_frame(spark, [(1,)], "observation_id int")
    assert q.assert_same_track(a, a) == "a"
    for bad in [(a, b), (a.withColumn("observation_id", F.lit(1)),), (spark.range(1),)]:
        with pytest.raises(ValueError):
            q.assert_same_track(*bad)


def test_subset_and_schema(spark):
    whole = local_frame(spark, [(1, "a"), (2, None), (1, "a")], "x int, y string")
    part = local_frame(spark, [(2, None), (9, "z"), (9, "z")], "x int, y string")
    assert tuple(q.is_subset(part, whole).first()) == (True, 2)
    diff = q.schema_diff(part, part.withColumn("w", F.lit(1))).filter("in_a <> in_b")
    assert [r["column"] for r in diff.collect()] == ["w"]
