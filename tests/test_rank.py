"""Distributed order against brute force, with ties, hot values, NULLs and tiny inputs."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from saldora.operators import rank as rk
from saldora.operators.keys import keyed
from saldora.session import local_frame, small


def _frame(spark, values, groups=None):
    rows = [(i, None if v is None else float(v), (groups or ["a"] * len(values))[i]) for i, v in enumerate(values)]
    return local_frame(spark, rows, "k long, v double, g string")


def _tiles(values, tiles):
    order = sorted(range(len(values)), key=lambda i: (values[i] is None, values[i] or 0, i))
    out = [0] * len(values)
    q, r = divmod(len(values), tiles)
    at = 0
    for t in range(tiles):
        for _ in range(q + (t < r)):
            out[order[at]] = t + 1
            at += 1
    return out


RNG = np.random.default_rng(5)
CASES = {
    "unique": list(RNG.permutation(997)),
    "hot value": [0.0] * 700 + list(RNG.normal(0, 100, 1300)),
    "three values": list(RNG.integers(0, 3, 1500)),
    "all equal": [7.0] * 10,
    "heavy tail": list(np.exp(RNG.normal(0, 4, 2000))),
    "with nulls": [None if i % 7 == 0 else i % 40 for i in range(600)],
    "one": [1.0],
    "three": [3.0, 3.0, 1.0],
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("tiles", [4, 5])
def test_ntile(spark, case, tiles):
    values = CASES[case]
    got = rk.with_ntile(_frame(spark, values), tiles, "v", "k").orderBy("k").collect()
    assert [r["tile"] for r in got] == _tiles(values, tiles)


def test_ntile_by_class(spark):
    values = list(RNG.integers(0, 6, 900))
    groups = ["a" if i % 3 == 0 else "b" for i in range(900)]
    got = rk.with_ntile(_frame(spark, values, groups), 3, "v", "k", "t", ["g"]).orderBy("k").collect()
    for g in "ab":
        at = [i for i in range(900) if groups[i] == g]
        assert [got[i]["t"] for i in at] == _tiles([values[i] for i in at], 3)


def test_group_quantiles(spark):
    values = list(np.concatenate([RNG.normal(0, 5, 3001), [2.0] * 1500, np.exp(RNG.normal(3, 3, 700))]))
    groups = ["hot" if i % 3 else "cold" for i in range(len(values))]
    probs = (0.0, 0.25, 0.5, 0.999, 1.0)
    out = rk.group_quantiles(_frame(spark, values, groups), "v", ["g"], probs).collect()
    assert len(out) == 2 * len(probs)
    frame = pd.DataFrame({"v": values, "g": groups})
    for r in out:
        want = np.quantile(frame.v[frame.g == r["g"]], r["prob"])
        assert r["value"] == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_median_groups_null_and_nan_free(spark):
    rows = [(None, 1.0), (None, 3.0), ("x", None), ("x", 4.0), ("y", None)]
    df = local_frame(spark, rows, "g string, v double")
    got = {r["g"]: r["m"] for r in rk.group_median(df, "v", ["g"], "m").collect()}
    assert got == {None: 2.0, "x": 4.0}


def test_bracket_holds_every_rank(spark):
    values = np.sort(np.exp(RNG.normal(0, 3, 4000)))
    df, keys = keyed(_frame(spark, list(RNG.permutation(values))), [])
    edges = small(rk.rank_edges(df, "v", keys))
    ranks = [1, 2, 17, 1999, 2000, 2001, 3990, 4000]
    slots = "array(" + ", ".join(f"struct({r} AS slot, {r}L AS rmin, {r}L AS rmax)" for r in ranks) + ")"
    got = {r["rank"]: r["value"] for r in rk.values_at_ranks(df, "v", keys, edges, slots).collect()}
    assert got == {r: values[r - 1] for r in ranks}


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums(spark, descending):
    values = [0.0] * 300 + list(RNG.integers(-50, 50, 600).astype(float))
    df = _frame(spark, values)
    out = rk.running_sums(df, "v", {"n": F.count(F.lit(1)), "s": F.sum("k")}, descending=descending)
    frame = pd.DataFrame({"v": values, "k": range(len(values))})
    want = frame.groupby("v").agg(n=("k", "size"), s=("k", "sum")).sort_index(ascending=not descending)
    want["before_n"] = want.n.cumsum() - want.n
    want["before_s"] = want.s.cumsum() - want.s
    got = out.toPandas().set_index("v").sort_index(ascending=not descending)
    assert (got[["n", "s", "before_n", "before_s"]] == want).all().all()
    assert set(got.all_n) == {900} and set(got.all_s) == {sum(range(900))}


def test_rank_splits_a_hot_value(spark):
    df = _frame(spark, [1.0] * 2000 + list(range(1000))).repartition(7)
    got = rk.with_rank(df, ["v"], "k").orderBy("v", "k").collect()
    assert [r["rank"] for r in got] == list(range(1, 3001))


def test_row_numbers_of_identical_rows(spark):
    df = spark.range(0, 5000, numPartitions=6).select(F.lit("same").alias("x"))
    ids = sorted(r["n"] for r in rk.with_row_number(df, "n").collect())
    assert ids == list(range(1, 5001))


def test_small_falls_back_beyond_its_bound(spark):
    df = spark.range(100)
    assert small(df, max_rows=99) is df
    assert small(df, max_rows=100) is not df


def test_tiles_of_many_groups(spark):
    """More groups than cut points can be written for; one of them holds a third of the rows."""
    draw = np.random.default_rng(12)
    n = 3000
    groups = [None if i % 3 == 0 else int(draw.integers(0, 400)) for i in range(n)]
    rows = [(i, None if i % 17 == 0 else float(draw.integers(0, 9)), g) for i, g in enumerate(groups)]
    df = local_frame(spark, rows, "k long, v double, g long")
    got = {r["k"]: r["t"] for r in rk.with_ntile(df, 4, "v", "k", "t", ["g"]).collect()}
    assert len(got) == n
    by_group = {}
    for k, v, g in rows:
        by_group.setdefault(g, []).append((v is None, v or 0.0, k))
    for own in by_group.values():
        own.sort()
        ends = [0, *rk.tile_ends(len(own), 4), len(own)]
        for tile in range(4):
            assert all(got[k] == tile + 1 for _, _, k in own[ends[tile] : ends[tile + 1]])
