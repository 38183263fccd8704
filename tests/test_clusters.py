from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from saldora.operators import clusters as cl
from saldora.session import local_frame

X = lambda: F.array("x", "y")


def _points(spark, n):
    draw = np.random.default_rng(2)
    at = draw.normal(0, 0.3, (n, 2)) + np.array([[0, 0], [4, 0], [0, 4]])[np.arange(n) % 3]
    return local_frame(spark, [(i, float(a), float(b)) for i, (a, b) in enumerate(at)], "k long, x double, y double")


def test_sample_is_the_first_by_hash_and_tasks_send_few(spark):
    df = _points(spark, 30_000)
    want = [r["x"] for r in df.select(X().alias("x"), F.xxhash64(F.lit(9), "k").alias("o")).orderBy("o").limit(cl.SAMPLE).collect()]
    assert np.array_equal(cl._sample(df, X(), 30_000, 9, "k"), np.array(want))
    assert len(cl._sample(df, X(), 30_000, 9, None)) == cl.SAMPLE
    twins = df.withColumn("k", F.lit(None).cast("long"))  # one hash for all rows
    assert len(cl._sample(twins, X(), 30_000, 9, "k")) == cl.SAMPLE


def test_a_pass_equals_plain_assignment(spark):
    df = _points(spark, 900)
    x = np.array([(r["x"], r["y"]) for r in df.collect()])
    centres = {0: x[:3].copy(), 1: x[[5, 5, 9, 20]].copy()}  # equal centres: the first one wins
    blocks = cl._blocks(df.select(X().alias("x")).repartition(4))
    assert blocks.count() <= 4
    for r, (size, sums, cost) in cl._step(blocks, centres).items():
        far = ((x[:, None, :] - centres[r][None]) ** 2).sum(axis=2)
        own = far.argmin(axis=1)
        assert size.tolist() == np.bincount(own, minlength=len(centres[r])).tolist()
        assert sums == pytest.approx(np.array([x[own == k].sum(axis=0) for k in range(len(centres[r]))]))
        assert cost == pytest.approx(far.min(axis=1).sum())
