"""Three-phase search against brute force."""

from __future__ import annotations

import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from saldora.llm.topk import Blocks, search
from tests_llm_helpers import rows

SCHEMA = pa.schema([
    ("vec_id", pa.int64()), ("embedding", pa.list_(pa.float64())), ("label", pa.int32()),
    ("id", pa.string()), ("vec", pa.string()), ("at", pa.string()), ("score", pa.string()),
])
SMALL = Blocks(lists=2, rows=13, queries=3, step=2)


def asked():
    return F.col("id") % 50 == 0


def frame(spark, data):
    ids, vectors = ([x[0] for x in data], [x[1] for x in data])
    more = [["x"] * len(data)] * 4
    return spark.createDataFrame(pa.table([ids, vectors, [1] * len(data), *more], schema=SCHEMA))


def brute(data, k=5):
    good = [
        (i, [math.floor(256 * x) for x in v]) for i, v in data
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (qid, q) in enumerate(good):
        if qid is None or qid % 50:
            continue
        found = [
            (-sum(x * y for x, y in zip(q, v)), i is None, i or 0, i)
            for b, (i, v) in enumerate(good) if a != b
        ]
        for rank, (score, _, _, i) in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1):
            out.append((qid, rank, i, -score))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows(df)), key=str)


def random_data(n, width, seed, grid=None):
    draw = random.Random(seed)
    value = (lambda: draw.choice(grid)) if grid else (lambda: draw.gauss(0, 1))
    return [(i * 5, [value() for _ in range(width)]) for i in range(n)]


@pytest.mark.parametrize("lists", [1, 2, 3])
def test_random_vectors(spark, lists):
    data = random_data(150, 7, 1)
    blocks = Blocks(lists=lists, rows=13, queries=3, step=2)
    assert found(search(frame(spark, data), asked(), blocks=blocks)) == brute(data)


def test_ties_and_copies(spark):
    """Coarse components give ties everywhere; a third of the rows holds one vector, ids repeat."""
    data = random_data(90, 4, 2, [0.0, 0.25, -0.25])
    data += [(i, [0.25, 0.25, 0.0, -0.25]) for i in range(400, 460)]
    data += [(50, [0.25, 0.0, 0.0, 0.0])] * 3 + [(50, [0.0, 0.25, 0.25, 0.0])] * 2 + [(100, data[20][1])] * 9
    assert found(search(frame(spark, data), asked(), blocks=SMALL)) == brute(data)


def test_nulls_and_extremes(spark):
    data = random_data(40, 3, 3) + [
        (None, [9.0, 9.0, 9.0]), (None, [9.0, 9.0, 9.0]), (350, None), (400, [1.0, None, 2.0]), (450, [float("nan"), 0.0, 0.0]),
        (500, [float("inf"), 0.0, 0.0]), (550, []), (600, [1.0]), (650, [1.0, 2.0, 3.0, 4.0, 5.0]), (701, [2.0**30, 1.0, 1.0]),
    ]
    assert found(search(frame(spark, data), asked(), blocks=SMALL)) == brute(data)


def test_large_components(spark):
    """Products beyond the exact range of doubles and of 32-bit storage."""
    data = [(i * 10, [float(2**19 + 7 * i), float(-(2**17) - i * i), float(i * 3)]) for i in range(40)]
    assert found(search(frame(spark, data), asked(), blocks=SMALL)) == brute(data)


def test_out_of_range_is_held(spark):
    data = [(0, [1e300, -1e300, 1.0]), (50, [-1e300, 1e300, 2.0]), (7, [1.0, 1.0, 1.0])]
    got = found(search(frame(spark, data), asked(), blocks=SMALL))
    assert len(got) == 4


@pytest.mark.parametrize("data", [[], [(50, [1.0])], [(50, None)], [(1, [1.0]), (2, [2.0])], [(50, [])]])
def test_few_rows(spark, data):
    assert found(search(frame(spark, data), asked())) == brute(data)


def test_fewer_candidates_than_wanted(spark):
    data = [(50, [1.0, 0.5]), (3, [2.0, 0.5]), (4, [2.0, 0.5]), (100, [0.0, 0.5])]
    assert found(search(frame(spark, data), asked())) == brute(data)


def test_result_does_not_depend_on_blocks(spark):
    data = random_data(200, 6, 4)
    assert found(search(frame(spark, data).repartition(7), asked(), k=3)) == brute(data, 3)
