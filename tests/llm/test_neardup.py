from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from saldora.llm import neardup
from saldora.llm.components import connected
from saldora.llm.queries import op4_near_duplicates

from tests_llm_helpers import documents, rows


def _set(text):
    w = (text or "").split()
    runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])
    return {k: 1 + math.log(n) for k, n in Counter(runs).items()}


def _similar(a, b):
    """Probability Jaccard by its definition."""
    total = 0.0
    for i in a.keys() & b.keys():
        total += 1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in a.keys() | b.keys())
    return total


def _classes(texts, least=neardup.SIMILARITY):
    sets = [_set(t) for t in texts]
    name = list(range(len(texts)))

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            same = (texts[i] or "") == (texts[j] or "")
            if same or (sets[i].keys() & sets[j].keys() and _similar(sets[i], sets[j]) >= least):
                a, b = sorted((root(i), root(j)))
                name[b] = a
    return [root(i) for i in range(len(texts))]


def test_query_against_all_pairs(spark, sf_dir):
    docs = rows(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id"))
    expected = _classes([d["text"] for d in docs])
    assert len(set(expected)) < len(expected)
    found = {r["doc_id"]: r["class_id"] for r in rows(op4_near_duplicates(spark, sf_dir))}
    assert [found[d["doc_id"]] for d in docs] == [docs[c]["doc_id"] for c in expected]


def _family(draw, n):
    """Edits of one text, lightly and heavily, so that links chain and break."""
    base = [f"b{draw.randrange(10**6)}" for _ in range(150)]
    for _ in range(n):
        own = list(base)
        for _ in range(draw.choice([0, 1, 2, 4, 6, 9])):
            own[draw.randrange(len(own))] = f"e{draw.randrange(10**6)}"
        yield " ".join(own)


def test_families_edges_and_nulls(spark, monkeypatch):
    monkeypatch.setattr(neardup, "STRAYS", 4)  # several blocks a bucket
    monkeypatch.setattr(neardup, "MEMBERS", 8)
    draw = random.Random(4)
    texts = [*_family(draw, 60), *_family(draw, 20), "one two", "one two", "one  two", "", "", None, "a b c d e f"]
    texts += ["x" * 100_000, "line " * 400, "line " * 380]
    docs = documents(spark, [(i * 3, t) for i, t in enumerate(texts)])
    found = {r["doc_id"]: r["class_id"] for r in rows(neardup.near_duplicate_classes(docs))}
    assert [found[i * 3] // 3 for i in range(len(texts))] == _classes(texts)
    kept = rows(neardup.keep_one_of_each(docs))
    assert sorted(r["doc_id"] // 3 for r in kept) == sorted(set(_classes(texts)))
    assert list(kept[0]) == docs.columns


def test_one_stays_of_null_ids_and_repeated_rows(spark):
    near = list(_family(random.Random(1), 1))[0]
    other = near + " more"
    docs = documents(spark, [(None, near), (None, other), (7, "p q"), (7, "p q"), (7, "r s"), (None, "t")])
    kept = rows(neardup.keep_one_of_each(docs))
    assert sorted((r["doc_id"] or 0, r["text"] in (near, other)) for r in kept) == [
        (0, False), (0, True), (7, False), (7, False)
    ]
    assert rows(neardup.near_duplicate_classes(documents(spark, []))) == []


def test_signature_estimates_probability_jaccard():
    rng = np.random.default_rng(0)
    code = rng.integers(1, 1 << 52, 440).astype(np.uint64)
    for cut in (1, 20, 120):
        a, b = np.sort(code[:300]), np.sort(code[cut : 300 + cut])
        u, v = rng.integers(1, 9, 300).astype(float), rng.integers(1, 9, 300).astype(float)
        exact = neardup.probability_jaccard(a, u, b, v)
        both = np.intersect1d(a, b)
        x = {int(c): w for c, w in zip(a, u)}
        y = {int(c): w for c, w in zip(b, v)}
        assert math.isclose(exact, _similar(x, y), rel_tol=1e-9)
        owner = np.repeat([0, 1], 300)
        sign = neardup.prob_minhash(owner, np.concatenate([a, b]), np.concatenate([u, v]), 2, 4096)
        assert abs((sign[0] == sign[1]).mean() - exact) < 5 * math.sqrt(0.25 / 4096)
        assert len(both)


def test_tiny_sets_fill_all_registers():
    sign = neardup.prob_minhash(np.array([0]), np.array([9], np.uint64), np.array([1.0]), 2, 256)
    assert (sign[0] == 9).all() and (sign[1] == 0).all()


def test_components(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)]
    frame = spark.createDataFrame(pa.table([[a for a, _ in edges], [b for _, b in edges]], names=["a", "b"]))
    name = {}

    def root(i):
        while name.setdefault(i, i) != i:
            i = name[i]
        return i

    for a, b in edges:
        lo, hi = sorted((root(a), root(b)))
        name[hi] = lo
    found = {r["node"]: r["comp"] for r in rows(connected(frame))}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: root(x) for x in linked}
    assert rows(connected(frame.limit(0))) == []
    assert {r["node"]: r["comp"] for r in rows(connected(frame, task_links=0))} == found


def test_few_links_need_few_stages(spark):
    chain = spark.range(400).select((F.col("id") * 7).alias("a"), (F.col("id") * 7 + 7).alias("b"))
    spark.sparkContext.setJobGroup("few links", "")
    try:
        found = rows(connected(chain))
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("few links")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r["node"]: r["comp"] for r in found} == {7 * i: 0 for i in range(401)}
    assert len(jobs) < 8


def test_pairs_that_agree_in_low_bytes_of_an_earlier_band(spark):
    codes = np.arange(1, 41, dtype=np.uint64).tobytes()
    nodes = [1, 2, 3, 4]  # 1 leads; 1 and 2 are the largest class; 3 and 4 are equal strays

    def links(first):
        bands = [[own, 99, *range(1000 * n, 1000 * n + neardup.BANDS - 2)] for n, own in zip(nodes, first)]
        signed = spark.createDataFrame(
            [(n, b, bytes(neardup.REGISTERS), 40) for n, b in zip(nodes, bands)],
            "node long, bands array<long>, signature binary, shingles int",
        )
        members = spark.createDataFrame([(99, 1, 1, n) for n in nodes], "bucket long, band int, leader long, node long")
        sets = spark.createDataFrame(
            [(n, codes if n > 2 else bytes(8 * [n]), b"") for n in nodes], "node long, codes binary, counts binary"
        )
        comps = spark.createDataFrame([(1, 1), (2, 1)], "node long, comp long")
        found = neardup.stray_links(members, comps, signed, sets)
        return {tuple(sorted(r.values())) for r in rows(found)}

    assert links([10, 20, 30, 40]) == {(3, 4)}  # no true common band before this one
    assert links([10, 20, 30, 30]) == set()  # looked at in their first bucket


def test_clashing_names(spark):
    docs = documents(spark, [(1, "a b c"), (2, "a b c"), (3, "x y")])
    for name in ("__key", "key", "first", "node", "_node"):
        docs = docs.drop(name).withColumn(name, docs["lang"])
    kept = rows(neardup.keep_one_of_each(docs))
    assert sorted(r["doc_id"] for r in kept) == [1, 3] and list(kept[0]) == docs.columns
