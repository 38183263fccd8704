from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from hashlib import sha256

import corpus_pipeline
from pyspark.sql import functions as F
from saldora.llm import mixing
from saldora.llm.queries import op3_mixed_shards, op3_source_mix
from saldora.llm.rows import table

from tests_llm_helpers import by_id, documents, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _targets(sizes):
    """By repeated resharing, one source capped at a time."""
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sizes)}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in capped]
        rate = (total - sum(capped.values())) / sum(weight[s] for s in free) if free else 0
        share = {s: rate * weight[s] for s in free}
        worst = max(free, key=lambda s: share[s] - 2 * sizes[s], default=None)
        if worst is None or share[worst] <= 2 * sizes[worst]:
            return {**capped, **share}
        capped[worst] = 2 * sizes[worst]


def test_query_against_targets(spark, sf_dir):
    docs = rows(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    size = {d["doc_id"]: len(WORD.findall(d["text"] or "")) for d in docs}
    own = Counter()
    for d in docs:
        own[d["source"]] += size[d["doc_id"]]
    order = sorted(own, key=lambda s: (s is None, (s or "").encode()))
    target = _targets({s: own[s] for s in order})
    found, taken = by_id(op3_source_mix(spark, sf_dir)), Counter()
    for d in docs:
        r = found[d["doc_id"]]
        assert r["size"] == size[d["doc_id"]] and r["source_size"] == own[d["source"]]
        assert abs(r["target"] - target[d["source"]]) < 1e-6 * max(1, target[d["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[d["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in own)
    assert by_id(op3_source_mix(spark, sf_dir)) == found


def test_tree_is_exact_and_fair():
    quotas = [1000, 0, 37, 5, 400]
    dealt = mixing.split_quotas(quotas, 10)
    assert [sum(col) for col in zip(*dealt)] == quotas
    sizes = [sum(row) for row in dealt]
    assert max(sizes) - min(sizes) <= 1
    draw = random.Random(1)
    got = [mixing.hypergeometric(draw, 30, 70, 20) for _ in range(20_000)]
    mean = sum(got) / len(got)
    assert abs(mean - 6) < 0.06 and abs(sum((x - mean) ** 2 for x in got) / len(got) - 20 * 0.3 * 0.7 * 80 / 99) < 0.15
    assert mixing.hypergeometric(draw, 0, 5, 3) == 0 and mixing.hypergeometric(draw, 5, 0, 3) == 3
    # of any size, with the right spread
    n = 10**12
    got = [(mixing.hypergeometric(draw, n, n, n) - n / 2) / (n / 8) ** 0.5 for _ in range(4_000)]
    assert abs(sum(got) / len(got)) < 0.08 and abs(sum(x * x for x in got) / len(got) - 1) < 0.1


def test_many_sources_are_filled_in_one_sweep():
    draw = random.Random(8)
    sizes = {i: draw.choice([0, 1, 5, 100, 10_000]) for i in range(3_000)}
    got = mixing.targets(list(sizes.values()), [(5, 2, 1)[i % 3] for i in range(3_000)], 1.5 * sum(sizes.values()), 2)
    assert abs(sum(got) - 1.5 * sum(sizes.values())) < 1e-3
    rate = max(t / (5, 2, 1)[i % 3] for i, t in enumerate(got) if t < 2 * sizes[i] - 1e-9)
    for i, t in enumerate(got):
        assert t <= 2 * sizes[i] + 1e-9 and (abs(t - rate * (5, 2, 1)[i % 3]) < 1e-6 or abs(t - 2 * sizes[i]) < 1e-6)


def test_last_pass_takes_permuted_blocks(spark):
    """What is taken follows the permutation of all blocks of the line, the short one included."""
    words = 20 * mixing.BLOCK_WORDS + 100
    docs = [(i, " ".join(f"d{i}w{k}" for k in range(words // 40)), None, "a") for i in range(40)]
    drawn = rows(mixing.draw_mix(documents(spark, docs), shards=4, share=0.5))
    total = sum(r["size"] for r in drawn)
    assert sum(r["taken"] for r in drawn) == round(0.5 * total)
    shares = sorted(r["taken"] / r["size"] for r in drawn)
    assert shares[0] == 0 and shares[-1] == 1
    other = rows(mixing.draw_mix(documents(spark, docs), shards=4, share=0.5, seed=99))
    assert {r["doc_id"]: r["taken"] for r in other} != {r["doc_id"]: r["taken"] for r in drawn}


def test_rows_without_ids_are_told_apart(spark):
    """Shared and missing ids, equal sizes: the same texts come out in any partitioning."""
    draw = random.Random(6)
    docs = [(draw.choice([None, 1, 2]), " ".join(draw.choice("abcdefgh") + str(k) for k in range(50)), None, "s") for _ in range(400)]
    frame = documents(spark, docs)
    mixes = []
    for f in (frame, frame.repartition(13), frame.orderBy(F.desc("text")).coalesce(1)):
        found = rows(mixing.shuffled_shards(mixing.draw_mix(f, carried=["text"], shards=4)))
        mixes.append(Counter((r["shard"], r["place"], r["text"]) for r in found))
    assert mixes[0] == mixes[1] == mixes[2]
    assert max(Counter(p for _, p, _ in mixes[0]).values()) <= 2


def test_pieces_are_disjoint_and_complete(spark):
    draw = random.Random(3)
    docs = [(i, " ".join(f"d{i}w{k}" for k in range(draw.randrange(300))), None, draw.choice(["a", "b", "B", "é", None])) for i in range(60)]
    docs += [(None, None, None, "b"), (7, "", None, "z"), (7, "", None, "z")]
    frame = documents(spark, docs)
    drawn = mixing.draw_mix(frame, carried=["text"], shards=8)
    found = rows(drawn)
    assert len(found) == len(docs)
    total = Counter()
    for r in found:
        for p in r["pieces"]:
            assert 0 <= p["first"] and p["first"] + p["words"] <= r["size"] and p["words"] > 0
        total[r["source"]] += r["taken"]
    # every word of a source is taken as often as another, give or take one pass
    mixed = rows(mixing.shuffled_shards(drawn))
    words = Counter(w for m in mixed for w in m["text"].split())
    seen = defaultdict(set)
    for r in found:
        for w in (r["text"] or "").split():
            seen[r["source"]].add(words[w])
    assert all(max(v) - min(v) <= 1 for v in seen.values())
    assert sum(words.values()) == sum(total.values())
    assert {r["source"]: r["target"] for r in found}["z"] == 0


def test_empty_table_and_plan(spark, sf_dir):
    assert rows(mixing.draw_mix(documents(spark, []))) == []
    assert rows(mixing.draw_mix(documents(spark, [(1, None)])))[0]["taken"] == 0
    plan = op3_source_mix(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_blocks_are_permuted(spark):
    for n in (1, 2, 7, 1000):
        found = [r["x"] for r in rows(spark.range(n).coalesce(1).selectExpr(f"{mixing.permuted('id', f'{n}L')} AS x"))]
        assert sorted(found) == list(range(n))
    steps = Counter(b - a for a, b in zip(found, found[1:]))
    assert max(steps.values()) < 10  # neither ranges nor a fixed stride
    line = " ".join(f"w{k}" for k in range(64 * mixing.BLOCK_WORDS))
    drawn = rows(mixing.draw_mix(documents(spark, [(1, line, None, "a")]), shards=4, share=1.0))
    order = [p["shard"] for p in sorted(drawn[0]["pieces"], key=lambda p: (p["pass"], p["first"]))]
    assert Counter(order) == {k: 16 for k in range(4)} and order != sorted(order)


def test_stage_and_shards_hold_the_mixed_texts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    shards = rows(op3_mixed_shards(spark, sf_dir))
    taken = {d: r["taken"] for d, r in by_id(op3_source_mix(spark, sf_dir)).items()}
    words = Counter()
    for r in shards:
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
        assert r["sha256"] == sha256(r["text"].encode()).hexdigest()
    assert {d: words[d] for d in taken} == taken
    staged = rows(corpus_pipeline.mix_sources(spark, docs, sf_dir))
    pieces = [(p["shard"], p["place"], r["doc_id"], r["source"], p["text"]) for r in staged for p in r["mixed"]]
    assert Counter(pieces) == Counter((r["shard"], r["place"], r["doc_id"], r["source"], r["text"]) for r in shards)
    assert len({r["shard"] for r in shards}) == mixing.SHARDS


def test_order_inside_a_shard(spark):
    docs = [(i, " ".join(f"d{i}w{k}" for k in range(50)), None, "a") for i in range(200)]
    found = [r.asDict() for r in mixing.shuffled_shards(mixing.draw_mix(documents(spark, docs), carried=["text"], shards=2)).coalesce(1).collect()]
    for shard in (0, 1):
        ids = [r["doc_id"] for r in sorted((r for r in found if r["shard"] == shard), key=lambda r: r["place"])]
        assert len(ids) > 50 and ids != sorted(ids)
