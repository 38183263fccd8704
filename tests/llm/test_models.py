"""Trained operators: held-out accuracy on the small tables, and their parts by themselves."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from saldora.llm import language, quality, toxicity
from saldora.llm.queries import op2_quality_neighbours, op8_toxicity, op9_language
from saldora.llm.rows import held_out

from tests_llm_helpers import by_id, documents, rows

SF = "/root/testdata/sf0.01"


def _labels(spark, items):
    kind = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32()), ("score", pa.string())])
    columns = list(zip(*items)) if items else [[], [], []]
    return spark.createDataFrame(pa.table([*map(list, columns), ["s"] * len(items)], schema=kind))


def _truth(spark, name):
    table = spark.read.parquet(f"{SF}/labels.parquet")
    return {r["doc_id"]: r[name] for r in rows(table)}


def test_quality_held_out(spark):
    truth, found = _truth(spark, "quality"), by_id(op2_quality_neighbours(spark, SF))
    own = [(found[i]["predicted"], y) for i, y in truth.items() if found[i]["held_out"]]
    assert np.mean([a == b for a, b in own]) >= 0.95
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in found.values())


def test_toxicity_held_out(spark):
    truth, found = _truth(spark, "toxic"), by_id(op8_toxicity(spark, SF))
    own = [(found[i]["predicted"], y) for i, y in truth.items() if found[i]["held_out"]]
    assert np.mean([a == b for a, b in own]) >= 0.9
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in found.values())


def test_language_held_out(spark):
    docs = {r["doc_id"]: r["lang"] for r in rows(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"))}
    found = by_id(op9_language(spark, SF))
    own = [found[i]["lang_pred"] == x for i, x in docs.items() if found[i]["held_out"] and x]
    assert np.mean(own) >= 0.95


ODD = [(1, None), (2, ""), (None, "abc"), (4, "12 34"), (5, "w " * 60_000), (6, "ok fine"), (6, "ok fine")]


def test_odd_rows(spark):
    docs = documents(spark, [(i, t, "xx" if t and "w" in t else "yy") for i, t in ODD])
    labels = _labels(spark, [(2, 1, 0), (5, 0, 1), (5, 1, 1), (6, None, None), (None, 1, 1), (99, 1, 1)])
    always = F.lit(True)
    quick = language.TrainingBounds(steps=3)
    for result in (
        quality.score(docs, quality.train(docs, labels, always)),
        toxicity.score(docs, toxicity.train(docs, labels, always)),
        language.identify_language(docs, always, quick),
    ):
        out = rows(result)
        assert sorted((r["doc_id"] or 0) for r in out) == [0, 1, 2, 4, 5, 6, 6]
        assert all(0 <= r["score"] <= 1 for r in out)
    out = rows(language.identify_language(docs, always, quick))
    assert {r["doc_id"] for r in out if r["lang_pred"] == "und"} == {1, 2, 4}


def test_nothing_to_learn_from(spark):
    docs, none = documents(spark, [(1, "a b"), (2, None)]), _labels(spark, [])
    assert {r["score"] for r in rows(quality.score(docs, quality.train(docs, none, F.lit(True))))} == {0.5}
    assert all(r["score"] < 1e-9 for r in rows(toxicity.score(docs, toxicity.train(docs, none, F.lit(True)))))
    assert {r["lang_pred"] for r in rows(language.identify_language(docs, F.lit(True)))} == {"und"}
    empty = documents(spark, [])
    assert rows(quality.score(empty, quality.train(empty, none, F.lit(True)))) == []
    assert rows(toxicity.score(empty, toxicity.train(empty, none, F.lit(True)))) == []
    assert rows(language.identify_language(empty, F.lit(True))) == []


def test_drop_toxic_keeps_columns(spark):
    docs = documents(spark, [(1, "a b"), (2, None)])
    model = toxicity.train(docs, _labels(spark, []), F.lit(True))
    kept = rows(toxicity.drop_toxic(docs, model))
    assert [r["doc_id"] for r in kept] == [1, 2] and list(kept[0]) == docs.columns


def test_held_out_is_never_learnt(spark):
    docs = documents(spark, [(i, f"text {i}", "aa" if i % 2 else "bb") for i in range(300)])
    out = {r["doc_id"]: r["h"] for r in rows(docs.select("doc_id", held_out(3, 1).alias("h")))}
    only = docs.where(F.col("doc_id").isin([i for i, h in out.items() if h]))
    assert language.train(only, ~held_out(3, 1)).languages == []


def test_letters():
    assert language.has_letter("2é") and language.has_letter("²x") and language.has_letter("字")
    assert not any(map(language.has_letter, ("", "12 ²Ⅷ _-", "!?")))


def test_gradients():
    net = language.Network.start(["a", "b", "c"], 4, 6)
    net.inputs = [x.astype(np.float64) for x in net.inputs]
    net.hidden = [x.astype(np.float64) for x in net.hidden]
    net.output, net.bias = net.output.astype(np.float64), net.bias.astype(np.float64)
    draw = np.random.default_rng(0)
    seen = draw.integers(0, 256, (5, 6)).astype(np.uint8)
    mask, label = np.ones((5, 6), dtype=bool), np.array([0, 1, 2, 1, 0])
    mask[0, 4:] = False
    _, grads = language.gradients(net, seen, mask, label)
    for weight, grad in zip(net.weights(), grads):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        was, losses = weight[at], []
        for step in (1e-2, -1e-2):
            weight[at] = was + step
            losses.append(language.gradients(net, seen, mask, label)[0])
        weight[at] = was
        assert (losses[0] - losses[1]) / 2e-2 == pytest.approx(grad[at], rel=1e-2)


def test_inference_equals_training_states():
    net = language.Network.start(["a", "b"], 8, 16)
    seen = np.random.default_rng(1).integers(0, 256, (7, 16)).astype(np.uint8)
    for d in (0, 1):
        assert np.allclose(net._run(seen.T.astype(np.intp), d), net.states(seen, d), atol=1e-5)
    data, offsets = seen.reshape(-1), np.array([0, 0, 5, 40, 112])
    p = language.document_probabilities(net, data, offsets, batch=3)
    assert np.allclose(p.sum(axis=1), [0, 1, 1, 1], atol=1e-5)


def _forward(net, text):
    """Mean distribution of one text, position by position in plain numpy."""
    data, h = np.frombuffer(text.encode(), np.uint8), net.hidden[0].shape[0]
    logistic = lambda x: 1 / (1 + np.exp(-x))
    total = np.zeros(len(net.languages))
    for a in range(0, len(data), net.width):
        piece = np.zeros(net.width, np.uint8)
        piece[: len(data[a : a + net.width])] = data[a : a + net.width]
        states = np.zeros((2, net.width, h))
        for d in (0, 1):
            state = np.zeros(h)
            for t in range(net.width) if d == 0 else reversed(range(net.width)):
                x, back = net.inputs[d][piece[t]].astype(float), state @ net.hidden[d].astype(float)
                update, reset = logistic(x[:h] + back[:h]), logistic(x[h : 2 * h] + back[h : 2 * h])
                new = np.tanh(x[2 * h :] + reset * back[2 * h :])
                state = new + update * (state - new)
                states[d, t] = state
        logits = states[0] @ net.output[:h] + states[1] @ net.output[h:] + net.bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        total += (p / p.sum(axis=1, keepdims=True))[: len(data) - a].sum(axis=0)
    return total / max(1, len(data))


def test_language_query_against_plain_network(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    net = language.train(docs, ~held_out(3, 1))
    found = by_id(op9_language(spark, sf_dir))
    seen = 0
    for d in rows(docs.select("doc_id", "text")):
        if d["text"] is not None and 0 < len(d["text"]) < 800 and language.has_letter(d["text"]):
            p, r = _forward(net, d["text"]), found[d["doc_id"]]
            assert r["score"] == pytest.approx(p.max(), abs=2e-4)
            assert r["lang_pred"] == net.languages[p.argmax()] or np.sort(p)[-1] - np.sort(p)[-2] < 1e-3
            seen += 1
    assert seen > 30


def test_language_depends_on_the_text_alone(spark, sf_dir):
    """Alone, repeated, next to others and in any partitioning: the same scores."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text is not null")
    net = language.train(docs, ~held_out(3, 1), language.TrainingBounds(steps=80))

    def found(these):
        got = by_id(language.predict(these, net))
        return {i: r["lang_pred"] for i, r in got.items()}, pytest.approx({i: r["score"] for i, r in got.items()}, abs=1e-6)

    short = docs.select("doc_id", F.expr("substring(text, 1, 20)").alias("text"))
    for these in (docs.select("doc_id", "text"), short):
        one = found(these)
        for other in (these.repartition(13), these.orderBy(F.desc("doc_id")).coalesce(1)):
            labels, scores = found(other)
            assert labels == one[0] and scores.expected == one[1]
    data = [(1, "Guten Tag"), (2, "x" * 90), (3, "Guten Tag"), (4, "and so on, he said"), (5, "Guten Tag")]
    labels, scores = found(documents(spark, data).coalesce(1))
    alone = rows(language.predict(documents(spark, data[:1]), net))[0]
    assert {labels[i] for i in (1, 3, 5)} == {alone["lang_pred"]}
    assert [scores.expected[i] for i in (1, 3, 5)] == pytest.approx([alone["score"]] * 3, abs=1e-6)


def test_rare_languages_are_learned(spark):
    """Batches are even over languages: one with six documents of 2,006 is told apart."""
    draw = np.random.default_rng(4)
    text = lambda letters: "".join(draw.choice(list(letters), 60))
    data = [(i, text("abcdef "), "aa") for i in range(2000)] + [(5000 + i, text("uvwxyz "), "bb") for i in range(6)]
    docs = documents(spark, [*data, *((9000 + i, text("uvwxyz "), None) for i in range(20))])
    found = by_id(language.identify_language(docs, F.lit(True), language.TrainingBounds(documents=400, steps=150)))
    assert all(found[9000 + i]["lang_pred"] == "bb" for i in range(20))
    assert sum(found[i]["lang_pred"] == "aa" for i in range(2000)) > 1990


def test_commonest_languages_within_the_bound(spark):
    docs = documents(spark, [(i, "abc", f"l{i % 7}") for i in range(50)])
    net = language.train(docs, F.lit(True), language.TrainingBounds(languages=3, steps=2))
    assert net.languages == ["l0", "l1", "l2"]  # eight of l0, seven of the others


def test_non_negative_risk_finds_positives():
    draw = np.random.default_rng(2)
    pos = (draw.random((400, 30)) < 0.1).astype(np.float32)
    pos[:, 0] = 1
    unl = (draw.random((2000, 30)) < 0.1).astype(np.float32)
    hidden = np.arange(2000) < 300
    unl[:, 0] = hidden
    w = toxicity.nn_pu_weights(pos, unl, 0.15, 400, 128)
    z = unl @ w[:-1] + w[-1]
    cut = toxicity.best_cut(pos @ w[:-1] + w[-1], z, 0.15)
    assert np.mean((z > cut) == hidden) > 0.99


def test_neighbours_are_exact():
    draw = np.random.default_rng(3)
    counts = draw.random((50, 64)).astype(np.float32)
    labels = draw.integers(0, 2, 50).astype(float)
    space = quality.latent_space(counts, labels, quality.Bounds(terms=64, rank=8, neighbours=5))
    probe = quality.project(space, draw.random((9, 64)).astype(np.float32))
    got = quality.votes(space, probe, np.zeros(9, dtype=bool))
    for v, score in zip(probe, got):
        cosine = space.vectors @ v
        near = np.argsort(-cosine)[:5]
        weight = np.maximum(cosine[near], 0) ** space.power + 1e-9
        assert score == pytest.approx((weight * labels[near]).sum() / weight.sum(), rel=1e-4)


def test_equal_neighbours_share_the_votes():
    """Forty equal labelled vectors, half of each label: one half, in whatever order they stand."""
    draw = np.random.default_rng(5)
    one = quality._unit(draw.random((1, 8)).astype(np.float32))
    for order in (np.arange(40), draw.permutation(40), np.argsort(np.arange(40) % 2, kind="stable")):
        labels = (np.arange(40) % 2)[order].astype(float)
        space = quality.Space(np.ones(8, np.float32), np.eye(8, dtype=np.float32), one.repeat(40, 0), labels, 15, 4.0, 0)
        assert quality.votes(space, one, np.zeros(1, dtype=bool))[0] == pytest.approx(0.5, abs=1e-9)
    # a nearer one counts whole, the equal ones share what is left
    vectors = np.concatenate([np.eye(2, dtype=np.float32)[:1], np.array([[0.6, 0.8]], np.float32).repeat(4, 0)])
    space = quality.Space(np.ones(2, np.float32), np.eye(2, dtype=np.float32), vectors, np.array([1.0, 0, 0, 0, 1]), 3, 1.0, 0)
    got = quality.votes(space, np.array([[1.0, 0.0]], np.float32), np.zeros(1, dtype=bool))[0]
    assert got == pytest.approx((1 + 0.5 * 0.6) / (1 + 2 * 0.6), abs=1e-6)


def test_packed_rows_give_the_same_space():
    draw = np.random.default_rng(6)
    counts = (draw.random((700, 64)) * (draw.random((700, 64)) < 0.2)).astype(np.float16).astype(np.float32)
    at = [np.flatnonzero(x).astype(np.uint16) for x in counts]
    packed = quality.Packed(at, [x[p].astype(np.float16) for p, x in zip(at, counts)], 64)
    bounds, found = quality.Bounds(terms=64, rank=8, words=0), (700, (counts > 0).sum(axis=0))
    labels = draw.integers(0, 2, 700).astype(float)
    a, b = (quality.latent_space(x, labels, bounds, found) for x in (counts, packed))
    assert np.array_equal(a.directions, b.directions) and np.array_equal(a.vectors, b.vectors)


def test_quality_query_against_plain_votes(spark):
    """The query's scores from vectors and votes computed one document at a time."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    space = quality.train(docs, labels, ~held_out(5, 0))
    found, seen = by_id(op2_quality_neighbours(spark, SF)), 0
    for d in rows(docs.select("doc_id", "text").where("doc_id % 9 = 0")):
        data = (d["text"] or "").encode()
        if not data:
            continue
        terms = _quality_terms(d["text"])[0].astype(float) * space.idf
        vector = terms / np.linalg.norm(terms) @ space.directions
        cosine = space.vectors @ (vector / np.linalg.norm(vector))
        order = np.argsort(-cosine)
        least = cosine[order[space.neighbours - 1]]
        above, equal = cosine > least + 1e-6, np.abs(cosine - least) <= 1e-6
        share = np.where(above, 1.0, np.where(equal, (space.neighbours - above.sum()) / equal.sum(), 0.0))
        weight = share * (np.maximum(cosine, 0) ** space.power + 1e-9)
        assert found[d["doc_id"]]["score"] == pytest.approx((weight * space.labels).sum() / weight.sum(), abs=2e-2)
        seen += 1
    assert seen > 90


def _quality_terms(*texts):
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    return quality.term_counts(np.frombuffer(b"".join(data), np.uint8), offsets, 2048, 4096)


def test_vocabulary_tells_texts_of_one_shape_apart():
    for a, b in (("the cat sat, on mats", "dog has ran, to hugs"), ("春眠不觉晓处处闻啼鸟", "床前明月光疑是地上霜")):
        x, y, again = _quality_terms(a * 3, b * 3, a * 3)
        assert (x[:2048] == y[:2048]).all() and (x != y).any() and (x == again).all()
        assert ((x[2048:] > 0) & (y[2048:] > 0)).sum() <= 1


def test_quality_that_shows_in_vocabulary_only(spark):
    draw = np.random.default_rng(2)
    good, bad = (["".join(map(chr, draw.integers(97, 123, 5))) for _ in range(30)] for _ in range(2))
    texts = [" ".join(draw.choice((bad, good)[i % 2], 60)) for i in range(200)]
    docs = documents(spark, list(enumerate(texts)))
    labels = _labels(spark, [(i, i % 2, 0) for i in range(100)])
    found = by_id(quality.score(docs, quality.train(docs, labels, F.lit(True))))
    assert all((found[i]["score"] > 0.5) == bool(i % 2) for i in range(100, 200))


def test_frequencies_are_of_all_documents(spark):
    texts = ["aa bb", "aa cc", None, "", "bb"]
    n, having = quality.document_frequencies(documents(spark, list(enumerate(texts))), quality.Bounds())
    assert n == 5 and (having == (_quality_terms(*(t or "" for t in texts)) > 0).sum(axis=0)).all()
