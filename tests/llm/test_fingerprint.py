from __future__ import annotations

import hashlib

from saldora.llm import fingerprint
from saldora.llm.queries import op5_fingerprints

from tests_llm_helpers import by_id, documents, rows


def _shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def _edited(text, following):
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _jaccard(a, b):
    a, b = _shingles(a), _shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query_against_whole_texts(spark, sf_dir):
    docs = rows(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id"))
    found = by_id(op5_fingerprints(spark, sf_dir))
    error, prints = [], {}
    for i, d in enumerate(docs):
        r, after = found[d["doc_id"]], docs[(i + 1) % len(docs)]["text"]
        edited = _edited(d["text"], after)
        assert r["n_chars"] == len(d["text"])
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        error += [r["near_edited"] - _jaccard(d["text"], edited), r["near_next"] - _jaccard(d["text"], after)]
        assert prints.setdefault(d["text"], r["fingerprint"]) == r["fingerprint"]
    assert len(set(prints.values())) == len(prints)
    assert abs(sum(error) / len(error)) < 0.02  # no bias
    assert (sum(e * e for e in error) / len(error)) ** 0.5 < 0.05


def test_edges(spark):
    docs = documents(spark, [(5, "a b c"), (2, ""), (9, None), (None, "é" * 5), (5, "a b"), (7, "z " * 40_000), (7, "z " * 40_000)])
    found = rows(fingerprint.fingerprint_documents(docs))
    assert len(found) == 7
    for r in found:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    by_size = {r["n_chars"]: r for r in found}
    # null id first, then 2, 5 (by MD5 of the text), 7 and 9; the first follows the last
    assert by_size[5]["edited_sha256"] == hashlib.sha256("ééé".encode()).hexdigest()
    assert by_size[0]["fingerprint"] == ""
    empty = [r for r in found if r["n_chars"] == 0]
    assert {r["doc_id"]: r["near_next"] for r in empty} == {2: 0.0, 9: 0.0}
    assert rows(fingerprint.fingerprint_documents(documents(spark, []))) == []
    alone = rows(fingerprint.fingerprint_documents(documents(spark, [(1, "a b c d")])))[0]
    assert alone["edited_sha256"] == hashlib.sha256(b"a b a b ").hexdigest()[:64] or alone["near_next"] == 1.0


def test_only_dataframe_operations(spark, sf_dir):
    plan = op5_fingerprints(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
