from __future__ import annotations

import hashlib
import re

import duckdb
import pyarrow as pa
from saldora.llm import decontaminate, queries
from saldora.llm.queries import op10_benchmark_hits

from tests_llm_helpers import by_id, documents, rows

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def _brute(texts, items, n=10):
    windows = {}
    for item, text in items:
        w = _words(text)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for text in texts:
        w, hit, found = _words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                own = windows.get(tuple(w[i : i + size]))
                if own:
                    hit.update(range(i, i + size))
                    found |= own
        ids = ",".join(sorted(map(str, found)))
        out.append((len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest()))
    return out


def _benchmark(spark, items):
    kind = pa.schema([("item_id", pa.int64()), ("text", pa.string()), ("words", pa.string())])
    columns = [[i for i, _ in items], [t for _, t in items], ["z"] * len(items)]
    return spark.createDataFrame(pa.table(columns, schema=kind))


def test_query_against_brute_force(spark, sf_dir):
    docs = rows(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    items = rows(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = by_id(op10_benchmark_hits(spark, sf_dir))
    expected = _brute([d["text"] for d in docs], [(i["item_id"], i["text"]) for i in items])
    assert any(e[1] for e in expected)
    for d, e in zip(docs, expected):
        r = found[d["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == e
        assert r["contaminated"] == (e[1] > 0)


def test_short_items_overlaps_ties_and_nulls(spark):
    long = " ".join(f"w{i}" for i in range(14))
    items = [(1, long), (2, "É a-B"), (2, "É a b"), (3, "..."), (4, None), (10, long), (5, "q " * 12)]
    texts = [long, "x É A b y É;a;B", None, "", "q " * 40, "w3 " + long + " " + long, "x" * 50_000, long]
    docs = documents(spark, list(enumerate(texts)) + [(None, long)])
    bench = _benchmark(spark, items)
    found = rows(decontaminate.contamination(docs, bench))
    expected = _brute(texts + [long], items)
    got = sorted(
        (r["n_words"], r["n_hit"], len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest())
        for r in found
    )
    assert got == sorted(expected)
    kept = rows(decontaminate.remove_contaminated(docs, bench))
    assert sorted(r["doc_id"] for r in kept) == [2, 3, 6] and list(kept[0]) == docs.columns
    spans = {r["doc_id"]: r["text"] for r in rows(decontaminate.remove_spans(docs, bench))}
    assert spans[1] == "x y" and spans[5] == "w3" and spans[6] == texts[6] and spans[2] is None


def test_empty_tables(spark):
    none, some = documents(spark, []), documents(spark, [(1, "a b")])
    assert rows(decontaminate.contamination(none, _benchmark(spark, [(1, "a b")]))) == []
    assert rows(decontaminate.contamination(some, _benchmark(spark, [])))[0]["n_hit"] == 0
    assert len(rows(decontaminate.remove_contaminated(some, _benchmark(spark, [])))) == 1
    assert len(rows(decontaminate.remove_spans(some, _benchmark(spark, [(9, "!")])))) == 1


def test_items_without_an_id_hit_too(spark):
    long = " ".join(f"w{k}" for k in range(12))
    items = [(None, long), (None, "p q"), (3, "p q"), (None, None), (None, "...")]
    texts = ["see " + long, "p q", "p q and " + long, "clean text"]
    docs = documents(spark, list(enumerate(texts)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = by_id(decontaminate.contamination(docs, bench))
    assert {i: (r["n_hit"], r["items"]) for i, r in found.items()} == {
        0: (12, [None]), 1: (2, ["3", None]), 2: (14, ["3", None]), 3: (0, [])
    }
    assert [r["doc_id"] for r in rows(decontaminate.remove_contaminated(docs, bench))] == [3]


def test_query_agrees_with_its_sql_on_items_without_an_id(spark, tmp_path):
    long = " ".join(f"w{k}" for k in range(12))
    documents(spark, list(enumerate(["see " + long, "p q", "p q and " + long, "clean text"]))).write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(None, long), (None, "p q"), (3, "p q")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    result = con.execute(queries.ORACLE["op10_benchmark_hits"])
    names = [c[0] for c in result.description]
    expected = {r[0]: dict(zip(names, r)) for r in result.fetchall()}
    assert by_id(queries.op10_benchmark_hits(spark, str(tmp_path))) == expected


def test_benchmarks_beyond_one_broadcast(spark, monkeypatch):
    """Rounds of a few windows each find what one round finds, in long texts and at all lengths."""
    items = [(i, " ".join(f"w{(i * 7 + k) % 50}" for k in range(3 + i % 14))) for i in range(30)]
    texts = [" ".join(f"w{(k * 3 + i) % 50}" for k in range(n)) for i, n in enumerate((0, 5, 60, 20_000))]
    texts += [" ".join(f"w{k % 50}" for k in range(i, i + 40)) for i in range(8)]
    docs, bench = documents(spark, list(enumerate(texts))), _benchmark(spark, items)
    expected = _brute(texts, items)
    for most in (decontaminate.BROADCAST_WINDOWS, 40):
        monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", most)
        found = by_id(decontaminate.contamination(docs, bench))
        assert [(found[i]["n_words"], found[i]["n_hit"], len(found[i]["items"])) for i in range(len(texts))] == [e[:3] for e in expected]


def test_clashing_names(spark):
    docs = documents(spark, [(1, "a b c"), (2, "x y")])
    for name in ("key", "__key", "hits", "words", "WORDS"):
        docs = docs.drop(name).withColumn(name, docs["lang"])
    bench = _benchmark(spark, [(1, "a b")])
    kept = rows(decontaminate.remove_contaminated(docs, bench))
    assert [r["doc_id"] for r in kept] == [2] and list(kept[0]) == docs.columns
    spans = rows(decontaminate.remove_spans(docs, bench))
    assert {r["doc_id"]: r["text"] for r in spans} == {1: "c", 2: "x y"} and list(spans[0]) == docs.columns
