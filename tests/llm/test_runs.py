"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from saldora.llm import queries
from saldora.llm.runs import collapse_runs, maximal_pairs, runs

from tests_llm_helpers import by_id, documents, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w):
    """(start, length, period) of all runs, by start and period."""
    n, best = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                best.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, size, q) for (s, size), q in best.items()), key=lambda r: (r[0], r[2]))


def kept(w, found):
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def planted(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def expected(doc_id, w):
    found = brute(w)
    longest = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    text = "".join(f"{a},{b},{c}\n" for a, b, c in found)
    return {
        "doc_id": doc_id, "n_runs": len(found), "start": longest[0], "length": longest[1], "period": longest[2],
        "exponent_milli": None if not found else 1000 * longest[1] // longest[2],
        "runs_sha256": hashlib.sha256(text.encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(kept(w, found).encode()).hexdigest(),
    }


def texts(seed, n, letters, most):
    """Random words with planted repeats, of few letters: many runs, nested and side by side."""
    draw, out = random.Random(seed), []
    for _ in range(n):
        w = []
        while len(w) < draw.randrange(1, most):
            unit = [draw.choice(letters) for _ in range(draw.randrange(1, 6))]
            w += unit * draw.choice([1, 1, 2, 4, 5, 7]) + unit[: draw.randrange(len(unit))]
        out.append(w)
    return out


@pytest.mark.parametrize("letters", ["a", "ab", "abc", "abcdefghij"])
def test_runs_of_a_slice(letters):
    found = [["x"] * 3, [], *texts(5, 120, letters, 60), ["y"] * 40, []]
    number = {c: i for i, c in enumerate("abcdefghijxy")}
    code = np.array([number[x] for w in found for x in w], dtype=np.uint64)
    cut = np.append(0, np.cumsum([len(w) for w in found]))
    text, start, length, period = runs(code, cut)
    got = [[] for _ in found]
    for t, s, size, q in zip(*(x.tolist() for x in (text, start, length, period))):
        got[t].append((s, size, q))
    assert got == [brute(w) for w in found]
    assert sum(map(len, got)) > 20


def test_maximal_pairs_of_one_letter():
    """Of n equal words the only run with the smallest period is the whole; multiples are pairs too."""
    n = 400
    found = maximal_pairs(list(range(n - 1, -1, -1)), list(range(1, n)), [-1 if i == 0 else 7 for i in range(n - 1, -1, -1)])
    assert {(0, n, q) for q in range(1, n // 4 + 1)} == set(found)


def test_operator(spark):
    data = [(i, " ".join(w)) for i, w in enumerate(texts(9, 60, "abcd", 80))]
    long = ["q", *["p", "r"] * 60_000, "s"]
    data += [
        (100, None), (101, ""), (102, " \t\n "), (103, "a a a a a a"), (103, "a a a a a a"), (None, "b c " * 9),
        (104, "é é é é é é 日 日 日 日 日 日 日"), (105, " ".join(long)), (106, "a a a a a a a a a a a a"),
    ]
    got = rows(collapse_runs(documents(spark, data).repartition(3)))
    assert len(got) == len(data)
    want = []
    for i, t in data:
        w = WORD.findall(t or "")
        found = [(1, 120_000, 2)] if i == 105 else brute(w)
        want.append((i, found, kept(w, found)))
    assert sorted(
        ((r["doc_id"], [tuple(x.values()) for x in r["runs"]], r["collapsed"]) for r in got), key=str
    ) == sorted(want, key=str)


def test_empty_table(spark):
    assert rows(collapse_runs(documents(spark, []))) == []


def test_query(spark, tmp_path):
    """Through the query's own planting: every tenth text has one, also null and empty ones."""
    draw = random.Random(3)
    data = []
    for i in range(300):
        n = draw.choice([0, 1, 2, 5, 9, 40, 90])
        data.append((i, None if i % 41 == 0 else " ".join(draw.choice("abcdefgh") for _ in range(n))))
    documents(spark, [*data, (None, "a a a a a a a"), (7, data[7][1])]).write.parquet(str(tmp_path / "documents.parquet"))
    got = rows(queries.op13_periodic_runs(spark, str(tmp_path)))
    want = [expected(i, planted(i, t)) for i, t in [*data, (None, "a a a a a a a"), (7, data[7][1])]]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_query_on_the_table(spark, sf_dir):
    docs = rows(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    found = by_id(queries.op13_periodic_runs(spark, sf_dir))
    seen = 0
    for d in docs:
        w = planted(d["doc_id"], d["text"])
        if len(w) <= 3000:
            assert found[d["doc_id"]] == expected(d["doc_id"], w)
            seen += 1
    assert seen > 150 and len(found) == len(docs)
