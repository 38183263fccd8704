"""Merkle manifest against a plain computation."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from saldora.llm import queries
from saldora.llm.manifest import FAN, STEPS, manifest

from tests_llm_helpers import documents, rows

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def climb(nodes):
    """Root of some nodes and, for each, its siblings level by level as (before, after)."""
    paths, own, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, i in enumerate(own):
            run = i // 8 * 8
            paths[k].append((level[run:i], level[i + 1 : run + 8]))
        own = [i // 8 for i in own]
        level = [H(*level[i : i + 8]) for i in range(0, len(level), 8)]
    return level[0], paths


def lower(text):
    return text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(data):
    """(doc_id, source, lang, n_chars, text) rows."""
    groups = {}
    for r in data:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    below = []
    for name in names:
        own = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        root, paths = climb([leaf(r) for r in own])
        below.append((own, root, paths))
    root, tops = climb([b[1] for b in below])
    out = []
    for (own, subroot, paths), top in zip(below, tops):
        for r, path in zip(own, paths):
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            node = leaf((*r[:4], lower(r[4]))) if changed else leaf(r)
            for before, after in [*path, *top]:
                node = H(*before, node, *after)
            siblings = H(*(x for before, after in [*path, *top] for x in [*before, *after]))
            out.append((r[0], leaf(r), subroot, root, siblings, node, node == root))
    return sorted(out, key=str)


def table(spark, tmp_path, data):
    documents(spark, [(i, t, lang, source) for i, source, lang, _, t in data]).repartition(5).write.parquet(
        str(tmp_path / "documents.parquet")
    )
    return [(i, source, lang, None if t is None else len(t), t) for i, source, lang, _, t in data]


def result(spark, tmp_path):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = rows(queries.op12_merkle_manifest(spark, str(tmp_path)))
    return sorted((tuple(r[n] for n in names) for r in got), key=str)


def sample(n, langs, seed=1):
    draw = random.Random(seed)
    return [(i * 3, draw.choice(["web", None, "böok"]), draw.choice(langs), 0, draw.choice(["A b", "c d", "É Z", "", None])) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 8, 9, 65, 700])
def test_sizes(spark, tmp_path, n):
    """Every shape of a last run; 700 rows of one group need a second round of blocks."""
    data = table(spark, tmp_path, sample(n, ["en"]))
    assert result(spark, tmp_path) == brute(data)


def test_groups(spark, tmp_path):
    """A hot group, more groups than a run holds, null group, names beyond ASCII, lone leaves."""
    langs = [None, "en", "en", "en", "en", "de", *[f"x{i}" for i in range(12)], "é", "Z", "日"]
    data = table(spark, tmp_path, sample(900, langs, 2))
    want = brute(data)
    assert result(spark, tmp_path) == want
    assert {w[6] for w in want} == {True, False}


def test_nulls_and_repeats(spark, tmp_path):
    data = sample(30, ["en", None], 3)
    data += [data[4]] * 20 + [(None, None, "en", 0, "T")] * 11 + [(None, None, None, 0, None), (12, "a", "en", 0, "Other")]
    data = table(spark, tmp_path, data)
    assert result(spark, tmp_path) == brute(data)


def test_empty_table(spark, tmp_path):
    table(spark, tmp_path, [])
    assert result(spark, tmp_path) == []


def test_operator_gives_the_siblings(spark):
    data = [(i, "Text" * i, "en", "s") for i in range(FAN**STEPS // 16)]
    got = rows(manifest(documents(spark, data), ["doc_id", "text"]))
    leaves = [leaf((i, t)) for i, t, _, _ in data]
    root, paths = climb(leaves)
    for r in got:
        assert r["root"] == root and r["verified"] and r["subroot"] == root
        assert r["proof"] == "".join(x for a, b in paths[r["doc_id"]] for x in [*a, *b])
