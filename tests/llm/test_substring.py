from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from saldora.llm import substring
from saldora.llm.queries import op7_repeated_passages

from tests_llm_helpers import by_id, documents, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _brute(texts, width=substring.WINDOW):
    split = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_query_against_brute_force(spark, sf_dir):
    docs = rows(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    found = by_id(op7_repeated_passages(spark, sf_dir))
    expected = _brute([d["text"] for d in docs])
    assert any(e[1] for e in expected)
    for d, e in zip(docs, expected):
        r = found[d["doc_id"]]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == e


def test_automaton_counts_substrings():
    draw = random.Random(1)
    sequences = [[draw.randrange(3) for _ in range(draw.randrange(1, 14))] for _ in range(8)]
    times = [draw.randrange(1, 4) for _ in sequences]
    automaton = substring.SuffixAutomaton()
    for s, t in zip(sequences, times):
        automaton.add(s, t)
    automaton.close()
    for limit in (1, 2, 4, 30):
        for probe in [*sequences, [0, 1, 2, 9, 1, 1, 0], []]:
            for end, (matched, count) in enumerate(automaton.statistics(probe, limit), 1):
                def occurs(part):
                    return sum(t * (s[i : i + len(part)] == part) for s, t in zip(sequences, times) for i in range(len(s)))
                best = max(k for k in range(min(limit, end) + 1) if k == 0 or occurs(probe[end - k : end]))
                assert matched == best
                assert best == 0 or count == occurs(probe[end - best : end])


@pytest.mark.parametrize("shard", [64, 1])
def test_small_alphabets_and_large_shards(spark, monkeypatch, shard):
    """Periodic texts, passages at other offsets, copies; with shard=1 all shards count as large."""
    monkeypatch.setattr(substring, "SHARD", shard)
    draw = random.Random(shard)
    passage = [f"p{draw.randrange(900)}" for _ in range(60)]
    texts = ["a " * 90, "a b " * 50, "\n".join(passage), None, "", "solo", "x" * 30_000]
    for k in range(25):
        own = [f"r{draw.randrange(10**6)}" for _ in range(draw.randrange(60))]
        cut = draw.randrange(30)
        texts.append(" ".join(own + passage[cut : cut + draw.randrange(20, 60)] + own[:5]))
    texts += texts[10:14] + ["é " + " ".join(passage[:34]), "\x0b".join(passage[:35])]
    ids = list(range(len(texts)))
    ids[-1] = ids[-2] = None
    docs = documents(spark, list(zip(ids, texts)))
    got = Counter((r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows(substring.remove_repeats(docs)))
    assert got == Counter(_brute(texts))


def test_stretches_cover_every_window_once():
    code = np.random.default_rng(0).integers(0, 50, 4_000).astype(np.uint64)
    cut = np.array([0, 10, 44, 80, 4_000])
    owner, first, size, _, _ = substring.stretches(code, cut)
    seen = Counter((o, f + k) for o, f, s in zip(owner, first, size) for k in range(s))
    assert seen == Counter((d, i) for d in range(4) for i in range(cut[d + 1] - cut[d] - substring.WINDOW + 1))


def test_empty_table_and_repeated_rows(spark):
    assert rows(substring.remove_repeats(documents(spark, []))) == []
    text = " ".join(map(str, range(40)))
    out = rows(substring.remove_repeats(documents(spark, [(1, text), (1, text)])))
    assert [(r["n_words"], r["n_removed"]) for r in out] == [(40, 40), (40, 40)]
