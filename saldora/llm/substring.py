"""Substring deduplication with suffix automata over reference shards.

A window is ``WINDOW`` consecutive words (runs of characters other than ASCII white space,
unchanged). Every word that is covered by a window which also starts anywhere else, in any
document, is removed; windows are judged on the input.

The reference is the corpus itself, which has no size bound, so its automata are not sent to
every task. Each text is cut into stretches of consecutive windows that share a minimiser
(the least hash of a window's runs of ``ANCHOR`` words). Equal windows have equal
minimisers, so the stretches of one minimiser are the only part of the reference that can
match one another: they are a shard. Equal stretches of a shard are counted, not repeated,
and shards with one stretch that occurs once end here. A shard of up to ``SHARD`` different
stretches becomes a suffix automaton with occurrence counts, and its stretches are streamed
through it: the matching statistic at a position is the longest suffix, cut at ``WINDOW``,
and the count of its state says how often that window occurs in the shard. Shards beyond
the bound, such as the edges of a passage that a third of all documents share, are counted
by the hash of each window instead, which gives the same answer and needs no group.

Words enter as 64-bit hashes; a text is known by two.

Cases: a null or empty text has no words; a text with fewer words than a window keeps them.
Repeated rows and copies are occurrences of one another. Overlapping occurrences inside one
document count. The kept words are joined by one space.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldora.llm.rows import document_columns
from saldora.llm.textbytes import mix, slices, span_hashes, window_hashes, word_hashes, words
from saldora.session import materialise

WINDOW = 35
ANCHOR = 8
SHARD = 64
_PLACE = np.uint64((1 << 20) - 1)
_SECOND = 0xE7037ED1A0B428DB  # another base: two hashes name a stretch


class SuffixAutomaton:
    """States of all substrings of the added sequences, with occurrence counts."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]

    def add(self, symbols: list[int], times: int) -> None:
        """One sequence that occurs ``times`` times."""
        next_, link, length, count = self.next, self.link, self.length, self.count
        last = 0
        for c in symbols:
            q = next_[last].get(c)
            if q is not None:  # seen in an earlier sequence
                if length[q] != length[last] + 1:
                    q = self._clone(last, c, q)
                last = q
                count[last] += times
                continue
            new = len(next_)
            next_.append({})
            length.append(length[last] + 1)
            link.append(0)
            count.append(times)
            p = last
            while p >= 0 and c not in next_[p]:
                next_[p][c] = new
                p = link[p]
            if p >= 0:
                q = next_[p][c]
                link[new] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
            last = new

    def _clone(self, p: int, c: int, q: int) -> int:
        next_, link = self.next, self.link
        copy = len(next_)
        next_.append(dict(next_[q]))
        self.length.append(self.length[p] + 1)
        link.append(link[q])
        self.count.append(0)
        link[q] = copy
        while p >= 0 and next_[p].get(c) == q:
            next_[p][c] = copy
            p = link[p]
        return copy

    def close(self) -> None:
        """Add up the ends of longer substrings at their suffixes."""
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.count[self.link[s]] += self.count[s]

    def statistics(self, symbols: list[int], limit: int) -> Iterator[tuple[int, int]]:
        """(matched length up to ``limit``, occurrences of that suffix) at every position."""
        state, matched = 0, 0
        next_, link, length, count = self.next, self.link, self.length, self.count
        for c in symbols:
            while state and c not in next_[state]:
                state = link[state]
                matched = length[state]
            step = next_[state].get(c)
            if step is None:
                matched = 0
            else:
                state = step
                matched += 1
            while state and length[link[state]] >= limit:
                state = link[state]
            matched = min(matched, limit)
            yield matched, count[state] if state else 0


# ------------------------------------------------------------------ stretches


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` numbers, by doubling."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def stretches(code: np.ndarray, cut: np.ndarray):
    """(document, first window, windows, minimiser, content) of all stretches of a slice.

    ``cut`` has how many words lie before each document. A new stretch begins where the
    minimiser's place changes. Equal windows have it in the same place of theirs, so no
    window occurs twice in one stretch, however periodic a text is.
    """
    n_words = np.diff(cut)
    empty = np.zeros(0, dtype=np.int64)
    if not len(code) or n_words.max(initial=0) < WINDOW:
        return empty, empty, empty, empty, empty
    owner = np.repeat(np.arange(len(n_words)), n_words)
    anchors = window_hashes(code, ANCHOR)
    # hash above, place below: of equal hashes the first place counts
    places = np.arange(len(anchors), dtype=np.uint64) & _PLACE
    least = _sliding_least((anchors & ~_PLACE) | places, WINDOW - ANCHOR + 1)
    begins = np.flatnonzero(owner[: len(least)] == owner[WINDOW - 1 : WINDOW - 1 + len(least)])
    place = begins + ((least[begins] - begins.astype(np.uint64)) & _PLACE).astype(np.int64)
    low = anchors[place]
    new = np.ones(len(begins), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[begins[1:]] != owner[begins[:-1]])
    at = np.flatnonzero(new)
    first, last = begins[at], begins[np.append(at[1:], len(begins)) - 1]
    size = last - first + 1
    starts, ends = first, last + WINDOW

    content = span_hashes(code, starts, ends) ^ (span_hashes(code, starts, ends, _SECOND) << np.uint64(1))
    return owner[first], first - cut[owner[first]], size, low[at].view(np.int64), content.view(np.int64)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in slices(batches):
        starts, ends, cut = words(data, offsets)
        owner, first, size, low, content = stretches(word_hashes(data, starts, ends), cut)
        yield pa.RecordBatch.from_arrays(
            [
                *(c.take(pa.array(owner)) for c in rows.columns[:2]), pa.array(first, pa.int64()).cast(pa.int32()),
                pa.array(size, pa.int64()).cast(pa.int32()), pa.array(low, pa.int64()), pa.array(content, pa.int64()),
            ],
            names=["k1", "k2", "first", "size", "shard", "content"],
        )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word hashes of the wanted stretches of each text."""
    for rows, data, offsets in slices(batches):
        starts, ends, cut = words(data, offsets)
        code = word_hashes(data, starts, ends)
        shard, content, times, kinds, symbols = [], [], [], [], []
        for i, wanted in enumerate(rows.column(1).to_pylist()):
            for w in wanted:
                a = cut[i] + w["first"]
                symbols.append(code[a : a + w["size"] + WINDOW - 1].tobytes())
                shard.append(w["shard"])
                content.append(w["content"])
                times.append(w["times"])
                kinds.append(w["kinds"])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(shard, pa.int64()), pa.array(content, pa.int64()), pa.array(times, pa.int64()),
                pa.array(kinds, pa.int64()), pa.array(symbols, pa.binary()),
            ],
            names=["shard", "content", "times", "kinds", "symbols"],
        )


def repeated_windows(parts: list[tuple[bytes, int]]) -> list[list[int]]:
    """For the stretches of one shard, with their counts: which of their windows repeat."""
    automaton = SuffixAutomaton()
    sequences = [np.frombuffer(p, dtype=np.uint64).tolist() for p, _ in parts]
    for symbols, (_, times) in zip(sequences, parts):
        automaton.add(symbols, times)
    automaton.close()
    return [
        [
            end - WINDOW + 1
            for end, (matched, times) in enumerate(automaton.statistics(symbols, WINDOW))
            if matched == WINDOW and times > 1
        ]
        for symbols in sequences
    ]


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per shard: its stretches against its automaton."""
    for batch in batches:
        shard, content, found = [], [], []
        for i, row in enumerate(batch.column(1).to_pylist()):
            own = batch.column(0)[i].as_py()
            for r, windows in zip(row, repeated_windows([(r["symbols"], r["times"]) for r in row])):
                if windows:
                    shard.append(own)
                    content.append(r["content"])
                    found.append(windows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(shard, pa.int64()), pa.array(content, pa.int64()), pa.array(found, pa.list_(pa.int32()))],
            names=["shard", "content", "windows"],
        )


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of stretches of large shards, by two 64-bit hashes."""
    for batch in batches:
        out: list[list] = [[], [], [], [], [], []]
        for i in range(batch.num_rows):
            code = np.frombuffer(batch["symbols"][i].as_py(), dtype=np.uint64)
            one, two = window_hashes(code, WINDOW), window_hashes(mix(code), WINDOW, _SECOND)
            n = len(one)
            for k, x in enumerate((
                np.full(n, batch["shard"][i].as_py()), np.full(n, batch["content"][i].as_py()),
                np.full(n, batch["times"][i].as_py()), np.arange(n), one.view(np.int64), two.view(np.int64),
            )):
                out[k].append(x)
        joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in joined],
            names=["shard", "content", "times", "at", "one", "two"],
        )


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in slices(batches):
        starts, ends, cut = words(data, offsets)
        blob = data.tobytes()
        removed, digests, kept_texts = [], [], []
        for i in range(rows.num_rows):
            a, b = cut[i], cut[i + 1]
            gone = np.zeros(b - a + 1, dtype=np.int64)
            spans = rows.column(1)[i].as_py() or []
            for span in spans:
                gone[span["lo"]] += 1
                gone[span["hi"]] -= 1
            keep = np.flatnonzero(np.cumsum(gone[:-1]) == 0) + a
            text = b" ".join([blob[s:e] for s, e in zip(starts[keep].tolist(), ends[keep].tolist())])
            removed.append(int(b - a - len(keep)))
            digests.append(hashlib.sha256(text).hexdigest())
            kept_texts.append(text.decode())
        yield pa.RecordBatch.from_arrays(
            [
                rows.column(0), pa.array(np.diff(cut), pa.int64()), pa.array(removed, pa.int64()),
                pa.array(digests, pa.string()), pa.array(kept_texts, pa.string()),
            ],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
        )


# ------------------------------------------------------------------ operator


def _named(docs: DataFrame) -> DataFrame:
    """Rows with two 64-bit hashes of their text: what is removed depends on the text only."""
    return document_columns(docs).select(
        F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"), "doc_id", "text"
    )


def repeated_spans(rows: DataFrame) -> DataFrame:
    """k1, k2, spans (lo, hi): the words of repeated windows of each text, by word position."""
    cut = rows.select("k1", "k2", "text").mapInArrow(
        _cut, "k1 long, k2 long, first int, size int, shard long, content long"
    )
    # one row per shard and task leaves the map side, however many copies there are
    shards = cut.groupBy("shard").agg(
        F.count("*").alias("all"), F.min("content").alias("low"), F.max("content").alias("high")
    ).where("all > 1").select("shard", F.expr("low != high").alias("mixed"))
    # stored, so that the join below is one of two plain exchanges, which Spark can split
    # where copies of one passage fill a shard
    shards = materialise(shards)
    known = materialise(cut.join(shards, "shard"))
    mixed = known.where("mixed")
    kinds = mixed.groupBy("shard", "content").agg(
        F.count("*").alias("times"), *[F.first(c).alias(c) for c in ("k1", "k2", "first", "size")]
    )
    per_shard = mixed.groupBy("shard").agg(F.approx_count_distinct("content", 0.02).alias("kinds"))
    kinds = materialise(kinds.join(per_shard, "shard"))
    wanted = kinds.groupBy("k1", "k2").agg(
        F.collect_list(F.struct("shard", "content", "times", "kinds", "first", "size")).alias("wanted")
    )
    # rows of one text are equal: they give the same stretches, of which one is kept; all
    # columns of rows are read, so that this exchange of the texts serves the last join too
    parts = (
        rows.join(wanted, ["k1", "k2"]).select("text", "wanted", "doc_id")
        .mapInArrow(_read, "shard long, content long, times long, kinds long, symbols binary")
        .groupBy("shard", "content").agg(*[F.first(c).alias(c) for c in ("times", "kinds", "symbols")])
    )
    small = (
        parts.where(F.col("kinds") <= SHARD)
        .groupBy("shard").agg(F.collect_list(F.struct("content", "times", "symbols")).alias("parts"))
        .mapInArrow(_stream, "shard long, content long, windows array<int>")
    )
    single = parts.where(F.col("kinds") > SHARD).mapInArrow(
        _explode, "shard long, content long, times long, at long, one long, two long"
    )
    counted = single.groupBy("one", "two").agg(F.sum("times").alias("all")).where("all > 1")
    large = (
        single.join(counted, ["one", "two"])
        .groupBy("shard", "content").agg(F.collect_list(F.col("at").cast("int")).alias("windows"))
    )
    found = small.unionByName(large)
    whole = F.array(F.struct(F.col("first").alias("lo"), (F.col("first") + F.col("size") + WINDOW - 1).alias("hi")))
    each = F.transform(
        "windows", lambda w: F.struct((F.col("first") + w).alias("lo"), (F.col("first") + w + WINDOW).alias("hi"))
    )
    hits = known.where("not mixed").select("k1", "k2", whole.alias("spans")).unionByName(
        mixed.join(found, ["shard", "content"]).select("k1", "k2", each.alias("spans"))
    )
    return hits.groupBy("k1", "k2").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, kept_text."""
    rows = _named(docs)
    joined = rows.join(repeated_spans(rows), ["k1", "k2"], "left").select("doc_id", "spans", "text")
    return joined.mapInArrow(
        _keep, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )
