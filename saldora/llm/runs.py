"""Periodic runs of words, found as maximal pairs, and texts with each run cut to one period.

A run is a stretch of consecutive words with smallest period q, of at least ``MIN_LENGTH``
words and at least ``EXPONENT`` periods, that no neighbouring word extends. Let two places
i < j = i + q of a text have a longest common extension of l words. If the words left of them
differ (or i is the first word) the pair is maximal: then the stretch of q + l words from i on
has period q and cannot be extended. So the maximal pairs with l >= (EXPONENT - 1) * q and
q + l >= MIN_LENGTH are exactly the runs with their periods, and the same stretches again with
multiples of these; the smallest period of a stretch is kept.

The maximal pairs come from the suffix array of the words of a text: intervals of suffixes
with a common prefix form a tree, which is built from its leaves up. Each interval holds its
places in order and a list of them for every left word; where two children of an interval
meet, the places of the smaller one look up places of the larger one within the allowed
distance and of other left words. Parts of the tree that cannot hold such a pair (one left
word only, or no two places close enough) are passed over.

Suffixes are sorted by prefix doubling, side by side for all texts of a slice. Words enter as
64-bit hashes; only words of one text are ever compared.

Cases: null and empty texts have no words, no runs and an empty collapsed text. Rows are
independent of each other: repeated rows and null ids are like any other. Very long texts are
slices of their own; their memory grows with the text, some 4 bytes a word and doubling.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldora.llm.rows import document_columns
from saldora.llm.textbytes import mix, slices, word_hashes, words

EXPONENT = 4
MIN_LENGTH = 6
# the shortest extension that any run's pair has: 5 words for period 1, then 6 for 2 and more
_LEAST = min(max(MIN_LENGTH - q, (EXPONENT - 1) * q) for q in range(1, MIN_LENGTH + 1))
SCHEMA = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


# ------------------------------------------------------------------ suffixes


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys: the index at which each one's group begins, and whether it has company."""
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(key)))
    return np.repeat(first, size), np.repeat(size > 1, size)


def suffix_ranks(code: np.ndarray, owner: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... words, the last ones all different.

    Equal ranks at depth d mean equal first d words of one text. ``ends`` is, for every word,
    where its text ends.
    """
    n = len(code)
    key = mix(code ^ mix(owner.astype(np.uint64)))
    order = np.argsort(key)
    first, company = _groups(key[order])
    rank = np.empty(n, dtype=np.int32)
    rank[order] = first
    active = order[company]
    ranks, depth = [rank], 1
    while len(active):
        old = rank[active].astype(np.int64)
        further = active + depth
        beyond = further >= ends[active]
        further[beyond] = 0
        after = rank[further].astype(np.int64)
        after[beyond] = -1
        key = old * (n + 1) + after + 1
        order = np.argsort(key)
        active, old, key = active[order], old[order], key[order]
        first, company = _groups(key)
        outer, _ = _groups(old)
        rank = rank.copy()
        rank[active] = old + (first - outer)
        ranks.append(rank)
        active = active[company]
        depth *= 2
    return ranks


def common_prefixes(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words the suffixes at a[i] and b[i], of one text and different, have in common."""
    n = len(ranks[0])
    total = np.zeros(len(a), dtype=np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        x, y = a + total, b + total
        inside = (x < n) & (y < n)
        x[~inside], y[~inside] = 0, 0
        same = inside & (ranks[level][x] == ranks[level][y])
        total[same] += 1 << level
    return total


# ------------------------------------------------------------------ interval tree


class _Interval:
    """Places below an interval: in order, and in order for every left word."""

    __slots__ = ("places", "by_left")

    def __init__(self, place: int, left: int) -> None:
        self.places = [place]
        self.by_left = {left: [place]}


def _meet(a: _Interval, b: _Interval, depth: int, left: dict[int, int], out: list) -> _Interval:
    """Pairs between two children of an interval of ``depth``, and the two as one."""
    small, large = (a, b) if len(a.places) <= len(b.places) else (b, a)
    most = depth // (EXPONENT - 1)
    places, by_left = large.places, large.by_left
    for own, members in small.by_left.items():
        alike = by_left.get(own, ())
        for i in members:
            lo, hi = bisect_left(places, i - most), bisect_right(places, i + most)
            near = hi - lo
            if near and alike:
                near -= bisect_right(alike, i + most) - bisect_left(alike, i - most)
            if not near:
                continue
            if len(by_left) <= hi - lo:
                found = [
                    j for other, at in by_left.items() if other != own
                    for j in at[bisect_left(at, i - most) : bisect_right(at, i + most)]
                ]
            else:
                found = [j for j in places[lo:hi] if left[j] != own]
            out.extend((min(i, j), abs(i - j) + depth, abs(i - j)) for j in found)
    for own, members in small.by_left.items():
        have = by_left.get(own)
        if have is None:
            by_left[own] = members
        else:
            _insert(have, members)
    _insert(places, small.places)
    return large


def _insert(have: list[int], more: list[int]) -> None:
    if len(more) > 8:
        have.extend(more)
        have.sort()  # two ordered runs: a merge
    else:
        for x in more:
            insort(have, x)


def maximal_pairs(places: list[int], prefixes: list[int], lefts: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal pairs close enough for a run.

    ``places`` are suffixes in sorted order, ``prefixes[k]`` what suffixes k and k + 1 have in
    common, ``lefts`` a number for the word to the left of each.
    """
    out: list[tuple[int, int, int]] = []
    left = dict(zip(places, lefts))
    stack: list[tuple[int, _Interval]] = []
    for k, place in enumerate(places):
        done = _Interval(place, lefts[k])
        depth = prefixes[k] if k < len(prefixes) else -1
        while stack and stack[-1][0] > depth:
            inner, first = stack.pop()
            done = _meet(first, done, inner, left, out)
        if stack and stack[-1][0] == depth:
            done = _meet(stack.pop()[1], done, depth, left, out)
        stack.append((depth, done))
    return out


def runs(code: np.ndarray, cut: np.ndarray):
    """(text, start, length, period) of the runs of all texts of a slice, by text, start, period.

    ``cut`` has how many words lie before each text.
    """
    n = len(code)
    none = np.zeros(0, dtype=np.int64)
    sizes = np.diff(cut)
    if sizes.max(initial=0) < MIN_LENGTH:
        return none, none, none, none
    owner = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.repeat(cut[1:], sizes)
    ranks = suffix_ranks(code, owner, ends)
    level = int(np.log2(_LEAST))  # all suffixes that share that many words with another one
    if level + 1 >= len(ranks):
        return none, none, none, none
    _, counts = np.unique(ranks[level], return_counts=True)
    shared = np.repeat(counts > 1, counts)  # a rank is where its group begins
    order = np.empty(n, dtype=np.int64)
    order[ranks[-1]] = np.arange(n)
    suffix = order[shared]
    prefix = common_prefixes(ranks, suffix[:-1], suffix[1:]) * (owner[suffix[:-1]] == owner[suffix[1:]])
    # parts of the tree below its intervals of _LEAST words
    part = np.append(0, np.cumsum(prefix < _LEAST)) if len(suffix) else none
    left = np.where(
        (suffix > 0) & (owner[suffix] == owner[np.maximum(suffix - 1, 0)]), ranks[0][np.maximum(suffix - 1, 0)], -1
    )
    begin = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    close = np.append(begin[1:], len(part))
    by_place = np.lexsort((suffix, part))
    gap = np.diff(suffix[by_place], append=2 * n + 2)
    gap[close - 1] = n  # the last place of a part has no next one
    deepest = np.append(prefix, 0)
    deepest[close - 1] = 0
    able = (
        (np.minimum.reduceat(left, begin) != np.maximum.reduceat(left, begin))
        & (np.minimum.reduceat(gap, begin) * (EXPONENT - 1) <= np.maximum.reduceat(deepest, begin))
    )
    found: list[tuple[int, int, int]] = []
    for k in np.flatnonzero(able):
        a, b = begin[k], close[k]
        found += maximal_pairs(suffix[a:b].tolist(), prefix[a : b - 1].tolist(), left[a:b].tolist())
    if not found:
        return none, none, none, none
    start, length, period = np.array(found, dtype=np.int64).T
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    keep = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1])) & (length >= MIN_LENGTH)
    start, length, period = start[keep], length[keep], period[keep]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    text = owner[start]
    return text, start - cut[text], length, period


# ------------------------------------------------------------------ operator


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray, n: int) -> pa.Array:
    """The words of each text with one space between them."""
    last = np.append(text[1:] != text[:-1], True)[: len(text)]
    size = ends - starts + ~last
    to = np.cumsum(size) - size
    source = np.repeat(starts - to, size) + np.arange(int(size.sum()))
    out = data[np.minimum(source, len(data) - 1)] if len(data) else data
    out[(to + size - 1)[~last]] = 32
    per_text = np.bincount(text, size, minlength=n).astype(np.int64)
    offsets = np.append(0, np.cumsum(per_text)).astype(np.int32)
    return pa.StringArray.from_buffers(n, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes()))


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in slices(batches):
        starts, ends, cut = words(data, offsets)
        n = rows.num_rows
        text, start, length, period = runs(word_hashes(data, starts, ends), cut)
        # how many runs' later periods lie over each word
        over = np.bincount(cut[text] + start + period, minlength=len(starts) + 1)
        over = over - np.bincount(cut[text] + start + length, minlength=len(starts) + 1)
        keep = np.flatnonzero(np.cumsum(over)[:-1] == 0)
        owner = np.repeat(np.arange(n), np.diff(cut))
        found = pa.StructArray.from_arrays(
            [pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"]
        )
        bounds = np.append(0, np.cumsum(np.bincount(text, minlength=n))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                rows.column(0), pa.ListArray.from_arrays(pa.array(bounds), found),
                _joined(data, starts[keep], ends[keep], owner[keep], n),
            ],
            names=["doc_id", "runs", "collapsed"],
        )


def collapse_runs(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, its runs by start and period, and the collapsed text: its
    words, without those that any run holds after its first period, joined by one space."""
    return document_columns(docs).mapInArrow(_collapse, SCHEMA)
