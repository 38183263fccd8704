"""A random forest of many trees, grown level by level in the same passes.

Features become bins once; rows are stored as blocks of bytes, a few dozen a row. A pass walks
each row down the trees grown so far and counts, for every open node and a random subset of its
features, rows by bin and class. The first levels of a walk are taken by all rows of a block
together, byte by byte; a feature of two bins is counted by its rarer bin only, found as the bits
set in a word a row, the other bin is what the node has besides. Counts of the tasks meet by
tree, where the best split of each node is found; the driver gets splits only. A row's weight in a tree is a Poisson draw from a
hash of its content, so the forest depends on the rows and the seed, not on their partitions.

Splits, bins, impurity, pruning and votes are those of Spark's forest: Gini, candidate cuts from
a sample, the least depth that parts the classes, sibling leaves of one prediction merged.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from saldora.operators.relational import quoted
from saldora.session import local_arrays

# Rows a block has at most, and at least when there are more tasks to fill.
BLOCK = (1_000, 131_072)
# Rows of a stored partition at most.
PARTITION_ROWS = 1_000_000
# Blocks of the largest size a task has at least for them to be dealt whole.
EVEN = 8
# Cells that a task counts in one pass; beyond them a level is several passes over some trees each.
CELLS = 32_000_000
# Passes of a level that run side by side.
PARALLEL = 3
# Levels of a walk that all rows of a block take together.
TOGETHER = 5
# Rows that are scored at a time, and scored with each column from a donor.
SCORED, SWAPPED = 65_536, 16_384

NODES = "tree int, id int, rows long, impurity double, weights array<double>, gain double, left int, right int, feature int, threshold double"
_SPLITS = "tree int, slot int, feature int, bin int, gain double, n0 long, n1 long, l0 long, l1 long"
_GOLDEN, _MIX = 0x9E3779B97F4A7C15, (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _draws(hashes: np.ndarray, tree: int) -> np.ndarray:
    """How often a tree sees each row: Poisson of mean 1, from the row's hash."""
    x = hashes + np.uint64((tree + 1) * _GOLDEN % 2**64)
    for shift, factor in zip((30, 27), _MIX):
        x ^= x >> np.uint64(shift)
        x *= factor
    x >>= np.uint64(48)
    return _POISSON.take(x.view(np.int64))


_POISSON = np.searchsorted(
    np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]), (np.arange(1 << 16) + 0.5) / (1 << 16)
).astype(np.uint8)


def find_cuts(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Cuts of one feature: between all values, or where equal weights lie on both sides of each."""
    distinct, place = np.unique(values, return_inverse=True)
    middle = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middle) < bins:
        return middle
    upto = np.cumsum(np.bincount(place, weights))
    wanted = np.arange(1, bins) * upto[-1] / bins
    at = np.searchsorted(upto, wanted)
    nearer = (at > 0) & (np.abs(upto[np.maximum(at - 1, 0)] - wanted) < np.abs(upto[at] - wanted))
    return middle[np.unique(np.minimum(at - nearer, len(middle) - 1))]


def _to_bins(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """(features, rows) as bytes; a value up to a cut lies below it."""
    out = np.empty(x.shape[::-1], np.uint8)
    for f, c in enumerate(cuts):
        own = np.ascontiguousarray(x[:, f])
        out[f] = own > c[0] if len(c) == 1 and not np.isnan(own).any() else np.searchsorted(c, own, side="left")
    return out


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _larger(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``rows`` or more, the last one aside."""
    parts, held = [], 0
    for batch in batches:
        if batch.num_rows:
            parts.append(batch)
            held += batch.num_rows
        if held >= rows:
            yield pa.concat_batches(parts)
            parts, held = [], 0
    if parts:
        yield pa.concat_batches(parts)


def _vector(features: Column | Sequence[Column]) -> Column:
    return features if isinstance(features, Column) else F.array(*features)


def _sampled_cuts(
    rows: DataFrame, features: Column, label: str, n: int, weight: dict[int, float], bins: int, seed: int,
) -> list[np.ndarray]:
    """Cuts of all features from a sample of the size that Spark's trees take, drawn before features are made."""
    wanted = max(bins * bins, 10_000)
    some = rows if n <= wanted else rows.sample(wanted / n, seed)
    some = some.select(features.alias("x"), F.col(label).alias("label")).toArrow()
    if not some.num_rows:
        raise ValueError("no rows to fit")
    x = _matrix(some.column("x").combine_chunks(), some.num_rows)
    w = np.array([weight[y] for y in some.column("label").to_pylist()])
    return [find_cuts(x[:, f], w, bins) for f in range(x.shape[1])]


def _blocks(rows: DataFrame, cuts: list[np.ndarray], block: int) -> DataFrame:
    """(n, zeros, bins, hashes): rows packed as bytes, those of class 0 first; ``bins`` feature by feature."""
    shared = rows.sparkSession.sparkContext.broadcast(cuts)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(parts):
            b, y, h = (np.concatenate(p, axis=-1) for p in zip(*parts))
            for a in range(0, len(y), block):
                order = np.argsort(y[a:a + block], kind="stable")
                own = [np.take(b[:, a:a + block], order, axis=1), h[a:a + block][order]]
                yield pa.RecordBatch.from_arrays([
                    pa.array([len(order)], pa.int32()), pa.array([int((y[a:a + block] == 0).sum())], pa.int32()),
                    *[pa.array([c.tobytes()], pa.binary()) for c in own]], names=["n", "zeros", "bins", "hashes"])

        parts, held = [], 0
        for batch in batches:
            if batch.num_rows:
                y, h = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
                parts.append((_to_bins(_matrix(batch.column(0), batch.num_rows), shared.value), y.astype(np.uint8), h.astype(np.int64).view(np.uint64)))
                held += batch.num_rows
            if held >= block:
                yield from packed(parts)
                parts, held = [], 0
        if parts:
            yield from packed(parts)

    return rows.select("x", "label", "h").mapInArrow(pack, "n int, zeros int, bins binary, hashes binary")


@dataclass
class _Tree:
    """A tree in growth; children stand side by side, a leaf leads to itself."""

    feature: np.ndarray
    bin: np.ndarray
    child: np.ndarray
    counts: np.ndarray
    gain: np.ndarray
    open: np.ndarray  # ids of the nodes of the last level that may be split

    @classmethod
    def root(cls) -> _Tree:
        return cls(np.zeros(1, np.int64), np.full(1, 255, np.uint8), np.zeros(1, np.int64), np.zeros((1, 2), np.int64), np.full(1, -1.0), np.zeros(1, np.int64))

    def grow(self, slot: np.ndarray, feature: np.ndarray, cut: np.ndarray, gain: np.ndarray, own: np.ndarray, left: np.ndarray, last: bool) -> None:
        ids = self.open[slot]
        self.counts[ids] = own
        split = gain > 0.0
        ids, left, own = ids[split], left[split], own[split]
        first = len(self.child) + 2 * np.arange(len(ids))
        self.feature[ids], self.bin[ids], self.child[ids], self.gain[ids] = feature[split], cut[split], first, gain[split]
        both = np.stack([left, own - left], axis=1).reshape(-1, 2)
        new = len(self.child) + np.arange(len(both))
        self.feature = np.concatenate([self.feature, np.zeros(len(both), np.int64)])
        self.bin = np.concatenate([self.bin, np.full(len(both), 255, np.uint8)])
        self.child = np.concatenate([self.child, new])
        self.counts = np.concatenate([self.counts, both])
        self.gain = np.concatenate([self.gain, np.full(len(both), -1.0)])
        self.open = new[(both > 0).all(axis=1)] if not last else new[:0]


def _first_steps(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, child: np.ndarray, steps: int) -> np.ndarray:
    """The node that each row reaches in a few steps: every comparison is made for all rows, and the
    nodes are picked by them from the last step up."""
    def reached(node: int, left: int) -> np.ndarray:
        down = int(child[node])
        if not left or down == node:
            return np.uint8(node)
        over = np.greater(bins[feature[node]], cut[node]).view(np.uint8)
        low, high = reached(down, left - 1), reached(down + 1, left - 1)
        if low.ndim == high.ndim == 0:  # siblings
            over += low
            return over
        picked = low ^ high
        picked &= np.negative(over, out=over)
        picked ^= low
        return picked

    out = reached(0, steps)
    return (np.full(bins.shape[1], out) if out.ndim == 0 else out).astype(np.int64)


def _walk(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, child: np.ndarray, steps: int, rows: np.ndarray | None = None) -> np.ndarray:
    """The node each row reaches, of all or some rows of ``bins``."""
    node = _first_steps(bins, feature, cut, child, min(steps, TOGETHER))
    if rows is not None:
        node = node.take(rows)
    if steps > TOGETHER:
        flat, begin = bins.ravel(), feature * bins.shape[1]
        rows = np.arange(bins.shape[1]) if rows is None else rows
        for _ in range(steps - TOGETHER):
            at = begin.take(node)
            at += rows
            over = flat.take(at) > cut.take(node)
            node = child.take(node)
            node += over
    return node


def _swapped(own: np.ndarray, donor: np.ndarray, column: np.ndarray, columns: int, trees: Sequence[tuple]) -> np.ndarray:
    """(columns, rows): the sum of all trees' shares when one column comes from the donor; ``column`` tells
    the features' (-1: none of them).

    A row walks down a tree once. Where its donor would turn off, a second walk begins for the column
    of that node, the first time for each; a column without one reaches the row's own leaf.
    """
    n = own.shape[1]
    rows, beyond = np.arange(n), own.size
    flat = np.concatenate([own.ravel(), donor.ravel()])
    out = np.zeros((columns, n))
    every = out.ravel()
    for feature, cut, child, share, steps in trees:
        begin, of = feature * n, column[feature]
        left = np.zeros(columns * n, bool)
        node = np.zeros(n, np.int64)
        row = col = at = np.zeros(0, np.int64)
        for _ in range(steps):
            if len(at):
                cell = begin.take(at)
                cell += row
                cell += (of.take(at) == col) * beyond
                over = flat.take(cell) > cut.take(at)
                at = child.take(at)
                at += over
            cell = begin.take(node)
            cell += rows
            limit = cut.take(node)
            over = flat.take(cell) > limit
            cell += beyond
            other = flat.take(cell) > limit
            down = child.take(node)
            off = np.flatnonzero(over != other)
            which = of.take(node.take(off))
            new = np.flatnonzero((which >= 0) & ~left.take(which * n + off))
            off, which = off.take(new), which.take(new)
            left[which * n + off] = True
            row, col = np.concatenate([row, off]), np.concatenate([col, which])
            at = np.concatenate([at, down.take(off) + other.take(off)])
            node = down
            node += over
        cell = col * n + row
        sums = every.take(cell) + share.take(at)
        out += share.take(node)
        every[cell] = sums
    return out


def _offsets(subset: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, int]:
    """Where the cells of each (node, feature) begin, and how many there are."""
    sizes = width[subset].ravel()
    ends = np.cumsum(sizes)
    return (ends - sizes).reshape(subset.shape), int(ends[-1])


class _Tally:
    """Rows of a task by the cells (node, feature, bin, class) of one tree.

    Counted are the rows of a node, those in the rarer bin of features with two bins, and all bins
    of the others; each for the nodes with class 0 first, then for the same with class 1.
    """

    def __init__(self, tree: int, grown: tuple, width: np.ndarray, place: np.ndarray) -> None:
        self.tree, (self.feature, self.cut, self.child, slots, self.subset) = tree, grown
        self.slots, self.nodes = slots, len(self.subset)
        self.wide = width[self.subset] > 2
        sizes = np.where(self.wide, width[self.subset], 0)
        ends = np.cumsum(sizes.ravel())
        self.cells = int(ends[-1])
        order = np.argsort(~self.wide, axis=1, kind="stable")
        starts = np.take_along_axis(ends.reshape(sizes.shape) - sizes, order, 1)
        self.wides = np.tile(self.wide.sum(axis=1), 2)
        self.features = np.tile(np.take_along_axis(self.subset, order, 1), (2, 1)).T.copy()
        self.starts = np.concatenate([starts, starts + self.cells]).T.copy()
        place = place[self.subset]  # -1 where no bit stands for the feature
        self.node, self.column = np.nonzero(place >= 0)
        place = place[self.node, self.column]
        words = place // 64
        self.masks, self.bits = [], []
        for k in range(int(words.max(initial=-1)) + 1):
            own = np.flatnonzero(words == k)
            mask = np.zeros(self.nodes, np.uint64)
            np.bitwise_or.at(mask, self.node[own], np.uint64(1) << (place[own] % 64).astype(np.uint64))
            self.masks.append(np.tile(mask, 2))
            self.bits.append((own, self.node[own] * 64 + place[own] % 64))
        self.total: tuple[np.ndarray, ...] | None = None

    def add(self, bins: np.ndarray, zeros: int, hashes: np.ndarray, words: list[np.ndarray], level: int) -> None:
        times = _draws(hashes, self.tree)
        rows = np.flatnonzero(times != 0)
        weight = times.take(rows).astype(np.float64)
        node = _walk(bins, self.feature, self.cut, self.child, level, rows)
        slot = self.slots.take(node)
        here = slot >= 0
        if not here.all():
            here = np.flatnonzero(here)
            slot, rows, weight = slot.take(here), rows.take(here), weight.take(here)
        slot[np.searchsorted(rows, zeros):] += self.nodes
        found = [np.bincount(slot, weight, 2 * self.nodes), self._rare(words, slot, rows, weight), self._wide(bins, slot, rows, weight)]
        if self.total is None:
            self.total = tuple(x.astype(np.int32) for x in found)
        else:
            for x, y in zip(self.total, found):
                x += y.astype(np.int32)

    def _rare(self, words: list[np.ndarray], slot: np.ndarray, rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
        out = np.zeros((2, len(self.node)))
        for word, mask, (own, at) in zip(words, self.masks, self.bits):
            left, s, w = word.take(rows), slot, weight
            left &= mask.take(slot)
            cells, weights = [np.zeros(0, np.int64)], [np.zeros(0)]
            while True:
                some = np.flatnonzero(left != 0)
                if not len(some):
                    break
                left, s, w = left.take(some), s.take(some), w.take(some)
                bit = left & (~left + np.uint64(1))  # the lowest one; its place is its exponent
                cell = bit.astype(np.float64).view(np.int64)
                cell >>= 52
                cell -= 1023
                cell += s << 6
                cells.append(cell)
                weights.append(w)
                left ^= bit
            found = np.bincount(np.concatenate(cells), np.concatenate(weights), 128 * self.nodes)
            out[:, own] = found.reshape(2, -1)[:, at]
        return out

    def _wide(self, bins: np.ndarray, slot: np.ndarray, rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
        flat, n = bins.ravel(), bins.shape[1]
        cells, weights = [np.zeros(0, np.int64)], [np.zeros(0)]
        fewest, most = int(self.wides.min()), int(self.wides.max())
        for j in range(most):
            if j >= fewest:
                some = np.flatnonzero((self.wides > j).take(slot))
                slot, rows, weight = slot.take(some), rows.take(some), weight.take(some)
            at = (self.features[j] * n).take(slot)
            at += rows
            cell = self.starts[j].take(slot)
            cell += flat.take(at)
            cells.append(cell)
            weights.append(weight)
        return np.bincount(np.concatenate(cells), np.concatenate(weights), 2 * self.cells)

    def counts(self, width: np.ndarray, rarer: np.ndarray) -> np.ndarray:
        """Rows by cell and class, features of two bins with both of them; ``rarer`` is the bin counted."""
        rows, rare, wide = (x.reshape(2, -1).T for x in self.total)
        starts, n = _offsets(self.subset, width)
        out = np.zeros((n, 2), np.int32)
        out[np.repeat(self.wide.ravel(), width[self.subset].ravel())] = wide
        out[starts[~self.wide]] = rows[np.nonzero(~self.wide)[0]]
        first, of = starts[self.node, self.column], rarer[self.subset[self.node, self.column]]
        out[first + (1 - of)] = rows[self.node] - rare
        out[first + of] = rare
        return out.ravel()


def _count(blocks: DataFrame, level: int, grown: dict[int, tuple], width: np.ndarray) -> DataFrame:
    """(tree, at, n): rows by tree and cell (node, feature, bin, class), what a task has of each."""
    shared = blocks.sparkSession.sparkContext.broadcast((grown, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grown, width = shared.value
        place = np.where(width == 2, np.cumsum(width == 2) - 1, -1)
        tallies, rarer = {}, None
        for batch in batches:
            for n, zeros, bins, hashes in zip(*(c.to_pylist() for c in batch.columns)):
                bins, hashes = np.frombuffer(bins, np.uint8).reshape(len(width), n), np.frombuffer(hashes, np.uint64)
                if rarer is None:
                    rarer = np.where((width == 2) & (2 * bins.sum(axis=1, dtype=np.int64) > n), 0, 1)
                    tallies = {t: _Tally(t, g, width, place) for t, g in grown.items()}
                words = [np.zeros(n, np.uint64) for _ in range(-(-(int(place.max()) + 1) // 64))]
                for f in np.flatnonzero(place >= 0):
                    words[place[f] // 64] |= (bins[f] == rarer[f]).astype(np.uint64) << np.uint64(place[f] % 64)
                for tally in tallies.values():
                    tally.add(bins, zeros, hashes, words, level)
        while tallies:
            t, tally = tallies.popitem()
            n = tally.counts(width, rarer)
            at = np.flatnonzero(n != 0).astype(np.uint32)
            dense = 2 * len(at) > len(n)
            yield pa.RecordBatch.from_arrays([
                pa.array([t], pa.int32()), pa.array([b"" if dense else at.tobytes()], pa.binary()),
                pa.array([(n if dense else n[at]).tobytes()], pa.binary())], names=["tree", "at", "n"])

    return blocks.select("n", "zeros", "bins", "hashes").mapInArrow(run, "tree int, at binary, n binary")


def best_splits(cells: np.ndarray, subset: np.ndarray, width: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """(feature, bin, gain, counts, counts of the left side) of every node from its cells' counts by
    class; a node that nothing divides has gain -1."""
    starts, n = _offsets(subset, width)
    first, size = starts.ravel(), width[subset].ravel()
    upto = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(cells.reshape(n, 2).astype(np.int64), axis=0)])
    segment = np.repeat(np.arange(len(first)), size)
    left = upto[1:] - upto[first][segment]
    all_ = (upto[first + size] - upto[first])[segment]
    right = all_ - left

    def gini(c):
        w = c * weight
        total = w.sum(axis=1)
        return total, 1.0 - (w**2).sum(axis=1) / np.maximum(total, 1e-100) ** 2

    (wl, il), (wr, ir), (wa, ia) = gini(left), gini(right), gini(all_)
    gain = ia - (wl * il + wr * ir) / np.maximum(wa, 1e-300)
    gain[(left.sum(axis=1) == 0) | (right.sum(axis=1) == 0)] = -1.0
    node = segment // subset.shape[1]
    begin = starts[:, 0]
    most = np.maximum.reduceat(gain, begin)
    hits = np.flatnonzero(gain == most[node])
    _, one = np.unique(node[hits], return_index=True)
    at = hits[one]
    return subset.ravel()[segment[at]], at - first[segment[at]], gain[at], all_[at], left[at]


def _choose(counted: DataFrame, grown: dict[int, tuple], width: np.ndarray, weight: np.ndarray) -> pa.Table:
    """The best split of every open node, found where a tree's counts meet."""
    subsets = {t: subset for t, (*_, subset) in grown.items()}
    shared = counted.sparkSession.sparkContext.broadcast((subsets, width, weight))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        subsets, width, weight = shared.value
        tree = key[0].as_py()
        _, n = _offsets(subsets[tree], width)
        cells = np.zeros(2 * n, np.int64)
        for batch in table.to_batches():
            for at, count in zip(batch.column("at"), batch.column("n")):
                at, count = np.frombuffer(at.as_py(), np.uint32), np.frombuffer(count.as_py(), np.int32)
                if len(at):
                    cells[at] += count
                elif len(count) == len(cells):
                    cells += count
        feature, cut, gain, own, left = best_splits(cells, subsets[tree], width, weight)
        columns = [np.full(len(gain), tree), np.arange(len(gain)), feature, cut, gain, *own.T, *left.T]
        types = [pa.int32()] * 4 + [pa.float64()] + [pa.int64()] * 4
        return pa.table([pa.array(c, type=t) for c, t in zip(columns, types)], names=[c.split()[0] for c in _SPLITS.split(", ")])

    return counted.groupBy("tree").applyInArrow(run, _SPLITS).toArrow()


def _passes(trees: dict[int, _Tree], features: int, width: np.ndarray) -> list[list[int]]:
    """Open trees in groups whose cells a task can hold."""
    wide = float(np.sort(width)[::-1][:features].sum())
    out, held = [[]], 0.0
    for t, tree in trees.items():
        cells = 2 * len(tree.open) * wide
        if out[-1] and held + cells > CELLS:
            out, held = [*out, []], 0.0
        out[-1].append(t)
        held += cells
    return out


def fit_forest(
    rows: DataFrame, features: Column | Sequence[Column], label: str, weight: dict[int, float], n: int, content: Sequence[str],
    trees: int, depth: int, bins: int, seed: int,
) -> ForestModel:
    """``features`` are columns or one array; ``rows`` hold 0/1 in ``label``, ``weight`` its weight by class, ``n`` their number; rows that are
    equal in ``content`` get the same draws. A node looks at the root of the features' number."""
    spark = rows.sparkSession
    own = rows.select(
        _vector(features).alias("x"), F.col(label).alias("label"), F.xxhash64(F.lit(seed), *map(quoted, content)).alias("h"))
    cuts = _sampled_cuts(rows, _vector(features), label, n, weight, bins, seed)
    tasks = max(1, min(-(-n // BLOCK[0]), max(spark.sparkContext.defaultParallelism, -(-n // PARTITION_ROWS))))
    width = np.array([len(c) + 1 for c in cuts])
    some = math.ceil(math.sqrt(len(cuts)))
    weights = np.array([weight.get(y, 0.0) for y in (0, 1)])
    block = min(BLOCK[1], max(BLOCK[0], -(-n // tasks)))
    if n < EVEN * BLOCK[1] * tasks:  # few blocks a task: rows are dealt, so that all tasks have as many
        stored = _blocks(own.repartition(tasks, "h"), cuts, block).persist()
    else:
        stored = _blocks(own, cuts, block).repartition(tasks).persist()
    growing = {t: _Tree.root() for t in range(trees)}

    def one_pass(level: int, of: list[int]) -> pa.Table:
        grown = {}
        for t in of:
            tree = growing[t]
            draw = np.random.default_rng([seed, t, level]).random((len(tree.open), len(cuts)))
            slots = np.full(len(tree.child), -1)
            slots[tree.open] = np.arange(len(tree.open))
            grown[t] = (tree.feature, tree.bin, tree.child, slots, np.sort(np.argsort(draw, axis=1)[:, :some], axis=1))
        return _choose(_count(stored, level, grown, width), grown, width, weights)

    carry = inheritable_thread_target(spark)
    try:
        for level in range(depth):
            groups = _passes({t: x for t, x in growing.items() if len(x.open)}, some, width)
            if not groups[0]:
                break
            with ThreadPoolExecutor(max_workers=PARALLEL) as pool:
                found = pa.concat_tables(pool.map(carry(lambda g, level=level: one_pass(level, g)), groups))
            tree, slot, feature, cut, gain, n0, n1, l0, l1 = (c.to_numpy() for c in found.columns)
            order = np.lexsort((slot, tree))
            ends = np.flatnonzero(np.diff(tree[order], append=-1)) + 1
            for a, b in zip([0, *ends[:-1]], ends):
                at = order[a:b]
                growing[int(tree[at[0]])].grow(
                    slot[at], feature[at], cut[at], gain[at], np.stack([n0[at], n1[at]], 1), np.stack([l0[at], l1[at]], 1),
                    level == depth - 1)
    finally:
        stored.unpersist()
    return ForestModel.grown(growing, cuts, weights, len(cuts))


@dataclass
class ForestModel:
    """Nodes of all trees as columns (see ``NODES``): tree by tree, the root first, children after
    their parent; ``left`` and ``right`` are ids within the tree, -1 in a leaf."""

    features: int
    columns: dict[str, np.ndarray]
    _shared: list[Any] = field(default_factory=list, repr=False)

    @classmethod
    def grown(cls, trees: dict[int, _Tree], cuts: list[np.ndarray], weight: np.ndarray, features: int) -> ForestModel:
        parts = []
        for t, tree in trees.items():
            w = tree.counts * weight
            leaf = tree.child == np.arange(len(tree.child))
            says = w[:, 1] > w[:, 0]
            for i in np.flatnonzero(~leaf)[::-1]:  # children come after their parent
                a = tree.child[i]
                leaf[i] = leaf[a] and leaf[a + 1] and says[a] == says[a + 1]
            kept = np.zeros(len(leaf), bool)
            kept[0] = True
            for i in np.flatnonzero(~leaf):
                kept[tree.child[i]:tree.child[i] + 2] = kept[i]
            ids, inner = np.cumsum(kept) - 1, ~leaf[kept]
            own, total = w[kept], w[kept].sum(axis=1)
            down = np.where(inner, ids[tree.child[kept]], -1)
            limit = [cuts[f][c] if i else np.nan for f, c, i in zip(tree.feature[kept], tree.bin[kept], inner)]
            parts.append({
                "tree": np.full(len(own), t), "id": np.arange(len(own)), "rows": tree.counts[kept].sum(axis=1),
                "impurity": 1.0 - (own**2).sum(axis=1) / np.maximum(total, 1e-100) ** 2, "w0": own[:, 0], "w1": own[:, 1],
                "gain": np.where(inner, tree.gain[kept], -1.0), "left": down, "right": np.where(inner, down + 1, -1),
                "feature": np.where(inner, tree.feature[kept], -1), "threshold": np.array(limit, float),
            })
        return cls(features, {c: np.concatenate([p[c] for p in parts]) for c in parts[0]})

    @classmethod
    def from_nodes(cls, nodes: DataFrame, features: int) -> ForestModel:
        found = nodes.orderBy("tree", "id").toArrow()
        columns = {c: found.column(c).to_numpy() for c in found.column_names if c != "weights"}
        w = _matrix(found.column("weights").combine_chunks(), found.num_rows)
        return cls(features, columns | {"w0": w[:, 0], "w1": w[:, 1]})

    def nodes(self, spark: SparkSession) -> DataFrame:
        c = self.columns
        pairs = pa.ListArray.from_arrays(
            pa.array(np.arange(len(c["w0"]) + 1) * 2, pa.int32()), pa.array(np.stack([c["w0"], c["w1"]], 1).ravel()))
        return local_arrays(spark, {**c, "weights": pairs}, NODES)

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 (named as Spark's models do)
        """Gains weighted by their node's rows, shares within a tree, summed and scaled to one."""
        c = self.columns
        inner = c["left"] >= 0
        trees = int(c["tree"].max()) + 1
        at = c["tree"][inner].astype(np.int64) * self.features + c["feature"][inner]
        gains = np.bincount(at, (c["gain"] * (c["w0"] + c["w1"]))[inner], trees * self.features).reshape(trees, -1)
        total = gains.sum(axis=1)
        shares = (gains[total > 0] / total[total > 0, None]).sum(axis=0)
        return DenseVector(shares / shares.sum() if shares.sum() > 0 else shares)

    def _compiled(self) -> tuple[list[np.ndarray], list[tuple]]:
        """Cuts in use by feature, and each tree with its thresholds as bins."""
        c = self.columns
        cuts = [np.unique(c["threshold"][(c["feature"] == f) & (c["left"] >= 0)]) for f in range(self.features)]
        ends = np.flatnonzero(np.diff(c["tree"], append=-1)) + 1
        trees = []
        for a, b in zip([0, *ends[:-1]], ends):
            own = {k: v[a:b] for k, v in c.items()}
            inner = own["left"] >= 0
            cut = np.full(b - a, 255, np.uint8)
            for f in np.unique(own["feature"][inner]):
                at = inner & (own["feature"] == f)
                cut[at] = np.searchsorted(cuts[f], own["threshold"][at])
            total = own["w0"] + own["w1"]
            share = np.where(total > 0, own["w1"] / np.where(total > 0, total, 1.0), 0.0)
            child = np.where(inner, own["left"], np.arange(b - a)).astype(np.int64)
            steps, level = 0, np.array([0])
            while (inner[level]).any():
                level = child[level[inner[level]]]
                level, steps = np.concatenate([level, level + 1]), steps + 1
            trees.append((np.where(inner, own["feature"], 0).astype(np.int64), cut, child, share, steps))
        return cuts, trees

    def _broadcast(self, spark: SparkSession) -> Any:
        if not self._shared:
            self._shared.append(spark.sparkContext.broadcast(self._compiled()))
        return self._shared[0]

    def score(self, df: DataFrame, features: Column | Sequence[Column], keep: Sequence[str]) -> DataFrame:
        """``keep`` columns and ``prob``: the mean of the positive shares of the leaves a row reaches."""
        shared = self._broadcast(df.sparkSession)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cuts, trees = shared.value
            for batch in _larger(batches, SCORED):
                bins = _to_bins(_matrix(batch.column(batch.num_columns - 1), batch.num_rows), cuts)
                prob = np.zeros(batch.num_rows)
                for feature, cut, child, share, steps in trees:
                    prob += share.take(_walk(bins, feature, cut, child, steps))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(prob / len(trees))], names=[*batch.schema.names[:-1], "prob"])

        given = df.select(*keep, _vector(features).alias("__x"))
        return given.mapInArrow(run, T.StructType([*given.schema.fields[:-1], T.StructField("prob", T.DoubleType())]))

    def packed(self, df: DataFrame, features: Column | Sequence[Column], keep: Sequence[str]) -> DataFrame:
        """``keep`` columns and ``x``, the features as this forest tells them apart, a byte each."""
        shared = self._broadcast(df.sparkSession)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cuts, _ = shared.value
            for batch in batches:
                if batch.num_rows:
                    bins = _to_bins(_matrix(batch.column(batch.num_columns - 1), batch.num_rows), cuts).T.tobytes()
                    ends = pa.py_buffer(np.arange(0, len(bins) + 1, len(cuts), dtype=np.int32))
                    cells = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, ends, pa.py_buffer(bins)])
                    yield pa.RecordBatch.from_arrays([*batch.columns[:-1], cells], names=[*batch.schema.names[:-1], "x"])

        given = df.select(*keep, _vector(features).alias("__x"))
        return given.mapInArrow(run, T.StructType([*given.schema.fields[:-1], T.StructField("x", T.BinaryType())]))

    def score_swapped(self, df: DataFrame, column: Sequence[int], columns: int, keep: Sequence[str]) -> DataFrame:
        """``keep`` columns, ``column`` and ``prob`` of the row in ``x`` with that column's features from
        ``donor``, a row each; the argument ``column`` says which column each feature comes from."""
        shared, of = self._broadcast(df.sparkSession), np.array(column)

        def swapped(own: np.ndarray, donor: np.ndarray) -> np.ndarray:
            _, trees = shared.value
            return _swapped(own, donor, of, columns, trees) / len(trees)

        read = lambda x: np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(len(x), -1)
        return swap_features(df, read, swapped, columns, keep).select(*keep, "column", F.col("value").alias("prob"))


def swap_features(
    df: DataFrame, read: Callable[[pa.Array], np.ndarray], swapped: Callable[[np.ndarray, np.ndarray], np.ndarray],
    columns: int, keep: Sequence[str],
) -> DataFrame:
    """``keep`` columns, ``column`` and ``value``, a row for each of the columns. ``read`` makes (rows, features) of
    the packed features ``x`` and ``donor``; ``swapped`` (columns, rows) of both, given as (features, rows)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _larger(batches, SWAPPED):
            own, donor = (np.ascontiguousarray(read(batch.column(c)).T) for c in (batch.num_columns - 2, batch.num_columns - 1))
            ends = pa.array(np.arange(batch.num_rows + 1) * columns, pa.int32())
            values = pa.ListArray.from_arrays(ends, pa.array(swapped(own, donor).T.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], values], names=[*batch.schema.names[:-2], "values"])

    given = df.select(*keep, "x", "donor")
    found = given.mapInArrow(run, T.StructType([*given.schema.fields[:-2], T.StructField("values", T.ArrayType(T.DoubleType()))]))
    return found.select(*keep, F.posexplode("values").alias("column", "value"))
