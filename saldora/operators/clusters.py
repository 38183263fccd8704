"""K-means for many starts and many k in the same passes.

The centres of all runs travel together: a pass reads the rows once, a task adds up for every
(run, cluster) what its rows give, and one aggregation sums the tasks' few rows. The number of
passes is that of the slowest run, however many runs there are; a run that stands still drops
out. Starts are drawn by k-means++ from a sample of ``SAMPLE`` rows; all rows take part in
every step and in the final costs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldora.session import spread

# Rows that starts are drawn from.
SAMPLE = 4_096
# Rows a task of a pass has at least and at most.
ROWS_PER_TASK = (5_000, 500_000)
# A run stands still when no centre moves further than this.
STILL = 1e-7


@dataclass
class Run:
    """A fitted start: centres, rows and cost of each cluster, steps taken."""

    centres: np.ndarray
    sizes: np.ndarray
    cost: float
    steps: int


def plus_plus(points: np.ndarray, k: int, draw: np.random.Generator) -> np.ndarray:
    """k-means++ with the best of a few candidates a step."""
    chosen = [points[draw.integers(len(points))]]
    near = ((points - chosen[0]) ** 2).sum(axis=1)
    for _ in range(1, k):
        total = near.sum()
        if total > 0:
            pick = np.searchsorted(np.cumsum(near), draw.random(2 + int(np.log(k))) * total)
        else:
            pick = draw.integers(len(points), size=1)
        tries = points[np.minimum(pick, len(points) - 1)]
        after = np.minimum(near[None, :], ((tries[:, None, :] - points[None, :, :]) ** 2).sum(axis=2))
        best = int(after.sum(axis=1).argmin())
        chosen.append(tries[best])
        near = after[best]
    return np.array(chosen)


def _blocks(points: DataFrame) -> DataFrame:
    """(rows, x): the points of many rows as the bytes of one matrix, column by column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(x)], pa.int32()), pa.array([x.T.tobytes()], pa.binary())], names=["rows", "x"])

    return points.mapInArrow(run, "rows int, x binary")


def _members(x: np.ndarray, centres: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """0/1 of every (cluster, row) and each row's squared distance; the first centre wins a tie.
    ``x`` holds a dimension in each row."""
    far = norms[:, None] - 2.0 * (centres @ x)
    near, own = far[0].copy(), np.zeros(far.shape[1], np.int8)
    for k in range(1, len(far)):
        closer = far[k] < near
        np.copyto(near, far[k], where=closer)
        own[closer] = k
    member = (own == np.arange(len(far), dtype=np.int8)[:, None]).astype(float)
    return member, np.maximum(near + (x**2).sum(axis=0), 0.0)


def _step(blocks: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """Per run: rows and sums of each cluster, and the cost of the assignment."""
    runs = list(centres)
    start = np.cumsum([0, *[len(centres[r]) for r in runs]])
    stacked = np.concatenate([centres[r] for r in runs])
    norms = (stacked**2).sum(axis=1)
    dims = stacked.shape[1]
    shared = blocks.sparkSession.sparkContext.broadcast((stacked, norms, start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stacked, norms, start = shared.value
        total = np.zeros((len(stacked), dims + 2))
        seen = False
        for batch in batches:
            for rows, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                seen = True
                x = np.frombuffer(packed.as_buffer(), np.float64).reshape(dims, rows)
                for a, b in zip(start[:-1], start[1:]):
                    member, near = _members(x, stacked[a:b], norms[a:b])
                    total[a:b, 0] += member.sum(axis=1)
                    total[a:b, 1] += member @ near
                    total[a:b, 2:] += member @ x.T
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), *[pa.array(c, pa.float64()) for c in total.T]],
                names=["place", *[f"s{i}" for i in range(dims + 2)]],
            )

    columns = [f"s{i}" for i in range(dims + 2)]
    sums = blocks.mapInArrow(run, "place int, " + ", ".join(f"{c} double" for c in columns))
    rows = sums.groupBy("place").agg(*[F.sum(c).alias(c) for c in columns]).collect()  # one a cluster
    shared.destroy()
    total = np.zeros((len(stacked), dims + 2))
    for r in rows:
        total[r["place"]] = [r[c] for c in columns]
    return {
        r: (total[a:b, 0], total[a:b, 2:], float(total[a:b, 1].sum())) for r, a, b in zip(runs, start[:-1], start[1:])
    }


def _sample(df: DataFrame, point: Column, rows: int, seed: int, key: str | None) -> np.ndarray:
    """The points of the ``SAMPLE`` rows that come first in a random order. Rows beyond a bound that
    twice as many are expected to meet drop out where they are read, so tasks send few."""
    order = F.xxhash64(F.lit(seed), key) if key else F.rand(seed)
    drawn = df.select(point.alias("x"), order.alias("o"))
    share = 2.0 * SAMPLE / max(rows, 1)
    bound = int(share * 2.0**64) - 2**63 if key else share
    near = drawn.where(F.col("o") < F.lit(bound)) if share < 1 else drawn
    found = near.orderBy("o").limit(SAMPLE).collect()
    if len(found) < min(SAMPLE, rows):
        found = drawn.orderBy("o").limit(SAMPLE).collect()
    return np.array([r["x"] for r in found])


def fit_all(
    df: DataFrame, point: Column, ks: Sequence[int], restarts: int, seed: int, max_iter: int = 300,
    key: str | None = None,
) -> dict[int, list[Run]]:
    """All restarts for every k. ``point`` is an array of doubles; ``df`` should be stored by the
    caller. With a ``key`` the sample of the starts depends on the rows alone."""
    rows = df.count()
    sample = _sample(df, point, rows, seed, key)
    if not len(sample):
        raise ValueError("no rows to cluster")
    names = [(k, i) for k in ks for i in range(restarts)]
    centres = {n: plus_plus(sample, k, np.random.default_rng([seed, k, i])) for n, (k, i) in enumerate(names)}
    blocks = _blocks(spread(df.select(point.alias("x")), rows, *ROWS_PER_TASK)).persist()
    try:
        steps = _move(blocks, centres, max_iter)
        out: dict[int, list[Run]] = {k: [] for k in ks}
        for n, (size, _, cost) in _step(blocks, centres).items():
            out[names[n][0]].append(Run(centres[n], size.astype(int), cost, steps[n]))
    finally:
        blocks.unpersist()
    return out


def _move(blocks: DataFrame, centres: dict[int, np.ndarray], max_iter: int) -> dict[int, int]:
    """Move ``centres`` until each run stands still; the steps each took."""
    steps = dict.fromkeys(centres, 0)
    going = set(centres)
    for _ in range(max_iter):
        if not going:
            break
        found = _step(blocks, {n: centres[n] for n in going})
        for n, (size, sums, _) in found.items():
            # an empty cluster keeps its centre
            new = np.where(size[:, None] > 0, sums / np.maximum(size, 1.0)[:, None], centres[n])
            moved = float(np.sqrt(((new - centres[n]) ** 2).sum(axis=1)).max())
            centres[n], steps[n] = new, steps[n] + 1
            if moved <= STILL:
                going.discard(n)
    return steps


def nearest(point: Column, centres: np.ndarray) -> Column:
    """Place of the nearest centre, the first one on a tie."""
    far = F.transform(
        F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres]),
        lambda c: F.aggregate(F.zip_with(c, point, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v),
    )
    return (F.array_position(far, F.array_min(far)) - 1).cast("int")


def unmoved(df: DataFrame, point: Column, centres: np.ndarray) -> DataFrame:
    """(cluster, rows, moved): assign, recompute the centre, and how far it lies from the given one."""
    dims = range(centres.shape[1])
    again = df.select(nearest(point, centres).alias("cluster"), point.alias("x")).groupBy("cluster").agg(
        F.count(F.lit(1)).alias("rows"), F.array(*[F.avg(F.col("x")[i]) for i in dims]).alias("centre")
    )
    given = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres])[F.col("cluster")]
    gap = F.aggregate(F.zip_with("centre", given, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
    return again.select("cluster", "rows", F.sqrt(gap).alias("moved"))
