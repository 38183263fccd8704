"""Connected components of a link table, without a hot group and off the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldora.session import materialise

# Links that one task takes at most; more go through stars.
TASK_LINKS = 1 << 18


def least_reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the links (a, b), ascending, and the least node that each reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[left], root[right]
        apart = x != y
        if not apart.any():
            return nodes, nodes[root]
        left, right, x, y = left[apart], right[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    links = [(x["a"].to_numpy(), x["b"].to_numpy()) for x in batches if x.num_rows]
    if links:
        found = least_reached(*map(np.concatenate, zip(*links)))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["node", "comp"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point the neighbours of every node at its least one; minima are pre-aggregated."""
    both = edges if not large else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # here a is the centre; in a small star b < a holds already
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    joined = both.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            least.select("a", F.col("low").alias("b"))
        )
    return out.where("a != b").distinct()


def connected(edges: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """(node, comp) for the nodes of ``edges`` (a, b): comp is the least node it reaches.

    ``edges`` are read twice and should be stored. Up to ``task_links`` links are solved by one
    task. More go through alternating large and small stars; every round is written to the
    shared folder, and the rounds end when the links no longer change. Nodes without links do
    not appear.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
    if links.count() <= task_links:
        return links.coalesce(1).mapInArrow(_solve, "node long, comp long")
    current = materialise(links.distinct())
    seen = None
    while True:
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
        current = materialise(_star(_star(current, True), False))
    ends = current.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return ends.unionByName(ends.select(F.col("comp").alias("node"), "comp").distinct())
