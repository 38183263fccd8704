"""Exact inner-product search by a three-phase uniform threshold.

The components of the vectors are split into ``lists`` slices of equal width; the scores that
one slice gives are a local score list, and a vector's score is the sum over the lists.

1. Every list hands in its best entries of each block of vectors. Their full scores give a
   safe cutoff for each query: its wanted number of vectors reach it.
2. The cutoffs go back to the lists with the queries. A vector that reaches the cutoff has
   one list at least in which it reaches the cutoff divided by the number of lists, so the
   lists hand in all entries from there on: nothing that matters can be missing.
3. What an entry lacks is asked of the other lists; the sums are exact and are ranked.

Vectors and queries meet in blocks of bounded size, one block pair and list at a time; no row
holds a single pair before the ranking. Equal vectors have equal scores, so they are one class
with its smallest ids, as many as can be ranked; that is exact and keeps a very common vector
small.

Cases: a vector that is null or holds a null or non-finite component takes no part. Vectors of
unequal length are compared as if zeros followed. A null id is no query; as a candidate it
follows all others among ties. Repeated rows are queries and candidates of their own. Fewer
candidates than ``k`` give fewer rows, an empty table none. Components are held within 2 ** 62
and the scores of a list within 2 ** 60; below that all results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from saldora.session import materialise

SCALE = 256
_MOST_COMPONENT = 1 << 62
_MOST_SCORE = 1 << 60


@dataclass(frozen=True)
class Blocks:
    """Lists and block sizes; they bound a task's memory and never change a result."""

    lists: int = 2
    rows: int = 8192
    queries: int = 1024
    step: int = 256  # queries scored at once inside a task


# ------------------------------------------------------------------ tables


def integers(vectors: DataFrame, vec_id: str, embedding: str, scale: int = SCALE) -> DataFrame:
    """id, vec: the floored multiples of all usable vectors."""
    whole = F.transform(
        F.col(embedding),
        lambda x: F.greatest(
            F.least(F.floor(x.cast("double") * scale), F.lit(_MOST_COMPONENT)), F.lit(-_MOST_COMPONENT)
        ),
    )
    usable = F.forall(
        F.col(embedding),
        lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)),
    )
    return vectors.where(F.col(embedding).isNotNull() & usable).select(
        F.col(vec_id).cast("long").alias("id"), whole.alias("vec")
    )


def _padded(width: int) -> Column:
    return F.concat("vec", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("vec"))).alias("vec")


def _placed(df: DataFrame, block: str, per_block: int, *order: Column) -> tuple[DataFrame, int]:
    """``df`` with an even block number and a place in the block, and the number of blocks."""
    df = materialise(df)
    blocks = max(1, -(-df.count() // per_block))
    key = F.pmod(F.xxhash64(*df.columns), F.lit(blocks)).cast("int")
    place = F.row_number().over(Window.partitionBy(block).orderBy(*order)) - 1
    return materialise(df.withColumn(block, key).withColumn("at", place)), blocks


def _slices(placed: DataFrame, block: str, width: int, lists: int, kind: str, out: str) -> DataFrame:
    """list, block and the block's slices of that list, one after the other in order of place."""
    cells = F.array_sort(F.collect_list(F.struct("at", "vec")))

    def cut(j: int) -> Column:
        return F.flatten(F.transform("cells", lambda c: F.slice(c["vec"], j * width + 1, width)))

    parts = [
        F.struct(F.lit(j).alias("list"), cut(j).cast(f"array<{kind}>").alias(out)) for j in range(lists)
    ]
    return placed.groupBy(block).agg(cells.alias("cells")).select(block, F.inline(F.array(*parts)))


# ------------------------------------------------------------------ inside a task


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of all queries with all rows, as far as they are held."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    if most < 2.0**53:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    if most < _MOST_SCORE:
        return queries @ rows.T
    wide = queries.astype(object) @ rows.astype(object).T
    return np.clip(wide, -_MOST_SCORE, _MOST_SCORE).astype(np.int64)


def _pair_scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner product of query i with row i."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    if most < _MOST_SCORE:
        return np.einsum("ij,ij->i", queries, rows)
    wide = (queries.astype(object) * rows.astype(object)).sum(axis=1)
    return np.clip(wide, -_MOST_SCORE, _MOST_SCORE).astype(np.int64)


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's ``k`` best entries, the leftmost ones among ties."""
    n = scores.shape[1]
    if n <= k:
        row, column = np.indices(scores.shape)
        return row.ravel(), column.ravel()
    kth = np.partition(scores, n - k, axis=1)[:, n - k : n - k + 1]
    row, column = np.nonzero(scores >= kth)
    above = scores[row, column] > kth[row, 0]
    order = np.lexsort((column, ~above, row))
    row, column = row[order], column[order]
    first = np.searchsorted(row, np.arange(scores.shape[0]))
    keep = np.arange(len(row)) - first[row] < k
    return row[keep], column[keep]


def _ints(cell: pa.Scalar) -> np.ndarray:
    return cell.values.to_numpy(zero_copy_only=False)


def _matrix(cell: pa.Scalar, width: int) -> np.ndarray:
    return _ints(cell).astype(np.int64).reshape(-1, width)


ENTRIES = "qb int, rb int, list int, q array<int>, c array<int>, s array<long>"


def _row(piece: dict, q: np.ndarray, c: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([piece["qb"]], pa.int32()), pa.array([piece["rb"]], pa.int32()),
            pa.array([piece["list"]], pa.int32()),
            pa.array([q.astype(np.int32)], pa.list_(pa.int32())),
            pa.array([c.astype(np.int32)], pa.list_(pa.int32())),
            pa.array([s.astype(np.int64)], pa.list_(pa.int64())),
        ],
        names=["qb", "rb", "list", "q", "c", "s"],
    )


def _pieces(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: batch.column(n)[i] for n in batch.schema.names}


def _numbers(piece: dict) -> dict:
    return {n: piece[n].as_py() for n in ("qb", "rb", "list")}


def _gather(width: int, k: int, step: int):
    """Arrow task: the best ``k`` entries of each query in this block of this list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches):
            queries, rows = _matrix(piece["y"], width), _matrix(piece["x"], width)
            found = []
            for at in range(0, len(queries), step):
                scores = _scores(queries[at : at + step], rows)
                q, c = _best(scores, k)
                found.append((q + at, c, scores[q, c]))
            yield _row(_numbers(piece), *map(np.concatenate, zip(*found)))

    return run


def _from_cutoff(width: int, lists: int, step: int):
    """Arrow task: all entries of this block and list that reach their share of the cutoff."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches):
            queries, rows = _matrix(piece["y"], width), _matrix(piece["x"], width)
            cutoff = np.full(len(queries), -lists * _MOST_SCORE, dtype=np.int64)
            if piece["cut"].is_valid:
                at, value = _ints(piece["cut"]["at"]), _ints(piece["cut"]["value"])
                cutoff[at] = value
            share = -(-cutoff // lists)  # rounded up: an entry is a whole number
            found = []
            for at in range(0, len(queries), step):
                scores = _scores(queries[at : at + step], rows)
                q, c = np.nonzero(scores >= share[at : at + step, None])
                found.append((q + at, c, scores[q, c]))
            yield _row(_numbers(piece), *map(np.concatenate, zip(*found)))

    return run


def _resolve(width: int, step: int = 1 << 16):
    """Arrow task: this list's score of every pair that any list has handed in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches):
            queries, rows = _matrix(piece["y"], width), _matrix(piece["x"], width)
            pairs, own, own_scores = [], np.zeros(0, np.int64), np.zeros(0, np.int64)
            for entry in piece["entries"]:
                pair = _ints(entry["q"]).astype(np.int64) * len(rows) + _ints(entry["c"])
                pairs.append(pair)
                if entry["list"].as_py() == piece["list"].as_py():
                    order = np.argsort(pair)
                    own, own_scores = pair[order], _ints(entry["s"])[order]
            wanted = np.unique(np.concatenate(pairs))
            at = np.searchsorted(own, wanted)
            known = np.zeros(len(wanted), dtype=bool)
            inside = at < len(own)
            known[inside] = own[at[inside]] == wanted[inside]
            scores = np.zeros(len(wanted), dtype=np.int64)
            scores[known] = own_scores[at[known]]
            missing = np.flatnonzero(~known)
            for k in range(0, len(missing), step):
                part = missing[k : k + step]
                scores[part] = _pair_scores(queries[wanted[part] // len(rows)], rows[wanted[part] % len(rows)])
            yield _row(_numbers(piece), wanted // len(rows), wanted % len(rows), scores)

    return run


ASKED = "qb int, at int, id long, copies long, own long"


def _with_own_score(width: int):
    """Arrow task: the score that each query's own row has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = batch.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            own = sum(
                _pair_scores(vec[:, j : j + width], vec[:, j : j + width]) for j in range(0, vec.shape[1], width)
            )
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("qb", "at", "id", "copies")), pa.array(own, pa.int64())],
                names=["qb", "at", "id", "copies", "own"],
            )

    return run


# ------------------------------------------------------------------ the search


def _totals(pieces: DataFrame, entries: DataFrame, width: int, k: int) -> DataFrame:
    """qb, rb, at, c, score: of every query the ``k`` best of the handed-in vectors of a block,
    with exact scores."""
    handed = entries.groupBy("qb", "rb").agg(F.collect_list(F.struct("list", "q", "c", "s")).alias("entries"))
    sums = (
        pieces.join(handed, ["qb", "rb"])
        .mapInArrow(_resolve(width), ENTRIES)
        .groupBy("qb", "rb")
        .agg(F.collect_list(F.struct("q", "c", "s")).alias("e"))
    )

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches):
            lists = piece["e"]
            q, c = _ints(lists[0]["q"]), _ints(lists[0]["c"])  # the same pairs in every list
            total = sum(_ints(x["s"]) for x in lists)
            order = np.lexsort((c, -total, q))
            q, c, total = q[order], c[order], total[order]
            keep = np.arange(len(q)) - np.searchsorted(q, q) < k
            n = int(keep.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([piece["qb"].as_py()] * n, pa.int32()), pa.array([piece["rb"].as_py()] * n, pa.int32()),
                    pa.array(q[keep], pa.int32()), pa.array(c[keep], pa.int32()), pa.array(total[keep], pa.int64()),
                ],
                names=["qb", "rb", "at", "c", "score"],
            )

    return sums.mapInArrow(best, "qb int, rb int, at int, c int, score long")


def search(
    vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id",
    embedding: str = "embedding", scale: int = SCALE, blocks: Blocks = Blocks(),
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of all other rows for each query row.

    ``is_query`` is a condition on the column ``id``, the row's id as a long.
    """
    most = k + 1  # the query's own row may be among them
    rows = materialise(integers(vectors, vec_id, embedding, scale))
    shape = rows.agg(
        F.max(F.size("vec")).alias("width"),
        F.max(F.array_max(F.transform("vec", F.abs))).alias("most"),
    ).first()
    width = max(1, -(-(shape["width"] or 0) // blocks.lists))
    kind = "int" if (shape["most"] or 0) < 1 << 31 else "long"
    full = rows.select("id", _padded(width * blocks.lists))

    # classes of equal vectors, with their smallest ids; the limit is applied before the exchange
    nth = F.row_number().over(Window.partitionBy("vec").orderBy(F.col("id").asc_nulls_last()))
    classes = (
        full.withColumn("nth", nth).where(F.col("nth") <= most)
        .groupBy("vec").agg(F.array_sort(F.collect_list(F.struct("nth", "id"))).alias("ids"))
        .select("vec", F.transform("ids", lambda x: x["id"]).alias("ids"))
    )
    classes, n_rows = _placed(classes, "rb", blocks.rows, F.col("ids")[0].asc_nulls_last(), F.col("vec"))
    asked = full.where(F.coalesce(is_query, F.lit(False)) & F.col("id").isNotNull())
    asked = asked.groupBy("id", "vec").agg(F.count(F.lit(1)).alias("copies"))
    asked, n_queries = _placed(asked, "qb", blocks.queries, F.col("id"), F.col("vec"))

    lists = materialise(_slices(classes, "rb", width, blocks.lists, kind, "x"))
    queries = materialise(_slices(asked, "qb", width, blocks.lists, kind, "y"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    spread = lists.select("*", every(n_queries).alias("qb"))

    def pieces(asking: DataFrame) -> DataFrame:
        """One row for each block of vectors, block of queries and list."""
        return spread.join(asking.select("*", every(n_rows).alias("rb")), ["list", "qb", "rb"])

    gathered = materialise(pieces(queries).mapInArrow(_gather(width, most, blocks.step), ENTRIES))
    first = _totals(pieces(queries), gathered, width, most)
    rank = F.row_number().over(Window.partitionBy("qb", "at").orderBy(F.desc("score")))
    cutoffs = first.withColumn("nth", rank).where(F.col("nth") == most)
    cutoffs = cutoffs.groupBy("qb").agg(F.collect_list(F.struct("at", F.col("score").alias("value"))).alias("cut"))
    cutoffs = cutoffs.select(
        "qb", F.struct(F.col("cut.at").alias("at"), F.col("cut.value").alias("value")).alias("cut")
    )
    with_cutoffs = queries.join(cutoffs, "qb", "left")
    entries = materialise(
        pieces(with_cutoffs).mapInArrow(_from_cutoff(width, blocks.lists, blocks.step), ENTRIES)
    )
    totals = _totals(pieces(queries), entries, width, most)

    best = totals.join(classes.select("rb", F.col("at").alias("c"), "ids"), ["rb", "c"])
    best = best.select("qb", "at", "score", F.explode("ids").alias("found"))
    order = Window.partitionBy("qb", "at").orderBy(F.desc("score"), F.col("found").asc_nulls_last())
    best = best.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most)
    best = best.groupBy("qb", "at").agg(F.array_sort(F.collect_list(F.struct("nth", "found", "score"))).alias("best"))
    result = asked.mapInArrow(_with_own_score(width), ASKED).join(best, ["qb", "at"])
    own = F.array_position(
        F.transform("best", lambda b: F.struct(b["found"].alias("id"), b["score"].alias("own"))),
        F.struct("id", "own"),
    )
    others = F.filter("best", lambda b, i: i + 1 != own)
    return (
        result.select("id", F.slice(others, 1, k).alias("best"), F.sequence(F.lit(1).cast("long"), "copies").alias("copy"))
        .select("id", "best", F.explode("copy"))
        .select("id", F.posexplode("best").alias("place", "b"))
        .select(
            F.col("id").alias("query_id"), (F.col("place") + 1).cast("int").alias("rank"),
            F.col("b.found").alias("vec_id"), F.col("b.score").alias("score"),
        )
    )
