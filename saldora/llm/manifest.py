"""Merkle manifest of a dataset, level by level in concatenated strings.

Every row is a leaf, the digest of its columns. The leaves of a group stand in order; ``FAN``
consecutive nodes become their parent, the digest of their hex digests, until one is left. A
block is ``FAN ** STEPS`` aligned nodes of a group; it holds a level as one string of hex
digests, in which the node at place i is the fixed-width substring at i * 64. Parents are the
digests of substrings of ``FAN`` nodes; a node's siblings are the two substrings that flank it
in its run. The roots of the blocks are the leaves of the next round, with blocks of their own,
until every group has one root; the group roots are one more group, whose root is the manifest's.

The siblings of a leaf are put together on the way down: a block keeps those of its root from
the round above, and its leaves add those inside the block. They are never stored by leaf.

Cases: a null column is ``-``. Null groups come first, then by the bytes of the name; null ids
come first in a group. Rows of equal id are ordered by their leaves, repeated rows are leaves of
their own with equal digests. A group of one leaf has that leaf as its root; so has a dataset
of one group the group's. An empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from saldora.session import materialise, small

FAN = 8
STEPS = 3
WIDTH = 64  # hex digits of a digest
_BLOCK = FAN**STEPS


# ------------------------------------------------------------------ expressions


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the byte count, a colon and the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(columns: Sequence[Column]) -> Column:
    return digest(*[field(c) for c in columns])


def _part(level: Column, first: Column, nodes: Column) -> Column:
    """``nodes`` nodes of a level from place ``first`` on; levels are the bytes of hex strings, in
    which a substring is found without reading what lies before it."""
    return F.substring(level, first * WIDTH + 1, nodes * WIDTH)


def _parents(level: Column) -> Column:
    """The level above: one digest for every ``FAN`` nodes, the last for fewer."""
    runs = F.ceil(F.octet_length(level) / F.lit(WIDTH * FAN)).cast("int")
    hashes = F.transform(
        F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(_part(level, i * FAN, F.lit(FAN)), 256)
    )
    return F.array_join(hashes, "").cast("binary")


def _flanks(level: Column, place: Column) -> Column:
    """before, after: the siblings of the node at ``place``, as concatenated digests."""
    first = F.floor(place / FAN).cast("int") * FAN
    return F.struct(
        _part(level, first, place - first).alias("before"),
        _part(level, place + 1, first + FAN - 1 - place).alias("after"),
    )


def levels_above(nodes: str) -> Column:
    """How many times ``FAN`` nodes become one until one is left."""
    powers = F.array(*[F.lit(FAN**k) for k in range(21)])
    return F.size(F.filter(powers, lambda p: p < F.col(nodes)))


def fold(node: Column, flanks: Column) -> Column:
    """The root that a node gives with its siblings, level by level."""
    return F.aggregate(
        flanks, node,
        lambda below, x: F.sha2(F.concat(x["before"], below.cast("binary"), x["after"]), 256),
    )


def proof(flanks: Column) -> Column:
    """All siblings of a path as one string of digests, left to right, level by level."""
    return F.aggregate(
        flanks, F.lit("").cast("binary"), lambda have, x: F.concat(have, x["before"], x["after"])
    ).cast("string")


# ------------------------------------------------------------------ rounds


def _round(nodes: DataFrame, done: int, extra: Sequence[str]) -> DataFrame:
    """grp, block, total, rows, steps, level0.., root from grp, place, total, node and ``extra``;
    ``done`` levels have been hashed before."""
    inside = F.struct((F.col("place") % _BLOCK).cast("int").alias("place"), "node", *extra)
    blocks = (
        nodes.groupBy("grp", F.floor(F.col("place") / _BLOCK).alias("block"))
        .agg(F.first("total").alias("total"), F.array_sort(F.collect_list(inside)).alias("rows"))
    )
    level = F.array_join(F.transform("rows", lambda r: r["node"]), "").cast("binary")
    steps = F.least(F.greatest(levels_above("total") - done, F.lit(0)), F.lit(STEPS))
    blocks = blocks.select("grp", "block", "total", "rows", steps.alias("steps"), level.alias("level0"))
    for k in range(1, STEPS + 1):
        blocks = blocks.withColumn(f"level{k}", F.when(F.col("steps") >= k, _parents(F.col(f"level{k - 1}"))))
    root = F.coalesce(*[F.col(f"level{k}") for k in range(STEPS, -1, -1)]).cast("string")
    return materialise(blocks.withColumn("root", root).drop(f"level{STEPS}"))


def grow(nodes: DataFrame, extra: Sequence[str] = ()) -> list[DataFrame]:
    """Rounds of blocks from the leaves up; in the last one every group is one block.

    ``nodes``: grp, place (from 0), total (nodes of the group), node and ``extra`` columns. The
    number of rounds is that of the largest group's levels over STEPS.
    """
    rounds: list[DataFrame] = []
    while True:
        blocks = _round(nodes, STEPS * len(rounds), [] if rounds else extra)
        rounds.append(blocks)
        if not blocks.agg(F.max("block")).first()[0]:
            return rounds
        nodes = blocks.select("grp", F.col("block").alias("place"), "total", F.col("root").alias("node"))


def walk(rounds: list[DataFrame], above: DataFrame, result: Callable[[Column, Column, Column], Column]) -> DataFrame:
    """``result(leaf's row, siblings up to the root, carried)`` of all leaves, as its fields.

    ``above``: grp, flanks of the group's root in what lies above, and ``carried``.
    """
    above = above.withColumn("place", F.lit(0).cast("long"))
    for blocks_of in reversed(rounds):
        upper = above.select(
            F.col("grp").alias("upper_grp"), F.col("place").alias("upper_place"), F.col("flanks").alias("upper"), "carried"
        )
        # both sides have one row a block: no key is common
        blocks = blocks_of.join(
            upper, F.col("grp").eqNullSafe(F.col("upper_grp")) & (F.col("block") == F.col("upper_place"))
        )

        def flanks(row: Column) -> Column:
            inside = [
                _flanks(F.col(f"level{k}"), F.floor(row["place"] / FAN**k).cast("int")) for k in range(STEPS)
            ]
            return F.concat(F.slice(F.array(*inside), 1, F.col("steps")), F.col("upper"))

        paths = F.transform("rows", lambda r: F.struct(r.alias("row"), flanks(r).alias("flanks")))
        if blocks_of is rounds[0]:
            found = F.transform(paths, lambda p: result(p["row"], p["flanks"], F.col("carried")))
            return blocks.select(F.inline(found))
        place = lambda p: F.col("block") * _BLOCK + p["row"]["place"]
        found = F.transform(paths, lambda p: F.struct(place(p).alias("place"), p["flanks"].alias("flanks")))
        above = blocks.select("grp", "carried", F.inline(found))
    raise ValueError("no rounds")


# ------------------------------------------------------------------ placing


def placed(leaves: DataFrame, grp: str, *order: str) -> DataFrame:
    """grp, place and total of each row in its group, without a group in one task.

    Rows are range-partitioned by group and order; a group's place in a partition follows from
    how many of its rows the partitions before hold.
    """
    keys = [F.col(c).asc_nulls_first() for c in (grp, *order)]
    # stored with a last key of its own, so that equal rows can be split between tasks
    stored = materialise(leaves.withColumn("__tie", F.monotonically_increasing_id()))
    keys.append(F.col("__tie").asc())
    ranged = materialise(
        stored.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("__mid", F.monotonically_increasing_id())
    ).drop("__tie")
    ranged = ranged.withColumn("__pid", F.shiftright("__mid", 33))
    parts = ranged.groupBy("__pid", F.col(grp).alias("__grp")).agg(
        F.min("__mid").alias("__first"), F.count(F.lit(1)).alias("__n")
    )
    in_group = Window.partitionBy("__grp")  # one row per partition and group
    before = in_group.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("__pid").alias("__p"), "__grp", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        F.sum("__n").over(in_group).alias("total"),
    )
    joined = ranged.join(
        small(materialise(parts)), (F.col("__pid") == F.col("__p")) & F.col(grp).eqNullSafe(F.col("__grp"))
    )
    place = F.col("__mid") - F.col("__first") + F.col("__before")
    return joined.withColumn("place", place).drop("__mid", "__pid", "__p", "__grp", "__first", "__before")


# ------------------------------------------------------------------ operator


def manifest(
    rows: DataFrame, columns: Sequence[str], key: str = "doc_id", group: str = "lang",
    tampered: dict[str, Column] | None = None,
) -> DataFrame:
    """key, leaf, subroot, root, proof (its siblings' digests), folded_root, verified of every row.

    ``tampered`` replaces columns of the rows that are checked: their leaf is recomputed and
    folded with the untampered siblings.
    """
    changed = tampered or {}
    leaves = rows.select(
        F.col(group).cast("string").alias("grp"), F.col(key).alias("id"),
        leaf([F.col(c) for c in columns]).alias("node"),
        leaf([changed.get(c, F.col(c)) for c in columns]).alias("checked"),
    )
    rounds = grow(placed(leaves, "grp", "id", "node"), ["id", "checked"])
    # the groups' roots are the one group of the tree above
    subroots = rounds[-1].select(F.lit(0).alias("grp"), F.col("grp").alias("name"), F.col("root").alias("node"))
    top = grow(placed(subroots, "grp", "name"), ["name"])
    root = top[-1].select("root").scalar()
    nothing = F.array().cast("array<struct<before: binary, after: binary>>")
    above = walk(
        top, top[-1].select("grp", nothing.alias("flanks"), F.lit(None).cast("string").alias("carried")),
        lambda row, flanks, _: F.struct(
            row["name"].alias("grp"), flanks.alias("flanks"), row["node"].alias("carried")
        ),
    )
    found = walk(
        rounds, above,
        lambda row, flanks, subroot: F.struct(
            row["id"].alias(key), row["node"].alias("leaf"), subroot.alias("subroot"),
            proof(flanks).alias("proof"), fold(row["checked"], flanks).alias("folded_root"),
        ),
    )
    return found.withColumn("root", root).withColumn("verified", F.col("folded_root") == F.col("root"))
