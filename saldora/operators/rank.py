"""Global order without a global sort: exact ranks, quantiles, tiles, prefix sums.

A window without PARTITION BY pulls all rows into one task, and one partitioned by
a bucket of values still meets the bucket whose value fills a third of the table.
Three shapes avoid both:

* *selection* (medians, tiles, exact splits, bootstrap ranks): a mergeable sketch
  gives a guaranteed bracket around each wanted rank, everything outside the bracket
  collapses in the map-side combine, and only distinct values inside the bracket are
  shuffled and ordered.  The rows themselves never move; a tile or a split is then a
  narrow comparison against a few cut points.
* *prefix sums* (rank tests, ROC and precision-recall): collapse to distinct values
  first, so ties of any weight are one row, then run sums inside value buckets and add
  bucket offsets.
* *row numbers*: range-partition on (order, unique key), which splits ties, write
  through reliable storage, and add per-partition offsets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saldora.operators.keys import ALL, join_keys, keyed, quote, sql_list
from saldora.session import local_frame, materialise, small

# Resolution of the sketch. The sketch's own error is a twentieth of a grid step, the
# brackets are widened by a whole step on both sides, so a bracket always holds its rank.
GRID = 500
ACCURACY = 20 * GRID
# Groups whose sketches (GRID + 1 values each) the driver may hold: about 8 MB.
EDGE_ROWS = 2_000
# Partitions whose cut points become part of an expression.
MAX_PARTITIONS = 200
_GRID_SQL = "array(" + ", ".join(f"{i / GRID!r}D" for i in range(GRID + 1)) + ")"


def _buckets(spark: SparkSession) -> int:
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


# ---------------------------------------------------------------- selection


def rank_edges(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """(keys, n, lowest, highest, grid): one pass, a sketch per group."""
    v = quote(value)
    return (
        df.filter(f"{v} IS NOT NULL")
        .groupBy(*keys)
        .agg(
            F.expr("count(1) AS n"),
            F.expr(f"min({v}) AS __min"),
            F.expr(f"max({v}) AS __max"),
            F.expr(f"percentile_approx({v}, {_GRID_SQL}, {ACCURACY}) AS __grid"),
        )
    )


def _windows(edges: DataFrame, keys: Sequence[str], slots: str) -> DataFrame:
    """(keys, n, slot, rmin, rmax, lo, hi): a value bracket per wanted span of ranks.

    ``slots`` is an SQL array of struct(slot, rmin, rmax) with ranks counted from 1.
    """
    lo_at = f"cast(floor((rmin - 1) / n * {GRID}) - 1 AS int)"
    hi_at = f"cast(ceil(rmax / n * {GRID}) + 1 AS int)"
    spans = edges.selectExpr(
        *map(quote, keys), "n", "__min", "__max", "__grid", f"inline({slots})"
    )
    return spans.selectExpr(
        *map(quote, keys),
        "n AS __n",
        "slot",
        "rmin",
        "rmax",
        f"CASE WHEN {lo_at} < 1 THEN __min ELSE get(__grid, {lo_at}) END AS lo",
        f"CASE WHEN {hi_at} >= {GRID} THEN __max ELSE get(__grid, {hi_at}) END AS hi",
    )


def _literal(value, kind: str) -> str:
    return f"cast('{value!r}' AS {kind})"


def _with_windows(rows: DataFrame, keys: Sequence[str], windows: DataFrame) -> DataFrame:
    """Each row with the windows of its group.

    Groups meet their windows in a hash join. Without groups there is nothing to join
    on, and the few windows are written into the projection as literals.
    """
    if list(keys) != [ALL]:
        return join_keys(rows, windows, keys)
    fields = [f for f in windows.schema if f.name != ALL]
    structs = [
        "struct(" + ", ".join(
            f"{_literal(w[f.name], f.dataType.simpleString())} AS {f.name}" for f in fields
        ) + ")"
        for w in windows.collect()
    ]
    return rows.selectExpr("*", f"inline(array({', '.join(structs)}))")


def _select(df: DataFrame, value: str, keys: Sequence[str], windows: DataFrame) -> DataFrame:
    """(keys, slot, n, rmin, rmax, value, before, ties) of the values covering the spans."""
    p = _buckets(df.sparkSession)
    v, slot_keys = quote(value), [*keys, "slot"]
    by = sql_list(slot_keys)
    rows = _with_windows(df.filter(f"{v} IS NOT NULL").select(*keys, value), keys, windows)
    # Rows below and above the bracket collapse into one row each, in buckets of their
    # own. Inside, equal steps on the arcsinh scale (monotone, so that a heavy tail does
    # not fill one bucket).
    flat = lambda c: f"signum({c}) * asinh(abs(cast({c} AS double)))"
    step = f"floor(({flat(v)} - {flat('lo')}) / ({flat('hi')} - {flat('lo')}) * {p})"
    collapsed = (
        rows.selectExpr(
            *map(quote, slot_keys),
            "__n",
            "rmin",
            "rmax",
            f"least(greatest({v}, lo), hi) AS __v",
            f"""cast(CASE WHEN {v} < lo THEN -1 WHEN {v} > hi THEN {p}
                WHEN {flat('hi')} > {flat('lo')} THEN least({step}, {p - 1})
                ELSE 0 END AS int) AS __b""",
        )
        .groupBy(*slot_keys, "__n", "rmin", "rmax", "__b", "__v")
        .agg(F.expr("count(1) AS ties"))
    )
    offsets = (
        collapsed.groupBy(*slot_keys, "__b")
        .agg(F.expr("sum(ties) AS __bn"))
        .selectExpr(
            *map(quote, slot_keys),
            "__b",
            f"""coalesce(sum(__bn) OVER (PARTITION BY {by} ORDER BY __b
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS __off""",
        )
    )
    run = collapsed.selectExpr(
        "*", f"sum(ties) OVER (PARTITION BY {by}, __b ORDER BY __v ROWS UNBOUNDED PRECEDING) AS __run"
    )
    return (
        join_keys(run, offsets, [*slot_keys, "__b"], never_null=[ALL, "slot", "__b"])
        .selectExpr(
            *map(quote, slot_keys), "__n AS n", "rmin", "rmax", "__v AS value",
            "__off + __run - ties AS before", "ties",
        )
        .filter("before < rmax AND before + ties >= rmin")
    )


def values_at_ranks(
    df: DataFrame, value: str, keys: Sequence[str], edges: DataFrame, slots: str
) -> DataFrame:
    """(keys, slot, n, rank, value) for every rank in the given spans; n counts the group.

    A span is expanded to its single ranks, so keep spans narrow: two ranks for a
    median, O(sqrt(n)) for the ranks of a bootstrap.
    """
    covered = _select(df, value, keys, small(_windows(edges, keys, slots)))
    ranks = "sequence(greatest(before + 1, rmin), least(before + ties, rmax))"
    return covered.selectExpr(
        *map(quote, keys), "slot", "n", f"explode({ranks}) AS rank", "value"
    )


def group_quantiles(
    df: DataFrame, value: str, keys: Sequence[str] = (), probs: Sequence[float] = (0.5,)
) -> DataFrame:
    """(keys, prob, value): exact quantiles with linear interpolation, NULLs skipped."""
    df, by = keyed(df, keys)
    # several passes follow: the narrow rows are stored once instead of made again each time
    df = materialise(
        df.selectExpr(*map(quote, by), f"cast({quote(value)} AS double) AS {quote(value)}")
    )
    slots = ", ".join(
        f"""struct({i} AS slot, cast(floor({float(p)}D * (n - 1)) + 1 AS bigint) AS rmin,
            cast(ceil({float(p)}D * (n - 1)) + 1 AS bigint) AS rmax)"""
        for i, p in enumerate(probs)
    )
    edges = small(rank_edges(df, value, by), EDGE_ROWS)
    found = values_at_ranks(df, value, by, edges, f"array({slots})")
    ends = found.groupBy(*by, "slot", "n").agg(
        F.expr("min_by(value, rank) AS __lo"), F.expr("max_by(value, rank) AS __hi")
    )
    prob = f"element_at(array({', '.join(f'{float(p)}D' for p in probs)}), slot + 1)"
    position = f"({prob} * (n - 1))"
    return ends.selectExpr(
        *map(quote, keys),
        f"{prob} AS prob",
        f"__lo + (__hi - __lo) * ({position} - floor({position})) AS value",
    )


def group_median(
    df: DataFrame, value: str, keys: Sequence[str] = (), out: str | None = None
) -> DataFrame:
    """(keys, out): exact median per group."""
    return group_quantiles(df, value, keys, (0.5,)).select(
        *keys, F.col("value").alias(out or f"median_{value}")
    )


# ------------------------------------------------------- cut points and tiles


@dataclass(frozen=True)
class Cut:
    """The row at a wanted rank: rows after (value, key) in the order lie beyond it."""

    group: tuple
    slot: int
    value: float
    key: int | None  # None: the cut falls behind the last row holding this value

    def beyond(self, value: Column, key: Column) -> Column:
        if self.key is None:
            return value > F.lit(self.value)
        return (value > F.lit(self.value)) | (
            (value == F.lit(self.value)) & (key > F.lit(self.key))
        )


def cut_points(
    df: DataFrame,
    by: str,
    key: str,
    ranks_of: Callable[[Mapping[tuple, int]], Mapping[tuple, Sequence[int]]],
    partition: Sequence[str] = (),
) -> list[Cut]:
    """Exact (value, key) at chosen ranks of the order ``by, key``, per partition.

    ``ranks_of`` receives the row count of each partition and returns the ranks (from
    1) to cut at. ``key`` must be an integer unique within a partition. Meant for a
    handful of partitions such as target classes; a finely partitioned rank is an
    ordinary window.
    """
    spark = df.sparkSession
    df, keys = keyed(df, partition)
    df = df.select(*keys, F.col(by).alias("__by"), F.col(key).cast("long").alias("__key"))
    edges = small(rank_edges(df, "__by", keys), EDGE_ROWS)
    groups = edges.select(*keys, "n").limit(MAX_PARTITIONS + 1).collect()
    if len(groups) > MAX_PARTITIONS:
        raise ValueError(f"more than {MAX_PARTITIONS} partitions to cut; use a window")
    counts = {tuple(r[k] for k in keys): r["n"] for r in groups}
    wanted = [
        (*g, j, int(r))
        for g, ranks in ranks_of(counts).items()
        for j, r in enumerate(ranks, start=1)
        if 1 <= r < counts[g]
    ]
    if not wanted:
        return []
    key_fields = [df.schema[k] for k in keys]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in key_fields)
    targets = local_frame(spark, wanted, f"{ddl}, asked int, rank long")
    # the targets' slot travels inside the struct
    spans = "array(struct(asked AS slot, rank AS rmin, rank AS rmax))"
    windows = small(_windows(join_keys(edges, targets, keys), keys, spans))
    hits = _select(df, "__by", keys, windows).collect()
    cuts, split = [], []
    for h in hits:
        g = tuple(h[k] for k in keys)
        if h["before"] + h["ties"] == h["rmin"]:
            cuts.append(Cut(g, h["slot"], h["value"], None))
        else:  # the cut falls between tied rows: find the key there
            split.append((*g, h["value"], h["slot"], h["rmin"] - h["before"]))
    if split:
        by_type = df.schema["__by"].dataType.simpleString()
        ties = local_frame(
            spark, split, f"{ddl}, __by {by_type}, __slot int, __within long"
        )
        tied = join_keys(df, F.broadcast(ties), [*keys, "__by"])
        tie_keys = [*keys, "__by", "__slot", "__within"]
        at = "array(struct(1 AS slot, __within AS rmin, __within AS rmax))"
        tie_edges = small(rank_edges(tied, "__key", tie_keys), EDGE_ROWS)
        found = values_at_ranks(tied, "__key", tie_keys, tie_edges, at)
        cuts += [
            Cut(tuple(r[k] for k in keys), r["__slot"], r["__by"], r["value"])
            for r in found.collect()
        ]
    return sorted(cuts, key=lambda c: (str(c.group), c.slot))


def passed_cuts(
    cuts: Sequence[Cut], by: str, key: str, partition: Sequence[str] = ()
) -> Column:
    """Number of cut points a row lies beyond (0 = before the first)."""
    total = F.lit(0)
    for c in cuts:
        hit = c.beyond(F.col(by), F.col(key))
        for name, val in zip(partition, c.group):
            hit = F.col(name).eqNullSafe(F.lit(val)) & hit
        total = total + F.when(hit, 1).otherwise(0)
    return total


def tile_ends(n: int, tiles: int) -> list[int]:
    """Last rank of each tile but the last; the first n mod tiles get one row more."""
    q, r = divmod(n, tiles)
    return [j * q + min(j, r) for j in range(1, tiles)]


def with_ntile(
    df: DataFrame,
    tiles: int,
    by: str,
    key: str,
    out: str = "tile",
    partition: Sequence[str] = (),
) -> DataFrame:
    """``ntile(tiles) OVER (PARTITION BY partition ORDER BY by NULLS LAST, key)``.

    Finds the tile boundaries by selection and labels rows by comparison: rows are
    not sorted and not shuffled (of more than ``MAX_PARTITIONS`` groups this holds for the large
    ones). They are stored once, as selection reads them more than
    once, so hand over the columns that are wanted only.
    """
    order = "__ntile_by"
    numeric = materialise(
        df.withColumn(order, F.coalesce(F.col(by).cast("double"), F.lit(float("inf"))))
    )

    def labelled(rows: DataFrame) -> DataFrame:
        cuts = cut_points(
            rows, order, key, lambda counts: {g: tile_ends(n, tiles) for g, n in counts.items()}, partition
        )
        tile = passed_cuts(cuts, order, key, partition) + F.lit(1)
        return rows.withColumn(out, tile.cast("long")).drop(order)

    sizes = numeric.groupBy(*partition).agg(F.count(F.lit(1)).alias("__n")) if partition else None
    if sizes is None or sizes.limit(MAX_PARTITIONS + 1).count() <= MAX_PARTITIONS:
        return labelled(numeric)
    # many groups: those above an equal share are fewer than MAX_PARTITIONS and keep the way
    # above; each of the others is small beside all rows, and a window orders it
    large = sizes.filter(F.col("__n") > numeric.count() // MAX_PARTITIONS).collect()
    in_large = F.lit(False)
    for r in large:
        own = F.lit(True)
        for name in partition:
            own = own & F.col(name).eqNullSafe(F.lit(r[name]))
        in_large = in_large | own
    window = Window.partitionBy(*partition).orderBy(order, key)
    rest = numeric.filter(~in_large).withColumn(out, F.ntile(tiles).over(window).cast("long")).drop(order)
    return labelled(numeric.filter(in_large)).unionByName(rest) if large else rest


# ------------------------------------------------------------- prefix sums


def value_splits(df: DataFrame, value: str) -> list[float]:
    """Ascending bucket bounds that spread the values evenly."""
    p = _buckets(df.sparkSession)
    return sorted(set(df.approxQuantile(value, [i / p for i in range(1, p)], 1.0 / (4 * p))))


def running_sums(
    df: DataFrame,
    value: str,
    sums: Mapping[str, Column],
    keys: Sequence[str] = (),
    descending: bool = False,
    splits: Sequence[float] | None = None,
) -> DataFrame:
    """Distinct values in order with their sums, the sums before them, and the totals.

    Returns (keys, value, s, before_s, all_s) for each entry of ``sums``. Ties are one
    row after the collapse, so a value of any weight costs nothing; buckets only hold
    distinct values. ``splits`` (see ``value_splits``) spares the pass that finds them;
    they only balance the work and never change the result.
    """
    df, by = keyed(df.filter(F.col(value).isNotNull()), keys)
    if splits is None:
        splits = value_splits(df, value)
    collapsed = df.groupBy(*by, value).agg(*[c.alias(s) for s, c in sums.items()])
    if splits:
        cutter = Bucketizer(
            splits=[-math.inf, *splits, math.inf], inputCol=value, outputCol="__b"
        )
        # Never null, and said so: a filter that the join would infer keeps the branches from sharing the collapse.
        collapsed = cutter.transform(collapsed).withColumn("__b", F.coalesce(F.col("__b").cast("int"), F.lit(0)))
    else:
        collapsed = collapsed.withColumn("__b", F.lit(0))

    way = "DESC" if descending else "ASC"
    v, group = quote(value), sql_list(by)
    per_bucket = collapsed.groupBy(*by, "__b").agg(
        *[F.expr(f"sum({s}) AS __t_{s}") for s in sums]
    )
    ahead = f"(PARTITION BY {group} ORDER BY __b {way} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = per_bucket.selectExpr(
        *map(quote, by),
        "__b",
        *[f"coalesce(sum(__t_{s}) OVER {ahead}, 0) AS __o_{s}" for s in sums],
        *[f"sum(__t_{s}) OVER (PARTITION BY {group}) AS all_{s}" for s in sums],
    )
    if not keys:
        offsets = F.broadcast(offsets)  # at most one row per bucket
    inside = f"(PARTITION BY {group}, __b ORDER BY {v} {way} ROWS UNBOUNDED PRECEDING)"
    running = collapsed.selectExpr("*", *[f"sum({s}) OVER {inside} AS __r_{s}" for s in sums])
    return join_keys(running, offsets, [*by, "__b"], never_null=[ALL, "__b"]).selectExpr(
        *map(quote, keys),
        v,
        *sums,
        *[f"__o_{s} + __r_{s} - {s} AS before_{s}" for s in sums],
        *[f"all_{s}" for s in sums],
    )


# -------------------------------------------------------------- row numbers


def _number(df: DataFrame, out: str) -> DataFrame:
    """1..n in partition order; the written copy fixes what each partition holds."""
    written = materialise(df.withColumn("__mid", F.monotonically_increasing_id()))
    numbered = written.withColumn("__pid", F.shiftright("__mid", 33))
    counts = numbered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition: few enough to order in one task.
    offsets = counts.select(
        "__pid",
        F.coalesce(
            F.sum("__n").over(
                Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("__off"),
    )
    index = F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        numbered.join(small(offsets), "__pid")
        .withColumn(out, (F.col("__off") + index + 1).cast("long"))
        .drop("__mid", "__pid", "__off")
    )


def with_rank(
    df: DataFrame, by: Sequence[str | Column], key: str | None = None, out: str = "rank"
) -> DataFrame:
    """Row number over a declared order; ``key`` (unique) breaks ties and splits them.

    Needs ``spark.checkpoint.dir``: the sorted rows are written once.
    """
    cols = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in by]
    if key is not None:
        cols.append(F.col(key).asc_nulls_last())
    return _number(df.repartitionByRange(*cols).sortWithinPartitions(*cols), out)


def with_row_number(df: DataFrame, out: str = "row_number") -> DataFrame:
    """Surrogate 1..n in scan order: no sort and no row shuffle, copies cost nothing."""
    return _number(df, out)
