"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

A source's share of the mix is its weight's, but never more than ``passes`` times its size;
what a source cannot give is shared out among the others by weight until none is above.
The shares become block quotas. A binary tree over the output shards splits the vector of
quotas: each node draws, without replacement, how many blocks of every source go left, so
each shard gets exactly its capacity and every source exactly its quota.

Within a source, documents are put in the order of a hash of id and text; their words form one
line, which is cut into blocks. A quota of several times the line takes the whole line as often
as it fits; of the last pass it takes blocks in a permuted order of all the line's blocks
(swap-or-not rounds, a bijection computed from the number alone) until the quota is full. The
shards take as many of the blocks, in that order, as the tree has dealt them, so blocks are
disjoint. Positions on the line are sums inside hash ranges plus the sums of earlier ranges: a
source with a third of all rows is spread over as many tasks as any other rows. Inside a shard
pieces are ordered by another hash, their ``place``; a shard's rows lie in several tasks, by
ranges of places.

Cases: a null text has size 0; sources are ordered by code point, a null source last and a
source of its own. Sources without words take nothing. Repeated rows are separate documents
on the line; which of two equal rows comes first does not matter, and rows that share an id, or
have none, are told apart by their texts. Empty tables give empty
results. More than ``MAX_SOURCES`` sources raise an error: quotas are made on the driver.
Only DataFrame operations touch rows.
"""

from __future__ import annotations

import itertools
import json
import math
import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from saldora.session import materialise

WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2
SHARDS = 64
BLOCK_WORDS = 1_024
ROUNDS = 32
SLICES = 4  # bits of the place that deal a shard's rows to tasks
MAX_SOURCES = 50_000
SEED = 17
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(_WORD)), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, passes: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``passes`` times its size.

    Sources reach their bounds in the order of size to weight: one sweep finds those that do.
    """
    out = [0.0] * len(sizes)
    order = sorted((i for i, s in enumerate(sizes) if s > 0), key=lambda i: sizes[i] / weights[i])
    spare, weight = float(total), float(sum(weights[i] for i in order))
    for k, i in enumerate(order):
        if spare / weight * weights[i] <= passes * sizes[i]:
            for j in order[k:]:
                out[j] = spare / weight * weights[j]
            break
        out[i] = float(passes * sizes[i])
        spare, weight = spare - out[i], weight - weights[i]
    return out


def hypergeometric(draw: random.Random, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement are good.

    Rejection under the hat that every log-concave distribution has around its mode: a handful of
    tries whatever the numbers, each accepted by the distribution's own probabilities.
    """
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (n + 1) * (good + 1) // (total + 2)))

    def log_ways(k: int) -> float:
        return -sum(map(math.lgamma, (k + 1, good - k + 1, n - k + 1, bad - n + k + 1)))

    at_mode = log_ways(mode)
    all_ways = math.lgamma(total + 1) - sum(map(math.lgamma, (good + 1, bad + 1, n + 1, total - n + 1)))
    peak = min(1.0, math.exp(at_mode - all_ways))
    flat = 1 + peak / 2
    while True:
        if draw.random() * (1 + flat) <= flat:
            away, accept = draw.random() * flat / peak, 1.0
        else:
            extra = draw.expovariate(1.0)
            away, accept = (flat + extra) / peak, math.exp(-extra)
        k = mode + (1 if draw.random() < 0.5 else -1) * math.floor(away + 0.5)
        if low <= k <= high and draw.random() * accept <= math.exp(log_ways(k) - at_mode):
            return k


def split_quotas(quotas: Sequence[int], shards: int, seed: int = SEED) -> list[list[int]]:
    """Blocks of every source for each shard: rows are shards, sums are exact both ways."""
    total = sum(quotas)
    capacity = [total // shards + (k < total % shards) for k in range(shards)]
    out: list[list[int]] = [[] for _ in range(shards)]
    stack = [(0, shards, list(quotas))]
    while stack:
        lo, hi, own = stack.pop()
        if hi - lo == 1:
            out[lo] = own
            continue
        mid = (lo + hi) // 2
        draw = random.Random(f"{seed}:{lo}:{hi}")
        wanted, rest, left = sum(capacity[lo:mid]), sum(own), []
        for q in own:
            x = hypergeometric(draw, q, rest - q, wanted)
            left.append(x)
            wanted, rest = wanted - x, rest - q
        stack += [(lo, mid, left), (mid, hi, [q - x for q, x in zip(own, left)])]
    return out


def permuted(block: str, blocks: str, seed: int = SEED) -> str:
    """SQL for the place of number ``block`` in a random order of 0 to ``blocks`` - 1."""
    draw = random.Random(f"{seed}:blocks")
    keys = ", ".join(f"{draw.getrandbits(62)}L" for _ in range(ROUNDS))
    other = f"pmod(k - x, {blocks})"
    return (
        f"aggregate(array({keys}), {block}, (x, k) -> "
        f"if(xxhash64(k, greatest(x, {other})) & 1L = 1L, {other}, x))"
    )


def _plan_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """A few driver-made rows as a relation, by way of a JSON literal."""
    kind = (
        "array<struct<source:string,source_size:bigint,target:double,full:bigint,rest:bigint,"
        "blocks:bigint,short:bigint,short_at:bigint,ends:array<bigint>>>"
    )
    frame = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), kind)))
    return frame


def source_plan(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
    passes: int = PASSES, shards: int = SHARDS, seed: int = SEED,
) -> DataFrame:
    """One row per source: source_size, target, how often its whole line is taken (full) and how
    many words of the last pass (rest), the line's blocks, the words of its last block and that
    one's place in the permuted order, and for each shard the end of its share of the blocks."""
    spark = sizes.sparkSession
    found = (
        sizes.groupBy("source").agg(F.sum("size").alias("size"))
        .withColumn("blocks", F.ceil(F.col("size") / F.lit(BLOCK_WORDS)))
        .withColumn("short_at", F.when(F.col("blocks") > 0, F.expr(permuted("(blocks - 1)", "blocks", seed))).otherwise(0))
        .orderBy(F.col("source").asc_nulls_last()).limit(MAX_SOURCES + 1).collect()
    )
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    own = [r["size"] for r in found]
    weight = [weights[i % len(weights)] for i in range(len(own))]
    target = targets(own, weight, share * sum(own), passes)
    rows, used = [], []
    for r, size, t in zip(found, own, target):
        full, rest = divmod(min(passes * size, round(t)), size) if size else (0, 0)
        short = size - (r["blocks"] - 1) * BLOCK_WORDS if size else 0
        last = -(-rest // BLOCK_WORDS)  # blocks of the last pass; one more if the short one is among them
        if r["short_at"] < last and last * BLOCK_WORDS - (BLOCK_WORDS - short) < rest:
            last += 1
        used.append(full * r["blocks"] + last)
        rows.append({
            "source": r["source"], "source_size": size, "target": t, "full": full, "rest": rest,
            "blocks": r["blocks"], "short": short, "short_at": r["short_at"],
        })
    dealt = split_quotas(used, shards, seed)
    for i, row in enumerate(rows):
        row["ends"] = list(itertools.accumulate(dealt[k][i] for k in range(shards)))
    return _plan_frame(spark, rows)


def draw_mix(
    docs: DataFrame, carried: Sequence[str] = (), weights: Sequence[int] = WEIGHTS,
    share: float = SHARE, passes: int = PASSES, shards: int = SHARDS, seed: int = SEED,
) -> DataFrame:
    """One row per document with the pieces the mix takes of it.

    doc_id, source, size, source_size, target, ``pieces`` (shard, pass, first word, words)
    and ``taken``, the sum of the pieces' words. ``carried`` columns of ``docs`` are kept.
    """
    # a row is known by two hashes of its text, one of them with its id, and one of its source
    # and of what is carried
    known = {
        "place": F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), F.col("text")),
        "tie": F.xxhash64(F.lit(seed + 2), F.col("text")), "kind": F.xxhash64(F.lit(seed), F.col("source"), *map(F.col, carried)),
    }
    keys = [c.alias(n) for n, c in known.items()]
    narrow = materialise(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source"), word_count().alias("size"), *keys
    ))
    plan = F.broadcast(source_plan(narrow, weights, share, passes, shards, seed))
    # as many hash ranges as rows in a range
    ranges = 1 << max(0, math.ceil(math.log2(max(1, narrow.count())) / 2))
    part = F.shiftright(F.col("place"), 64 - int(math.log2(ranges))) if ranges > 1 else F.lit(0).cast("long")
    ranged = narrow.withColumn("part", part)
    sums = ranged.groupBy("source", "part").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("__source"), F.col("part").alias("__part"),
        F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"),
    )
    inside = (
        Window.partitionBy("source", "part").orderBy("place", "doc_id", "tie", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    lined = (
        ranged.withColumn("at", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, F.col("source").eqNullSafe(F.col("__source")) & (F.col("part") == F.col("__part")))
        .withColumn("at", F.col("at") + F.col("before"))
    )
    plan = plan.withColumnRenamed("source", "__named")
    taken = lined.join(plan, F.col("source").eqNullSafe(F.col("__named")))
    # the blocks that a document lies in, with their places in the permuted order
    blocks = (
        f"transform(if(size > 0, sequence(at div {BLOCK_WORDS}, (at + size - 1) div {BLOCK_WORDS}), array()),"
        f" b -> named_struct('b', b, 'x', {permuted('b', 'blocks', seed)}))"
    )
    whole = f"if(s.b = blocks - 1, short, {BLOCK_WORDS}L)"
    before = f"(s.x * {BLOCK_WORDS} - if(short_at < s.x, {BLOCK_WORDS} - short, 0))"  # words of the blocks before
    kept = f"if(p < full, {whole}, if(p = full, greatest(0L, least({whole}, rest - {before})), 0L))"
    pieces = F.expr(
        f"transform(array({blocks}), own -> flatten(transform(sequence(0, {passes - 1}), p -> filter(transform(own, s ->"
        " named_struct('shard', size(filter(ends, e -> e <= p * blocks + s.x)), 'pass', p,"
        f" 'first', greatest(0L, s.b * {BLOCK_WORDS} - at),"
        f" 'words', least(at + size, s.b * {BLOCK_WORDS} + {kept}) - greatest(at, s.b * {BLOCK_WORDS}))),"
        " x -> x.words > 0))))[0]"
    )
    drawn = taken.withColumn("pieces", pieces).withColumn(
        "taken", F.expr("aggregate(pieces, 0L, (a, x) -> a + x.words)")
    )
    if carried:
        # the carried columns move once: one row of each kind of equal rows meets all of them
        whole = docs.select(*keys, *[F.col(c).alias(f"__c_{c}") for c in carried])
        whole = whole.groupBy(*known).agg(*[F.first(f"__c_{c}").alias(f"__c_{c}") for c in carried])
        drawn = drawn.join(whole, list(known))
    return drawn.select(
        "doc_id", "source", "size", "source_size", "target", "taken", "pieces",
        *[F.col(f"__c_{c}").alias(c) for c in carried],
    )


def mixed_pieces(text: str = "text", seed: int = SEED, digest: bool = True) -> Column:
    """The drawn pieces of a document with their words: shard, place in it, text, sha256."""
    words = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), "")

    def piece(w: Column, p: Column) -> Column:
        own = F.array_join(F.slice(w, p["first"].cast("int") + 1, p["words"].cast("int")), " ")
        return F.struct(
            p["shard"].alias("shard"),
            F.xxhash64(F.lit(seed + 1), F.col("doc_id"), p["pass"], p["first"], own).alias("place"),
            own.alias("text"), *([F.sha2(own, 256).alias("sha256")] if digest else []),
        )

    # the words are bound to a variable, so that a text is split once, not once a piece
    return F.transform(F.array(words), lambda w: F.transform("pieces", lambda p: piece(w, p)))[0]


def shuffled_shards(drawn: DataFrame, text: str = "text", seed: int = SEED) -> DataFrame:
    """The mix itself: one row per piece, dealt to its shard and in random order inside it.

    Columns: shard, place (the order), doc_id, source, text (the piece's words), sha256.
    ``drawn`` carries the text.
    """
    rows = drawn.select("doc_id", "source", F.explode(mixed_pieces(text, seed, digest=False)).alias("piece"))
    return (
        rows.select("piece.shard", "piece.place", "doc_id", "source", "piece.text")
        .repartition("shard", F.shiftright("place", 64 - SLICES)).sortWithinPartitions("shard", "place")
        .withColumn("sha256", F.sha2("text", 256))  # after the exchange: digests do not compress
    )
