"""Near-duplicate classes by ProbMinHash, banding and verification.

A document is a weighted set: its runs of five words (runs of characters other than ASCII
white space, unchanged), each weighing ``1 + ln(count)``. Of two documents the probability
Jaccard similarity counts; documents at ``SIMILARITY`` or more are linked, and a class is
what links connect.

Signature: every shingle sends arrivals of a Poisson process whose rate is its weight, each
to a register that the arrival's hash names; a register keeps the shingle that came first.
A shingle stops as soon as its next arrival is later than all registers' firsts. The share
of equal registers estimates the similarity.

Candidates: equal bands of ``ROWS`` registers put documents into buckets. No bucket is
expanded into pairs. Instead

1. each document is compared with the least leader (first member) of its buckets, then with
   the other leaders that its links have not already reached;
2. in buckets that still hold several classes, the members outside the largest class are
   compared with all members, in blocks of bounded size, by their signatures; pairs whose
   estimate is within ``MARGIN`` (four standard deviations) of the bound go on. A pair
   with several buckets is looked at in the first of its bands' real hashes. The pairs stay
   arrays of their block, to which each member's set is brought once.

Every pair that goes on is verified on the exact weighted sets, unless its classes have been
connected by then. Two documents of one bucket that end up in different classes have thus
been compared, in step 2 by their estimate first: at a similarity of exactly 0.8 it falls
below the margin with probability 7e-5 (binomial, 256 registers), and more rarely above.

Cases: equal texts are one node (64-bit text hash) and always one class. A text of one to
four words has one shingle, its words; texts without words are linked to equal texts only.
A null text is empty. A class is named by its least doc_id, null ids counting as greater; a
class of null ids has a null name. Repeated rows are copies. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldora.llm.components import connected
from saldora.llm.rows import unused
from saldora.llm.textbytes import SLICE_BYTES, mix, slices, window_hashes, word_hashes, words
from saldora.session import materialise

SHINGLE = 5
SIMILARITY = 0.8
REGISTERS = 256
BANDS = 24
ROWS = 4
MARGIN = 0.1
STRAYS = 512
MEMBERS = 2_048
BLOCK_SHINGLES = 1 << 20
_DOCS = 1 << 12  # documents in one sort key
_PAIRS = 1 << 14  # pairs of a block that are looked at together
_CODE_BITS = 52


# ------------------------------------------------------------------ weighted sets


def weighted_sets(data: np.ndarray, offsets: np.ndarray):
    """(owner, code, count) of the distinct shingles of at most 4,096 documents, sorted."""
    starts, ends, cut = words(data, offsets)
    code = word_hashes(data, starts, ends)
    n_words = np.diff(cut)
    owner = np.repeat(np.arange(len(n_words)), n_words)
    runs = window_hashes(code, SHINGLE)
    whole = np.flatnonzero(owner[: len(runs)] == owner[SHINGLE - 1 :]) if len(runs) else np.zeros(0, int)
    found, owners = [runs[whole]], [owner[whole]]
    for i in np.flatnonzero((n_words > 0) & (n_words < SHINGLE)):
        own = code[cut[i] : cut[i + 1]]
        found.append(window_hashes(own, len(own)))
        owners.append(np.array([i]))
    key = np.concatenate(owners).astype(np.uint64) << np.uint64(_CODE_BITS)
    key |= np.concatenate(found) >> np.uint64(64 - _CODE_BITS)
    key.sort()
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(key)))
    key = key[at]
    return (key >> np.uint64(_CODE_BITS)).astype(np.int64), key & np.uint64((1 << _CODE_BITS) - 1), count


def weights(count: np.ndarray) -> np.ndarray:
    return 1 + np.log(count)


def prob_minhash(owner: np.ndarray, code: np.ndarray, weight: np.ndarray, n: int, m: int = REGISTERS):
    """(n, m) codes of the first arrivals; zero rows for documents without shingles."""
    first = np.full(n * m, np.inf)
    winner = np.zeros(n * m, dtype=np.uint64)
    time = np.zeros(len(code))
    number = 0
    while len(code):
        # later rounds have few shingles left: give each several arrivals at once
        burst = 1 if number < 4 else 16 if number < 100 else 64
        k = np.arange(number, number + burst, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)
        draw = mix(code[:, None] + k)
        gap = -np.log1p(-((draw >> np.uint64(11)) * 2.0**-53)) / weight[:, None]
        arrival = time[:, None] + np.cumsum(gap, axis=1)
        place = owner[:, None] * m + (mix(draw) % np.uint64(m)).astype(np.int64)
        if burst > 1:
            early = arrival < first[place]
            t, at = arrival[early], place[early]
            who = np.broadcast_to(code[:, None], arrival.shape)[early]
        else:
            t, at, who = arrival[:, 0], place[:, 0], code
        np.minimum.at(first, at, t)
        won = first[at] == t
        winner[at[won]] = who[won]
        time = arrival[:, -1]
        number += burst
        going = time < first.reshape(n, m).max(axis=1)[owner]
        owner, code, weight, time = owner[going], code[going], weight[going], time[going]
    return winner.reshape(n, m)


def probability_jaccard(a: np.ndarray, u: np.ndarray, b: np.ndarray, v: np.ndarray) -> float:
    """Exact similarity of two weighted sets with sorted codes: sum over common elements of
    1 / sum_j max(u_j / u_i, v_j / v_i), by one sort on the ratios u_j / v_j."""
    _, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(in_a):
        return 0.0
    only_u = u.sum() - u[in_a].sum()
    only_v = v.sum() - v[in_b].sum()
    x, y = u[in_a], v[in_b]
    ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    first = np.searchsorted(ratio, ratio, side="left")  # equal ratios count as u
    above = x.sum() - np.concatenate([[0], np.cumsum(x)])[first] + only_u
    below = np.concatenate([[0], np.cumsum(y)])[first] + only_v
    return float((1 / (above / x + below / y)).sum())


def _chunks(batches: Iterator[pa.RecordBatch]):
    for rows, data, offsets in slices(batches, most=SLICE_BYTES >> 2):
        for at in range(0, rows.num_rows, _DOCS):
            to = min(rows.num_rows, at + _DOCS)
            own = offsets[at : to + 1]
            yield rows.slice(at, to - at), data[own[0] : own[-1]], own - own[0]


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in _chunks(batches):
        n = rows.num_rows
        owner, code, count = weighted_sets(data, offsets)
        winner = prob_minhash(owner, code, weights(count), n)
        held = np.bincount(owner, minlength=n)
        bands = np.zeros((n, BANDS), dtype=np.uint64)
        for k in range(ROWS):
            bands = mix(bands + mix(winner[:, k : BANDS * ROWS : ROWS]))
        bands = mix(bands + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
        low = winner.astype(np.uint8)
        keep = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [
                rows.column(0).take(pa.array(keep)),
                pa.array(list(bands[keep]), pa.list_(pa.int64())),
                pa.array([low[i].tobytes() for i in keep], pa.binary()),
                pa.array(held[keep], pa.int64()).cast(pa.int32()),
            ],
            names=["node", "bands", "signature", "shingles"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in _chunks(batches):
        owner, code, count = weighted_sets(data, offsets)
        cut = np.searchsorted(owner, np.arange(rows.num_rows + 1))
        count = np.minimum(count, np.iinfo(np.uint32).max).astype(np.uint32)
        codes = [code[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]
        # counts that are all 1 are left out
        counts = [count[a:b].tobytes() if (count[a:b] > 1).any() else b"" for a, b in zip(cut[:-1], cut[1:])]
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(codes, pa.binary()), pa.array(counts, pa.binary())],
            names=["node", "codes", "counts"],
        )


def _unpacked(codes: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes and weights of a packed set."""
    code = np.frombuffer(codes, dtype=np.uint64)
    if not counts:
        return code, np.ones(len(code))
    return code, weights(np.frombuffer(counts, dtype=np.uint32))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def read(batch: pa.RecordBatch, i: int, side: str):
        return _unpacked(batch[f"codes_{side}"][i].as_py(), batch[f"counts_{side}"][i].as_py())

    for batch in batches:
        near = [
            probability_jaccard(*read(batch, i, "a"), *read(batch, i, "b"))
            for i in range(batch.num_rows)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch["a"], batch["b"], pa.array(near, pa.float64())], names=["a", "b", "similarity"]
        )


# ------------------------------------------------------------------ candidates


def text_node(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` that reach the bound on their exact weighted sets."""
    def side(name: str) -> DataFrame:
        return sets.select(
            F.col("node").alias(name), F.col("codes").alias(f"codes_{name}"),
            F.col("counts").alias(f"counts_{name}"),
        )

    joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    return (
        joined.select("a", "b", "codes_a", "counts_a", "codes_b", "counts_b")
        .mapInArrow(_verify, "a long, b long, similarity double")
        .where(F.col("similarity") >= SIMILARITY).select("a", "b")
    )


def _with_class(df: DataFrame, comps: DataFrame, node: str, out: str) -> DataFrame:
    named = comps.select(F.col("node").alias(node), F.col("comp").alias(out))
    return df.join(named, node, "left").withColumn(out, F.coalesce(out, node))


def _compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block the pairs whose estimate is near the bound, most alike first, as arrays."""
    least = SIMILARITY - MARGIN

    def unpack(value: pa.Scalar):
        rows = value.values
        nodes = rows.field("node").to_numpy(zero_copy_only=False)
        comps = rows.field("comp").to_numpy(zero_copy_only=False)
        signs = np.frombuffer(b"".join(rows.field("signature").to_pylist()), dtype=np.uint8)
        earlier = rows.field("earlier").flatten().to_numpy(zero_copy_only=False)
        return nodes, comps, signs.reshape(len(nodes), REGISTERS), earlier.reshape(len(nodes), -1)

    for batch in batches:
        out: list[list[np.ndarray]] = [[], [], [], []]
        for i in range(batch.num_rows):
            strays, members = unpack(batch["strays"][i]), unpack(batch["members"][i])
            found: list[list[np.ndarray]] = [[], [], [], [], []]
            for at in range(0, len(strays[0]), 16):
                part = slice(at, at + 16)
                equal = strays[2][part][:, None, :] == members[2][None, :, :]
                share = equal.mean(axis=2)
                s, m = np.nonzero((share >= least) & (strays[1][part][:, None] != members[1][None, :]))
                # a pair is looked at in the first of its common bands: no earlier hash agrees
                own = ~(strays[3][part][s] == members[3][m]).any(axis=1)
                s, m = s[own], m[own]
                for k, x in enumerate((
                    strays[0][part][s], members[0][m], strays[1][part][s], members[1][m], -share[s, m]
                )):
                    found[k].append(x)
            columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in found]
            order = np.argsort(columns[4], kind="stable")
            for k in range(4):
                out[k].append(columns[k][order])
        yield pa.RecordBatch.from_arrays(
            [batch["block"], *(pa.array(x, pa.list_(pa.int64())) for x in out)],
            names=["block", "a", "b", "comp_a", "comp_b"],
        )


def _verify_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a block's pairs on their exact sets; a pair already connected needs none."""
    for batch in batches:
        left, right = [], []
        for i in range(batch.num_rows):
            sets = {x["node"]: _unpacked(x["codes"], x["counts"]) for x in batch["sets"][i].as_py()}
            root: dict[int, int] = {}

            def find(c: int) -> int:
                while root.setdefault(c, c) != c:
                    root[c] = c = root[root[c]]
                return c

            pairs = [batch[k][i].values for k in ("a", "b", "comp_a", "comp_b")]
            for at in range(0, len(pairs[0]), _PAIRS):
                for a, b, x, y in zip(*(p.slice(at, _PAIRS).to_pylist() for p in pairs)):
                    if find(x) != find(y) and probability_jaccard(*sets[a], *sets[b]) >= SIMILARITY:
                        root[find(x)] = find(y)
                        left.append(a)
                        right.append(b)
        yield pa.RecordBatch.from_arrays(
            [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"]
        )


def stray_links(members: DataFrame, comps: DataFrame, signed: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between different classes of one bucket, enough to connect them.

    ``members`` (bucket, band, leader, node), ``signed`` (node, bands, signature, shingles),
    ``sets`` (node, codes, counts); in each bucket the nodes outside its largest
    class are compared with all nodes, in blocks bounded by members and by shingles.
    """
    classed = _with_class(members, comps, "node", "comp")
    sizes = classed.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    buckets = sizes.groupBy("bucket").agg(
        F.max_by("comp", F.struct("n", "comp")).alias("main"), F.sum("n").alias("all"),
        F.max("n").alias("most"),
    ).where("all > most and all > 2").select("bucket", "main")
    # a leader has been compared with its whole bucket
    stray = (F.col("comp") != F.col("main")) & (F.col("node") != F.col("leader"))
    active = materialise(classed.join(buckets, "bucket").withColumn("stray", stray))
    # one signature per text, only of those that are still in question
    signs = active.select("node").distinct().join(signed.dropDuplicates(["node"]), "node")
    rows = active.join(signs.select("node", "bands", "signature", "shingles"), "node")
    parts = rows.groupBy("bucket").agg(
        F.greatest(
            F.ceil(F.count_if("stray") / STRAYS),
            F.ceil(F.sum(F.when(F.col("stray"), F.col("shingles")).otherwise(0)) / BLOCK_SHINGLES),
        ).cast("int").alias("parts_s"),
        F.greatest(F.ceil(F.count("*") / MEMBERS), F.ceil(F.sum("shingles") / BLOCK_SHINGLES))
        .cast("int").alias("parts_m"),
    ).where("parts_s > 0")
    rows = rows.join(parts, "bucket").withColumn(
        "own_s", F.expr("pmod(xxhash64(node, 1), parts_s)").cast("int")
    ).withColumn("own_m", F.expr("pmod(xxhash64(node, 2), parts_m)").cast("int"))
    earlier = F.slice("bands", F.lit(1), F.col("band")).alias("earlier")
    item = F.struct("node", "comp", "signature", earlier).alias("item")
    s = rows.where("stray").select(
        "bucket", "band", F.col("own_s").alias("i"), F.explode(F.expr("sequence(0, parts_m - 1)")).alias("j"),
        F.lit(True).alias("stray"), item,
    )
    m = rows.select(
        "bucket", "band", F.explode(F.expr("sequence(0, parts_s - 1)")).alias("i"), F.col("own_m").alias("j"),
        F.lit(False).alias("stray"), item,
    )
    blocks = s.unionByName(m).groupBy("bucket", "band", "i", "j").agg(
        F.collect_list(F.when(F.col("stray"), F.col("item"))).alias("strays"),
        F.collect_list(F.when(~F.col("stray"), F.col("item"))).alias("members"),
    ).where("size(strays) > 0 and size(members) > 0")
    near = materialise(
        blocks.select(F.concat_ws(":", "bucket", "i", "j").alias("block"), "strays", "members")
        .mapInArrow(
            _compare_blocks,
            "block string, a array<long>, b array<long>, comp_a array<long>, comp_b array<long>",
        ).where("size(a) > 0")
    )
    asked = near.select("block", F.explode(F.array_union("a", "b")).alias("node"))
    gathered = asked.join(sets, "node").groupBy("block").agg(
        F.collect_list(F.struct("node", "codes", "counts")).alias("sets")
    )
    return (
        near.join(gathered, "block").select("a", "b", "comp_a", "comp_b", "sets")
        .mapInArrow(_verify_blocks, "a long, b long").distinct()
    )


def near_duplicate_links(docs: DataFrame) -> DataFrame:
    """(node, comp) for all texts with a link; node is ``text_node`` of the text."""
    texts = docs.select(text_node().alias("node"), "text")
    signed = materialise(
        texts.mapInArrow(_sign, "node long, bands array<long>, signature binary, shingles int")
    )
    placed = signed.select("node", F.posexplode("bands").alias("band", "bucket"))
    leaders = materialise(
        placed.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("last"))
        .where("leader != last").select("bucket", "leader")
    )
    # copies of a text are several rows up to here
    members = materialise(
        placed.join(leaders, "bucket").select("bucket", "band", "leader", "node").distinct()
    )
    wanted = members.select("node").distinct()
    sets = materialise(
        texts.join(wanted, "node", "left_semi").dropDuplicates(["node"])
        .mapInArrow(_sets, "node long, codes binary, counts binary")
    )
    stars = members.where("node != leader").select(F.col("node").alias("a"), F.col("leader").alias("b"))
    nearest = stars.groupBy("a").agg(F.min("b").alias("b"))
    links = materialise(verified(nearest, sets))
    comps = materialise(connected(links))
    crossing = _with_class(_with_class(stars.distinct(), comps, "a", "comp_a"), comps, "b", "comp_b")
    second = crossing.where("comp_a != comp_b").select("a", "b").join(nearest, ["a", "b"], "left_anti")
    links = materialise(links.unionByName(verified(second, sets)))
    comps = materialise(connected(links))
    return connected(links.unionByName(materialise(stray_links(members, comps, signed, sets))))


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, node, comp, class_id (least doc_id of its class), n_class."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    comps = near_duplicate_links(rows)
    own = rows.select("doc_id", text_node().alias("node"))
    texts = own.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
    classed = materialise(_with_class(texts, comps, "node", "comp"))
    named = classed.groupBy("comp").agg(
        F.min("first_id").alias("class_id"), F.sum("copies").alias("n_class")
    )
    by_text = classed.select("node", "comp").join(named, "comp")
    return own.join(by_text, "node").select("doc_id", "node", "comp", "class_id", "n_class")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their class: its least doc_id.

    In a class of null ids the least text hash stays; of rows with one id and several texts
    the least text hash, of repeated rows one.
    """
    classes = near_duplicate_classes(docs)
    key, first, node = (unused(docs, c) for c in ("key", "first", "node"))
    keep = materialise(
        classes.groupBy("comp").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("x")
        ).select(F.col("x.doc_id").alias(first), F.col("x.node").alias(node))
    )
    there = docs.withColumn(key, text_node())
    kept = there.join(
        keep, (F.col(key) == F.col(node)) & F.col("doc_id").cast("long").eqNullSafe(F.col(first)), "left_semi"
    )
    repeated = classes.groupBy("doc_id", "node").count().where("count > 1").limit(1).count() > 0
    if repeated:
        kept = kept.dropDuplicates(["doc_id", key])
    return kept.drop(key)
