"""Benchmark decontamination with a broadcast table of normalised test n-grams.

Normalised words are runs of 0-9, a-z (A-Z lower-cased) and all characters beyond ASCII.
An item's windows are its runs of ``n`` consecutive words; an item with fewer words, but
not none, is one window. A document word inside any occurrence of any window is hit.

Documents are scanned once per window length that exists: every run of that many words is
hashed and looked up, found runs are compared word by word with the window's text. The
window table is broadcast if it is small by count, else the lookup is a shuffle join, which
Spark splits where a run is frequent.

Cases: null or empty text has no words and no hits; an empty benchmark, or one without
words, hits nothing. Items with equal windows are all reported. Repeated documents give
repeated results; repeated item ids count once. Items with a null id hit like any other; together they count
as one item, whose null comes last and is in no joined list of ids.
Only DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldora.llm.rows import row_key, unused
from saldora.session import materialise

N = 10
BROADCAST_WINDOWS = 500_000  # a round; rows of about a hundred bytes
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normal_words(text: str = "text") -> Column:
    """Array of normalised words; null has none."""
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(lower, _BREAKS), "")


def benchmark_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """One row per distinct window: gram (its words), size, items that have it, its hash.

    ``items`` may hold one null, for all items without an id.
    """
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item"), normal_words().alias("words")
    ).where("size(words) > 0")
    placed = items.select(
        "item", "words", F.least(F.size("words"), F.lit(n)).alias("size")
    ).withColumn("at", F.explode(F.expr("sequence(1, size(words) - size + 1)")))
    grams = placed.select(
        "item", "size", F.array_join(F.expr("slice(words, at, size)"), " ").alias("gram"),
        F.expr(
            "aggregate(transform(slice(words, at, size), w -> xxhash64(w)), 0L,"
            " (h, x) -> xxhash64(h, x))"
        ).alias("code"),
    )
    return grams.groupBy("gram", "size", "code").agg(
        # arrays, because a set of the ids themselves leaves nulls out
        F.flatten(F.collect_set(F.array("item"))).alias("items")
    )


def _code(size: int) -> str:
    """SQL for the hash of the ``size`` words that start at position ``i`` of ``h``."""
    code = "0L"
    for k in range(size):
        code = f"xxhash64({code}, get(h, i + {k}))"
    return code


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """One row per occurrence: key (row_key), at (first word, from 0), size, items.

    The windows are broadcast, ``BROADCAST_WINDOWS`` of them at a time: a larger benchmark takes
    several rounds over the documents, each with an equal share of the window hashes. No
    document's words go through an exchange.
    """
    windows = materialise(benchmark_windows(benchmark, n))
    counts = {r["size"]: r["n"] for r in windows.groupBy("size").agg(F.count("*").alias("n")).collect()}
    sizes = sorted(counts)
    if not sizes:
        return docs.sparkSession.range(0).selectExpr(
            "string(id) key", "int(id) at", "int(id) size", "array(string(id)) items"
        )
    words = docs.select(row_key().alias("key"), normal_words().alias("words"))
    hashed = words.withColumn("h", F.expr("transform(words, w -> xxhash64(w))"))
    # all lengths in one pass. From here to the hits there are only expressions that Spark
    # compiles into one loop: no row that still has its document's words is ever copied
    lengths = F.explode(F.array(*map(F.lit, sizes))) if len(sizes) > 1 else F.lit(sizes[0])
    runs = hashed.select("key", "words", "h", lengths.alias("size"))
    runs = runs.select("key", "words", "h", "size", F.posexplode("h").alias("i", "first"))
    runs = runs.where(F.col("i") <= F.size("h") - F.col("size"))
    code = F.expr(_code(sizes[-1]))
    for size in sizes[:-1]:
        code = F.when(F.col("size") == size, F.expr(_code(size))).otherwise(code)
    runs = runs.select("key", "words", "i", "size", code.alias("code"))
    rounds = -(-sum(counts.values()) // BROADCAST_WINDOWS)
    found = None
    for part in range(rounds):
        own = windows.where(F.pmod("code", F.lit(rounds)) == part).select("code", "size", "gram", "items")
        hits = runs.join(F.broadcast(own), ["code", "size"]).where(
            F.array_join(F.slice("words", F.col("i") + 1, F.col("size")), " ") == F.col("gram")
        ).select("key", F.col("i").alias("at"), "size", "items")
        found = hits if found is None else found.unionByName(hits)
    return found


def hit_report(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """Per distinct (doc_id, text) with hits: key, n_hit, sorted item ids, hit spans.

    Frequent items make many hits of one document, never a group larger than its words.
    """
    # repeated rows have equal hits: one of them is enough
    hits = find_hits(docs, benchmark, n).groupBy("key", "at").agg(
        F.max("size").alias("size"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")
    )
    per_doc = hits.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("at", "size"))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    # starts ascend: a hit adds the words beyond the furthest end so far
    return per_doc.select(
        "key", "items", "hits",
        F.expr(
            "aggregate(hits, named_struct('n', 0L, 'to', 0L), (a, x) -> named_struct("
            " 'n', a.n + greatest(0L, x.at + x.size - greatest(a.to, bigint(x.at))),"
            " 'to', greatest(a.to, bigint(x.at + x.size)))).n"
        ).alias("n_hit"),
    )


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (sorted), hits (at, size)."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"),
        F.size(normal_words()).cast("long").alias("n_words"),
    )
    found = hit_report(docs, benchmark, n)
    return rows.join(found, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("hits", F.array().cast("array<struct<at:int,size:int>>")).alias("hits"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """The rows of ``docs``, all columns, that no window occurs in."""
    key = unused(docs, "key")
    found = find_hits(docs, benchmark, n).select(F.col("key").alias(key)).distinct()
    return docs.join(found, row_key() == F.col(key), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """All rows; ``text`` of documents with hits becomes its normalised words outside them.

    Documents without hits keep their text as it is.
    """
    key, hits, words = (unused(docs, c) for c in ("key", "hits", "words"))
    found = hit_report(docs, benchmark, n).select(F.col("key").alias(key), F.col("hits").alias(hits))
    kept = F.expr(
        f"array_join(transform(filter(transform({words}, (w, i) -> struct(w, i)),"
        f" x -> not exists({hits}, h -> x.i >= h.at and x.i < h.at + h.size)), x -> x.w), ' ')"
    )
    joined = docs.join(found, row_key() == F.col(key), "left")
    return joined.withColumn(words, normal_words()).withColumn(
        "text", F.when(F.col(hits).isNull(), F.col("text")).otherwise(kept)
    ).select(*docs.columns)
