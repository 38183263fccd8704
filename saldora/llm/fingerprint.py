"""Document fingerprints by one-permutation MinHash with optimal densification.

Every run of five words is hashed once. The upper bits of a hash name one of ``BINS`` bins,
the smallest hash of each bin is kept. An empty bin takes over the value of a non-empty one
that a hash of (bin, candidate) chooses, so equal sets fill equal bins from equal places.
Of every bin the low ``BITS`` bits are stored, packed as hex. The likeness of two
fingerprints is the share of equal bins, corrected for the 2 ** -BITS chance agreements.

Words are runs of characters other than ASCII white space, unchanged. A text of one to four
words has one shingle, its words; a text without words has the empty fingerprint, which is
like another empty one (1.0) and unlike all others (0.0).

The edited text of a document needs the next document: ids are put in order once, as narrow
rows, and only the piece of text that is asked for travels to the neighbour.

Cases: a null text is empty. Null ids come first in the order. Rows of equal id are ordered
by the MD5 of their text; repeated rows share the next different row. A single document is
its own next one. An empty table gives an empty result.
Only DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldora.llm.rows import SPACES, document_columns, numbered, row_key
from saldora.session import materialise

WORDS = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
BITS = 8


def _bin(x: str) -> str:
    return f"shiftrightunsigned({x}, {64 - BIN_BITS})"


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the fingerprint of column ``text`` as ``out`` (hex, two digits a bin)."""
    low = (1 << BITS) - 1
    shingles = " , ".join(f"get(__h, i + {k})" for k in range(WORDS))
    return (
        df.withColumn("__w", F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), SPACES), ""))
        .withColumn("__h", F.expr("transform(__w, w -> xxhash64(w))"))
        .withColumn(
            "__s",
            F.expr(
                f"sort_array(CASE WHEN size(__h) >= {WORDS}"
                f" THEN transform(sequence(0, size(__h) - {WORDS}), i -> xxhash64({shingles}))"
                " WHEN size(__h) > 0 THEN array(xxhash64(__h)) ELSE array() END)"
            ),
        )
        .withColumn(
            "__first",
            F.expr(f"filter(__s, (x, i) -> i = 0 OR {_bin('x')} != {_bin('get(__s, i - 1)')})"),
        )
        .withColumn(
            "__bins",
            F.expr(f"map_from_arrays(transform(__first, x -> {_bin('x')}), transform(__first, x -> x & {low}L))"),
        )
        .withColumn(
            out,
            F.expr(
                # the map is named twice so that it is a column of its own, made once a row
                "CASE WHEN size(__bins) = 0 THEN '' ELSE array_join(transform("
                f" sequence(0L, {BINS - 1}L), j -> lpad(hex(coalesce(__bins[j],"
                f"  array_min(transform(__first, x -> (xxhash64(j, {_bin('x')}) & {~low}L) | (x & {low}L))) & {low}L"
                f" )), {BITS // 4}, '0')), '') END"
            ),
        )
        .drop("__w", "__h", "__s", "__first", "__bins")
    )


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of two fingerprints, 0 to 1."""
    chance = 2.0**-BITS
    digits = BITS // 4
    return F.expr(
        f"CASE WHEN {a} = {b} THEN 1.0D WHEN {a} = '' OR {b} = '' THEN 0.0D ELSE greatest(0.0D,"
        f" (size(filter(sequence(0, {BINS - 1}), i ->"
        f" substring({a}, i * {digits} + 1, {digits}) = substring({b}, i * {digits} + 1, {digits})))"
        f" / {float(BINS)}D - {chance}D) / {1 - chance}D) END"
    )


def next_rows(docs: DataFrame) -> DataFrame:
    """Distinct rows in order: key, doc_id, n_chars, next_key (the first one's after the last)."""
    rows = docs.select("doc_id", row_key().alias("key"), F.char_length("text").cast("long").alias("n_chars"))
    placed = numbered(
        rows.distinct(), F.col("doc_id").asc_nulls_first(), F.col("key").asc(), out="rn"
    )
    placed = materialise(placed)
    last = placed.agg(F.max("rn")).first()[0] or 0
    following = placed.select(
        F.when(F.col("rn") == 1, F.lit(last)).otherwise(F.col("rn") - 1).alias("rn"),
        F.col("key").alias("next_key"),
    )
    return placed.join(following, "rn").drop("rn")


def edited_texts(docs: DataFrame, order: DataFrame) -> DataFrame:
    """key, text and edited text: the last half replaced by as much of the next one's start."""
    texts = docs.select(row_key().alias("key"), "text")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    asked = order.select(F.col("next_key").alias("key"), F.col("key").alias("asks"), half.alias("half"))
    # one asker per text; repeated rows answer alike
    answers = (
        texts.join(asked, "key")
        .select(F.col("asks").alias("key"), F.expr("left(text, half)").alias("piece"))
        .groupBy("key").agg(F.max("piece").alias("piece"))
    )
    kept = (F.char_length("text") - F.floor(F.char_length("text") / 2)).cast("int")
    return texts.join(answers, "key").withColumn(
        "edited", F.concat(F.left("text", kept), F.col("piece"))
    ).drop("piece")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and how alike they are.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next.
    """
    rows = document_columns(docs).select("doc_id", "text")
    order = materialise(next_rows(rows))
    own = materialise(
        with_fingerprint(rows.select(row_key().alias("key"), "text"), "text", "fingerprint")
        .select("key", "fingerprint")
    )
    edited = with_fingerprint(edited_texts(rows, order), "edited", "edited_fingerprint").select(
        "key", F.sha2("edited", 256).alias("edited_sha256"), "edited_fingerprint"
    )
    once = own.dropDuplicates(["key"])
    joined = (
        edited.join(order, "key").join(once, "key")
        .join(once.select(F.col("key").alias("next_key"), F.col("fingerprint").alias("next_fingerprint")), "next_key")
    )
    return joined.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
