"""Column helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from saldora.session import materialise

SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def document_columns(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id (long), text (null: empty) and ``more`` of a table that may hold other columns."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        *more,
    )


def unused(df: DataFrame, base: str) -> str:
    """``base``, with as many marks in front as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Identity of a row by what it holds: repeated rows share it, a null id has one too."""
    return F.concat_ws(
        ":",
        F.coalesce(F.col(doc_id).cast("string"), F.lit("null")),
        F.md5(F.coalesce(F.col(text), F.lit(""))),
    )


def held_out(modulus: int, rest: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text leaves ``rest``; a null id is never held out."""
    return F.coalesce(
        F.crc32(F.col(doc_id).cast("string")) % modulus == rest, F.lit(False)
    )


def numbered(df: DataFrame, *order: Column, out: str = "rn") -> DataFrame:
    """1..n in a declared order: range partitions, offsets per partition, no one-task sort.

    The ordered rows (narrow ones, please) are written once to the shared folder.
    """
    placed = materialise(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__mid", F.monotonically_increasing_id())
    ).withColumn("__pid", F.shiftright("__mid", 33))
    sizes = placed.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    index = F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.join(offsets, "__pid")
        .withColumn(out, (F.col("__off") + index + 1).cast("long"))
        .drop("__mid", "__pid", "__off")
    )


def first_by_hash(df: DataFrame, rows: int, key: str = "doc_id") -> DataFrame:
    """At most ``rows`` rows, always the same ones: those with the smallest key hashes."""
    return df.orderBy(F.xxhash64(key), F.col(key)).limit(rows)
