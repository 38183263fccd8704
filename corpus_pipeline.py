"""Pipeline over ``documents``: toxic ones go, one of each near-duplicate class stays,
benchmark passages go, secrets are masked, the sources are mixed to their target weights.

Each stage takes (spark, docs, sf_dir); its result is written and read again as the next
stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from saldora.llm import decontaminate, mixing, neardup, secrets, toxicity
from saldora.llm.rows import held_out, table
from saldora.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at 0.7 or more go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out(3, 1))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class the document with the least id stays."""
    return neardup.keep_one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark window occurs go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, with their secrets replaced."""
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with what the mix takes of it: the texts of its pieces, each with its
    shard, its place there and a digest."""
    drawn = mixing.draw_mix(docs, carried=["text"])
    return drawn.select(
        "doc_id", "source", "size", "source_size", "target", "taken",
        mixing.mixed_pieces().alias("mixed"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
]

# Trained scores, MinHash classes and hash orders have no SQL form; tests hold the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
