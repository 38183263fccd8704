"""Readers and writers. Files are always read with a declared schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldora.operators.relational import quoted, rename
from saldora.sources.schemas import override

DATE_FORMAT = "yyyy-MM-dd"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = ",",
    types: Mapping[str, str | T.DataType] | None = None,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Header CSV with a declared schema.

    ``types`` overrides single column types; ``names`` renames columns (dotted and
    reserved names become plain ones). A cell that does not fit its type is NULL.
    """
    if types:
        schema = override(schema, types)
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("mode", "PERMISSIVE")
        .option("dateFormat", DATE_FORMAT)
        .csv(path)
    )
    return rename(df, names) if names else df


def write_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    """Header CSV without an index column; one part file per partition."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).option(
        "dateFormat", DATE_FORMAT
    ).csv(path)
    return path


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_report(report: DataFrame, path: str) -> str:
    """One-row report as JSON lines."""
    report.write.mode("overwrite").json(path)
    return path


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast to a declared table; a missing column is an error."""
    lower = {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema if f.name.lower() not in lower]
    if missing:
        raise ValueError(f"columns missing for the table: {missing}")
    return df.select(
        *[quoted(lower[f.name.lower()]).cast(f.dataType).alias(f.name) for f in schema]
    )


def to_date_lenient(col: str, fmt: str = DATE_FORMAT):
    """Date, or NULL when the text is no date."""
    return F.try_to_date(F.col(col), fmt)
