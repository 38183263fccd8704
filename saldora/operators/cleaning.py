"""Cleaning steps and the three dataset cleaners.

Each step is a narrow projection; only exact-duplicate handling shuffles. Reports are
one-row frames computed by a single aggregation over the uncleaned input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldora.operators.relational import quoted
from saldora.sources.io import DATE_FORMAT

# Markers and limits of the data sources.
DATE_MARKER = "NaT"
UNKNOWN = "unknown"
DEPENDENTS_CAP = 9
ADULT_AGE = 18
NEVER_PRIMARY = 999
NEVER_SECONDARY = -1


@dataclass
class Cleaned:
    data: DataFrame
    report: DataFrame


def null_marker(df: DataFrame, col: str, marker: str) -> DataFrame:
    return df.withColumn(col, F.nullif(F.col(col), F.lit(marker)))


def parse_date(df: DataFrame, col: str, fmt: str = DATE_FORMAT) -> DataFrame:
    """Text to date; what is no date becomes NULL instead of failing the job."""
    return df.withColumn(col, F.try_to_date(F.col(col), fmt))


def date_audit(col: str, marker: str = DATE_MARKER, fmt: str = DATE_FORMAT) -> dict[str, Column]:
    """Aggregates over the raw text column: markers, unparseable, valid."""
    text = F.col(col)
    parsed = F.try_to_date(F.nullif(text, F.lit(marker)), fmt)
    marked = F.count_if(text == marker)
    return {
        "marker_count": marked,
        "unparseable": F.count_if(parsed.isNull()) - marked,
        "valid_dates": F.count(parsed),
    }


def null_above(df: DataFrame, col: str, cap: float) -> DataFrame:
    return df.withColumn(col, F.when(F.col(col) > cap, None).otherwise(F.col(col)))


def flag_below(df: DataFrame, col: str, limit: float, out: str) -> DataFrame:
    """Boolean flag; a missing value is not below anything."""
    return df.withColumn(out, F.coalesce(F.col(col) < limit, F.lit(False)))


def split_sentinel(
    df: DataFrame, col: str, sentinel, flag: str, value: str
) -> DataFrame:
    """(flag, nullable value) from a column in which ``sentinel`` means never.

    The source column stays. A NULL counts as never: the value is unknown, and the
    sources contain none.
    """
    known = F.coalesce(F.col(col) != F.lit(sentinel), F.lit(False))
    return df.withColumn(flag, known).withColumn(
        value, F.when(known, F.col(col)).cast("double")
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    """(duplicates): rows that repeat an earlier identical row; NULLs are equal."""
    copies = df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    return copies.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicates"))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of each identical row (hash aggregate: copies combine map-side)."""
    return df.dropDuplicates()


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def marker_rates(df: DataFrame, marker: str = UNKNOWN) -> DataFrame:
    """(column, n, rate) of the text columns in which the marker occurs; one pass."""
    cols = text_columns(df)
    if not cols:
        raise ValueError("no text column to search")
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(quoted(c) == marker).alias(f"m{i}") for i, c in enumerate(cols)],
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n"))
            for i, c in enumerate(cols)
        ]
    )
    return (
        counts.select("__rows", F.explode(entries).alias("__e"))
        .select("__e.column", "__e.n", (F.col("__e.n") / F.col("__rows")).alias("rate"))
        .filter("n > 0")
    )


def key_is_unique(df: DataFrame, key: str) -> DataFrame:
    """(rows, distinct_keys, is_unique); a single NULL counts as one value."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.max("__n") == 1, F.lit(True)).alias("is_unique"),
    )


def row_accounting(before: DataFrame, after: DataFrame) -> DataFrame:
    """(rows_in, rows_removed, rows_out)."""
    n_in = before.agg(F.count(F.lit(1)).alias("rows_in"))
    n_out = after.agg(F.count(F.lit(1)).alias("rows_out"))
    return n_in.withColumn("rows_out", n_out.scalar()).withColumn(
        "rows_removed", F.col("rows_in") - F.col("rows_out")
    )


def clean_churn(raw: DataFrame, key: str = "customer_id") -> Cleaned:
    """Track A: dates, implausible dependents, minor flag. Keeps every row."""
    clean = null_marker(raw, "last_transaction", DATE_MARKER)
    clean = parse_date(clean, "last_transaction")
    clean = null_above(clean, "dependents", DEPENDENTS_CAP)
    clean = flag_below(clean, "age", ADULT_AGE, "age_under_18_flag")
    dates = date_audit("last_transaction")
    counts = raw.agg(
        F.count(F.lit(1)).alias("original_rows"),
        dates["marker_count"].alias("last_transaction_marker_count"),
        dates["unparseable"].alias("last_transaction_unparseable"),
        dates["valid_dates"].alias("last_transaction_valid_dates"),
        F.count_if(F.col("dependents") > DEPENDENTS_CAP).alias("dependents_invalid_count"),
        F.count_if(F.col("age") < ADULT_AGE).alias("age_under_18_count"),
    )
    unique = key_is_unique(clean, key).select("is_unique")
    report = counts.withColumn("key_unique_after_cleaning", unique.scalar()).withColumn(
        "final_rows", F.col("original_rows")
    )
    return Cleaned(clean, report)


def _copies(df: DataFrame) -> DataFrame:
    """Different rows with their number ``__n``; copies combine map-side."""
    return df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))


def _all_copies() -> Column:
    return F.coalesce(F.sum("__n"), F.lit(0))


def _contact_counts(
    clean: DataFrame, rows: str, weight: Column | None = None, **more: Column
) -> DataFrame:
    """Rows in all and by contact flag; ``weight`` is how many rows a row stands for."""
    one = F.lit(1).cast("long") if weight is None else weight

    def total(when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, one)), F.lit(0))

    return clean.agg(
        total(F.lit(True)).alias(rows),
        total(F.col("previous_contact_flag")).alias("previously_contacted_count"),
        total(~F.col("previous_contact_flag")).alias("never_contacted_count"),
        *[c.alias(name) for name, c in more.items()],
    )


def _split_pdays(df: DataFrame, sentinel: int) -> DataFrame:
    return split_sentinel(
        df, "pdays", sentinel, "previous_contact_flag", "days_since_previous_contact"
    )


def clean_campaign(raw: DataFrame) -> Cleaned:
    """Track B primary: exact duplicates removed, pdays split, 'unknown' kept."""
    # one grouping gives the rows that stay and how many there were of each
    copies = _split_pdays(_copies(raw), NEVER_PRIMARY)
    report = _contact_counts(copies, "rows_after_dedup", original_rows=_all_copies()).withColumn(
        "duplicate_rows_removed", F.col("original_rows") - F.col("rows_after_dedup")
    )
    return Cleaned(copies.drop("__n"), report)


def clean_campaign_secondary(raw: DataFrame) -> Cleaned:
    """Track B secondary: duplicates only counted, pdays split, 'unknown' kept."""
    clean = _split_pdays(raw, NEVER_SECONDARY)
    copies = _split_pdays(_copies(raw), NEVER_SECONDARY)
    found = F.coalesce(F.sum(F.col("__n") - 1), F.lit(0))
    report = _contact_counts(copies, "final_rows", F.col("__n"), duplicate_rows_found=found)
    return Cleaned(clean, report)
