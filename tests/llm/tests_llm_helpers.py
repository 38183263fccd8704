"""Small frames for the tests of this folder."""

from __future__ import annotations

import pyarrow as pa

SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()),
    ("n_chars", pa.int64()), ("key", pa.string()), ("score", pa.string()),
])


def documents(spark, rows):
    """(doc_id, text[, lang[, source]]) rows with two more columns of clashing names."""
    full = [(*r, *[None] * (4 - len(r))) for r in rows]
    columns = list(zip(*full)) if full else [[], [], [], []]
    sizes = [None if t is None else len(t) for t in columns[1]]
    table = pa.table(
        [*map(list, columns), sizes, ["x"] * len(full), ["y"] * len(full)], schema=SCHEMA
    )
    return spark.createDataFrame(table)


def rows(df):
    return df.toArrow().to_pylist()


def by_id(df):
    return {r["doc_id"]: r for r in rows(df)}
