"""Every registered query runs; every one with SQL agrees with DuckDB row by row."""

from __future__ import annotations

import math

import duckdb
import pytest

from saldora import catalog

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
QUERIES, ORACLE = catalog.queries(), catalog.oracle_sql()

@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x + 0.0:.9g}"
    return str(x)


def _rows(columns, rows):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(_cell(r[i]) for i in at) for r in rows)


def test_oracles_belong_to_queries():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert got
        return
    cur = duck.execute(ORACLE[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.columns, got) == _rows(columns, cur.fetchall())
