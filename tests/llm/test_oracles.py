"""Queries with a SQL twin agree with it row by row."""

from __future__ import annotations

import duckdb
import pytest
from saldora.llm.queries import ORACLE, QUERIES

from tests_llm_helpers import rows


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twin(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cursor = con.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    expected = sorted(str([str(x[columns.index(c)]) for c in sorted(columns)]) for x in cursor.fetchall())
    got = sorted(str([str(r[c]) for c in sorted(r)]) for r in rows(QUERIES[name](spark, sf_dir)))
    assert got == expected
