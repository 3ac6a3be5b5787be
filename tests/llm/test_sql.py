"""Operators that SQL can express give what DuckDB gives on the same tables."""

from __future__ import annotations

import duckdb
import pytest

from barloom.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, data, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    ours = QUERIES[name](spark, data)
    theirs = con.execute(SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    names = sorted(ours.columns)
    mine = sorted(tuple(str(r[c]) for c in names) for r in ours.collect())
    assert mine == sorted(tuple(str(v) for v in row) for row in theirs[names].itertuples(index=False, name=None)) and mine
