"""Every query with SQL gives what DuckDB gives on the same tables."""

from __future__ import annotations

import math

import duckdb
import pandas as pd
import pytest

from barloom.queries import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events".split()


def canon(frame: pd.DataFrame) -> list:
    def value(x):
        if x is None or x is pd.NA or x is pd.NaT or isinstance(x, float) and math.isnan(x):
            return None
        return x.item() if hasattr(x, "item") else str(x) if not isinstance(x, (str, int, float, bool)) else x

    frame = frame[sorted(frame.columns)]
    return sorted((tuple(map(value, row)) for row in frame.itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, data, duck, name):
    ours, theirs = QUERIES[name](spark, data).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canon(ours) == canon(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
