"""Every query with oracle SQL matches DuckDB on sf0.001 (the driver's gate, in small)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF0001
from newsflow.sources.tables import TABLES, table_path


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF0001, t)}')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF0001)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _canon([tuple(r) for r in df.collect()], df.columns) == _canon(rel.fetchall(), rel.columns)
