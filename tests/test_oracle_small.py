"""Every registered query against its DuckDB SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from sparkmill.plans.oracle import oracle_sql
from sparkmill.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    want = _rows(cols, cur.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want
