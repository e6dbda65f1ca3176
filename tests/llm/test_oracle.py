"""The registered queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

from sparkmill.llm.oracle import ORACLE
from sparkmill.llm.queries import QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    expected = con.execute(ORACLE[name]).to_arrow_table()
    got = QUERIES[name](spark, DIR).toArrow().select(expected.column_names)
    rows = lambda t: sorted(map(str, (tuple(r.values()) for r in t.to_pylist())))
    assert rows(got) == rows(expected)
    assert [str(f.type).replace("large_", "") for f in got.schema] == [str(f.type).replace("large_", "") for f in expected.schema]
