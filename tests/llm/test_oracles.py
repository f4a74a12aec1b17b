"""The dealt operators' queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

from kinship.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    res = con.sql(ORACLES[name])
    cols = sorted(df.columns)
    assert cols == sorted(res.columns)
    order = [res.columns.index(c) for c in cols]
    got = sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
    assert got == sorted(tuple(str(r[i]) for i in order) for r in res.fetchall())
