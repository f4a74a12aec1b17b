"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from kinship.plans import driver, driver_more, driver_stores  # noqa: F401

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _norm(v):
    if isinstance(v, float):
        return ("f", round(v, 12)) if not math.isnan(v) else ("nan",)
    if v is None:
        return ("null",)
    return ("v", str(v))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "nq_similarity" in df.columns


# the training-data operators have their own tests
BASE = sorted(n for n in E.oracle_sql() if n in driver.ORACLES)


@pytest.mark.parametrize("name", BASE)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    got = sorted(tuple(_norm(v) for v in r) for r in df.collect())
    res = con.sql(E.oracle_sql()[name])
    ocols = list(res.columns)
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    exp = sorted(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert got == exp
