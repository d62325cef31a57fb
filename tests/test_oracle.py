"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from ledgerly.plans import registry
from ledgerly.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
registry.load_all()
QUERIES = registry.QUERIES
ORACLES = registry.ORACLES


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, v)
    if hasattr(v, "as_tuple"):
        return (2, float(v))
    if isinstance(v, bool):
        return (3, int(v))
    if isinstance(v, int):
        return (2, float(v))
    return (4, str(v))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(ORACLES))
    assert missing == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = df.columns
    got = sorted(tuple(_norm(x) for x in r) for r in df.collect())
    cur = con.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    want = sorted(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
