"""Every registered query against the same question in DuckDB."""

import math
import os

import duckdb
import pytest

from spindle.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in ORACLES:
        assert len(columns) > 0
        return
    out = duck.sql(ORACLES[name])
    assert sorted(out.columns) == columns
    at = [out.columns.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in at) for r in out.fetchall()), key=repr)
    assert got == want
