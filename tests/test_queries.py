"""Every registered query of the library against its SQL in DuckDB."""

import math

import duckdb
import pytest

from lattica.plans import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v.isoformat()[:19].replace("T", " ") if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    rel = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    at = [df.columns.index(c) for c in rel.columns]
    got = sorted(repr(tuple(plain(r[i]) for i in at)) for r in df.collect())
    want = sorted(repr(tuple(map(plain, r))) for r in rel.fetchall())
    assert got == want
