"""Every registered query of the library against its SQL on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from tapeline.plans import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return None if isinstance(v, float) and math.isnan(v) else v


def test_all_have_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    cursor = duck.execute(SQL[name])
    have = [d[0] for d in cursor.description]
    assert sorted(have) == cols
    want = [tuple(plain(r[have.index(c)]) for c in cols) for r in cursor.fetchall()]
    rows = [tuple(plain(r[c]) for c in cols) for r in got.collect()]
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert sorted(rows, key=key) == sorted(want, key=key)
