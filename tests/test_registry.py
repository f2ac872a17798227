"""Every registered query of the core library against its SQL twin, on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from strandline import registry

SF = "/root/testdata/sf0.001"


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    result = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expect = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=str)
    assert got == expect
