"""Every query with SQL against DuckDB on the smallest tables."""

import datetime
import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from hopweave.plans import registry

DATA = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return str(v) if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    return con


@pytest.mark.skipif(not Path(DATA).exists(), reason="the test tables are not here")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    sql = duck.sql(registry.oracle_sql()[name])
    theirs = list(sql.columns)
    assert sorted(theirs) == cols
    at = [theirs.index(c) for c in cols]
    want = Counter(repr(tuple(plain(r[i]) for i in at)) for r in sql.fetchall())
    got = Counter(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())
    assert got == want


def test_every_core_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())
