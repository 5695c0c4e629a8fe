"""Every query with oracle SQL gives the oracle's rows on the smallest tables."""

import decimal
import os

import duckdb
import pytest

from rootline.plans.oracle import ORACLE
from rootline.plans.queries import REGISTRY


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.fixture(scope="module")
def duck(small):
    c = duckdb.connect()
    for name in os.listdir(small):
        c.execute(f"create view {name.removesuffix('.parquet')} as select * from '{small}/{name}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, small, duck, name):
    df = REGISTRY[name](spark, small)
    got = [r.asDict() for r in df.collect()]
    found = duck.execute(ORACLE[name])
    columns = [x[0] for x in found.description]
    assert sorted(columns) == sorted(df.columns)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    order = sorted(columns)
    want = sorted((tuple(plain(r[columns.index(c)]) for c in order) for r in found.fetchall()), key=key)
    assert sorted((tuple(plain(r[c]) for c in order) for r in got), key=key) == want


def test_names():
    assert set(ORACLE) <= set(REGISTRY)
