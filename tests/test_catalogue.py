"""Every query of the catalogue against its SQL, on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from volcohort.plans import every

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.sql(f"create view {f.split('.')[0]} as select * from '{DATA}/{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return round(float(v), 6) if hasattr(v, "as_tuple") else v


@pytest.mark.parametrize("name", list(every.QUERIES))
def test_query(spark, duck, name):
    df = every.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    if name not in every.ORACLES:
        assert df.count() > 0
        return
    rel = duck.sql(every.ORACLES[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
