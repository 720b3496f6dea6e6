"""Every registered panel and table query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

from panelkiln.plans.registry import QUERIES, SQL

from .conftest import DATA


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    return v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for t in "orders lineitem events customer part".split():
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    cur = con.execute(SQL[name])
    columns = [c[0] for c in cur.description]
    want = sorted((tuple(plain(v) for v in r) for r in cur.fetchall()), key=str)
    got = QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=str) == want
