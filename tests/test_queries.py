"""Every query of the core against its SQL on the smallest tables, compared row by row."""

import math
import os

import duckdb
import pytest

from wavelake import queries as core

SQL = core.oracle_sql()


@pytest.fixture(scope="module")
def db(data):
    con = duckdb.connect()
    for f in os.listdir(data):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{data}/{f}')")
    return con


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    return repr(round(float(v), 9)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(core.queries()))
def test_query(spark, db, data, name):
    df = core.queries()[name](spark, data)
    got = df.toPandas()
    if name not in SQL:
        assert len(got.columns)
        return
    want = db.sql(SQL[name]).df()
    assert set(got.columns) == set(want.columns)
    rows = lambda x: sorted(tuple(canon(v) for v in r) for r in x[sorted(x.columns)].astype(object).itertuples(index=False))
    assert rows(got) == rows(want)
