"""Every registered query of the library against its reference SQL in DuckDB, on the smallest tables."""

import datetime
import decimal
import os
from collections import Counter

import duckdb
import pytest

from duelbook import catalog

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = catalog.queries(), catalog.oracle_sql()


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (float, decimal.Decimal)):
        # Eight digits, and nothing below 1e-13: sums in another order may leave that much of a 0.
        return float(f"{round(float(v), 13):.8g}") + 0.0 if v == v else "nan"
    if isinstance(v, int):
        return float(f"{v:.8g}")
    if isinstance(v, datetime.datetime):
        return str(v.replace(tzinfo=None))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{FOLDER}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    if name in ORACLE:
        cursor = duck.execute(ORACLE[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == columns
        at = [names.index(c) for c in columns]
        want = Counter(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())
        assert got == want, (list((got - want).items())[:2], list((want - got).items())[:2])
