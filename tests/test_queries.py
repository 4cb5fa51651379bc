"""Every query with SQL gives the same rows as another engine over the same tables; every query runs."""

import math
import os
from collections import Counter

import pytest

from genomeframe.plans.oracle import ORACLE
from genomeframe.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables are not here")
duckdb = pytest.importorskip("duckdb")


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return bytes(v) if isinstance(v, bytearray) else v


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.sql(f"CREATE VIEW {f.partition('.')[0]} AS SELECT * FROM '{FOLDER}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = QUERIES[name](spark, FOLDER)
    names = sorted(df.columns)
    rows = Counter(tuple(plain(r[n]) for n in names) for r in df.collect())
    if name in ORACLE:
        other = sql.sql(ORACLE[name])
        assert sorted(other.columns) == names
        at = [other.columns.index(n) for n in names]
        assert rows == Counter(tuple(plain(r[i]) for i in at) for r in other.fetchall())
    else:
        assert rows


def test_names():
    assert set(ORACLE) <= set(QUERIES)
    assert QUERIES["p1_found"] and all(f"p{n}_found" in QUERIES for n in (1, 2, 3, 5))
