"""The registered queries run over the whole tables; those with SQL give the same rows as another engine."""

import os
from collections import Counter

import pytest

from genomeframe.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables are not here")
duckdb = pytest.importorskip("duckdb")


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
    rows = Counter(tuple(r[n] for n in names) for r in df.collect())
    assert rows
    if name in ORACLE:
        other = sql.sql(ORACLE[name])
        assert sorted(other.columns) == names
        at = [other.columns.index(n) for n in names]
        assert rows == Counter(tuple(r[i] for i in at) for r in other.fetchall())


def test_results_do_not_depend_on_the_splits(spark):
    """The same rows from one scan task as from many."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for name in ("p6_packing", "p7_mix"):
            results = []
            for size in ("16k", "128m"):
                spark.conf.set("spark.sql.files.maxPartitionBytes", size)
                results.append(Counter(map(tuple, QUERIES[name](spark, FOLDER).collect())))
            assert results[0] == results[1]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_columns(spark):
    assert QUERIES["p8_found"](spark, FOLDER).dtypes == [("doc_id", "bigint"), ("sent_start", "int"), ("sent_end", "int")]
