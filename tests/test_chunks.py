"""Key chunks against plain loops in the declared order."""

import random

import pytest
from pyspark.sql import functions as F

from genomeframe.operators import chunks as C


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    r = random.Random(2)
    rows = [(r.choice([None, 0, 0, 0, 0, 1, 2]), r.choice([None, *range(40)]), i, "x") for i in range(1200)] + [(9, None, 5000, "x")] * 2
    path = str(tmp_path_factory.mktemp("chunks") / "t")
    spark.createDataFrame(rows, "ref int, start int, id long, `chunk` string").repartition(6).write.parquet(path)
    df = spark.read.parquet(path)
    # the order of the files' names, and of the rows in them
    placed = df.select("*", F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("at")).orderBy("f", "at").drop("f", "at")
    return df, [tuple(x) for x in placed.collect()]


@pytest.mark.parametrize(("size", "order"), [(1, False), (7, False), (7, True), (100, False), (100, True), (10**6, False)])
def test_numbers_and_states(table, size, order):
    df, rows = table
    order = ["id"] if order else []
    if order:
        rows = sorted(rows, key=lambda x: x[2])
    out = C.number_rows(df, "ref", size, order)
    assert out.columns == ["ref", "start", "id", "chunk_in", "row_no", "chunk"]
    by = {}
    for x in out.collect():
        by.setdefault(x["ref"], []).append((x["row_no"], x["id"]))
        assert x["chunk"] == x["row_no"] // size
    for key in {x[0] for x in rows}:
        assert sorted(by[key]) == list(enumerate(x[2] for x in rows if x[0] == key))
    got = {x["key"]: x for x in C.per_key(df, "ref", "start", size, order).collect()}
    for key in {x[0] for x in rows}:
        values = [x[1] for x in rows if x[0] == key]
        there = [v for v in values if v is not None]
        x = got[key]
        assert (x["n_rows"], x["n_values"], x["n_chunks"]) == (len(values), len(there), -(-len(values) // size))
        assert (x["first_value"], x["last_value"]) == ((there[0], there[-1]) if there else (None, None))
        steps = [b - a for a, b in zip(there, there[1:])]
        assert x["inversions"] == sum(s < 0 for s in steps) and x["longest_step"] == max(steps, default=None)


def test_heavy(spark, table):
    df, rows = table
    found = {x["key_value"]: x["n_rows"] for x in C.across([("t", C.heavy_keys(C.per_key(df, "ref", "start", 50), 0.05))]).collect()}
    want = {k: n for k in {x[0] for x in rows} if (n := sum(x[0] == k for x in rows)) >= 0.05 * len(rows)}
    assert found == {"*" if k is None else str(k): n for k, n in want.items()}
    empty = df.limit(0)
    assert C.across([("t", C.heavy_keys(C.per_key(empty, "ref", "start")))]).collect() == []


def test_key_types(spark):
    for kind, values in (("string", ["", None, "a"]), ("boolean", [True, False, None]), ("binary", [b"", b"\xff", None]), ("double", [0.0, None, 1.5])):
        df = spark.createDataFrame([(v, 1) for v in values * 2], f"k {kind}, v int")
        for options in ({}, {"order": ["v", "k"]}, {"stable": True}):
            got = C.per_key(df, "k", "v", 1, **options).collect()
            assert sorted(x["n_rows"] for x in got) == [2, 2, 2]
            assert sorted(str(x["key"]) for x in got) == sorted(map(str, values))
    with pytest.raises(ValueError):
        C.number_rows(spark.range(3), "id", 0)


def test_order_does_not_depend_on_files_or_splits(spark, tmp_path):
    r = random.Random(7)
    rows = [(r.choice([0, 0, 0, 1, None]), r.choice([None, *range(50)]), i) for i in range(900)]
    r.shuffle(rows)
    results, old = [], spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for k, (files, size) in enumerate(((1, "128m"), (3, "128m"), (5, "2000"))):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.createDataFrame(rows, "ref int, start int, id long").repartition(files).write.parquet(str(tmp_path / str(k)))
            results.append(sorted(map(str, C.per_key(spark.read.parquet(str(tmp_path / str(k))), "ref", "start", 40, order=["id"]).collect())))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert results[0] == results[1] == results[2]


def test_a_key_with_most_rows_costs_no_task_more(spark, tmp_path):
    """Rows stay where they are read: no shuffle but of counts, offsets and states."""
    spark.range(50_000).select(F.when(F.col("id") % 10 > 0, 1).otherwise(F.col("id")).alias("k"), "id").repartition(4).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = C.chunk_states(df, "k", "id", 1000)._jdf.queryExecution().executedPlan().toString()
    first = plan[: plan.rindex("MapInArrow")] if "MapInArrow" in plan else ""
    assert "MapInArrow" in plan and first is not None
    below = plan[plan.rindex("MapInArrow") :]
    assert "BroadcastHashJoin" in below and "hashpartitioning" not in below
