"""Interval operators: literal expectations, and random data against plain-Python brute force."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from genomeframe import operators as ops

SCHEMA = "chrom string, start int, end int, strand string, id long"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def simple(spark, *rows):
    return frame(spark, [(c, s, e) for c, s, e in rows], "chrom string, start int, end int")


def got(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


def draw(seed, n, empty=False, span=70000):
    """Rows on three chromosomes, over several bins."""
    r, rows = random.Random(seed), []
    for i in range(n):
        s = r.choice([r.randrange(200), r.randrange(span)])
        e = s + (r.randrange(0 if empty else 1, 30) if r.random() < 0.9 else r.randrange(1, span))
        rows.append((r.choice(["chr1", "chr1", "chr2", "chr10"]), s, e, r.choice("+-"), i))
    return rows


def nulls():
    return [(None, 1, 5, "+", 900), ("chr1", None, 5, "+", 901), ("chr1", 3, None, "-", 902), ("chr1", 2, 9, None, 903)]


def hit(a, b):
    return a[1] < b[2] and b[1] < a[2]


def by_key(rows, on):
    groups = defaultdict(list)
    for x in rows:
        key = (x[0], x[3]) if on else (x[0],)
        if None not in (*key, x[1], x[2]):
            groups[key].append(x)
    return groups


def merged(rows):
    out = []
    for x in sorted(rows, key=lambda x: (x[1], x[2])):
        if out and x[1] < out[-1][1]:
            out[-1][1] = max(out[-1][1], x[2])
        else:
            out.append([x[1], x[2]])
    return out


@pytest.mark.parametrize(("seed", "empty", "on"), [(1, False, False), (2, True, False), (3, True, True)])
def test_single_set_operators(spark, seed, empty, on):
    rows = draw(seed, 120, empty) + nulls()
    df, on_cols = frame(spark, rows), ["strand"] if on else None
    groups = by_key(rows, on)
    extra = ["strand"] if on else []
    want = Counter((k[0], s, e, *k[1:]) for k, g in groups.items() for s, e in merged(g))
    assert got(ops.merge(df, on_cols), "chrom", "start", "end", *extra) == want

    clustered = {r["id"]: r["cluster_id"] for r in ops.cluster(df, on_cols).collect()}
    assert len(clustered) == len(rows)
    flat, no = {}, -1
    for _, g in sorted(groups.items()):
        end = None
        for x in sorted(g, key=lambda x: (x[1], x[2])):
            if end is None or x[1] >= end:
                no, end = no + 1, x[2]
            end = max(end, x[2])
            flat[x[4]] = (no, x[1], x[2])
    # equal zero-length rows may swap their ids
    assert Counter((clustered[i], s, e) for i, (_, s, e) in flat.items()) == Counter(flat.values())
    assert all(clustered[x[4]] is None for x in rows if x[4] not in flat)

    for sizes in (None, {"chr1": 200000, "chr2": 10, "chrX": 5}):
        want = Counter()
        for k, g in groups.items():
            at = 0
            for s, e in merged(g):
                if s > at:
                    want[(k[0], at, s, *k[1:])] += 1
                at = max(at, e)
            if sizes and at < sizes.get(k[0], 0):
                want[(k[0], at, sizes[k[0]], *k[1:])] += 1
        assert got(ops.complement(df, sizes, on_cols), "chrom", "start", "end", *extra) == want

    want = Counter()
    for k, g in groups.items():
        points = sorted({p for x in g for p in x[1:3]})
        for p, q in zip(points, points[1:]):
            depth = sum(x[1] <= p and x[2] >= q for x in g)
            if depth:
                want[(k[0], p, q, *k[1:], depth)] += 1
    assert got(ops.coverage(df, on_cols), "chrom", "start", "end", *extra, "depth") == want
    assert got(ops.disjoin(df, on_cols), "chrom", "start", "end", *extra) == Counter({x[:-1]: n for x, n in want.items()})


@pytest.mark.parametrize(("seed", "empty", "on"), [(4, False, False), (5, True, False), (6, True, True)])
def test_pairwise_operators(spark, seed, empty, on):
    rows_a, rows_b = draw(seed, 90, empty) + nulls(), draw(seed + 50, 70, empty) + nulls()
    a, b, on_cols = frame(spark, rows_a), frame(spark, rows_b), ["strand"] if on else None
    gb = by_key(rows_b, on)

    def hits(x):
        key = (x[0], x[3]) if on else (x[0],)
        if None in (*key, x[1], x[2]):
            return None
        return [y for y in gb.get(key, []) if hit(x, y)]

    want = Counter((x[4], y[4]) for x in rows_a for y in hits(x) or [])
    for width in (64, 1024, 1 << 20):
        assert got(ops.overlap(a, b, on_cols=on_cols, bin_width=width), "a_id", "b_id") == want
    assert got(ops.overlap(a, b, "semi", on_cols), "id") == Counter((x[4],) for x in rows_a if hits(x))
    assert got(ops.subtract(a, b, on_cols), "id") == Counter((x[4],) for x in rows_a if hits(x) == [])
    assert got(ops.count_overlaps(a, b, on_cols), "id", "count") == Counter((x[4], len(hits(x) or [])) for x in rows_a)

    for mode in ("nearest", "start_adjacent"):
        if mode == "start_adjacent" and empty:
            continue
        want = {}
        for x in rows_a:
            key, found = (x[0], x[3]) if on else (x[0],), hits(x)
            mates = [] if found is None else gb.get(key, [])
            if found:
                best = min((abs((x[1] + x[2]) // 2 - (y[1] + y[2]) // 2), y[4]) for y in found)
                want[x[4]] = (best[1], 0)
            elif mates:
                if mode == "start_adjacent":
                    order = sorted(mates, key=lambda y: (y[1], y[4]))
                    p = sum(y[1] < x[1] for y in order)
                    mates = order[max(p - 1, 0) : p + 1]
                best = min((max(y[1] - x[2], x[1] - y[2], 0), y[4]) for y in mates)
                want[x[4]] = (best[1], best[0])
            else:
                want[x[4]] = (None, None)
        out = ops.nearest(a, b, on_cols, mode, "id", "id")
        assert {r["a_id"]: (r["b_id"], r["distance"]) for r in out.collect()} == want
        assert out.count() == len(rows_a)


@pytest.mark.parametrize(("seed", "empty"), [(7, False), (8, True)])
def test_range_operators(spark, seed, empty):
    rows_a, rows_b = draw(seed, 60, empty) + nulls() + [("chr7", 5, 5, "+", 70), ("chr7", 5, 9, "+", 71)], draw(seed + 9, 40, empty) + nulls()
    a, b = frame(spark, rows_a), frame(spark, rows_b)
    ga, gb = by_key(rows_a, False), by_key(rows_b, False)
    cut = defaultdict(list)
    for k, g in ga.items():
        cut[k] = [(k[0], max(x[1], y[1]), min(x[2], y[2])) for x in g for y in gb.get(k, []) if hit(x, y)]
    # zero-length pieces at one place count once per distinct pair, so they are compared without their number
    pieces = lambda c: set(c) if empty else c
    want = Counter((k[0], s, e) for k, g in cut.items() for s, e in merged(g))
    assert pieces(got(ops.intersect_ranges(a, b), "chrom", "start", "end")) == pieces(want)
    both = by_key(rows_a + rows_b, False)
    want = Counter((k[0], s, e) for k, g in both.items() for s, e in merged(g))
    assert got(ops.union_ranges(a, b), "chrom", "start", "end") == want
    want = Counter()
    for k, g in ga.items():
        for x in g:
            if k not in gb:
                want[(k[0], x[1], x[2])] += 1
                continue
            at = x[1]
            for s, e in merged(gb[k]):
                if s < x[2] and x[1] < e:
                    if at < s:
                        want[(k[0], at, s)] += 1
                    at = max(at, e)
            if at < x[2]:
                want[(k[0], at, x[2])] += 1
    assert got(ops.setdiff_ranges(a, b, 64), "chrom", "start", "end") == want


def test_a_long_interval_makes_few_rows(spark):
    from genomeframe.operators import pairwise
    from genomeframe.roles import pack

    wide = pack(simple(spark, ("chr1", 0, 248_000_000)))
    small = pack(simple(spark, *(("chr1", i * 1000, i * 1000 + i) for i in range(1, 2000, 7))))
    shifts = pairwise._shifts(1024, wide.schema["s"].dataType)
    wide, small = (pairwise._with_level(x, shifts) for x in (wide, small))
    assert pairwise._binned(wide, small, shifts).count() <= 2
    assert pairwise._binned(small, wide, shifts).count() <= 4 * small.count()
    ends = spark.createDataFrame([("chr1", 0, 2**62), ("chr1", -(2**40), 5), ("chr1", 7, 9)], "chrom string, start long, end long")
    assert len(ops.overlap(ends, ends).collect()) == 7


def test_half_of_the_rows_at_one_place(spark):
    """A hot position is one row of the sweep, and the join back splits it."""
    from pyspark.sql import functions as F

    n = 200_000
    a = spark.range(n, numPartitions=4).select(F.lit("chr1").alias("chrom"), F.when(F.col("id") % 2 == 0, 5000).otherwise(F.col("id") * 3).cast("int").alias("start"), "id")
    a = a.withColumn("end", (F.col("start") + 20).cast("int"))
    b = spark.range(2000, numPartitions=2).select(F.lit("chr1").alias("chrom"), (F.col("id") * 50).cast("int").alias("start"), (F.col("id") * 50 + 30).cast("int").alias("end"))
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        counted = ops.count_overlaps(a, b)
        sizes = [r["n"] for r in counted.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == n and max(sizes) < 0.15 * n
        assert counted.where("id = 0").first()["count"] == 1
        total = sum(max(0, min(1999, (s + 19) // 50) - max(0, -(-(s - 29) // 50)) + 1) for i in range(n) for s in [5000 if i % 2 == 0 else i * 3])
        assert counted.agg(F.sum("count")).first()[0] == total
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_geometry(spark):
    at = lambda f, *r: [tuple(x) for x in f(simple(spark, ("chr1", *r))).select("start", "end").collect()]
    assert at(lambda d: ops.expand(d, 5), 10, 20) == [(5, 25)]
    assert at(lambda d: ops.expand(d, 5), 3, 10) == [(1, 15)]
    assert at(lambda d: ops.expand(d, start_amount=2, end_amount=8), 10, 20) == [(8, 28)]
    assert at(lambda d: ops.expand(d), 0, 5) == [(1, 5)]
    assert at(lambda d: ops.shift(d, 7), 10, 20) == [(17, 27)]
    assert at(lambda d: ops.shift(d, -50), 10, 20) == [(1, 11)]
    assert at(lambda d: ops.flank(d, 50), 100, 200) == [(50, 100)]
    assert at(lambda d: ops.flank(d, 50, start=False), 100, 200) == [(200, 250)]
    assert at(lambda d: ops.flank(d, 100), 5, 20) == [(1, 5)]
    assert at(lambda d: ops.set_width(d, 5), 10, 30) == [(10, 15)]
    assert at(lambda d: ops.set_width(d, 5, "end"), 10, 30) == [(25, 30)]
    assert at(lambda d: ops.set_width(d, 6, "center"), 10, 30) == [(17, 23)]
    assert at(lambda d: ops.tile(d, 30), 0, 100) == [(0, 30), (30, 60), (60, 90), (90, 100)]
    assert at(lambda d: ops.tile(d, 20), 5, 5) == []
    assert at(lambda d: ops.expand(d, 5), None, 10) == [(None, 15)]
    for bad in (lambda d: ops.set_width(d, 5, "middle"), lambda d: ops.tile(d, 0)):
        with pytest.raises(ValueError):
            bad(simple(spark, ("chr1", 1, 2)))


def test_sort(spark):
    df = simple(spark, ("chr10", 1, 2), ("chr2", 9, 10), ("chrX", 1, 2), (None, 1, 2), ("chr2", 3, 4), ("chr99999999999999999999", 1, 2), ("chr1", 5, 6))
    order = [(r[0], r[1]) for r in ops.sort_bedframe(df).collect()]
    assert order == [("chr1", 5), ("chr2", 3), ("chr2", 9), ("chr10", 1), ("chr99999999999999999999", 1), ("chrX", 1), (None, 1)]
    assert [r[0] for r in ops.sort_bedframe(df, False).collect()][:4] == ["chr1", "chr10", "chr2", "chr2"]


def test_names_types_and_empty_inputs(spark):
    rows = [("c", 5, 8, {"k": 1}, 1.5, 2), ("c", 5, 8, {"k": 1}, 1.5, 2), (None, None, None, None, None, None)]
    df = frame(spark, rows, "contig string, pos long, stop long, `count` map<string,int>, distance double, cluster_id int")
    assert ops.count_overlaps(df, df).columns == ["contig", "pos", "stop", "count_in", "distance", "cluster_id", "count"]
    assert Counter(r["count"] for r in ops.count_overlaps(df, df).collect()) == Counter([2, 2, 0])
    assert ops.cluster(df).columns[-2:] == ["cluster_id_in", "cluster_id"]
    assert len(ops.overlap(df, df).collect()) == 4
    assert len(ops.nearest(df, df).collect()) == 3
    assert ops.merge(df).columns == ["chrom", "start", "end"]
    ids = df.withColumn("pos", F.col("pos")).withColumn("contig", F.lit(3)).withColumnRenamed("distance", "row")
    assert len(ops.overlap(ids, ids, "semi").collect()) == 2
    none = df.limit(0)
    for f in (ops.merge, ops.cluster, ops.complement, ops.coverage, ops.disjoin, ops.expand, ops.sort_bedframe, lambda d: ops.tile(d, 3)):
        assert f(none).collect() == []
    for f in (ops.overlap, ops.nearest, ops.count_overlaps, ops.subtract, ops.intersect_ranges, ops.union_ranges, ops.setdiff_ranges):
        assert f(none, none).collect() == []
    assert len(ops.subtract(df, none).collect()) == 2
    assert [r["b_pos"] for r in ops.nearest(df, none).collect()] == [None] * 3
    with pytest.raises(ValueError):
        ops.merge(df.drop("stop"))
    with pytest.raises(ValueError):
        ops.overlap(df, df, "anti")
    with pytest.raises(ValueError):
        ops.overlap(df, df, on_cols=["strand"])


def test_periods_and_gaps(spark):
    r = random.Random(5)
    rows = [(r.choice([1, 1, 1, 2, None]), r.choice(["chr1", "chr2", None]), s, s + r.randrange(-1, 40), "x") for s in (r.randrange(-30, 60000) for _ in range(150))]
    rows += [(3, "chr1", 5, 9, "x"), (3, "chr1", 9, 12, "x"), (3, "chr1", 20, None, "x"), (3, "chr1", None, 7, "x")] * 2
    want, groups = Counter(), defaultdict(list)
    for t, c, s, e, x in rows:
        if None not in (t, c, s, e) and e > s:
            groups[t, c].append((c, s, e))
    for (t, c), g in groups.items():
        m = merged(g)
        want.update((t, c, "period", s, e) for s, e in m)
        want.update((t, c, "gap", x[1], y[0]) for x, y in zip(m, m[1:]) if x[1] < y[0])
    df = frame(spark, rows, "track_id long, chrom string, start int, end int, kind string")
    out = ops.periods_and_gaps(df, ["track_id", "chrom"])
    assert got(out, *out.columns) == want
    assert ops.periods_and_gaps(df.limit(0), ["track_id", "chrom"]).collect() == []
