"""Summaries: the true rank error stays within the bound that they report, and that within the one asked for."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from genomeframe.operators import quantiles as Q

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


def off(values, p, got):
    """Ranks between the rank asked for and the nearest rank that the answer has."""
    v = np.sort(values)
    want = min(max(math.ceil(p * len(v)), 1), len(v))
    low, high = np.searchsorted(v, got, "left") + 1, np.searchsorted(v, got, "right")
    assert low <= high, "the answer is one of the values"
    return max(low - want, want - high, 0)


@pytest.mark.parametrize("seed", range(6))
def test_merging_many_parts(seed):
    r = np.random.default_rng(seed)
    draws = [lambda n: r.normal(size=n), lambda n: r.integers(0, 8, n).astype(float), lambda n: np.exp(r.normal(0, 4, n))]
    values = [draws[(seed + i) % 3](int(r.integers(1, 4000))) for i in range(20)]
    eps, levels = 0.01, 3
    parts = [Q.compress(Q.from_sorted(np.sort(v)), Q._slack(len(v), eps, levels)) for v in values]
    for width in (4, 5):
        parts = [Q.combine(parts[i : i + width]) for i in range(0, len(parts), width)]
        parts = [Q.compress(p, Q._slack(p[3], eps, levels)) for p in parts]
    (s,), whole = parts, np.concatenate(values)
    assert s[3] == len(whole) and len(s[0]) < len(whole) / 4
    bound = Q.rank_error(s)
    assert bound <= eps * len(whole) + 1
    assert all(off(whole, p, g) <= bound + 1e-9 for p, g in zip(PROBS, Q.answer(s, PROBS)))


def test_groups_at_once_equal_groups_one_by_one():
    r = np.random.default_rng(3)
    groups = [np.sort(r.integers(0, k + 1, n).astype(float)) for k, n in ((0, 1), (3, 50), (9, 2000), (5000, 3000), (0, 7))]
    ends = np.cumsum([0, *map(len, groups)])
    n, vals, rmin, rmax = Q.grouped(np.concatenate(groups), ends, lambda n: n / 200)
    for i, g in enumerate(groups):
        want = Q.compress(Q.from_sorted(g), len(g) / 200)
        got = Q.long(n[i].as_py(), vals[i].as_py(), rmin[i].as_py(), rmax[i].as_py())
        assert all(np.array_equal(a, b) for a, b in zip(got[:3], want[:3])) and got[3] == want[3] == len(g)


def test_stored_summaries_come_back():
    r = np.random.default_rng(6)
    for k, n in ((0, 1), (0, 2), (1, 3), (3, 50), (9000, 40), (5, 2000)):
        exact = Q.from_sorted(np.sort(r.integers(0, k + 1, n).astype(float)))
        for s in (exact, Q.compress(exact, 3.0), Q.combine([exact, Q.from_sorted(np.array([0.5, 2.0]))])):
            back = Q.long(*Q.short(s))
            # of a run of equal values only the first and the last are needed
            assert back[3] == s[3] and Q.answer(back, PROBS) == Q.answer(s, PROBS) and Q.rank_error(back) == Q.rank_error(s)
            assert s is not exact or all(np.array_equal(a, b) for a, b in zip(back[:3], s[:3]))
    n, vals, rmin, rmax = Q.short(Q.from_sorted(np.array([1.0, 1.0, 2.0])))
    assert (n, list(vals), rmin, list(rmax)) == (3, [1.0, 2.0], None, [2, 3])


def test_a_group_of_many_summaries(spark):
    """More summaries of one key than are held at once; the bound still holds."""
    r = np.random.default_rng(8)
    parts = [r.normal(i % 5, 1, 40) for i in range(1500)]
    rows = [(*Q.short(Q.from_sorted(np.sort(v)))[:2], None, None) for v in parts]
    df = spark.createDataFrame([("m", int(n), [float(x) for x in v], a, b) for n, v, a, b in rows], f"metric string, {Q.SUMMARY}")
    (x,) = Q.quantiles(Q.merge_summaries(df, ["metric"], 0.01), PROBS).collect()
    whole = np.concatenate(parts)
    assert x["n"] == len(whole) and 0 < x["rank_error"] <= 0.01 * len(whole) + 1
    assert all(off(whole, p, x[f"p{round(p * 100):02d}"]) <= x["rank_error"] for p in PROBS)


def test_summaries_of_a_table(spark):
    r = np.random.default_rng(1)
    rows = [(int(k), f"s{k % 3}" if k else None, dt.date(2026, 1, 1 + i % 3), float(x) if i % 11 else None, "x") for i, (k, x) in enumerate(zip(r.choice([0, 1, 1, 1, 5], 6000), r.normal(size=6000)))]
    rows += [(7, "s9", None, float("nan"), "x"), (7, "s9", None, float("inf"), "x"), (None, "s9", None, 1.5, "x")]
    df = spark.createDataFrame(rows, "ref int, sample string, day date, m double, `key` string").repartition(7, "m")
    s = Q.summarize(df, ["m"], {"ref": "ref", "sample": "sample", "day": "day"}, 0.01, ["ref", "sample"])
    got = {(x["dimension"], x["key"]): x for x in Q.quantiles(s, PROBS).collect()}
    names = [f"p{round(p * 100):02d}" for p in PROBS]
    pick = {"ref": 0, "sample": 1, "day": 2}
    for (dim, key), x in got.items():
        own = [t[3] for t in rows if t[3] is not None and t[3] == t[3] and key == (("|".join("*" if t[i] is None else str(t[i]) for i in (0, 1))) if "+" in dim else None if t[pick[dim]] is None else str(t[pick[dim]]))]
        assert x["n"] == len(own) and x["rank_error"] <= 0.01 * len(own) + 1
        assert all(off(np.array(own), p, x[c]) <= x["rank_error"] for p, c in zip(PROBS, names))
    assert {k for d, k in got if d == "day"} == {"2026-01-01", "2026-01-02", "2026-01-03", None}
    assert got["ref", "7"]["n"] == 1 and got["ref", None]["p50"] == 1.5
    days = Q.merge_summaries(s.where("dimension = 'day'"), ["metric"])
    x = Q.quantiles(days, PROBS).collect()[0]
    own = np.array([t[3] for t in rows if t[3] is not None and t[3] == t[3]])
    assert x["n"] == len(own) and all(off(own, p, x[c]) <= x["rank_error"] for p, c in zip(PROBS, names))
    assert Q.summarize(df.limit(0), ["m"], {"ref": "ref"}).collect() == []
    assert Q.summarize(df.withColumn("m", F.lit(None).cast("double")), ["m"], {"ref": "ref"}).collect() == []
