"""Percentiles per group within a bounded rank error, from summaries that can be stored and merged.

A *summary* of n values is a short sorted list of some of them, each with a rank interval ``[rmin, rmax]`` that holds its
true rank, in the manner of Greenwald and Khanna; nothing is random. Three operations keep track of the error:

* building from sorted values is exact (``rmin = rmax``), then compressed;
* merging interleaves the lists and adds the rank bounds of the neighbours in each of the others, so that absolute errors
  add up and the relative error stays the largest of the parts;
* compressing keeps, for evenly spaced ranks, the values nearest to them; it may add ``eps * n / levels`` ranks, so that all
  levels together stay within ``eps * n``.

Summaries are built inside the scan's tasks (one per group and ``BUFFER_ROWS`` rows), so the shuffle carries summaries, never
values. They are merged by a tree: first in as many buckets as the number of input partitions calls for, ``FAN_IN`` at a
time, so that no task reads an unbounded group even if one key holds most rows. The bound that holds for a result is
read off its own rank intervals (``rank_error``) and is at most ``eps * n`` (plus one rank).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_EPS = 0.005
FAN_IN = 32
BUFFER_ROWS = 1_000_000
SUMMARY = "n long, vals array<double>, rmin array<long>, rmax array<long>"
Summary = tuple[np.ndarray, np.ndarray, np.ndarray, int]


def from_sorted(values: np.ndarray) -> Summary:
    """Exact summary; of a run of equal values the first and the last are kept."""
    n = len(values)
    edge = np.zeros(n, bool)
    edge[:1] = edge[-1:] = True
    step = values[1:] != values[:-1]
    edge[1:] |= step
    edge[:-1] |= step
    at = np.flatnonzero(edge)
    return values[at], at + 1, at + 1, n


def grouped(values: np.ndarray, ends: np.ndarray, slack: Callable[[int], float]) -> list[pa.Array]:
    """Arrow columns ``n, vals, rmin, rmax`` of many groups at once: group i is ``values[ends[i]:ends[i + 1]]``, sorted.

    Groups that need no compression are written short (see ``short``); only the others are handled one by one.
    """
    sizes = np.diff(ends)
    large = np.array([slack(int(n)) >= 1 for n in sizes], bool)
    # the last of each run of equal values
    keep = np.ones(len(values), bool)
    keep[:-1] = values[1:] != values[:-1]
    keep[ends[1:] - 1] = True
    rank = np.arange(len(values)) - np.repeat(ends[:-1], sizes) + 1
    for i in np.flatnonzero(large):
        a, b = ends[i], ends[i + 1]
        kept = compress(from_sorted(values[a:b]), slack(int(b - a)))
        keep[a:b] = False
        keep[a + kept[1] - 1] = True
    kept = np.add.reduceat(keep, ends[:-1])
    plain = ~large & (kept == sizes)

    def lists(data: np.ndarray, there: np.ndarray) -> pa.ListArray:
        offsets = np.append(0, np.cumsum(np.where(there, kept, 0))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(data[keep & np.repeat(there, sizes)]), mask=pa.array(~there))

    every = np.ones(len(sizes), bool)
    return [pa.array(sizes.astype(np.int64)), lists(values, every), lists(rank.astype(np.int64), large), lists(rank.astype(np.int64), ~plain)]


def short(s: Summary) -> tuple:
    """``n, vals, rmin, rmax`` as they are stored. An exact summary needs no intervals: it has its distinct values and, in ``rmax``, the
    rank of the last of each, or no ranks at all if no value repeats."""
    vals, rmin, rmax, n = s[0].astype(float), s[1].astype(np.int64), s[2].astype(np.int64), s[3]
    if len(vals) and rmin[0] == 1 and rmax[-1] == n and np.array_equal(rmin, rmax):
        last = np.append(vals[1:] != vals[:-1], True)
        # between neighbours that differ no rank may be missing, else values were left out
        if np.all(np.diff(rmax)[last[:-1]] == 1):
            return n, vals[last], None, None if last.sum() == n else rmax[last]
    return n, vals, rmin, rmax


def long(n: int, vals: object, rmin: object, rmax: object) -> Summary:
    """The summary that ``short`` stored: first and last value of each run with their ranks, or tuples with intervals."""
    vals = np.asarray(vals, float)
    if rmin is not None:
        return vals, np.asarray(rmin, np.int64), np.asarray(rmax, np.int64), int(n)
    last = np.arange(1, len(vals) + 1) if rmax is None else np.asarray(rmax, np.int64)
    first = np.append(1, last[:-1] + 1)[: len(last)]
    several = first < last
    at = np.repeat(np.arange(len(vals)), 1 + several)
    ranks = np.empty(len(at), np.int64)
    ends = np.cumsum(1 + several) - 1
    ranks[ends] = last
    ranks[ends[several] - 1] = first[several]
    return vals[at], ranks, ranks, int(n)


def compress(s: Summary, slack: float) -> Summary:
    """Keep the tuples nearest to ranks ``2 * slack`` apart, the first and the last among them."""
    vals, rmin, rmax, n = s
    if len(vals) < 3 or slack < 1:
        return s
    targets = np.arange(0, n + 1, max(1.0, 2 * slack))
    if len(vals) <= len(targets):
        return s
    middle = (rmin + rmax) / 2
    right = np.clip(np.searchsorted(middle, targets), 1, len(vals) - 1)
    nearer = np.where(targets - middle[right - 1] <= middle[right] - targets, right - 1, right)
    keep = np.unique(np.concatenate([[0], nearer, [len(vals) - 1]]))
    return vals[keep], rmin[keep], rmax[keep], n


def combine(parts: Sequence[Summary]) -> Summary:
    """All tuples in order, each with the ranks that its neighbours in the other parts imply."""
    if len(parts) == 1:
        return parts[0]
    vals = np.concatenate([p[0] for p in parts])
    own = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    rmin, rmax = np.concatenate([p[1] for p in parts]).astype(np.int64), np.concatenate([p[2] for p in parts]).astype(np.int64)
    for j, (v, low, high, n) in enumerate(parts):
        # equal values of earlier parts come first
        before = np.where(own > j, np.searchsorted(v, vals, "right"), np.searchsorted(v, vals, "left"))
        low0, high0 = np.concatenate([[0], low]), np.concatenate([np.asarray(high) - 1, [n]])
        other = own != j
        rmin += np.where(other, low0[before], 0)
        rmax += np.where(other, high0[before], 0)
    order = np.lexsort((rmin, own, vals))
    return vals[order], rmin[order], rmax[order], sum(p[3] for p in parts)


def rank_error(s: Summary) -> float:
    """The largest distance in ranks between a rank asked for and the answer's true rank, as the summary's intervals bound it.

    Between two equal values every rank has that value.
    """
    vals, rmin, rmax, _ = s
    gaps = (rmax[1:] - rmin[:-1])[vals[1:] != vals[:-1]]
    return float(gaps.max() / 2) if len(gaps) and gaps.max() > 1 else 0.0


def answer(s: Summary, probs: Sequence[float]) -> list[float]:
    """For each p the value whose rank interval is nearest to ``ceil(p * n)``."""
    vals, rmin, rmax, n = s
    wanted = np.clip(np.ceil(np.asarray(probs) * n), 1, n)
    off = np.maximum(np.abs(wanted[:, None] - rmin), np.abs(rmax - wanted[:, None]))
    return [float(x) for x in vals[off.argmin(axis=1)]]


def _slack(n: int, eps: float, levels: int) -> float:
    """Ranks that one compression may add; as many compressions as levels share the error allowed."""
    return eps * n / levels


def _levels(partitions: int) -> int:
    """Merging steps until one summary a group is left."""
    steps, width = 1, max(1, partitions)
    while width > FAN_IN:
        steps, width = steps + 1, -(-width // FAN_IN)
    return steps


def summarize(
    df: DataFrame, metrics: Sequence[str], groups: dict[str, Column | str], eps: float = DEFAULT_EPS, cells: Sequence[str] = ()
) -> DataFrame:
    """``dimension, key, metric, n, vals, rmin, rmax``: one mergeable summary per dimension, key and metric (stored as ``short`` says).

    ``groups`` maps the name of a dimension to its key column; each row counts once in every dimension. ``cells`` names
    dimensions whose combinations come out as well, as one more dimension (names joined by ``+``, keys by ``|``, null ``*``). Null and NaN values
    are not values, a null key is the key null, infinities are values. An empty input gives no rows.
    """
    names = list(groups)
    dims = {n: [n] for n in names} | ({"+".join(cells): list(cells)} if cells else {})
    raw = df.select(*((df[g] if isinstance(g, str) else g).alias(f"g{i}") for i, g in enumerate(groups.values())))
    kinds = [f.dataType for f in raw.schema]

    def plain(col: Column, kind: T.DataType) -> Column:  # whole numbers and dates travel as numbers
        return col.cast("long") if isinstance(kind, T.IntegralType) else F.unix_date(col).cast("long") if isinstance(kind, T.DateType) else col.cast("string")

    def shown(key: object, kind: T.DataType) -> str | None:
        if pd.isna(key):
            return None
        return str(int(key)) if isinstance(kind, T.IntegralType) else str(np.datetime64(int(key), "D")) if isinstance(kind, T.DateType) else str(key)

    narrow = df.select(
        *(plain(df[g] if isinstance(g, str) else g, kind).alias(f"g{i}") for i, (g, kind) in enumerate(zip(groups.values(), kinds))),
        *(df[m].cast("double").alias(f"m{i}") for i, m in enumerate(metrics)),
    )
    partitions = narrow.rdd.getNumPartitions()
    steps = _levels(partitions)
    levels = steps + 1

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, buffer, size = TaskContext.get(), [], 0
        part = context.partitionId() if context else 0
        for batch in batches:
            buffer.append(batch)
            size += batch.num_rows
            if size >= BUFFER_ROWS:
                yield from flush(buffer, part)
                buffer, size = [], 0
        if buffer:
            yield from flush(buffer, part)

    def flush(buffer: list[pa.RecordBatch], part: int) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(buffer)
        codes = []
        for j in range(len(names)):
            c = rows.column(f"g{j}").combine_chunks().dictionary_encode(null_encoding="encode")
            codes.append((c.indices.to_numpy(zero_copy_only=False), c.dictionary.to_pylist()))
        for i, m in enumerate(metrics):
            values = rows.column(f"m{i}").to_numpy().astype(float)
            there = np.flatnonzero(~np.isnan(values))
            # sorted by value once; each dimension's groups then keep that order
            there = there[np.argsort(values[there], kind="stable")]
            for name, columns in dims.items():
                own = [codes[names.index(c)] for c in columns]
                group = np.zeros(len(there), np.int64)
                for c, keys in own:
                    group = group * max(1, len(keys)) + c[there]
                order = np.argsort(group, kind="stable")
                found, ends = np.unique(group[order], return_index=True)
                if not len(found):
                    continue
                summaries = grouped(values[there][order], np.append(ends, len(order)), lambda n: _slack(n, eps, levels))
                labels, rest = [], found
                for c, keys in reversed(own):
                    shown_keys = [shown(k, kinds[names.index(columns[len(own) - 1 - len(labels)])]) for k in keys]
                    labels.insert(0, [shown_keys[x] for x in rest % len(keys)])
                    rest = rest // len(keys)
                key = labels[0] if len(labels) == 1 else ["|".join("*" if x is None else x for x in t) for t in zip(*labels)]
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n), pa.array(key, pa.string()), pa.array([m] * n), pa.array(np.full(n, part, np.int64)), *summaries],
                    ["dimension", "key", "metric", "part", "n", "vals", "rmin", "rmax"],
                )

    out = narrow.mapInArrow(build, f"dimension string, key string, metric string, part long, {SUMMARY}")
    for step in range(steps):
        left = FAN_IN ** (step + 1)
        out = _merged(out.withColumn("part", F.floor(F.col("part") / left).cast("long")) if step < steps - 1 else out.withColumn("part", F.lit(0).cast("long")), eps, levels)
    return out.drop("part")


def _merged(summaries: DataFrame, eps: float, levels: int, keys: Sequence[str] = ("dimension", "key", "metric", "part")) -> DataFrame:
    """One summary per ``keys``; merged ``FAN_IN`` at a time as they come, so a group of any size takes a bounded memory."""
    keys, kinds = list(keys), dict(summaries.dtypes)

    def together(parts: list[tuple], level: int | None) -> tuple:
        out = combine([long(*p) for p in parts])
        # inner levels share one half of what this step may add, the last compression takes the other
        share = 2.0 if level is None else 2.0 * (level + 1) * (level + 2)
        return short(compress(out, _slack(out[3], eps, levels) / share))

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, tiers, out = None, [], []

        def add(stored: tuple, level: int = 0) -> None:
            """Never more than FAN_IN summaries of a level are held, however many the group has."""
            while len(tiers) <= level:
                tiers.append([])
            tiers[level].append(stored)
            if len(tiers[level]) == FAN_IN:
                full, tiers[level] = tiers[level], []
                add(together(full, level), level + 1)

        def close() -> None:
            parts = [s for tier in tiers for s in tier]
            out.append((*current, *(parts[0] if len(parts) == 1 else together(parts, None))))
            tiers.clear()

        for pdf in batches:
            keyed = pdf[keys].astype(object).where(pdf[keys].notna(), None)
            for *key, n, v, a, b in zip(*(keyed[k] for k in keys), pdf["n"], pdf["vals"], pdf["rmin"], pdf["rmax"]):
                if key != current and tiers:
                    close()
                current = key
                add((int(n), v, a, b))
            if out:
                yield pd.DataFrame(out, columns=[*keys, "n", "vals", "rmin", "rmax"])
                out.clear()
        if tiers:
            close()
            yield pd.DataFrame(out, columns=[*keys, "n", "vals", "rmin", "rmax"])

    # a definite order: results do not depend on the order in which shuffled rows arrive
    rows = summaries.select(*keys, "n", "vals", "rmin", "rmax").repartition(*keys).withColumn("__at", F.xxhash64("n", "vals", "rmin", "rmax"))
    rows = rows.sortWithinPartitions(*keys, "n", "__at").drop("__at")
    return rows.mapInPandas(merge, f"{', '.join(f'{k} {kinds[k]}' for k in keys)}, {SUMMARY}")


def merge_summaries(summaries: DataFrame, keys: Sequence[str] = ("dimension", "key", "metric"), eps: float = DEFAULT_EPS) -> DataFrame:
    """Put summaries of separate days or partitions together, one per ``keys``.

    Absolute rank errors add up, and this compression may add ``eps * n / 2`` ranks more; the bound is in the result.
    """
    # a tree of two steps, so that one key's summaries are not all read by one task
    kinds = dict(summaries.dtypes)
    salted = summaries.withColumn("part", F.pmod(F.xxhash64("n", "vals", "rmin"), F.lit(FAN_IN)).cast("long"))
    if not all(k in kinds for k in keys):
        raise ValueError(f"the summaries lack one of the columns {', '.join(keys)}")
    once = _merged(salted, eps, 4, [*keys, "part"])
    return _merged(once.withColumn("part", F.lit(0).cast("long")), eps, 4, [*keys, "part"]).drop("part")


def true_ranks(df: DataFrame, metrics: Sequence[str], groups: dict[str, Column | str], results: DataFrame, probs: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
    """``results`` of ``quantiles`` held against all values: ``dimension, key, metric, n, within_bound``.

    For each probability the ranks that the answer has among the group's values are counted; ``within_bound`` tells that all lie
    within ``rank_error`` (and half a rank) of the rank asked for. ``results`` must have one row per dimension, key and metric.
    """
    names = list(names or (f"p{round(p * 100):02d}" for p in probs))
    raw = df.select(*(((df[g] if isinstance(g, str) else g).cast("string")).alias(f"g{i}") for i, g in enumerate(groups.values())), *(df[m].cast("double").alias(f"m{i}") for i, m in enumerate(metrics)))
    cells = [F.struct(F.lit(n).alias("dimension"), F.col(f"g{i}").alias("key")) for i, n in enumerate(groups)]
    values = [F.struct(F.lit(m).alias("metric"), F.col(f"m{i}").alias("x")) for i, m in enumerate(metrics)]
    rows = raw.select(F.explode(F.array(*values)).alias("v"), *(f"g{i}" for i in range(len(groups)))).where("v.x IS NOT NULL AND NOT isnan(v.x)")
    rows = rows.select("v.*", F.explode(F.array(*cells)).alias("c")).select("c.*", "metric", "x").withColumn("key", F.coalesce("key", F.lit("*")))
    # values are counted before they meet the results
    rows = rows.groupBy("dimension", "key", "metric", "x").agg(F.count("*").alias("times"))
    asked = results.withColumn("key", F.coalesce("key", F.lit("*"))).select("dimension", "key", "metric", F.col("n").alias("stated"), "rank_error", *names)
    joined = rows.join(asked, ["dimension", "key", "metric"])
    counts = [F.sum(F.when(F.col("x") < F.col(c), F.col("times")).otherwise(0)).alias(f"low_{c}") for c in names]
    counts += [F.sum(F.when(F.col("x") <= F.col(c), F.col("times")).otherwise(0)).alias(f"high_{c}") for c in names]
    out = joined.groupBy("dimension", "key", "metric").agg(F.sum("times").alias("n"), F.max("stated").alias("stated"), F.max("rank_error").alias("rank_error"), *counts)
    ok = F.col("n") == F.col("stated")
    for p, c in zip(probs, names):
        wanted = F.least(F.greatest(F.ceil(F.lit(p) * F.col("n")), F.lit(1)), F.col("n"))
        miss = F.greatest(F.col(f"low_{c}") + 1 - wanted, wanted - F.col(f"high_{c}"), F.lit(0))
        ok = ok & (miss <= F.col("rank_error") + 0.5)
    return out.select("dimension", F.nullif("key", F.lit("*")).alias("key"), "metric", "n", ok.alias("within_bound"))


def quantiles(summaries: DataFrame, probs: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
    """The summaries' other columns, ``n``, one column per probability, ``rank_error`` (ranks) and ``relative_error``."""
    names = list(names or (f"p{round(p * 100):02d}" for p in probs))
    keep, asked = [c for c in summaries.columns if c not in ("vals", "rmin", "rmax", "n")], np.asarray(probs)
    kinds = dict(summaries.dtypes)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for n, v, a, b in zip(pdf["n"], pdf["vals"], pdf["rmin"], pdf["rmax"]):
                if a is None:  # exact: the value at each rank
                    at = np.clip(np.ceil(asked * n), 1, n).astype(np.int64)
                    found = np.asarray(v)[at - 1 if b is None else np.searchsorted(b, at)]
                    rows.append((*found.tolist(), 0.0, 0.0))
                    continue
                s = long(n, v, a, b)
                rows.append((*answer(s, probs), e := rank_error(s), e / n))
            yield pd.concat([pdf[[*keep, "n"]].reset_index(drop=True), pd.DataFrame(rows, columns=[*names, "rank_error", "relative_error"], dtype=float)], axis=1)

    schema = [*(f"{c} {kinds[c]}" for c in keep), "n long", *(f"{c} double" for c in names), "rank_error double", "relative_error double"]
    return summaries.mapInPandas(ask, ", ".join(schema))
