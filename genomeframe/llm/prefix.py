"""Ranks and running sums in a random order within groups, however large one group is.

The order is that of a 64-bit hash, so the range of its values cuts every group into buckets of nearly equal size without
sampling: bucket b of 2**k holds the b-th of the k-bit ranges. A window runs inside each (group, bucket); sums of whole
buckets, one row each, are carried to the buckets behind. No task holds more than a bucket, whatever the group's share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

#: Rows that a bucket should hold about, and bits of a bucket's number that one window counts over.
BUCKET_ROWS, WINDOW_BITS = 50_000, 16


def bits_for(rows: int) -> int:
    """Bits so that a group of all ``rows`` has buckets of about BUCKET_ROWS."""
    return max(1, (max(rows, 1) // BUCKET_ROWS).bit_length())


def random_key(seed: int, *columns: str | Column) -> Column:
    """A 64-bit hash of the columns; equal rows have equal keys in any run, on any number of tasks."""
    return F.xxhash64(F.lit(seed), *columns)


def _before(totals: DataFrame, groups: Sequence[str], names: Sequence[str], bits: int) -> DataFrame:
    """Sums over the buckets before each; more than 2 ** WINDOW_BITS buckets are first summed in blocks of so many."""
    def running(*keys: str) -> dict[str, Column]:
        spec = W.Window.partitionBy(*keys).orderBy("bucket").rowsBetween(W.Window.unboundedPreceding, -1)
        return {n: F.coalesce(F.sum(n).over(spec), F.lit(0)) for n in names}

    if bits <= WINDOW_BITS:
        return totals.withColumns(running(*groups))
    totals = totals.withColumn("block", F.shiftright("bucket", WINDOW_BITS))
    blocks = totals.groupBy(*groups, F.col("block").alias("bucket")).agg(*(F.sum(n).alias(n) for n in names))
    blocks = _before(blocks, groups, names, bits - WINDOW_BITS).select(*groups, F.col("bucket").alias("block"), *(F.col(n).alias(f"{n}_block") for n in names))
    inner = totals.withColumns(running(*groups, "block")).join(blocks, [*groups, "block"])
    return inner.select(*groups, "bucket", *((F.col(n) + F.col(f"{n}_block")).alias(n) for n in names))


def with_running(df: DataFrame, groups: Sequence[str], key: str, sums: dict[str, str], bits: int, ties: Sequence[str] = ()) -> DataFrame:
    """Add, for each ``new: column`` of ``sums``, the sum over the rows of the group before this one in the order of ``key``.

    ``row_number`` is the column ``1``: ``{"rank": "1"}`` counts the rows before. Groups must not be null. Rows that are
    equal in ``key`` and ``ties`` may change places, so these should tell apart all rows that differ.
    """
    df = df.withColumn("bucket", F.shiftright(F.col(key), 64 - bits))
    value = lambda c: F.lit(1).cast("long") if c == "1" else F.col(c).cast("long")
    totals = df.groupBy(*groups, "bucket").agg(*(F.sum(value(c)).alias(f"__{n}") for n, c in sums.items()))
    totals = _before(totals, groups, [f"__{n}" for n in sums], bits)
    inner = W.Window.partitionBy(*groups, "bucket").orderBy(key, *ties).rowsBetween(W.Window.unboundedPreceding, -1)
    df = df.withColumns({n: F.coalesce(F.sum(value(c)).over(inner), F.lit(0)) for n, c in sums.items()})
    df = df.join(totals, [*groups, "bucket"])
    return df.withColumns({n: F.col(n) + F.col(f"__{n}") for n in sums}).drop("bucket", *(f"__{n}" for n in sums))
