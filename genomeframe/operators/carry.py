"""Running values over sorted positions without one task per key.

A running maximum or sum per chromosome would put the whole chromosome into one window. Here each key's positions are
cut into bins of ``2 ** BIN_SHIFT`` positions. A window runs inside each (key, bin); one row per (key, bin) then passes
what the bins before it hold. The second window sees at most (span / bin width) rows a key: 131,072 for 32-bit
positions at the default width, whatever the number of intervals.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

BIN_SHIFT = 14


def with_bin(df: DataFrame, pos: str, shift: int = BIN_SHIFT) -> DataFrame:
    return df.withColumn("bin", F.shiftright(F.col(pos), shift).cast("long"))


def inside(keys: Sequence[str], *order: Column | str) -> W.WindowSpec:
    return W.Window.partitionBy(*keys, "bin").orderBy(*order)


def before(spec: W.WindowSpec) -> W.WindowSpec:
    return spec.rowsBetween(W.Window.unboundedPreceding, -1)


def upto(spec: W.WindowSpec) -> W.WindowSpec:
    return spec.rowsBetween(W.Window.unboundedPreceding, 0)


def with_carry(
    df: DataFrame,
    keys: Sequence[str],
    per_bin: dict[str, Column],
    carried: dict[str, Callable[[W.WindowSpec], Column]],
    source: DataFrame | None = None,
    backward: dict[str, Callable[[W.WindowSpec], Column]] | None = None,
) -> DataFrame:
    """Add to each row what the other bins of its key hold.

    ``per_bin`` aggregates each (key, bin); ``carried`` maps a new column to an expression over a window of these
    aggregates in the order of the bins, ``backward`` the same in reverse order. Keys must not be null. ``source`` has rows whose aggregates are the same as those of
    ``df`` but that cost less to reach: the aggregation then begins in the scan's tasks and shuffles one row per bin.
    """
    ahead, back = (W.Window.partitionBy(*keys).orderBy(order) for order in (F.col("bin").asc(), F.col("bin").desc()))
    bins = (df if source is None else source).groupBy(*keys, "bin").agg(*(c.alias(n) for n, c in per_bin.items()))
    bins = bins.select(*keys, "bin", *(f(ahead).alias(n) for n, f in carried.items()), *(f(back).alias(n) for n, f in (backward or {}).items()))
    return df.join(bins, [*keys, "bin"])
