"""Islands of overlapping intervals and the gaps between them, for any number of key columns.

Method: sort by start per entity, compare each start with the running maximum of the ends before it, label the islands
cumulatively, aggregate each island, and read the gaps from the rows that open an island. Both running values are
carried from bin to bin (``carry``), so a key that holds a third of all rows is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import carry


def distinct_starts(df: DataFrame, keys: Sequence[str], empties: bool = True) -> DataFrame:
    """``keys, s, e, n``: one row per key and start with its largest end; this bounds a bin by its width in positions.

    Zero-length intervals stay apart from the others at the same start, with their number ``n``; ``n`` is 1 for others.
    Without ``empties`` the input has none, and ``n`` is 1 throughout.
    """
    if not empties:
        return df.groupBy(*keys, "s").agg(F.max("e").alias("e")).withColumn("n", F.lit(1).cast("long"))
    empty = F.col("s") >= F.col("e")
    out = df.groupBy(*keys, "s", empty.alias("empty")).agg(F.max("e").alias("e"), F.count("*").alias("n"))
    return out.select(*keys, "s", "e", F.when(F.col("empty"), F.col("n")).otherwise(F.lit(1)).cast("long").alias("n"))


def flagged_starts(df: DataFrame, keys: Sequence[str], empties: bool = True) -> DataFrame:
    """The distinct starts of ``df`` (keys, s, e without nulls) with ``prev_end`` and ``opens``.

    ``prev_end`` is the largest end of all rows of the key before this one; ``opens`` tells that the row starts an island.
    Touching intervals (start = previous end) open a new island.
    """
    starts = carry.with_bin(distinct_starts(df, keys, empties), "s")
    starts = carry.with_carry(
        starts, keys, {"bin_end": F.max("e")}, {"carried_end": lambda spec: F.max("bin_end").over(carry.before(spec))}, source=carry.with_bin(df, "s")
    )
    local = F.max("e").over(carry.before(carry.inside(keys, "s", "e")))
    starts = starts.withColumn("prev_end", F.greatest(local, F.col("carried_end"))).drop("carried_end")
    return starts.withColumn("opens", F.col("prev_end").isNull() | (F.col("s") >= F.col("prev_end")))


def with_island(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``island``, the start, end and number of the row that opened the island of each row."""
    df = df.withColumn("opening", F.when(F.col("opens"), F.struct("s", "e", "n")))
    df = carry.with_carry(
        df,
        keys,
        {"bin_opening": F.max("opening")},
        {"carried_opening": lambda spec: F.max("bin_opening").over(carry.before(spec))},
    )
    local = F.max("opening").over(carry.upto(carry.inside(keys, "s", "e")))
    return df.withColumn("island", F.coalesce(local, F.col("carried_opening"))).drop("carried_opening", "opening")


def periods(flagged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, s, e`` of each island of ``flagged_starts``."""
    out = with_island(flagged, keys).groupBy(*keys, "island").agg(F.max("e").alias("e"))
    # a zero-length interval that nothing covers is an island by itself, each time it occurs
    copies = F.when(F.col("island.s") >= F.col("e"), F.col("island.n")).otherwise(F.lit(1))
    out = out.select(*keys, F.col("island.s").alias("s"), "e", F.explode(F.sequence(F.lit(1).cast("long"), copies.cast("long"))).alias("copy"))
    return out.drop("copy")


def periods_and_gaps(df: DataFrame, entity: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """Continuous periods of each entity's intervals, and the gaps between neighbouring periods.

    Result: ``entity..., kind ('period' or 'gap'), seg_start, seg_end``. Intervals that share a position form one period;
    touching ones stay two periods without a gap. Nothing is reported before the first or after the last period.
    Rows with a null entity column, start or end, and rows whose end does not exceed their start, take no part.
    Repeated rows count once. An empty input gives no rows. Other columns, whatever their names, are ignored.
    """
    entity = list(entity)
    safe = df.select(*(df[c].alias(f"k{i}") for i, c in enumerate(entity)), df[start].alias("s"), df[end].alias("e"))
    keys = [f"k{i}" for i in range(len(entity))]
    safe = safe.where(" AND ".join(f"{c} IS NOT NULL" for c in [*keys, "s", "e"]) + " AND e > s")
    flagged = flagged_starts(safe, keys, empties=False)
    names = [F.col(k).alias(c) for k, c in zip(keys, entity)]
    found = periods(flagged, keys).select(*names, F.lit("period").alias("kind"), F.col("s").alias("seg_start"), F.col("e").alias("seg_end"))
    gaps = flagged.where("opens AND prev_end < s").select(*names, F.lit("gap").alias("kind"), F.col("prev_end").alias("seg_start"), F.col("s").alias("seg_end"))
    return found.unionAll(gaps)
