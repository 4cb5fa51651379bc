"""Per-key results in equal-sized chunks, when a few keys hold most rows.

Method: exact offset chunking. The rows of each key are counted per input part (a split of a file, or a range of the order
column); prefix sums of these counts over the parts give each (part, key) its offset; a row's exact number within its key is
its part's offset plus its place among the part's rows of the key; numbers are cut into chunks of equal size; each chunk's
rows are reduced to small states where they are read; the states of a key are merged in the order of its chunks.

Rows are not shuffled to be numbered: a task reads its part in order and counts. Only counts, offsets and states travel, so a key
that holds most rows costs no task more than its part of the input.

The order of rows is declared: ``order`` names columns, otherwise it is that of the files' names and of the rows in them. Neither
depends on the number of tasks or on how files are split. A DataFrame that does not come from files needs ``order`` (or
``stable=True``, which says that it reads the same each time, in the order wanted).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from ..session import cut, shared_folder

DEFAULT_CHUNK_ROWS = 100_000
#: monotonically_increasing_id keeps the partition above this bit and the row's place in it below.
PARTITION_SHIFT = 33
STATE = "run long, chunk long, at long, n_rows long, n_values long, first_value double, last_value double, inversions long, longest_step double"


def _plain_key(df: DataFrame) -> DataFrame:
    """Keys in a form without nulls, so that equi-joins keep null keys: ``is_null, k``."""
    kind = df.schema["k"].dataType
    text = F.hex("k") if isinstance(kind, T.BinaryType) else F.col("k").cast("string")
    plain = F.coalesce("k", F.lit(0).cast(kind)) if isinstance(kind, T.IntegralType) else F.coalesce(text, F.lit(""))
    return df.withColumn("is_null", F.col("k").isNull()).withColumn("k", plain)


def _placed(df: DataFrame, columns: Sequence[Column], order: Sequence[str], stable: bool) -> DataFrame:
    """The columns with ``file, part, place``: parts in order of (file, part), rows in order of ``place`` inside a part."""
    if order:
        named = df.select(*columns, *(df[c].alias(f"__o{i}") for i, c in enumerate(order)))
        keys = [F.col(f"__o{i}").asc_nulls_first() for i in range(len(order))]
        # written once: a range partitioning samples its input, so it must not be computed twice
        df = cut(named.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*(f"__o{i}" for i in range(len(order)))))
        columns = [F.col(f"`{c}`") for c in df.columns]
    elif not stable:
        try:
            return df.select(*columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("place"))
        except AnalysisException:
            df = cut(df.select(*columns))
            columns = [F.col(f"`{c}`") for c in df.columns]
    at = F.monotonically_increasing_id()
    return df.select(*columns, F.lit("").alias("file"), F.shiftright(at, PARTITION_SHIFT).alias("part"), at.alias("place"))


def _offsets(rows: DataFrame) -> DataFrame:
    """``file, part, is_null, k, offset``: rows of the key in the parts before."""
    counts = rows.groupBy("file", "part", "is_null", "k").agg(F.count("*").alias("n"))
    before = W.Window.partitionBy("is_null", "k").orderBy("file", "part").rowsBetween(W.Window.unboundedPreceding, -1)
    return counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))


def number_rows(df: DataFrame, key: str, chunk_rows: int = DEFAULT_CHUNK_ROWS, order: Sequence[str] = (), stable: bool = False) -> DataFrame:
    """Add ``row_no`` (from 0, dense within each key, in the declared order) and ``chunk`` to every row.

    A null key is a key like any other. Input columns of these names come out with the suffix ``_in``. An empty input
    gives no rows. Whole rows are shuffled here, since each comes out with its number; ``chunk_states`` does without.
    """
    if chunk_rows < 1:
        raise ValueError("chunk_rows must be positive")
    names = [f"{c}_in" if c.lower() in ("row_no", "chunk") else c for c in df.columns]
    row = F.struct(*(df[c].alias(f"c{i}") for i, c in enumerate(df.columns)))
    rows = _plain_key(_placed(df, [row.alias("row"), df[key].alias("k")], order, stable))
    keys = ["file", "part", "is_null", "k"]
    local = F.row_number().over(W.Window.partitionBy(*keys).orderBy("place")) - 1
    numbered = rows.withColumn("local", local).join(_offsets(rows), keys)
    row_no = F.col("local") + F.col("offset")
    return numbered.select(
        *(F.col(f"row.c{i}").alias(n) for i, n in enumerate(names)),
        row_no.cast("long").alias("row_no"), F.floor(row_no / chunk_rows).cast("long").alias("chunk"),
    )


def _reduce(chunk_rows: int):
    """States of rows that come sorted by run (a key's rows of one part) and place: one for each run and chunk in a batch."""

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_run, done = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            run, offset = batch.column("run").to_numpy(), batch.column("offset").to_numpy()
            value = batch.column("value").to_numpy(zero_copy_only=False).astype(float)
            begins = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
            sizes = np.diff(np.append(begins, len(run)))
            local = np.arange(len(run)) - np.repeat(begins, sizes)
            if run[0] == last_run:
                local[: sizes[0]] += done
            last_run, done = run[-1], int(local[-1]) + 1
            number = offset + local
            chunk = number // chunk_rows
            edges = np.flatnonzero(np.append(True, (run[1:] != run[:-1]) | (chunk[1:] != chunk[:-1])))
            group = np.repeat(np.arange(len(edges)), np.diff(np.append(edges, len(run))))
            there = np.flatnonzero(~np.isnan(value))
            own, values = group[there], value[there]
            inner = own[1:] == own[:-1]
            step = np.where(inner, values[1:] - values[:-1], -np.inf)
            n = len(edges)
            m = np.bincount(own, minlength=n)
            longest = np.full(n, -np.inf)
            np.maximum.at(longest, own[1:], step)
            first, final = np.full(n, np.nan), np.full(n, np.nan)
            first[own[::-1]], final[own] = values[::-1], values
            falls = np.bincount(own[1:], weights=inner & (values[1:] < values[:-1]), minlength=n).astype(np.int64) if len(own) else np.zeros(n, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(run[edges]), pa.array(chunk[edges]), pa.array(number[edges]), pa.array(np.bincount(group, minlength=n)), pa.array(m),
                    pa.array(first, mask=m == 0), pa.array(final, mask=m == 0), pa.array(falls), pa.array(longest, mask=m < 2),
                ],
                [x.split(" ")[0] for x in STATE.split(", ")],
            )

    return states


def chunk_states(df: DataFrame, key: str, value: str, chunk_rows: int = DEFAULT_CHUNK_ROWS, order: Sequence[str] = (), stable: bool = False) -> DataFrame:
    """One row per key and chunk: the boundary state of its rows in the declared order.

    ``key, chunk, n_rows, n_values, first_value, last_value, inversions, longest_step``. Values that are null (or NaN) are
    not values. ``inversions`` counts values below the one before, ``longest_step`` is the largest difference upwards.
    """
    if chunk_rows < 1:
        raise ValueError("chunk_rows must be positive")
    rows = _placed(df, [df[key].alias("k"), df[value].cast("double").alias("value")], order, stable)
    kind = rows.schema["k"].dataType
    rows = _plain_key(rows)
    # offsets are written: their size is then known, and the planner broadcasts them only if they are small
    path = shared_folder(df.sparkSession)
    _offsets(rows.drop("value")).withColumn("run", F.monotonically_increasing_id()).write.parquet(path)
    offsets = df.sparkSession.read.parquet(path)
    keys = ["file", "part", "is_null", "k"]
    numbered = rows.join(offsets, keys).select("run", "offset", "place", "value").sortWithinPartitions("run", "place").drop("place")
    states = numbered.mapInArrow(_reduce(chunk_rows), STATE)
    names = offsets.select("run", F.when(~F.col("is_null"), F.unhex("k") if isinstance(kind, T.BinaryType) else F.col("k")).cast(kind).alias("key"))
    # a chunk's rows may lie in several runs and batches; ``at`` is the number of a state's first row
    return _merged(states.join(names, "run"), ["key", "chunk"], "at")


def _merged(states: DataFrame, keys: Sequence[str], order: str, more: Sequence[Column] = ()) -> DataFrame:
    """States of the same keys put together in order: the steps across their borders are added."""
    spec = W.Window.partitionBy(*keys).orderBy(order)
    previous = F.last("last_value", ignorenulls=True).over(spec.rowsBetween(W.Window.unboundedPreceding, -1))
    states = states.withColumn("border", F.col("first_value") - previous)
    has = F.when(F.col("n_values") > 0, F.col(order))
    return states.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), *more, F.sum("n_values").alias("n_values"),
        F.min_by("first_value", has).alias("first_value"), F.max_by("last_value", has).alias("last_value"),
        (F.sum("inversions") + F.count(F.when(F.col("border") < 0, 1))).alias("inversions"),
        F.greatest(F.max("longest_step"), F.max("border")).alias("longest_step"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    """One row per key from its chunks' states, merged in the order of the chunks."""
    return _merged(states, ["key"], "chunk", [F.count("*").alias("n_chunks")])


def per_key(df: DataFrame, key: str, value: str, chunk_rows: int = DEFAULT_CHUNK_ROWS, order: Sequence[str] = (), stable: bool = False) -> DataFrame:
    """Per key: ``key, n_rows, n_chunks, n_values, first_value, last_value, inversions, longest_step`` in the declared order.

    Null keys form a group of their own; a key without values has null first, last and step. Equal neighbours are no
    inversion. An empty input gives no rows.
    """
    return merge_states(chunk_states(df, key, value, chunk_rows, order, stable))


def heavy_keys(results: DataFrame, share: float = 0.05) -> DataFrame:
    """Of the results of ``per_key``, the keys that hold at least ``share`` of all rows: ``key, n_rows``."""
    total = results.agg(F.sum("n_rows")).scalar()
    return results.where(F.col("n_rows") >= F.lit(share) * total).select("key", "n_rows")


def across(tables: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Rows of several ``heavy_keys`` results with the table's name; a null key is written ``*``."""
    parts = [df.select(F.lit(name).alias("table_name"), F.coalesce(F.col("key").cast("string"), F.lit("*")).alias("key_value"), "n_rows") for name, df in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out
