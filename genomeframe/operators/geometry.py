"""Row-wise changes of intervals. Other columns pass through; null coordinates stay null. No shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..roles import pack, resolve_roles, unpack

#: Starts are clamped to this value.
FIRST = 1


def _half(c: Column) -> Column:
    """Integer division by two that truncates toward zero."""
    return F.when(c < 0, -F.shiftright(-c, 1)).otherwise(F.shiftright(c, 1))


def _replaced(df: DataFrame, start: Column, end: Column, packed: DataFrame | None = None) -> DataFrame:
    roles, packed = resolve_roles(df), pack(df) if packed is None else packed
    out = []
    for name, col in zip(df.columns, unpack(df.columns)):
        new = {roles.start: (start, "s"), roles.end: (end, "e")}.get(name)
        out.append(new[0].cast(packed.schema[new[1]].dataType).alias(name) if new else col)
    return packed.select(*out)


def expand(df: DataFrame, amount: int = 0, start_amount: int | None = None, end_amount: int | None = None) -> DataFrame:
    left, right = (amount if x is None else x for x in (start_amount, end_amount))
    return _replaced(df, F.when(F.col("s").isNotNull(), F.greatest(F.col("s") - left, F.lit(FIRST))), F.col("e") + right)


def shift(df: DataFrame, amount: int) -> DataFrame:
    """Move by ``amount``; an interval that would begin before the first position keeps its width."""
    moved = F.col("s") + amount
    start = F.when(F.col("s").isNotNull(), F.greatest(moved, F.lit(FIRST)))
    return _replaced(df, start, F.when(moved < FIRST, F.col("e") - F.col("s") + FIRST).otherwise(F.col("e") + amount))


def flank(df: DataFrame, width: int, start: bool = True) -> DataFrame:
    """The ``width`` positions before the start, or after the end."""
    if start:
        return _replaced(df, F.when(F.col("s").isNotNull(), F.greatest(F.col("s") - width, F.lit(FIRST))), F.col("s"))
    return _replaced(df, F.col("e"), F.col("e") + width)


def set_width(df: DataFrame, width: int, anchor: str = "start") -> DataFrame:
    if anchor == "start":
        return _replaced(df, F.col("s"), F.col("s") + width)
    if anchor == "end":
        return _replaced(df, F.when(F.col("e").isNotNull(), F.greatest(F.col("e") - width, F.lit(FIRST))), F.col("e"))
    if anchor == "center":
        mid = _half(F.col("s") + F.col("e"))
        return _replaced(df, F.when(mid.isNotNull(), F.greatest(mid - width // 2, F.lit(FIRST))), mid + (width + 1) // 2)
    raise ValueError("anchor must be 'start', 'end' or 'center'")


def tile(df: DataFrame, width: int) -> DataFrame:
    """Cut each interval into pieces of ``width`` from its start on; the last may be shorter, empty intervals vanish."""
    if width <= 0:
        raise ValueError("width must be positive")
    packed = pack(df).where("s < e")
    step = F.lit(width).cast(packed.schema["s"].dataType)
    packed = packed.withColumn("t", F.explode(F.sequence(F.col("s"), F.col("e") - 1, step)))
    return _replaced(df, F.col("t"), F.least(F.col("t") + width, F.col("e")), packed)
