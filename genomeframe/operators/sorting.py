"""Order of intervals by chromosome and start."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..roles import pack, resolve_roles, unpack

LAST = 2**63 - 1


def natural_key(chrom: Column) -> tuple[Column, Column]:
    """The name without its trailing digits, and these digits as a number (the largest long if none, or too many)."""
    number = F.regexp_extract(chrom, "([0-9]+)$", 1).try_cast("bigint")
    return F.regexp_replace(chrom, "[0-9]+$", ""), F.coalesce(number, F.lit(LAST))


def order_columns(natural_chrom_order: bool = True) -> list[Column]:
    """Sort keys over packed rows; the end and the rest of the row only make the order definite."""
    if natural_chrom_order:
        prefix, number = natural_key(F.col("k0"))
        first = [prefix.asc_nulls_last(), F.when(F.col("k0").isNotNull(), number).asc_nulls_last()]
    else:
        first = [F.col("k0").asc_nulls_last()]
    return [*first, F.col("s").asc_nulls_last(), F.col("e").asc_nulls_last()]


def sort_bedframe(df: DataFrame, natural_chrom_order: bool = True) -> DataFrame:
    """All rows, ordered by chromosome (chr2 before chr10 if natural) and start; nulls last. One range-partitioned sort."""
    resolve_roles(df)
    return pack(df).orderBy(*order_columns(natural_chrom_order)).select(*unpack(df.columns))
