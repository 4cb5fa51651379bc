"""Which columns of a DataFrame are the chromosome, the start and the end of its intervals.

The operators work on *packed* frames: the whole input row in one struct ``row`` with positional field names, beside
the grouping keys ``k0, k1, ...`` and the coordinates ``s`` and ``e``. No input column can clash with a helper column
this way, whatever its name is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHROM_NAMES = ("chrom", "contig", "chr")
START_NAMES = ("start", "pos")
END_NAMES = ("end", "stop")


@dataclass(frozen=True)
class Roles:
    chrom: str
    start: str
    end: str


def resolve_roles(df: DataFrame) -> Roles:
    """The first candidate present wins, names are case-sensitive; a missing role raises ValueError."""

    def pick(role: str, candidates: Sequence[str]) -> str:
        for name in candidates:
            if name in df.columns:
                return name
        raise ValueError(f"no {role} column: expected one of {', '.join(candidates)}; got {', '.join(df.columns)}")

    return Roles(pick("chromosome", CHROM_NAMES), pick("start", START_NAMES), pick("end", END_NAMES))


def check_on_cols(df: DataFrame, on_cols: Sequence[str] | None) -> list[str]:
    cols = list(on_cols or [])
    for name in cols:
        if name not in df.columns:
            raise ValueError(f"on_cols names {name!r}, which is not a column")
    return cols


def key_names(on_cols: Sequence[str] | None) -> list[str]:
    return [f"k{i}" for i in range(1 + len(list(on_cols or [])))]


def _coordinate(df: DataFrame, position: int) -> Column:
    col = df[df.columns[position]]
    kind = df.schema[position].dataType
    return col if isinstance(kind, (T.IntegerType, T.LongType)) else col.cast("long")


def pack(df: DataFrame, on_cols: Sequence[str] | None = None) -> DataFrame:
    """``row, k0.., s, e``. Keys are compared as strings, so whole-number keys group as well."""
    roles, names = resolve_roles(df), df.columns
    keys = [roles.chrom, *check_on_cols(df, on_cols)]
    safe = df.toDF(*(f"c{i}" for i in range(len(names))))
    return safe.select(
        F.struct(*safe.columns).alias("row"),
        *(safe[f"c{names.index(k)}"].cast("string").alias(f"k{i}") for i, k in enumerate(keys)),
        _coordinate(safe, names.index(roles.start)).alias("s"),
        _coordinate(safe, names.index(roles.end)).alias("e"),
    )


def bare(df: DataFrame, on_cols: Sequence[str] | None = None) -> DataFrame:
    """Keys and coordinates only, of the rows that have all of them."""
    return complete(pack(df, on_cols).drop("row"), key_names(on_cols))


def complete(packed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return packed.where(" AND ".join(f"{c} IS NOT NULL" for c in [*keys, "s", "e"]))


def unpack(names: Sequence[str], prefix: str = "", source: str = "row", new: Sequence[str] = ()) -> list[Column]:
    """The input's columns again. One that bears the name of a column the operator adds gets the suffix ``_in``."""
    taken = {n.lower() for n in new}

    def out(name: str) -> str:
        full = prefix + name
        while full.lower() in taken:
            full += "_in"
        return full

    return [F.col(f"{source}.c{i}").alias(out(n)) for i, n in enumerate(names)]
