"""Alignment flag bits as column predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The twelve flag bits of the SAM format.
BITS = {
    "segmented": 0x1,
    "properly_segmented": 0x2,
    "unmapped": 0x4,
    "mate_unmapped": 0x8,
    "reverse_complemented": 0x10,
    "mate_reverse_complemented": 0x20,
    "first_segment": 0x40,
    "last_segment": 0x80,
    "secondary": 0x100,
    "qc_fail": 0x200,
    "duplicate": 0x400,
    "supplementary": 0x800,
}


def has(flags: Column | str, name: str) -> Column:
    """True where the named bit is set, null where the flags are null."""
    if name not in BITS:
        raise ValueError(f"unknown flag {name!r}; expected one of {', '.join(BITS)}")
    col = F.col(flags) if isinstance(flags, str) else flags
    return col.bitwiseAND(F.lit(BITS[name])) != 0


def mask(*names: str) -> int:
    """The bits of several flags together."""
    out = 0
    for n in names:
        out |= BITS[n]
    return out


def all_of(flags: Column | str, *names: str) -> Column:
    col = F.col(flags) if isinstance(flags, str) else flags
    return col.bitwiseAND(F.lit(mask(*names))) == mask(*names)


def predicates(flags: Column | str) -> list[Column]:
    """``is_<name>`` for every bit."""
    return [has(flags, n).alias(f"is_{n}") for n in BITS]
