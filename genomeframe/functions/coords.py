"""Positions, closed intervals and regions (1-based), as values and as column predicates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_POSITION = 2**63 - 1


@dataclass(frozen=True, order=True)
class Position:
    """A 1-based position."""

    value: int

    def __post_init__(self) -> None:
        if not 1 <= self.value <= MAX_POSITION:
            raise ValueError(f"a position must be from 1 to {MAX_POSITION}, not {self.value}")

    @classmethod
    def parse(cls, text: str) -> Position:
        return cls(_number(text))

    def get(self) -> int:
        return self.value

    def __int__(self) -> int:
        return self.value

    def __str__(self) -> str:
        return str(self.value)

    def checked_add(self, n: int) -> Position | None:
        """None if the sum is no position."""
        return Position(self.value + n) if 1 <= self.value + n <= MAX_POSITION else None


def _number(text: str) -> int:
    if not (text.isascii() and text.isdigit()):
        raise ValueError(f"not a position: {text!r}")
    return Position(int(text)).value


@dataclass(frozen=True)
class Interval:
    """A closed interval; a missing bound is open."""

    start: int | None = None
    end: int | None = None

    def __post_init__(self) -> None:
        for x in (self.start, self.end):
            if x is not None:
                Position(x)

    @classmethod
    def parse(cls, text: str) -> Interval:
        """``''``, ``'8'`` (from 8 on) or ``'8-13'``."""
        if not text:
            return cls()
        start, dash, end = text.partition("-")
        return cls(_number(start), _number(end) if dash else None)

    def __str__(self) -> str:
        if self.end is None:
            return "" if self.start is None else str(self.start)
        return f"{self.start or 1}-{self.end}"

    def contains(self, position: int | Position) -> bool:
        p = int(position)
        return (self.start is None or p >= self.start) and (self.end is None or p <= self.end)

    def intersects(self, other: Interval) -> bool:
        return (self.end is None or other.start is None or other.start <= self.end) and (other.end is None or self.start is None or self.start <= other.end)

    def contains_column(self, position: Column) -> Column:
        bounds = [F.lit(True)]
        bounds += [position >= self.start] if self.start is not None else []
        bounds += [position <= self.end] if self.end is not None else []
        out = bounds[0]
        for b in bounds[1:]:
            out = out & b
        return out & position.isNotNull()

    def intersects_columns(self, first: Column, last: Column) -> Column:
        """Whether rows that cover ``first..last`` (closed, 1-based) meet this interval; pushes down to the scan."""
        out = first.isNotNull()
        if self.end is not None:
            out = out & (first <= self.end)
        return out & (last >= self.start) if self.start is not None else out


@dataclass(frozen=True)
class Region:
    """An interval on a named reference sequence."""

    name: str
    interval: Interval = Interval()

    @classmethod
    def parse(cls, text: str) -> Region:
        """``'chr1'`` or ``'chr1:100-200'``."""
        if not text:
            raise ValueError("an empty region")
        name, colon, rest = text.rpartition(":")
        if colon:
            try:
                return cls(name, Interval.parse(rest))
            except ValueError:
                pass  # a colon that belongs to the name
        return cls(text)

    @property
    def start(self) -> int | None:
        return self.interval.start

    @property
    def end(self) -> int | None:
        return self.interval.end

    def __str__(self) -> str:
        bounds = str(self.interval)
        return f"{self.name}:{bounds}" if bounds else self.name

    def to_predicate(self, chrom: Column, first: Column, last: Column) -> Column:
        return (chrom == self.name) & self.interval.intersects_columns(first, last)


@dataclass(frozen=True, order=True)
class MappingQuality:
    """0 to 254; 255 means missing and is no value."""

    value: int

    def __post_init__(self) -> None:
        if not 0 <= self.value <= 254:
            raise ValueError("a mapping quality must be from 0 to 254")

    def __int__(self) -> int:
        return self.value


def mapping_quality(col: Column) -> Column:
    """255 is null."""
    return F.nullif(col, F.lit(255).cast("short")).cast("short")


@dataclass(frozen=True, order=True)
class VirtualPosition:
    """Place in a block-compressed file: offset of the block (48 bits) and offset in its data (16 bits)."""

    compressed: int
    uncompressed: int = 0

    def __post_init__(self) -> None:
        if not 0 <= self.compressed < 1 << 48 or not 0 <= self.uncompressed < 1 << 16:
            raise ValueError("a virtual position has 48 and 16 bits")

    @classmethod
    def from_u64(cls, n: int) -> VirtualPosition:
        return cls(n >> 16, n & 0xFFFF)

    def __int__(self) -> int:
        return self.compressed << 16 | self.uncompressed
