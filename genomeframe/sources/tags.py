"""Further fields of alignments: typed values, the text of SAM and the bytes of BAM.

A tag is ``struct<tag, type, value, i, f, a>``: its name, its type (``A i f Z H``, or ``B`` with the type of the items), its value
as SAM writes it, and the value as a whole number, a float or an array where it is one.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import short

TAG_TYPE = "array<struct<tag:string,type:string,value:string,i:bigint,f:double,a:array<double>>>"
#: Struct letters of the numeric types.
NUMBERS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}


def decode(raw: bytes | None) -> list[tuple]:
    """Tags of a BAM record, in order."""
    out, at, raw = [], 0, bytes(raw or b"")
    while at + 3 <= len(raw):
        name, kind = raw[at : at + 2].decode("latin-1"), chr(raw[at + 2])
        at += 3
        if kind == "A":
            out.append((name, "A", chr(raw[at]), None, None, None))
            at += 1
        elif kind in "ZH":
            stop = raw.index(0, at)
            out.append((name, kind, raw[at:stop].decode("latin-1"), None, None, None))
            at = stop + 1
        elif kind == "B":
            item, n = chr(raw[at]), struct.unpack_from("<i", raw, at + 1)[0]
            values = struct.unpack_from(f"<{n}{NUMBERS[item]}", raw, at + 5)
            at += 5 + struct.calcsize(f"<{n}{NUMBERS[item]}")
            shown = map(short if item == "f" else str, values)
            out.append((name, f"B{item}", ",".join([item, *shown]), None, None, [float(v) for v in values]))
        elif kind in NUMBERS:
            value = struct.unpack_from("<" + NUMBERS[kind], raw, at)[0]
            at += struct.calcsize(NUMBERS[kind])
            out.append((name, "f", short(value), None, float(value), None) if kind == "f" else (name, "i", str(value), value, float(value), None))
        else:
            raise ValueError(f"tag {name} has an unknown type {kind!r}")
    return out


def encode(tags: object) -> bytes:
    """Bytes of BAM from (tag, type, value, ...); whole numbers take the narrowest type."""
    out = b""
    for t in tags if tags is not None else ():
        name, kind, value = (t["tag"], t["type"], t["value"]) if isinstance(t, dict) else t[:3]
        head = name.encode("latin-1")
        if kind == "i":
            n = int(value)
            code = next((c for c, low, high in (("c", -128, 127), ("C", 0, 255), ("s", -32768, 32767), ("S", 0, 65535), ("i", -(1 << 31), (1 << 31) - 1), ("I", 0, (1 << 32) - 1)) if low <= n <= high), None)
            if code is None:
                raise ValueError(f"tag {name} does not fit 32 bits: {n}")
            out += head + code.encode() + struct.pack("<" + NUMBERS[code], n)
        elif kind == "f":
            out += head + b"f" + struct.pack("<f", float(value))
        elif kind[:1] == "B":
            item, *rest = value.split(",")
            values = [float(x) if item == "f" else int(x) for x in rest]
            out += head + b"B" + item.encode() + struct.pack(f"<i{len(values)}{NUMBERS[item]}", len(values), *values)
        else:
            raw = value.encode("latin-1")
            out += head + kind.encode() + (raw[:1] if kind == "A" else raw + b"\0")
    return out


def decoded(data: Column) -> Column:
    """Typed tags of the raw column of BAM."""

    @F.pandas_udf(TAG_TYPE)
    def read(raws: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("tag", "type", "value", "i", "f", "a")
        for raw in raws:
            yield pd.Series([None if x is None else [dict(zip(names, t)) for t in decode(x)] for x in raw])

    return read(data)


def encoded(tags: Column) -> Column:
    """The raw column of BAM from typed tags."""

    @F.pandas_udf("binary")
    def write(lists: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for tags in lists:
            yield pd.Series([encode(x) for x in tags])

    return write(tags)


def from_fields(fields: Column) -> Column:
    """Typed tags of SAM text fields (``NM:i:0``), by built-in functions."""

    def tag(t: Column) -> Column:
        kind, value = F.substring(t, 4, 1), F.substr(t, F.lit(6))
        items = F.slice(F.split(value, ","), 2, 1 << 30)
        return F.struct(
            F.substring(t, 1, 2).alias("tag"), F.when(kind == "B", F.concat(kind, F.substring(value, 1, 1))).otherwise(kind).alias("type"), value.alias("value"),
            F.when(kind == "i", value.try_cast("bigint")).alias("i"), F.when(kind.isin("i", "f"), value.try_cast("double")).alias("f"),
            F.when(kind == "B", F.transform(items, lambda x: x.try_cast("double"))).alias("a"),
        )

    return F.transform(fields, tag)


def to_fields(tags: Column) -> Column:
    """The text fields of SAM from typed tags, as an array."""
    return F.transform(tags, lambda t: F.concat_ws(":", t["tag"], F.substring(t["type"], 1, 1), t["value"]))
