"""Flags, coordinates and decoding of alignment columns."""

import struct

import pytest
from pyspark.sql import functions as F

from genomeframe.functions import alignment, flags
from genomeframe.functions.coords import Interval, MappingQuality, Position, Region, VirtualPosition


def test_positions_and_intervals():
    assert Position.parse("8").get() == 8 and Position(2) < Position(3) and int(Position(5).checked_add(2)) == 7
    assert Position(2**63 - 1).checked_add(1) is None
    for bad in (lambda: Position(0), lambda: Position.parse("x"), lambda: Interval.parse("a-b"), lambda: Region.parse(""), lambda: MappingQuality(255), lambda: VirtualPosition(1 << 48)):
        with pytest.raises(ValueError):
            bad()
    assert Interval.parse("8-13") == Interval(8, 13) and Interval.parse("8") == Interval(8) and Interval.parse("") == Interval()
    assert str(Interval(None, 13)) == "1-13" and str(Interval(8)) == "8" and str(Interval()) == ""
    assert Interval(8, 13).contains(13) and not Interval(8, 13).contains(14) and Interval().contains(1)
    assert Interval(8, 13).intersects(Interval(13, 20)) and not Interval(8, 13).intersects(Interval(14)) and Interval(8).intersects(Interval())
    r = Region.parse("chr1:100-200")
    assert (r.name, r.start, r.end, str(r), str(Region.parse("chr1"))) == ("chr1", 100, 200, "chr1:100-200", "chr1")
    assert Region.parse("HLA:01:x").name == "HLA:01:x"
    v = VirtualPosition(3, 7)
    assert int(v) == 3 << 16 | 7 and VirtualPosition.from_u64(int(v)) == v


def test_region_predicate(spark):
    df = spark.createDataFrame([("chr1", 90, 99), ("chr1", 90, 100), ("chr1", 200, 250), ("chr1", 201, 250), ("chr2", 100, 150), (None, 1, 2), ("chr1", None, None)], "c string, a int, b int")
    out = df.where(Region.parse("chr1:100-200").to_predicate(F.col("c"), F.col("a"), F.col("b"))).collect()
    assert [(r["a"], r["b"]) for r in out] == [(90, 100), (200, 250)]


def test_flags(spark):
    df = spark.createDataFrame([(99,), (0,), (None,)], "flags int")
    rows = df.select(*flags.predicates("flags"), flags.all_of("flags", "segmented", "first_segment").alias("both")).collect()
    assert rows[0]["is_segmented"] and rows[0]["is_mate_reverse_complemented"] and rows[0]["is_first_segment"] and not rows[0]["is_unmapped"] and rows[0]["both"]
    assert not any(rows[1]) and rows[2]["is_unmapped"] is None
    with pytest.raises(ValueError):
        flags.has("flags", "nope")


def test_decoding(spark):
    ops = lambda *xs: b"".join(struct.pack("<I", n << 4 | alignment.OPERATIONS.index(o)) for n, o in xs)
    seq = bytes([0x12, 0x48, 0x10])
    rows = [(ops((36, "M")), seq, bytes([0, 40, 2])), (ops((5, "S"), (300, "M"), (2, "I"), (3, "D"), (70000, "N"), (4, "=")), b"", b""), (b"", b"\x11", b"\x01"), (None, None, None)]
    df = spark.createDataFrame(rows, "cigar binary, seq binary, qual binary")
    out = df.select(
        alignment.cigar_text(F.col("cigar")).alias("c"), alignment.reference_length(F.col("cigar")).alias("n"),
        alignment.sequence_text(F.col("seq"), F.lit(5)).alias("s"), alignment.quality_text(F.col("qual")).alias("q"), alignment.alignment_end(F.lit(10), F.col("cigar")).alias("e"),
    ).collect()
    assert [r["c"] for r in out] == ["36M", "5S300M2I3D70000N4=", "*", None]
    assert [r["n"] for r in out] == [36, 70307, 0, None]
    assert [r["s"] for r in out] == ["ACGTA", "", "AA", None]
    assert [r["q"] for r in out][:3] == ["!I#", "", '"']
    assert [r["e"] for r in out] == [45, 70316, 10, None]
