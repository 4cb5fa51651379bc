"""Set algebra on positions: intersect, union and difference of two interval sets; results are ``chrom, start, end``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..roles import bare
from . import carry, islands
from .pairwise import DEFAULT_BIN_WIDTH, _pairs
from .single import merge


def _positions(df: DataFrame) -> DataFrame:
    return bare(df).select(F.col("k0").alias("chrom"), F.col("s").alias("start"), F.col("e").alias("end"))


def _steps(df: DataFrame, side: str) -> DataFrame:
    """Endpoints of the rows of a side: where rows start and end, and where zero-length ones lie."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    blank = {f"{what}_{x}": none for what in ("starts", "ends", "empty") for x in "ab"}
    step = lambda pos, what: F.struct(F.col(pos).alias("pos"), *((one if n == f"{what}_{side}" else v).alias(n) for n, v in blank.items()))
    points = F.when(F.col("s") < F.col("e"), F.array(step("s", "starts"), step("e", "ends"))).otherwise(F.array(step("s", "empty")))
    return bare(df).select("k0", F.explode(points).alias("x")).select("k0", "x.*")


def intersect_ranges(a: DataFrame, b: DataFrame) -> DataFrame:
    """What rows of a and rows of b share, pair by pair, merged; touching pieces stay apart.

    No pairs are formed: one sweep over the endpoints of both sides counts the rows of each side over every stretch between two
    endpoints, and those that go on through an endpoint. A stretch that both sides cover is part of the result; it continues the one
    before it if rows of both sides go through the endpoint between them. A zero-length row inside a row of the other side
    gives a zero-length piece, once a place, unless it lies inside a longer piece.
    """
    columns = [f"{what}_{x}" for what in ("starts", "ends", "empty") for x in "ab"]
    steps = _steps(a, "a").unionAll(_steps(b, "b")).groupBy("k0", "pos").agg(*(F.sum(c).alias(c) for c in columns))
    steps = carry.with_bin(steps, "pos")
    total = lambda c: lambda spec: F.coalesce(F.sum(c).over(carry.before(spec)), F.lit(0))
    steps = carry.with_carry(
        steps, ["k0"], {"bin_a": F.sum(F.col("starts_a") - F.col("ends_a")), "bin_b": F.sum(F.col("starts_b") - F.col("ends_b")), "bin_pos": F.min("pos")},
        {"carried_a": total("bin_a"), "carried_b": total("bin_b"), "next_pos": lambda spec: F.lead("bin_pos").over(spec)},
    )
    spec = carry.inside(["k0"], "pos")
    depth = {x: F.sum(F.col(f"starts_{x}") - F.col(f"ends_{x}")).over(carry.upto(spec)) + F.col(f"carried_{x}") for x in "ab"}
    rows = steps.withColumns({"end": F.coalesce(F.lead("pos").over(spec), "next_pos"), "depth_a": depth["a"], "depth_b": depth["b"]})
    through_a, through_b = F.col("depth_a") - F.col("starts_a") > 0, F.col("depth_b") - F.col("starts_b") > 0
    covered = (F.col("depth_a") > 0) & (F.col("depth_b") > 0)
    lone = ((F.col("empty_a") > 0) & through_b & ~through_a) | ((F.col("empty_b") > 0) & through_a & ~through_b)
    rows = rows.select("k0", "bin", "pos", "end", covered.alias("covered"), lone.alias("lone"), F.when(covered & ~(through_a & through_b), F.col("pos")).alias("opening"))
    rows = rows.where("covered OR lone")
    parts = carry.with_carry(rows.where("covered"), ["k0"], {"bin_opening": F.max("opening")}, {"carried": lambda spec: F.max("bin_opening").over(carry.before(spec))})
    parts = parts.withColumn("start", F.coalesce(F.max("opening").over(carry.upto(spec)), "carried")).groupBy("k0", "start").agg(F.max("end").alias("end"))
    out = parts.unionAll(rows.where("lone").select("k0", F.col("pos").alias("start"), F.col("pos").alias("end")))
    return out.select(F.col("k0").alias("chrom"), "start", "end")


def union_ranges(a: DataFrame, b: DataFrame) -> DataFrame:
    """The merged intervals of both sets."""
    return merge(_positions(a).unionByName(_positions(b)))


def setdiff_ranges(a: DataFrame, b: DataFrame, bin_width: int = DEFAULT_BIN_WIDTH) -> DataFrame:
    """What is left of each row of a without the positions of b.

    b is merged, a is not: overlapping or equal rows of a give overlapping or equal results. What is left of a row lies
    before b's first period, in a gap between two periods, or after the last; so each row meets gaps only and no window
    over a row's hits is needed. On a chromosome that b lacks, rows are kept as they are, empty ones too.
    """
    rows, other = bare(a), bare(b)
    flagged = islands.flagged_starts(other, ["k0"])
    gaps = flagged.where("opens AND prev_end < s").select("k0", F.col("prev_end").alias("s"), F.col("s").alias("e"))
    inner = _pairs(rows, gaps, ["k0"], bin_width)
    inner = inner.select(F.col("a_k0").alias("k0"), F.greatest("a_s", "b_s").alias("s"), F.least("a_e", "b_e").alias("e"))
    bounds = other.groupBy("k0").agg(F.min("s").alias("first"), F.max("e").alias("last"))
    outer = rows.join(bounds, "k0", "left")
    parts = F.array(F.struct(F.col("s"), F.least("e", "first").alias("e")), F.struct(F.greatest("s", "last").alias("s"), F.col("e")))
    outer = outer.select("k0", F.col("first").isNull().alias("kept"), F.explode(F.when(F.col("first").isNull(), F.array(F.struct("s", "e"))).otherwise(parts)).alias("x"))
    outer = outer.where("kept OR x.s < x.e").select("k0", "x.s", "x.e")
    out = inner.where("s < e").unionAll(outer)
    return out.select(F.col("k0").alias("chrom"), F.col("s").alias("start"), F.col("e").alias("end"))
