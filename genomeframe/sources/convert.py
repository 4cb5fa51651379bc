"""From the BAM columns to the SAM columns and back, by built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import alignment
from . import tags
from .bam import SCHEMA
from .headers import SamHeader
from .text import SAM_COLUMNS

BAM_COLUMNS = tuple(x.split(" ")[0] for x in SCHEMA.split(", "))


def _names(header: SamHeader) -> list[str]:
    """Reference names by id; a header is a small object."""
    return list(header.reference_sequences())


def bam_to_sam(df: DataFrame, header: SamHeader) -> DataFrame:
    """SAM columns, and the typed tags as ``data`` if there is a column ``tags`` or ``data``; ids that the header lacks give null names."""
    names = F.array(*(F.lit(n) for n in _names(header))) if _names(header) else F.array().cast("array<string>")
    name = lambda c: F.get(names, F.col(c)).cast("binary")
    bare = lambda c: F.when(c == "*", F.lit("")).otherwise(c).cast("binary")
    new: dict[str, Column] = {
        "reference_sequence_name": name("reference_sequence_id"),
        "mate_reference_sequence_name": name("mate_reference_sequence_id"),
        "cigar": bare(alignment.cigar_text(F.col("cigar"))),
        "sequence": alignment.sequence_text(F.col("sequence"), F.when(F.length("quality_scores") > 0, F.length("quality_scores")).otherwise(2 * F.length("sequence"))).cast("binary"),
        "quality_scores": bare(alignment.quality_text(F.col("quality_scores"))),
    }
    further = [F.col("tags").alias("data")] if "tags" in df.columns else [tags.decoded(F.col("data")).alias("data")] if "data" in df.columns else []
    return df.select(*(new.get(c, F.col(c)).alias(c) for c in SAM_COLUMNS), *further)


def sam_to_bam(df: DataFrame, header: SamHeader) -> DataFrame:
    """BAM columns; names that the header lacks give null ids. Typed tags in ``data`` become the raw ``data`` of BAM."""
    ids = F.array(*(F.lit(n) for n in _names(header))) if _names(header) else F.array().cast("array<string>")

    def ident(c: str) -> Column:
        at = F.array_position(ids, F.col(c).cast("string"))
        return F.when(at > 0, at - 1).cast("int")

    text = lambda c: F.col(c).cast("string")
    new: dict[str, Column] = {
        "reference_sequence_id": ident("reference_sequence_name"),
        "mate_reference_sequence_id": ident("mate_reference_sequence_name"),
        "cigar": alignment.cigar_binary(text("cigar")),
        "sequence": alignment.sequence_binary(text("sequence")),
        "quality_scores": alignment.quality_binary(text("quality_scores")),
        "data": tags.encoded(F.col("data")) if "data" in df.columns else F.lit(b""),
    }
    return df.select(*(new.get(c, F.col(c)).alias(c) for c in BAM_COLUMNS))
