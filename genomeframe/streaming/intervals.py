"""Structured Streaming over the same operators: lines become records and intervals meet a fixed set as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.pairwise import DEFAULT_BIN_WIDTH, overlap
from ..operators.records import parse_records
from ..sources.text import sam_columns, vcf_columns


def stream_overlap(stream: DataFrame, fixed: DataFrame, on_cols: Sequence[str] | None = None, bin_width: int = DEFAULT_BIN_WIDTH) -> DataFrame:
    """Pairs of arriving intervals with those of a fixed set: a stream-static equi-join on bins, without state."""
    return overlap(stream, fixed, "join", on_cols, bin_width)


def stream_records(lines: DataFrame) -> DataFrame:
    """``parse_records`` of arriving lines (``line_id, fmt, line``); bad lines carry their errors."""
    return parse_records(lines, spread_rows=False)


def stream_vcf(lines: DataFrame) -> DataFrame:
    """Variants of arriving text lines (column ``value``)."""
    return lines.where(~F.col("value").startswith("#") & (F.col("value") != "")).select(*vcf_columns(F.col("value")))


def stream_sam(lines: DataFrame) -> DataFrame:
    """Alignments of arriving text lines (column ``value``)."""
    return lines.where(~F.col("value").startswith("@") & (F.col("value") != "")).select(*sam_columns(F.col("value")))


def window_counts(records: DataFrame, time_col: str, key_col: str, width: str = "1 day", late: str = "7 days") -> DataFrame:
    """``key, window_start, n`` per tumbling window of event time; rows later than ``late`` are dropped with their window."""
    rows = records.select(F.col(time_col).alias("at"), F.col(key_col).alias("key")).withWatermark("at", late)
    out = rows.groupBy(F.window("at", width).alias("w"), "key").agg(F.count("*").alias("n"))
    return out.select("key", F.col("w.start").alias("window_start"), "n")
