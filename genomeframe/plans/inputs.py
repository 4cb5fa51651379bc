"""The test tables and the interval views that the queries read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def variant_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """Variants as 0-based half-open intervals: ``pos - 1`` up to the end of the reference bases."""
    v = table(spark, folder, "variants")
    return v.select("variant_id", "chrom", (F.col("pos") - 1).alias("start"), (F.col("pos") - 1 + F.length("ref")).alias("end"), "sample_id", "info_dp")


def tracks(spark: SparkSession, folder: str) -> DataFrame:
    """Track intervals that are intervals: an end that does not exceed the start is dirt, nulls stay."""
    t = table(spark, folder, "track_intervals")
    return t.where("start IS NULL OR end IS NULL OR end > start").select("interval_id", "track_id", "sample_id", "chrom", "start", "end", "strand")


def order_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """Intervals made from orders: 22 chromosomes, short and evenly spread."""
    start = (F.col("o_orderkey") * 37 % 100000).cast("int")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("chr"), F.col("o_custkey") % 22 + 1).alias("chrom"), start.alias("start"), (start + 1 + (F.col("o_custkey") % 50)).cast("int").alias("end")
    )


def event_intervals(spark: SparkSession, folder: str) -> DataFrame:
    start = (F.col("event_id") * 7919 % 100000).cast("int")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"), F.concat(F.lit("chr"), F.col("user_id") % 22 + 1).alias("chrom"), start.alias("start"), (start + 1 + (F.col("event_id") % 50)).cast("int").alias("end")
    )


#: The views of orders and events in SQL.
PLAIN_VIEWS = """WITH v AS (SELECT o_orderkey AS id, 'chr' || (o_custkey % 22 + 1) AS chrom, CAST(o_orderkey * 37 % 100000 AS INTEGER) AS "start", CAST(o_orderkey * 37 % 100000 + 1 + o_custkey % 50 AS INTEGER) AS "end" FROM orders),
t AS (SELECT event_id AS id, 'chr' || (user_id % 22 + 1) AS chrom, CAST(event_id * 7919 % 100000 AS INTEGER) AS "start", CAST(event_id * 7919 % 100000 + 1 + event_id % 50 AS INTEGER) AS "end" FROM events)
"""

#: The same views in SQL.
VIEWS = """WITH v AS (SELECT variant_id, chrom, pos - 1 AS "start", CAST(pos - 1 + length(ref) AS INTEGER) AS "end", sample_id, info_dp FROM variants),
t AS (SELECT interval_id, track_id, sample_id, chrom, "start", "end", strand FROM track_intervals
      WHERE "start" IS NULL OR "end" IS NULL OR "end" > "start"),
tn AS (SELECT * FROM t WHERE chrom IS NOT NULL AND "start" IS NOT NULL AND "end" IS NOT NULL),
vn AS (SELECT * FROM v WHERE chrom IS NOT NULL AND "start" IS NOT NULL AND "end" IS NOT NULL)
"""
