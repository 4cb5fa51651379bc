"""Named queries over the test tables: one or more for every operator. All read whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .. import operators as ops
from ..functions import alignment, coords, flags
from ..operators import chunks, islands, packed, quantiles, records
from ..session import cut, shared_folder
from ..sources import bam, bcf, convert, headers, text
from . import formats
from .inputs import event_intervals, order_intervals, table, tracks, variant_intervals

Query = Callable[[SparkSession, str], DataFrame]
PROBS = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "contigs").select(F.col("contig_name").alias("chrom"), F.col("seq_length").alias("size"))


def _ranked(df: DataFrame, natural: bool) -> DataFrame:
    """Where ``sort_bedframe`` puts the rows of each chromosome and start: the first and last place, counted over all rows."""
    at = F.monotonically_increasing_id()
    ordered = cut(ops.sort_bedframe(df, natural).select("chrom", "start", F.shiftright(at, 33).alias("part"), at.bitwiseAND((1 << 33) - 1).alias("place")))
    # one row per partition of the result
    sizes = ordered.groupBy("part").agg(F.count("*").alias("n"))
    before = W.Window.orderBy("part").rowsBetween(W.Window.unboundedPreceding, -1)
    ordered = ordered.join(sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "part")
    rank = F.col("offset") + F.col("place") + 1
    return ordered.groupBy("chrom", "start").agg(F.count("*").alias("n_rows"), F.min(rank).alias("first_rank"), F.max(rank).alias("last_rank"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    values = packed.split_packed(table(spark, d, "variants"), "variant_id", ["id", "alt"])
    return values.where("n_values >= 2").select("variant_id", "field_name", "value_pos", "value_text")


def p1_dialects(spark: SparkSession, d: str) -> DataFrame:
    values = packed.split_packed(table(spark, d, "variants"), "variant_id", ["id", "alt"])
    first = values.groupBy("field_name", "dialect").agg(F.count_distinct("variant_id").alias("n_fields"), F.count("*").alias("n_values"))
    return first


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return islands.periods_and_gaps(table(spark, d, "track_intervals"), ["track_id", "chrom"])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    a, v = table(spark, d, "alignments"), table(spark, d, "variants")
    found = [
        ("alignments", chunks.heavy_keys(chunks.per_key(a, "reference_sequence_id", "alignment_start"))),
        ("variants", chunks.heavy_keys(chunks.per_key(v, "chrom", "pos"))),
    ]
    return chunks.across(found).select("table_name", "key_value")


def p3_per_key(spark: SparkSession, d: str) -> DataFrame:
    """Per reference or chromosome: rows, values, how the starts run in the order of the rows' ids."""
    a = chunks.per_key(table(spark, d, "alignments"), "reference_sequence_id", "alignment_start", order=["alignment_id"])
    v = chunks.per_key(table(spark, d, "variants"), "chrom", "pos", order=["variant_id"])
    name = lambda df, n: df.withColumns({"table_name": F.lit(n), "key": F.coalesce(F.col("key").cast("string"), F.lit("*"))})
    return name(a, "alignments").unionByName(name(v, "variants"))


def _p4_sides(spark: SparkSession, d: str) -> list[tuple]:
    """(table's name, rows, metrics, groups) of the two tables."""
    a, v = table(spark, d, "alignments"), table(spark, d, "variants")
    ga = {"reference": "reference_sequence_id", "sample": "sample_id", "day": F.to_date("sequenced_at")}
    gv = {"reference": "chrom", "sample": "sample_id", "day": F.to_date("called_at")}
    return [("alignments", a, ["mapping_quality", "template_length"], ga), ("variants", v, ["qual"], gv)]


def _summaries(spark: SparkSession, d: str, dims: tuple[str, ...] = ("reference", "sample", "day"), cells: tuple[str, ...] = ()) -> DataFrame:
    left, right = (
        quantiles.summarize(df, metrics, {k: groups[k] for k in dims}, cells=cells).withColumn("table_name", F.lit(name))
        for name, df, metrics, groups in _p4_sides(spark, d)
    )
    return left.unionByName(right)


def p4_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Every percentile per reference, per sample and per day held against the exact ranks: is it within the bound stated for it?"""
    out = None
    for name, df, metrics, groups in _p4_sides(spark, d):
        results = quantiles.quantiles(quantiles.summarize(df, metrics, groups), PROBS)
        checked = quantiles.true_ranks(df, metrics, groups, results, PROBS).withColumn("table_name", F.lit(name))
        out = checked if out is None else out.unionByName(checked)
    return out


def p4_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles per reference or chromosome, per sample, per day, and per combination of the three; with the bound on the
    rank error of each."""
    dims = ("reference", "sample", "day")
    return quantiles.quantiles(_summaries(spark, d, dims, dims), PROBS)


def p4_days_together(spark: SparkSession, d: str) -> DataFrame:
    """Summaries of single days put together: percentiles over all days."""
    days = _summaries(spark, d, ("day",))
    return quantiles.quantiles(quantiles.merge_summaries(days, ["table_name", "metric"]), PROBS)


def _parsed(spark: SparkSession, d: str) -> DataFrame:
    return records.parse_records(table(spark, d, "raw_lines"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return records.bad_lines(_parsed(spark, d)).select("line_id", "reason")


def p5_errors(spark: SparkSession, d: str) -> DataFrame:
    return records.bad_lines(_parsed(spark, d))


def p5_files(spark: SparkSession, d: str) -> DataFrame:
    """The raw lines as files, parsed across lines: per format and file its headers, records, bad units by reason, and the lines that
    belong to a unit before them. A quoted text with a semicolon gets a line break there, so that fields run over lines."""
    path, lines = shared_folder(spark), table(spark, d, "raw_lines").where("fmt IN ('vcf', 'sam')")
    two_marks = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit(""))) == 2
    broken = F.when((F.col("fmt") == "vcf") & two_marks, F.regexp_replace("line", '(\t"[^"\t]*);([^"\t]*"(?:\t|$))', "$1\n$2")).otherwise(F.col("line"))
    lines = lines.select("fmt", "file_name", "line_no", F.coalesce(broken, F.lit("")).alias("value"))
    for fmt in ("vcf", "sam"):
        own = lines.where(F.col("fmt") == fmt).repartition("file_name").sortWithinPartitions("file_name", "line_no")
        own.select("file_name", "value").write.partitionBy("file_name").text(f"{path}/{fmt}")
    units = None
    for fmt in ("vcf", "sam"):
        own = records.parse_files(spark, f"{path}/{fmt}", fmt).withColumn("fmt", F.lit(fmt))
        units = own if units is None else units.unionByName(own)
    named = units.withColumn("file_name", F.url_decode(F.regexp_extract("file", "file_name=([^/]*)/", 1)))
    bad = lambda r: F.count(F.when(F.exists("errors", lambda e: e["reason"] == r), 1)).alias(f"n_{r}")
    return named.groupBy("fmt", "file_name").agg(
        F.count(F.when(F.col("kind") == "header", 1)).alias("n_headers"), F.count(F.when(F.col("kind") == "record", 1)).alias("n_records"),
        *(bad(r) for r in ("quoting", "column_count", "pos", "qual", "template_length")),
        F.sum(F.when(F.exists("errors", lambda e: e["reason"] == "quoting"), F.col("n_lines") - 1).otherwise(0)).alias("n_skipped"),
    )


def p5_vcf_records(spark: SparkSession, d: str) -> DataFrame:
    return _parsed(spark, d).where("vcf IS NOT NULL").select("line_id", "vcf.*")


def p5_sam_records(spark: SparkSession, d: str) -> DataFrame:
    out = _parsed(spark, d).where("sam IS NOT NULL").select("line_id", "sam.*")
    return out.withColumn("tags", F.array_join("tags", "\t"))


def _alignment_view(spark: SparkSession, d: str) -> DataFrame:
    """Placed alignments as intervals with their reference's name."""
    a, c = table(spark, d, "alignments"), table(spark, d, "contigs")
    a = a.select("alignment_id", "reference_sequence_id", "alignment_start", "cigar", "flags", "mapping_quality", "sample_id")
    a = a.where("reference_sequence_id IS NOT NULL AND alignment_start IS NOT NULL")
    a = a.join(c.select(F.col("contig_id").alias("reference_sequence_id"), F.col("contig_name").alias("chrom")), "reference_sequence_id")
    end = alignment.alignment_end(F.col("alignment_start"), F.col("cigar"))
    return a.select("alignment_id", "chrom", (F.col("alignment_start") - 1).alias("start"), end.cast("int").alias("end"), "sample_id", "flags", "mapping_quality")


def _region(spark: SparkSession, d: str) -> DataFrame:
    region = coords.Region.parse("chr1:1000000-60000000")
    v = table(spark, d, "variants")
    hit = region.to_predicate(F.col("chrom"), F.col("pos"), F.col("pos") + F.length("ref") - 1)
    return v.where(hit).select("variant_id", "chrom", "pos")


def _flags(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "alignments")
    return a.select("alignment_id", *flags.predicates("flags"), coords.mapping_quality(F.col("mapping_quality")).cast("int").alias("mapq"))


def _decoded(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "alignments")
    return a.select(
        "alignment_id", F.col("name").cast("string").alias("name"), alignment.cigar_text(F.col("cigar")).alias("cigar_text"),
        alignment.reference_length(F.col("cigar")).alias("reference_length"),
        alignment.sequence_text(F.col("sequence"), F.length("quality_scores")).alias("sequence_text"),
    )


def _as_bam(spark: SparkSession, d: str) -> DataFrame:
    """The BAM columns of all alignments."""
    return table(spark, d, "alignments").select(*(c for c in convert.BAM_COLUMNS if c != "data"))


def _sam_view(spark: SparkSession, d: str) -> DataFrame:
    """All alignments with the columns of the SAM schema, decoded."""
    a, c = table(spark, d, "alignments"), table(spark, d, "contigs")
    names = lambda i: c.select(F.col("contig_id").alias(i), F.col("contig_name").cast("binary").alias(f"{i}_name"))
    a = a.join(names("reference_sequence_id"), "reference_sequence_id", "left").join(names("mate_reference_sequence_id"), "mate_reference_sequence_id", "left")
    text = {
        "name": F.col("name"), "flags": F.col("flags"), "reference_sequence_name": F.col("reference_sequence_id_name"), "alignment_start": F.col("alignment_start"),
        "mapping_quality": F.col("mapping_quality"), "cigar": alignment.cigar_text(F.col("cigar")).cast("binary"),
        "mate_reference_sequence_name": F.col("mate_reference_sequence_id_name"), "mate_alignment_start": F.col("mate_alignment_start"), "template_length": F.col("template_length"),
        "sequence": alignment.sequence_text(F.col("sequence"), F.length("quality_scores")).cast("binary"), "quality_scores": alignment.quality_text(F.col("quality_scores")).cast("binary"),
    }
    return a.select("alignment_id", F.struct("cigar", "sequence", "quality_scores").alias("raw"), *(v.alias(k) for k, v in text.items()))


def sam_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Alignments written as SAM lines, parsed again, and encoded back to the binary columns."""
    lines = _sam_view(spark, d).select("alignment_id", "raw", text.sam_line().alias("line"))
    back = lines.select("alignment_id", "raw", *text.sam_columns(F.col("line")))
    same = lambda c, f: (F.col(f"raw.{c}") == f(F.col(c).cast("string"))).alias(f"same_{c}")
    return back.select(
        "alignment_id", F.col("name").cast("string").alias("name"), "flags", F.col("reference_sequence_name").cast("string").alias("reference"), "alignment_start",
        F.col("mapping_quality").cast("int").alias("mapping_quality"), "mate_alignment_start", "template_length",
        same("cigar", alignment.cigar_binary), same("sequence", alignment.sequence_binary),
        F.when(F.hex("raw.quality_scores").startswith("FF"), F.length("quality_scores") == 0).otherwise(same("quality_scores", alignment.quality_binary)).alias("same_quality_scores"),
    )


def fastq_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Reads written as FASTQ records and parsed again."""
    reads = _sam_view(spark, d).withColumn("description", F.concat(F.lit("ref "), "reference_sequence_name"))
    lines = reads.select("alignment_id", F.split(text.fastq_lines(), "\n").alias("x"))
    back = lines.select("alignment_id", *text.fastq_columns(F.col("x")[0], F.col("x")[1], F.col("x")[3]))
    return back.select("alignment_id", F.col("name").cast("string").alias("name"), F.col("description").cast("string").alias("description"), F.length("sequence").alias("n_bases"), F.when(F.col("quality_scores") != F.lit(b"*"), F.length("quality_scores")).alias("n_qualities"))


def vcf_parse_info(spark: SparkSession, d: str) -> DataFrame:
    """Variants written as VCF lines and parsed with a header. Tabs in a field are written as their code."""
    header = headers.VcfHeader.parse("\n".join([
        "##fileformat=VCFv4.3", '##INFO=<ID=NREADS,Number=1,Type=Integer,Description="Reads at the place">',
        '##INFO=<ID=ORIGIN,Number=1,Type=String,Description="Sample">', "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO",
    ]))
    v = table(spark, d, "variants")
    rows = v.select("chrom", "pos", "id", "ref", "alt", "qual", F.col("info_dp").alias("INFO_NREADS"), F.col("sample_id").cast("string").alias("INFO_ORIGIN"))
    lines = v.select("variant_id", *rows.columns[:6], F.col("info_dp").alias("INFO_NREADS"), F.col("sample_id").cast("string").alias("INFO_ORIGIN"))
    lines = lines.select("variant_id", text.vcf_record_line(rows, header).alias("line"))
    return lines.select("variant_id", *text.vcf_columns(F.col("line"), header))


def bam_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """All alignments written as BAM files to the shared folder and read back."""
    bam.register(spark)
    sizes = {r["contig_name"]: r["seq_length"] for r in table(spark, d, "contigs").orderBy("contig_id").collect()}
    path = shared_folder(spark)
    _as_bam(spark, d).write.format("bam").mode("overwrite").option("header", str(headers.SamHeader.of(sizes))).save(path)
    back = spark.read.format("bam").load(path)
    return back.select(
        F.col("name").cast("string").alias("name"), "flags", "reference_sequence_id", "alignment_start", F.col("mapping_quality").cast("int").alias("mapping_quality"),
        F.hex("cigar").alias("cigar"), "mate_reference_sequence_id", "mate_alignment_start", "template_length", F.hex("sequence").alias("sequence"), F.hex("quality_scores").alias("quality_scores"),
    )


def bcf_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """All variants written as BCF files to the shared folder and read back."""
    bcf.register(spark)
    contigs = "".join(f"##contig=<ID={r[0]}>\n" for r in table(spark, d, "contigs").orderBy("contig_id").select("contig_name").collect())
    header = f'##fileformat=VCFv4.3\n{contigs}##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth">\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n'
    path = shared_folder(spark)
    v = table(spark, d, "variants").where("chrom IS NOT NULL").select("chrom", "pos", "id", "ref", "alt", "qual", F.col("info_dp").alias("INFO_DP"))
    v.write.format("bcf").mode("overwrite").option("header", header).save(path)
    return spark.read.format("bcf").load(path)


def track_annotation(spark: SparkSession, d: str) -> DataFrame:
    """Per track: pairs of its intervals with variants, how many variants these are, and the largest depth among them."""
    v = variant_intervals(spark, d)
    pairs = ops.overlap(tracks(spark, d).select("track_id", "chrom", "start", "end"), v)
    return pairs.groupBy(F.col("a_track_id").alias("track_id")).agg(
        F.count("*").alias("n_hits"), F.count_distinct("b_variant_id").alias("n_variants"), F.max("b_info_dp").alias("most_reads")
    )


def overlap_reads(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of alignments and track intervals, per interval: how many, and the first and last alignment."""
    pairs = ops.overlap(tracks(spark, d).select("interval_id", "chrom", "start", "end"), _alignment_view(spark, d).select("alignment_id", "chrom", "start", "end"))
    return pairs.groupBy(F.col("a_interval_id").alias("interval_id")).agg(
        F.count("*").alias("n_reads"), F.min("b_alignment_id").alias("first_read"), F.max("b_alignment_id").alias("last_read")
    )


def _slim(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names)


QUERIES: dict[str, Query] = {
    "overlap_join": lambda s, d: ops.overlap(variant_intervals(s, d), tracks(s, d)).select("a_variant_id", "b_interval_id", "a_chrom", "a_start", "b_end"),
    "overlap_join_on_cols": lambda s, d: ops.overlap(variant_intervals(s, d), tracks(s, d), on_cols=["sample_id"]).select("a_variant_id", "b_interval_id", "a_sample_id"),
    "overlap_semi": lambda s, d: ops.overlap(variant_intervals(s, d), tracks(s, d), "semi"),
    "subtract": lambda s, d: ops.subtract(variant_intervals(s, d), tracks(s, d)),
    "count_overlaps": lambda s, d: ops.count_overlaps(variant_intervals(s, d), tracks(s, d)),
    "count_overlaps_on_cols": lambda s, d: ops.count_overlaps(variant_intervals(s, d), tracks(s, d), ["sample_id"]),
    "count_overlaps_reads": lambda s, d: ops.count_overlaps(_alignment_view(s, d), variant_intervals(s, d)).select("alignment_id", "chrom", "start", "end", "count"),
    "nearest": lambda s, d: _slim(ops.nearest(variant_intervals(s, d), tracks(s, d), None, "nearest", "variant_id", "interval_id"), "a_variant_id", "b_interval_id", "distance"),
    "nearest_on_cols": lambda s, d: _slim(ops.nearest(variant_intervals(s, d), tracks(s, d), ["sample_id"], "nearest", "variant_id", "interval_id"), "a_variant_id", "b_interval_id", "distance"),
    "cluster": lambda s, d: _slim(ops.cluster(tracks(s, d)), "interval_id", "cluster_id"),
    "cluster_on_cols": lambda s, d: _slim(ops.cluster(tracks(s, d), ["strand"]), "interval_id", "cluster_id"),
    "merge": lambda s, d: ops.merge(tracks(s, d)),
    "merge_on_cols": lambda s, d: ops.merge(tracks(s, d), ["sample_id"]),
    "complement": lambda s, d: ops.complement(tracks(s, d)),
    "complement_sizes": lambda s, d: ops.complement(tracks(s, d), _sizes(s, d)),
    "coverage": lambda s, d: ops.coverage(tracks(s, d)),
    "coverage_on_cols": lambda s, d: ops.coverage(tracks(s, d), ["strand"]),
    "coverage_alignments": lambda s, d: ops.coverage(_alignment_view(s, d)).where("depth > 2"),
    "disjoin": lambda s, d: ops.disjoin(tracks(s, d)),
    "intersect_ranges": lambda s, d: ops.intersect_ranges(tracks(s, d).where("strand = '+'"), tracks(s, d).where("strand = '-'")),
    "union_ranges": lambda s, d: ops.union_ranges(tracks(s, d), variant_intervals(s, d)),
    "setdiff_ranges": lambda s, d: ops.setdiff_ranges(tracks(s, d), variant_intervals(s, d)),
    "expand": lambda s, d: ops.expand(tracks(s, d), 100),
    "expand_asym": lambda s, d: ops.expand(tracks(s, d), start_amount=5_000_000, end_amount=7),
    "shift_left_clamp": lambda s, d: ops.shift(tracks(s, d), -9_000_000),
    "shift_right": lambda s, d: ops.shift(tracks(s, d), 500),
    "flank_up": lambda s, d: ops.flank(tracks(s, d), 200),
    "flank_down": lambda s, d: ops.flank(tracks(s, d), 200, False),
    "set_width_start": lambda s, d: ops.set_width(tracks(s, d), 75),
    "set_width_end": lambda s, d: ops.set_width(tracks(s, d), 75, "end"),
    "set_width_center": lambda s, d: ops.set_width(tracks(s, d), 75, "center"),
    "tile": lambda s, d: ops.tile(tracks(s, d), 1000),
    "sort_natural": lambda s, d: _ranked(tracks(s, d), True),
    "sort_lex": lambda s, d: _ranked(tracks(s, d), False),
    "flags_predicates": _flags,
    "region_filter": _region,
    "decode_alignments": _decoded,
    "sam_round_trip": sam_round_trip,
    "fastq_round_trip": fastq_round_trip,
    "vcf_parse_info": vcf_parse_info,
    "bam_round_trip": bam_round_trip,
    "bcf_round_trip": bcf_round_trip,
    "track_annotation": track_annotation,
    "chrom_sizes": lambda s, d: formats.chrom_sizes(s, d),
    "overlap_reads": overlap_reads,
    "overlap_orders_events": lambda s, d: ops.overlap(order_intervals(s, d), event_intervals(s, d)).select("a_id", "b_id"),
    "nearest_orders_events": lambda s, d: _slim(ops.nearest(order_intervals(s, d), event_intervals(s, d), None, "nearest", "id", "id"), "a_id", "b_id", "distance"),
    "nearest_start_adjacent": lambda s, d: _slim(ops.nearest(variant_intervals(s, d), tracks(s, d), None, "start_adjacent", "variant_id", "interval_id"), "a_variant_id", "b_interval_id", "distance"),
    "subtract_on_cols": lambda s, d: ops.subtract(variant_intervals(s, d), tracks(s, d), ["sample_id"]),
    "complement_on_cols": lambda s, d: ops.complement(tracks(s, d), _sizes(s, d), ["strand"]),
    "disjoin_on_cols": lambda s, d: ops.disjoin(tracks(s, d), ["strand"]),
    **formats.QUERIES,
    "p1_found": p1_found,
    "p1_dialects": p1_dialects,
    "p2_found": p2_found,
    "p3_found": p3_found,
    "p3_per_key": p3_per_key,
    "p4_percentiles": p4_percentiles,
    "p4_days_together": p4_days_together,
    "p4_bounds": p4_bounds,
    "p5_found": p5_found,
    "p5_errors": p5_errors,
    "p5_files": p5_files,
    "p5_vcf_records": p5_vcf_records,
    "p5_sam_records": p5_sam_records,
}
