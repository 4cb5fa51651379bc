"""Queries that write the test tables as files of each format, read them back, rewrite and scan them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import operators as ops
from ..functions import alignment
from ..session import shared_folder, spread
from ..sources import bam, bcf, convert, headers, tags, text
from .inputs import table

REGION, REGION_FIRST, REGION_LAST = "chr1:1000000-60000000", 1_000_000, 60_000_000


def sam_header(spark: SparkSession, d: str, order: str = "unknown") -> headers.SamHeader:
    """The contigs as a header; a header is a small object."""
    rows = table(spark, d, "contigs").orderBy("contig_id").select("contig_name", "seq_length").collect()
    return headers.SamHeader.of({r[0]: r[1] for r in rows}, order)


def chrom_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Names and sizes as the header of a written SAM file gives them."""
    path, header = shared_folder(spark), sam_header(spark, d)
    text.write_sam(convert.bam_to_sam(_alignments(spark, d), header), path, header)
    return text.read_sam_header(spark, path).chrom_sizes(spark)


def vcf_header(spark: SparkSession, d: str) -> headers.VcfHeader:
    """Contigs and fields. An Integer has 32 bits in the formats, so ROW is a String if an id does not fit; a BCF file keeps the 8 least for itself."""
    low, high = table(spark, d, "variants").where("chrom IS NOT NULL").agg(F.min("variant_id"), F.max("variant_id")).first()
    row = "Integer" if low is None or -(1 << 31) + 8 <= low and high < 1 << 31 else "String"
    contigs = [f"##contig=<ID={r[0]},length={r[1]}>" for r in table(spark, d, "contigs").orderBy("contig_id").select("contig_name", "seq_length").collect()]
    return headers.VcfHeader.parse("\n".join([
        "##fileformat=VCFv4.3", *contigs,
        '##FILTER=<ID=weak,Description="Quality below 20">', '##FILTER=<ID=shallow,Description="Few reads">',
        f'##INFO=<ID=ROW,Number=1,Type={row},Description="Row of the table">', '##INFO=<ID=NREADS,Number=1,Type=Integer,Description="Reads at the place">',
        '##INFO=<ID=PARTS,Number=.,Type=Float,Description="Shares, one may be missing">', '##INFO=<ID=EVEN,Number=0,Type=Flag,Description="Even sample">',
        '##INFO=<ID=ORIGIN,Number=1,Type=String,Description="Sample in words">',
        '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">', '##FORMAT=<ID=CN,Number=1,Type=Integer,Description="Copies">',
        "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tleft\tright",
    ]))


def _alignments(spark: SparkSession, d: str) -> DataFrame:
    """The BAM columns of all alignments, with tags made from the row id, the sample and the flags."""
    tag = lambda name, kind, value: F.struct(F.lit(name).alias("tag"), F.lit(kind).alias("type"), value.alias("value"))
    sample = F.coalesce(F.col("sample_id").cast("string"), F.lit("none"))
    made = F.array(
        tag("XI", "i", F.col("alignment_id").cast("string")), tag("RG", "Z", F.concat(F.lit("sample "), sample)),
        tag("XF", "f", F.concat((F.col("flags") % 8).cast("string"), F.lit(".5"))), tag("XB", "BS", F.concat(F.lit("S,"), F.col("flags").cast("string"), F.lit(",7"))),
    )
    full = F.transform(made, lambda t: F.struct(t["tag"], t["type"], t["value"], F.lit(None).cast("bigint").alias("i"), F.lit(None).cast("double").alias("f"), F.lit(None).cast("array<double>").alias("a")))
    columns = [c for c in convert.BAM_COLUMNS if c != "data"]
    return spread(table(spark, d, "alignments").select(*columns, "alignment_id", "sample_id")).select(*columns, full.alias("tags"))


def _shown(df: DataFrame, tag_col: str) -> DataFrame:
    """The columns in a form that can be compared; the typed tags one by one."""
    tag = lambda name: F.element_at(F.filter(tag_col, lambda t: t["tag"] == name), 1)
    plain = [F.hex(c).alias(c) if c in ("cigar", "sequence", "quality_scores") else F.col(c).cast("int").alias(c) for c in convert.BAM_COLUMNS if c not in ("data", "name")]
    return df.select(
        tag("XI")["i"].alias("alignment_id"), F.col("name").cast("string").alias("name"), *plain, tag("RG")["value"].alias("tag_text"),
        tag("XF")["f"].alias("tag_float"), F.array_join(F.transform(tag("XB")["a"], lambda x: x.cast("int").cast("string")), ",").alias("tag_array"),
    )


def _write_bam(df: DataFrame, path: str, header: headers.SamHeader, mode: str = "overwrite", index: bool = False) -> None:
    df.write.format("bam").mode(mode).option("header", str(header)).option("index", str(index).lower()).save(path)


def bam_rewrite_mapped(spark: SparkSession, d: str) -> DataFrame:
    """Alignments written as BAM in two appends, read, filtered to the mapped ones, written again with all they have, read typed."""
    bam.register(spark)
    path, header, rows = shared_folder(spark), sam_header(spark, d), _alignments(spark, d)
    _write_bam(rows.where("flags & 1 = 0"), f"{path}/all", header, "append")
    _write_bam(rows.where("flags & 1 = 1"), f"{path}/all", header, "append")
    mapped = spark.read.format("bam").load(f"{path}/all").where("flags & 4 = 0")
    _write_bam(mapped, f"{path}/mapped", header)
    return _shown(spark.read.format("bam").option("tags", "true").load(f"{path}/mapped"), "tags")


def bam_region_scan(spark: SparkSession, d: str) -> DataFrame:
    """Alignments sorted into BAM files whose tasks index them; one region read through the indexes."""
    bam.register(spark)
    path, header = shared_folder(spark), sam_header(spark, d, "coordinate")
    ordered = _alignments(spark, d).orderBy(F.col("reference_sequence_id").asc_nulls_last(), F.col("alignment_start").asc_nulls_last())
    _write_bam(ordered, path, header, index=True)
    found = spark.read.format("bam").option("region", REGION).option("tags", "true").load(path)
    return _shown(found, "tags").select("alignment_id", "name", "reference_sequence_id", "alignment_start", "cigar")


def sam_file_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Alignments written as SAM files with a header and tags, and read with the header's names."""
    path, header = shared_folder(spark), sam_header(spark, d)
    text.write_sam(convert.bam_to_sam(_alignments(spark, d), header), path, header)
    back = convert.sam_to_bam(text.read_sam(spark, path, tags=True), text.read_sam_header(spark, path))
    return _shown(back.withColumn("tags", tags.decoded(F.col("data"))), "tags")


def fastq_file_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Reads written as FASTQ files and read back; a read without qualities gets as many ``!``."""
    path = shared_folder(spark)
    a = table(spark, d, "alignments")
    n = F.length("quality_scores")
    quality = F.when(F.hex("quality_scores").startswith("FF"), F.repeat(F.lit("!"), n)).otherwise(alignment.quality_text(F.col("quality_scores")))
    reads = a.select(
        F.concat(F.lit("r"), F.col("alignment_id").cast("string")).cast("binary").alias("name"),
        F.when(F.col("sample_id").isNotNull(), F.concat(F.lit("sample "), F.col("sample_id").cast("string"))).cast("binary").alias("description"),
        alignment.sequence_text(F.col("sequence"), n).cast("binary").alias("sequence"), quality.cast("binary").alias("quality_scores"),
    )
    text.write_fastq(reads, path)
    return text.read_fastq(spark, path).select(*(F.col(c).cast("string").alias(c) for c in reads.columns[:3]), F.md5("quality_scores").alias("quality_md5"))


def _variants(spark: SparkSession, d: str, header: headers.VcfHeader) -> DataFrame:
    """All variants with a chromosome, with filters, INFO and two samples made from their columns. A BCF record needs a contig."""
    row = F.col("variant_id").cast("int" if dict(header.info_fields())["ROW"] == "Integer" else "string")
    v = spread(table(spark, d, "variants").where("chrom IS NOT NULL"))
    sample, text_of = F.col("sample_id"), lambda c: F.coalesce(c.cast("string"), F.lit("."))
    marks = F.when(F.col("qual") < 20, F.array(F.lit("weak"), F.lit("shallow"))).when(F.col("qual") >= 20, F.array(F.lit("PASS")))
    return v.select(
        "chrom", "pos", _plain("id").alias("id"), "ref", _plain("alt").alias("alt"), "qual", marks.alias("filter"),
        row.alias("INFO_ROW"), F.col("info_dp").alias("INFO_NREADS"),
        F.when(sample.isNotNull(), F.array((sample % 8 / 8).cast("float"), F.lit(None).cast("float"), F.lit(0.25).cast("float"))).alias("INFO_PARTS"),
        F.coalesce(sample % 2 == 0, F.lit(False)).alias("INFO_EVEN"), F.concat(F.lit("a;b=100%,"), sample.cast("string")).alias("INFO_ORIGIN"),
        F.when(F.col("info_dp") > 10, F.lit("0/1\t1|1")).otherwise(F.lit("./.\t0/0")).alias("FMT_GT"),
        F.concat_ws("\t", text_of(sample), F.lit(".")).alias("FMT_CN"),
    )


def _plain(c: str) -> Column:
    """An empty field or a lone dot is a missing one in the formats."""
    return F.nullif(F.nullif(F.col(c), F.lit("")), F.lit("."))


def _row_id(df: DataFrame) -> Column:
    """The id of the table's row as a number, however the header holds it."""
    return F.col("INFO_ROW").cast("bigint") if df.schema["INFO_ROW"].dataType == T.StringType() else F.col("INFO_ROW")


def _shown_variants(df: DataFrame) -> DataFrame:
    out = df.withColumns({"INFO_ROW": _row_id(df), "filter": F.array_join("filter", ";"), "INFO_PARTS": F.array_join(F.transform("INFO_PARTS", lambda x: (x * 8).cast("int").cast("string")), ",", ".")})
    return out.withColumns({c: F.replace(F.col(c), F.lit("\t"), F.lit(" ")) for c in ("FMT_GT", "FMT_CN")})


def vcf_rewrite_by_qual(spark: SparkSession, d: str) -> DataFrame:
    """Variants written as VCF, read, filtered by quality, written again with all they have, and read."""
    path, header = shared_folder(spark), vcf_header(spark, d)
    text.write_vcf(_variants(spark, d, header), f"{path}/all", header)
    found = text.read_vcf(spark, f"{path}/all", text.read_vcf_header(spark, f"{path}/all"), filters=True, info_arrays=True)
    text.write_vcf(found.where("qual >= 30"), f"{path}/good", header)
    return _shown_variants(text.read_vcf(spark, f"{path}/good", text.read_vcf_header(spark, f"{path}/good"), filters=True, info_arrays=True))


def _write_bcf(df: DataFrame, path: str, header: headers.VcfHeader, index: bool = False) -> None:
    df.write.format("bcf").mode("append").option("header", str(header)).option("index", str(index).lower()).save(path)


def _read_bcf(spark: SparkSession, path: str, region: str | None = None) -> DataFrame:
    reader = spark.read.format("bcf").option("filters", "true").option("info_arrays", "true")
    return (reader.option("region", region) if region else reader).load(path)


def vcf_to_bcf(spark: SparkSession, d: str) -> DataFrame:
    """Variants written as VCF, read, written as BCF in two appends, and read."""
    bcf.register(spark)
    path, header = shared_folder(spark), vcf_header(spark, d)
    text.write_vcf(_variants(spark, d, header), f"{path}/vcf", header)
    found = text.read_vcf(spark, f"{path}/vcf", header, filters=True, info_arrays=True)
    for part in ("INFO_EVEN", "NOT INFO_EVEN"):
        _write_bcf(found.where(part), f"{path}/bcf", header)
    return _shown_variants(_read_bcf(spark, f"{path}/bcf"))


def bcf_region_scan(spark: SparkSession, d: str) -> DataFrame:
    """Variants sorted into BCF files whose tasks index them; one region read through the indexes."""
    bcf.register(spark)
    path, header = shared_folder(spark), vcf_header(spark, d)
    order = F.array_position(F.array(*map(F.lit, header.contigs())), F.col("chrom"))
    _write_bcf(_variants(spark, d, header).orderBy(order, F.col("pos").asc_nulls_first()), path, header, index=True)
    found = _read_bcf(spark, path, REGION)
    return found.select(_row_id(found).alias("variant_id"), "chrom", "pos", F.array_join("filter", ";").alias("filter"))


def vcf_bcf_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Variants with an even sample in a BCF file, the others in a VCF file; for each of the latter those of the former within 20 kb."""
    bcf.register(spark)
    path, header = shared_folder(spark), vcf_header(spark, d)
    rows = _variants(spark, d, header)
    text.write_vcf(rows.where("NOT INFO_EVEN"), f"{path}/vcf", header)
    _write_bcf(rows.where("INFO_EVEN"), f"{path}/bcf", header)
    place = lambda df: df.select(_row_id(df).alias("variant_id"), "chrom", (F.col("pos") - 1).alias("start"), (F.col("pos") - 1 + F.length("ref")).alias("end"))
    left = place(text.read_vcf(spark, f"{path}/vcf", text.read_vcf_header(spark, f"{path}/vcf")))
    pairs = ops.overlap(ops.expand(left, 20_000), place(_read_bcf(spark, f"{path}/bcf")))
    return pairs.groupBy("a_variant_id").agg(F.count("*").alias("n_hits"), F.min("b_variant_id").alias("first_hit"))


_BAM_SQL = """SELECT alignment_id, CAST(name AS VARCHAR) AS name, flags, reference_sequence_id, alignment_start, CAST(nullif(mapping_quality, 255) AS INTEGER) AS mapping_quality,
hex(cigar) AS cigar, mate_reference_sequence_id, mate_alignment_start, template_length, hex(sequence) AS sequence,
CASE WHEN hex(quality_scores) LIKE 'FF%' THEN '' ELSE hex(quality_scores) END AS quality_scores, 'sample ' || coalesce(CAST(sample_id AS VARCHAR), 'none') AS tag_text,
CAST(flags % 8 + 0.5 AS DOUBLE) AS tag_float, flags || ',7' AS tag_array FROM alignments"""

_VCF_SQL = """SELECT chrom, pos, nullif(nullif(id, ''), '.') AS id, ref, nullif(nullif(alt, ''), '.') AS alt, qual,
CASE WHEN qual < 20 THEN 'weak;shallow' WHEN qual >= 20 THEN 'PASS' END AS "filter", CAST(variant_id AS INTEGER) AS "INFO_ROW", info_dp AS "INFO_NREADS",
(sample_id % 8) || ',.,2' AS "INFO_PARTS", coalesce(sample_id % 2 = 0, false) AS "INFO_EVEN", 'a;b=100%,' || sample_id AS "INFO_ORIGIN",
CASE WHEN info_dp > 10 THEN '0/1 1|1' ELSE './. 0/0' END AS "FMT_GT", CASE WHEN sample_id IS NULL THEN '. .' ELSE sample_id || ' .' END AS "FMT_CN" FROM variants WHERE chrom IS NOT NULL"""


def oracle(covered: str, words: str) -> dict[str, str]:
    """SQL of these queries; ``words`` and ``covered`` decode cigars."""
    first = f"pos <= {REGION_LAST} AND pos + length(ref) - 1 >= {REGION_FIRST} AND chrom = 'chr1'"
    place = 'variant_id, chrom, pos - 1 AS "start", pos - 1 + length(ref) AS "end" FROM variants WHERE chrom IS NOT NULL AND pos IS NOT NULL AND'
    return {
        "bam_rewrite_mapped": _BAM_SQL + " WHERE flags & 4 = 0",
        "sam_file_round_trip": _BAM_SQL,
        "bam_region_scan": f"""SELECT alignment_id, CAST(name AS VARCHAR) AS name, reference_sequence_id, alignment_start, hex(cigar) AS cigar FROM ({words})
JOIN contigs ON contig_id = reference_sequence_id AND contig_name = 'chr1' WHERE alignment_start <= {REGION_LAST} AND alignment_start + greatest({covered}, 1) - 1 >= {REGION_FIRST}""",
        "fastq_file_round_trip": """SELECT 'r' || alignment_id AS name, 'sample ' || sample_id AS description,
substr(translate(hex(sequence), '0123456789ABCDEF', '=ACMGRSVTWYHKDBN'), 1, octet_length(quality_scores)) AS sequence,
md5(array_to_string(list_transform(range(0, octet_length(quality_scores)), lambda i: CASE WHEN hex(quality_scores) LIKE 'FF%' THEN '!'
  ELSE chr(CAST('0x' || substr(hex(quality_scores), 2 * i + 1, 2) AS INTEGER) + 33) END), '')) AS quality_md5 FROM alignments""",
        "vcf_rewrite_by_qual": _VCF_SQL + " AND qual >= 30",
        "vcf_to_bcf": _VCF_SQL,
        "bcf_region_scan": f"""SELECT CAST(variant_id AS INTEGER) AS variant_id, chrom, pos, CASE WHEN qual < 20 THEN 'weak;shallow' WHEN qual >= 20 THEN 'PASS' END AS "filter" FROM variants WHERE {first}""",
        "vcf_bcf_overlap": f"""WITH a AS (SELECT {place} NOT coalesce(sample_id % 2 = 0, false)), b AS (SELECT {place} sample_id % 2 = 0)
SELECT CAST(a.variant_id AS INTEGER) AS a_variant_id, count(*) AS n_hits, CAST(min(b.variant_id) AS INTEGER) AS first_hit
FROM a JOIN b ON a.chrom = b.chrom AND greatest(a."start" - 20000, 1) < b."end" AND b."start" < a."end" + 20000 GROUP BY a.variant_id""",
    }


QUERIES = {f.__name__: f for f in (
    bam_rewrite_mapped, bam_region_scan, sam_file_round_trip, fastq_file_round_trip, vcf_rewrite_by_qual, vcf_to_bcf, bcf_region_scan, vcf_bcf_overlap,
)}
