"""SAM, VCF and FASTQ text: native readers and writers, splittable and without Python in the tasks.

``*_columns`` turn a column of lines into typed columns and ``*_line`` turn typed columns into lines, so they work on any
DataFrame, batch or stream; ``read_*`` and ``write_*`` add the files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from . import tags as aux
from .headers import SamHeader, VcfHeader

#: The columns of the SAM batch schema, in order.
SAM_COLUMNS = (
    "name", "flags", "reference_sequence_name", "alignment_start", "mapping_quality", "cigar",
    "mate_reference_sequence_name", "mate_alignment_start", "template_length", "sequence", "quality_scores",
)


def _field(line: Column, i: int) -> Column:
    return F.get(F.split(F.regexp_replace(line, "\r$", ""), "\t"), F.lit(i))


def _known(c: Column, missing: str) -> Column:
    return F.when(c != missing, c)


def sam_columns(line: Column) -> list[Column]:
    """The SAM batch schema. ``*`` names, position 0 and mapping quality 255 are null; flags and lengths that are no numbers 0."""
    f = [_field(line, i) for i in range(11)]
    number = lambda c, kind="int": c.try_cast(kind)
    place = lambda c: F.when(number(c) > 0, number(c))
    mate = F.when(f[6] == "=", f[2]).otherwise(f[6])
    bare = lambda c: F.when(c == "*", F.lit("")).otherwise(c).cast("binary")
    cols = [
        _known(f[0], "*").cast("binary"), F.coalesce(number(f[1]), F.lit(0)), _known(f[2], "*").cast("binary"), place(f[3]),
        F.when(number(f[4]).between(0, 254), number(f[4])).cast("short"), bare(f[5]), _known(mate, "*").cast("binary"), place(f[7]),
        F.coalesce(number(f[8]), F.lit(0)), bare(f[9]), bare(f[10]),
    ]
    return [c.alias(n) for c, n in zip(cols, SAM_COLUMNS)]


def sam_tags(line: Column) -> Column:
    """The further fields, typed (see ``tags``)."""
    return aux.from_fields(F.slice(F.split(F.regexp_replace(line, "\r$", ""), "\t"), 12, 1 << 30))


def sam_line(tags: Column | None = None) -> Column:
    """One line from the columns of the SAM schema and, if given, the typed tags."""
    text = lambda n: F.when(F.length(n) > 0, F.col(n).cast("string")).otherwise(F.lit("*"))
    number = lambda n, missing: F.coalesce(F.col(n).cast("string"), F.lit(missing))
    cols = [
        text("name"), number("flags", "0"), text("reference_sequence_name"), number("alignment_start", "0"), number("mapping_quality", "255"), text("cigar"),
        text("mate_reference_sequence_name"), number("mate_alignment_start", "0"), number("template_length", "0"), text("sequence"), text("quality_scores"),
    ]
    return F.concat_ws("\t", *cols, *([] if tags is None else [aux.to_fields(tags)]))


def header_lines(spark: SparkSession, path: str, mark: str) -> list[str]:
    """The header of a text file, or of the first file of a folder that is not empty; only that file's start is read."""
    for name in sorted(spark.read.text(path).inputFiles()):
        lines, n = spark.read.text(name), 256
        while True:
            # the first rows of a file are those of its first split: this reads no further than it must
            found = [r["value"] for r in lines.take(n)]
            header = next((i for i, x in enumerate(found) if not x.startswith(mark)), len(found))
            if header < len(found) or len(found) < n:
                break
            n *= 16
        if found:
            return found[:header]
    return []


def read_sam_header(spark: SparkSession, path: str) -> SamHeader:
    return SamHeader.parse("\n".join(header_lines(spark, path, "@")))


def read_sam(spark: SparkSession, path: str, tags: bool = False) -> DataFrame:
    lines = spark.read.text(path).where(~F.col("value").startswith("@") & (F.col("value") != ""))
    return lines.select(*sam_columns(F.col("value")), *([sam_tags(F.col("value")).alias("data")] if tags else []))


def _write_lines(lines: DataFrame, header: str, path: str) -> None:
    """A folder of text parts; the header is the first part, so that parts in order of their names make one file."""
    spark = lines.sparkSession
    text = lines.toDF("value")
    if header:
        head = spark.createDataFrame([(header.rstrip("\n"),)], "value string").coalesce(1)
        text = head.unionAll(text)
    text.write.mode("overwrite").text(path)


def write_sam(df: DataFrame, path: str, header: SamHeader) -> None:
    """The columns of the SAM schema and, if there is one, the column ``data`` of typed tags; others are an error."""
    unknown = [c for c in df.columns if c not in (*SAM_COLUMNS, "data")]
    if unknown:
        raise ValueError(f"a SAM line has no place for the column {unknown[0]!r}")
    _write_lines(df.select(sam_line(F.col("data") if "data" in df.columns else None)), str(header), path)


#: Fixed values of the format: characters that VCF text holds as a percent sign and their code.
_ENCODED = {"\t": "%09", "\n": "%0A", "\r": "%0D"}
_DECODED = {"%3A": ":", "%3B": ";", "%3D": "=", "%2C": ",", "%0D": "\r", "%0A": "\n", "%09": "\t", "%25": "%"}


def _chain(c: Column, pairs: dict[str, str]) -> Column:
    for old, new in pairs.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def vcf_encoded(c: Column, more: str = "") -> Column:
    """Text with the characters that would break a line (and those of ``more``) written as their codes."""
    return _chain(c, {"%": "%25", **_ENCODED, **{x: f"%{ord(x):02X}" for x in more}})


def vcf_decoded(c: Column) -> Column:
    """Text with its codes resolved; text without a percent sign is not touched."""
    return F.when(c.contains("%"), _chain(c, _DECODED)).otherwise(c)


def _is_key(key: str, bare: bool) -> Callable[[Column], Column]:
    return lambda x: (x == key) | x.startswith(f"{key}=") if bare else x.startswith(f"{key}=")


def _caster(kind: str) -> Callable[[Column], Column]:
    return lambda x: x.try_cast(kind)


def _sample_value(at: Column) -> Callable[[Column], Column]:
    return lambda s: F.coalesce(F.when(at > 0, F.get(F.split(s, ":"), at - 1)), F.lit("."))


def _vcf_steps(line: Column, header: VcfHeader | None) -> list[Callable[[dict[str, Column]], dict[str, Column]]]:
    """What the columns of a line are made from, by name; each step builds on those before."""
    steps = [lambda _: {"fields": F.split(F.regexp_replace(line, "\r$", ""), "\t")}]
    if header is None:
        return steps
    # by number, as the names of columns do not tell "dp" from "DP"
    n, keys = len(header.sample_names()), [(i, k) for i, (k, kind) in enumerate(header.info_fields()) if kind != "Flag"]
    formats = [(i, k) for i, (k, _) in enumerate(header.format_fields())] if n else []
    place = lambda x: {"keys": F.split(F.get(x["fields"], F.lit(8)), ":"), "samples": F.slice(x["fields"], 10, n)} if n else {}
    last = lambda x, k: F.try_element_at(F.filter(x["parts"], _is_key(k, False)), F.lit(-1))
    return [
        *steps, lambda x: {"parts": F.split(F.get(x["fields"], F.lit(7)), ";"), **place(x)},
        lambda x: {f"info {i}": F.substr(last(x, k), F.lit(len(k) + 2)) for i, k in keys} | {f"at {i}": F.array_position(x["keys"], k).cast("int") for i, k in formats},
    ]


def _vcf_values(x: dict[str, Column], header: VcfHeader | None, filters: bool, info_arrays: bool) -> list[Column]:
    """The columns of ``vcf_columns`` from what ``_vcf_steps`` gives."""
    f = [F.get(x["fields"], F.lit(i)) for i in range(7)]
    out = [
        f[0].alias("chrom"), F.when(f[1].try_cast("int") > 0, f[1].try_cast("int")).alias("pos"), vcf_decoded(_known(f[2], ".")).alias("id"), f[3].alias("ref"), vcf_decoded(_known(f[4], ".")).alias("alt"),
        f[5].try_cast("float").alias("qual"),
    ]
    if filters:
        out.append(F.when(f[6] != ".", F.split(f[6], ";")).alias("filter"))
    if header is None:
        return out
    kinds, several = {"Integer": "int", "Float": "float"}, header.info_lists() if info_arrays else frozenset()
    for i, (key, kind) in enumerate(header.info_fields()):
        if kind == "Flag":
            out.append(F.coalesce(F.exists(x["parts"], _is_key(key, True)), F.lit(False)).alias(f"INFO_{key}"))
            continue
        value = _known(x[f"info {i}"], ".")
        if key in several:
            value = F.transform(F.split(value, ","), _caster(kinds[kind]))
        elif kind in kinds:
            value = F.get(F.split(value, ","), F.lit(0)).try_cast(kinds[kind])
        else:
            value = vcf_decoded(value)
        out.append(value.alias(f"INFO_{key}"))
    for i, (key, _) in enumerate(header.format_fields() if header.sample_names() else ()):
        out.append(F.array_join(F.transform(x["samples"], _sample_value(x[f"at {i}"])), "\t").alias(f"FMT_{key}"))
    return out


def vcf_columns(line: Column, header: VcfHeader | None = None, filters: bool = False, info_arrays: bool = False) -> list[Column]:
    """``chrom, pos, id, ref, alt, qual``; with a header one ``INFO_<KEY>`` per INFO and, with samples, one ``FMT_<KEY>`` per FORMAT.

    Fields of several numbers give their first value, or an array with ``info_arrays``; flags that are absent are false.
    ``filters`` adds ``filter``, an array of names. Codes of characters (``%3B``) in texts are resolved.
    FORMAT values are joined by tabs, one per sample, ``.`` where missing.
    """
    made: dict[str, Column] = {}
    for step in _vcf_steps(line, header):
        made |= step(made)
    return _vcf_values(made, header, filters, info_arrays)


def vcf_line(info: Column | None = None, filters: Column | None = None, samples: Sequence[Column] = ()) -> Column:
    """One line from the six base columns; ``info``, ``filters`` and ``samples`` (the keys, then the samples) are text."""
    missing = lambda c: F.coalesce(F.when(c != "", c), F.lit("."))
    cols = [
        missing(F.col("chrom")), F.coalesce(F.col("pos").cast("string"), F.lit("0")), missing(vcf_encoded(F.col("id"))), F.coalesce(F.col("ref"), F.lit("N")),
        missing(vcf_encoded(F.col("alt"))), missing(F.col("qual").cast("string")),
    ]
    return F.concat_ws("\t", *cols, F.lit(".") if filters is None else missing(filters), F.lit(".") if info is None else missing(info), *samples)


def _info_text(df: DataFrame, header: VcfHeader) -> Column:
    parts = []
    for key, kind in header.info_fields():
        name = f"INFO_{key}"
        if name not in df.columns:
            continue
        value = F.col(name)
        if kind == "Flag":
            parts.append(F.when(value, F.lit(key)))
            continue
        if isinstance(df.schema[name].dataType, T.ArrayType):
            value = F.when(F.size(value) > 0, F.array_join(F.transform(value, lambda x: x.cast("string")), ",", "."))
        elif kind in ("Integer", "Float"):
            value = value.cast("string")
        else:
            value = vcf_encoded(value, ";=")
        parts.append(F.concat(F.lit(f"{key}="), value))
    return F.concat_ws(";", *parts)


def _sample_text(df: DataFrame, header: VcfHeader) -> list[Column]:
    """FORMAT and one column per sample; keys that no sample of a row has are left out, the genotype comes first."""
    n = len(header.sample_names())
    keys = sorted((k for k, _ in header.format_fields() if f"FMT_{k}" in df.columns), key=lambda k: k != "GT")
    if not n:
        return []
    if not keys:
        return [F.lit(".")] * (n + 1)
    there = F.array(*(F.struct(F.lit(k).alias("key"), F.split(F.col(f"FMT_{k}"), "\t").alias("own")) for k in keys))
    there = F.filter(there, lambda x: x["own"].isNotNull() & F.exists(x["own"], lambda v: v != "."))
    text = lambda f: F.coalesce(F.nullif(F.array_join(F.transform(there, f), ":"), F.lit("")), F.lit("."))

    def sample(i: int) -> Column:
        return text(lambda x: F.coalesce(F.get(x["own"], F.lit(i)), F.lit(".")))

    return [text(lambda x: x["key"]), *(sample(i) for i in range(n))]


def vcf_record_line(df: DataFrame, header: VcfHeader) -> Column:
    """One line from the columns that ``vcf_columns`` gives with this header; a column that no line can hold is an error."""
    known = ["chrom", "pos", "id", "ref", "alt", "qual", "filter"]
    known += [f"INFO_{k}" for k, _ in header.info_fields()] + ([f"FMT_{k}" for k, _ in header.format_fields()] if header.sample_names() else [])
    unknown = [c for c in df.columns if c not in known]
    if unknown:
        raise ValueError(f"the header has no place for the column {unknown[0]!r}")
    filters = None
    if "filter" in df.columns:
        filters = F.array_join("filter", ";") if isinstance(df.schema["filter"].dataType, T.ArrayType) else F.col("filter")
    return vcf_line(_info_text(df, header), filters, _sample_text(df, header))


def read_vcf_header(spark: SparkSession, path: str) -> VcfHeader:
    return VcfHeader.parse("\n".join(header_lines(spark, path, "#")))


def read_vcf(spark: SparkSession, path: str, header: VcfHeader | None = None, filters: bool = False, info_arrays: bool = False) -> DataFrame:
    """Six columns, or all of the header's if it is given. Compressed text is read as well."""
    df = spark.read.text(path).where(~F.col("value").startswith("#") & (F.col("value") != ""))
    # one projection a step, so that a line is split once and not for each use of a field
    made: dict[str, Column] = {}
    for step in _vcf_steps(F.col("value"), header):
        new = step(made)
        df = df.select(*made.values(), *(c.alias(n) for n, c in new.items()))
        made |= {n: F.col(f"`{n}`") for n in new}
    return df.select(*_vcf_values(made, header, filters, info_arrays))


def write_vcf(df: DataFrame, path: str, header: VcfHeader | None = None) -> None:
    """FILTER, INFO and the samples are built from the columns that the header names (see ``vcf_record_line``)."""
    header = header or VcfHeader()
    _write_lines(df.select(vcf_record_line(df, header)), str(header), path)


def fastq_columns(title: Column, sequence: Column, quality: Column) -> list[Column]:
    """``name, description, sequence, quality_scores`` (binary) from the lines of a record; an empty description is null."""
    head = F.substr(F.regexp_replace(title, "\r$", ""), F.lit(2))
    name = F.regexp_extract(head, r"^(\S*)", 1)
    rest = F.regexp_extract(head, r"^\S*\s+(.*)$", 1)
    clean = lambda c: F.regexp_replace(c, "\r$", "").cast("binary")
    return [name.cast("binary").alias("name"), F.when(rest != "", rest).cast("binary").alias("description"), clean(sequence).alias("sequence"), clean(quality).alias("quality_scores")]


def _is_title(lines: Sequence[str], i: int) -> bool:
    """A line with ``@`` in front and a ``+`` line two lines on is a title: two lines behind a quality line stands a sequence."""
    return i + 2 < len(lines) and lines[i].startswith("@") and lines[i + 2].startswith("+")


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """Records of four lines: ``name, description, sequence, quality_scores``.

    Records are cut in the scan's tasks. Only what lies between a split's border and its first and last whole record, a few
    lines, is shuffled and put together. Further lines at a file's end that are no whole record are left out.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, held, inside = None, [], False
        for pdf in batches:
            rows: list[tuple] = []
            for file, split, value in zip(pdf["file"], pdf["split"], pdf["value"]):
                if (file, split) != place:
                    rows += [(*place, "tail", i, x, None, None, None) for i, x in enumerate(held)] if place else []
                    place, held, inside = (file, split), [], split == 0
                held.append(value)
                if not inside:
                    # the first title is known two lines later
                    i = len(held) - 3
                    if i >= 0 and _is_title(held, i):
                        rows += [(file, split, "head", k, x, None, None, None) for k, x in enumerate(held[:i])]
                        rows.append((file, split, "whole", -1, None, None, None, None))
                        held, inside = held[i:], True
                if inside and len(held) == 4:
                    rows.append((file, split, "record", -1, *held))
                    held = []
            yield pd.DataFrame(rows, columns=["file", "split", "kind", "no", *"abcd"])
        rest = [(*place, "tail", i, x, None, None, None) for i, x in enumerate(held)] if place else []
        yield pd.DataFrame(rest, columns=["file", "split", "kind", "no", *"abcd"])

    found = lines.mapInPandas(cut, "file string, split long, kind string, no int, a string, b string, c string, d string")
    # border lines of one file in order; a mark of a split with whole records separates its head from its tail
    border = found.where("kind != 'record'").withColumn("rank", F.expr("CASE kind WHEN 'head' THEN 0 WHEN 'whole' THEN 1 ELSE 2 END"))
    order = W.Window.partitionBy("file").orderBy("split", "rank", "no")
    border = border.withColumn("gap", F.count(F.when(F.col("kind") == "whole", 1)).over(order)).where("kind != 'whole'")
    border = border.withColumn("at", F.row_number().over(W.Window.partitionBy("file", "gap").orderBy("split", "rank", "no")) - 1)
    pick = lambda k: F.max(F.when(F.col("at") % 4 == k, F.col("a")))
    joined = border.groupBy("file", "gap", F.floor(F.col("at") / 4).alias("record")).agg(*(pick(k).alias(n) for k, n in enumerate("abcd")))
    records = found.where("kind = 'record'").select(*"abcd").unionAll(joined.where("b IS NOT NULL AND d IS NOT NULL").select(*"abcd"))
    return records.where("a != ''").select(*fastq_columns(F.col("a"), F.col("b"), F.col("d")))


def fastq_lines() -> Column:
    """The four lines of a record."""
    title = F.concat_ws(" ", F.concat(F.lit("@"), F.coalesce(F.col("name").cast("string"), F.lit(""))), F.col("description").cast("string"))
    text = lambda n: F.coalesce(F.col(n).cast("string"), F.lit(""))
    return F.concat_ws("\n", title, text("sequence"), F.lit("+"), text("quality_scores"))


def write_fastq(df: DataFrame, path: str) -> None:
    _write_lines(df.select(fastq_lines()), "", path)
