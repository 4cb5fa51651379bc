"""Text records with a reason and a place for each that does not parse, and typed values for those that do.

A recursive-descent grammar reads VCF and SAM text::

    text    = unit { newline unit }          unit   = header | record
    header  = ('#' | '@') rest of the line   record = field { tab field }
    field   = quoted | plain                 quoted = '"' { any but '"' | '""' } '"'      (VCF only)

Errors do not stop it. A record whose quoted field is not closed, or goes on after its closing mark, is given up at that
place; the parser then resumes at the next *anchor*: the start of a line that is validated as the start of a record (a
header mark, or a name, a tab and a whole number). Lines before it belong to the broken field.

``parse_records`` takes each row of a table as a text by itself, so a broken row never swallows another row. ``parse_files`` reads
files: there a quoted field may run over lines, but never over an anchor; so a file falls into stretches that begin at anchors
and can be read one by one, whatever its splits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..session import spread

VCF_FIELDS = ("chrom", "pos", "id", "ref", "alt", "qual", "filter", "info")
SAM_FIELDS = (
    "name", "flags", "reference_sequence_name", "alignment_start", "mapping_quality", "cigar",
    "mate_reference_sequence_name", "mate_alignment_start", "template_length", "sequence", "quality_scores",
)
VCF_TYPE = "struct<chrom:string,pos:int,id:string,ref:string,alt:string,qual:double,filter:string,info:string>"
SAM_TYPE = (
    "struct<name:string,flags:int,reference_sequence_name:string,alignment_start:int,mapping_quality:int,cigar:string,"
    "mate_reference_sequence_name:string,mate_alignment_start:int,template_length:int,sequence:string,quality_scores:string,tags:array<string>>"
)
ERROR_TYPE = "array<struct<reason:string,field_no:int,offset:int,message:string>>"
MAX_INT = 2**31 - 1
#: The header mark of each format.
HEADER = {"vcf": "#", "sam": "@"}
_WHOLE, _SIGNED = re.compile(r"[0-9]+"), re.compile(r"-?[0-9]+")
_NUMBER = re.compile(r"[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?")
_TAG = re.compile(r".{2}:[AifZHB]:.*", re.DOTALL)
_ANCHOR = re.compile(r"[^\t\n\"]+\t[0-9]+(?=[\t\r\n]|\Z)")


class Broken(Exception):
    """A quoting error: (offset, number of the field, message)."""


@dataclass
class Unit:
    """A header or a record: where it starts, its kind, its fields and its errors."""

    start: int
    kind: str = "record"
    fields: list[str] = field(default_factory=list)
    offsets: list[int] = field(default_factory=list)
    errors: list[tuple[str, int | None, int, str]] = field(default_factory=list)


class Grammar:
    """One text in one format; with ``across`` a quoted field may run over lines, up to the next anchor."""

    def __init__(self, text: str, fmt: str, across: bool = False):
        self.text, self.fmt, self.at, self.across = text, fmt, 0, across
        self.end = len(text)

    def line_end(self, at: int) -> tuple[int, int]:
        """(the newline behind ``at`` or the end of the text, the end of the line without a carriage return)."""
        stop = self.text.find("\n", at)
        stop = len(self.text) if stop < 0 else stop
        return stop, stop - 1 if stop > at and self.text[stop - 1] == "\r" else stop

    def units(self) -> Iterator[Unit]:
        while True:
            yield self.unit()
            if self.at >= len(self.text):
                return
            self.at += 1  # the newline

    def unit(self) -> Unit:
        unit = Unit(self.at)
        line_end, self.end = self.line_end(self.at)
        if self.text.startswith(HEADER[self.fmt], self.at):
            unit.kind = "header"
        else:
            try:
                self.record(unit)
                if self.across:
                    line_end = self.line_end(self.end)[0]
            except Broken as e:
                offset, number, message = e.args
                unit.errors = [("quoting", number, offset, message)]
                line_end = self.anchor(self.line_end(offset)[0])
        self.at = line_end
        return unit

    def anchor(self, at: int) -> int:
        """From a line's end on, the end of the line before the next validated start of a record, or of the text."""
        while at < len(self.text):
            if self.text.startswith(HEADER[self.fmt], at + 1) or _ANCHOR.match(self.text, at + 1):
                return at
            at = self.text.find("\n", at + 1)
            if at < 0:
                return len(self.text)
        return at

    def record(self, unit: Unit) -> None:
        while True:
            unit.offsets.append(self.at)
            unit.fields.append(self.field(len(unit.offsets)))
            if self.at >= self.end:
                return
            self.at += 1  # the tab

    def field(self, number: int) -> str:
        if self.fmt == "vcf" and self.at < self.end and self.text[self.at] == '"':
            return self.quoted(number)
        start, stop = self.at, self.text.find("\t", self.at, self.end)
        self.at = self.end if stop < 0 else stop
        return self.text[start : self.at]

    def quoted(self, number: int) -> str:
        start = at = self.at
        limit = self.anchor(self.line_end(start)[0]) if self.across else self.end
        while True:
            at = self.text.find('"', at + 1, limit)
            if at < 0:
                raise Broken(start, number, "the quoted field is not closed")
            if at + 1 < limit and self.text[at + 1] == '"':
                at += 1
                continue
            break
        if self.across:
            self.end = self.line_end(at)[1]
        if at + 1 < self.end and self.text[at + 1] != "\t":
            raise Broken(at + 1, number, "the quoted field goes on after its closing mark")
        self.at = at + 1
        return self.text[start + 1 : at].replace('""', '"')


def _whole(text: str, low: int = 1) -> int | None:
    """A whole number of ASCII digits within 32 bits, else None."""
    return int(text) if _WHOLE.fullmatch(text) and len(text.lstrip("0")) <= 10 and low <= int(text) <= MAX_INT else None


def _signed(text: str) -> int | None:
    if not _SIGNED.fullmatch(text) or len(text.lstrip("-0")) > 10:
        return None
    return n if -MAX_INT - 1 <= (n := int(text)) <= MAX_INT else None


def typed_vcf(unit: Unit) -> dict | None:
    """Typed values of a VCF record; errors are added to the unit."""
    if len(unit.fields) != len(VCF_FIELDS):
        unit.errors.append(("column_count", None, unit.start, f"{len(unit.fields)} fields instead of {len(VCF_FIELDS)}"))
        return None
    row = dict(zip(VCF_FIELDS, unit.fields))
    pos, qual = _whole(row["pos"]), row["qual"]
    if pos is None:
        unit.errors.append(("pos", 2, unit.offsets[1], "not a whole number from 1 to 2147483647"))
    if qual != "." and not _NUMBER.fullmatch(qual):
        unit.errors.append(("qual", 6, unit.offsets[5], "neither '.' nor an unsigned number"))
    if unit.errors:
        return None
    return row | {"pos": pos, "qual": None if qual == "." else float(qual)} | {k: None for k in ("id", "alt", "filter", "info") if row[k] == "."}


def typed_sam(unit: Unit) -> dict | None:
    """Typed values of a SAM record; errors are added to the unit. Flags and mapping quality that are no numbers are null."""
    n = len(SAM_FIELDS)
    if len(unit.fields) < n:
        unit.errors.append(("column_count", None, unit.start, f"{len(unit.fields)} fields instead of at least {n}"))
        return None
    for i, tag in enumerate(unit.fields[n:], n):
        if not _TAG.fullmatch(tag):
            unit.errors.append(("column_count", i + 1, unit.offsets[i], "a further field that is no tag"))
            return None
    row = dict(zip(SAM_FIELDS, unit.fields))
    length = _signed(row["template_length"])
    if length is None:
        unit.errors.append(("template_length", 9, unit.offsets[8], "not a whole number within 32 bits"))
        return None
    quality = _whole(row["mapping_quality"], 0)
    return row | {
        "flags": _whole(row["flags"], 0), "alignment_start": _whole(row["alignment_start"]), "mapping_quality": None if quality == 255 else quality,
        "mate_alignment_start": _whole(row["mate_alignment_start"]), "template_length": length, "tags": unit.fields[n:],
    } | {k: None for k in ("reference_sequence_name", "mate_reference_sequence_name") if row[k] == "*"}


def parse_text(text: str | None, fmt: str | None) -> list[tuple[int, str, dict | None, dict | None, list[tuple]]]:
    """(record number, kind, VCF values, SAM values, errors) of each unit of a text."""
    if fmt not in HEADER:
        return [(1, "bad", None, None, [("format", None, 0, f"unknown format {fmt!r}")])]
    out = []
    for no, unit in enumerate(Grammar(text or "", fmt).units(), 1):
        vcf = sam = None
        if unit.kind == "record" and not unit.errors:
            if fmt == "vcf":
                vcf = typed_vcf(unit)
            else:
                sam = typed_sam(unit)
        out.append((no, "bad" if unit.errors else unit.kind, vcf, sam, unit.errors))
    return out


def parse_records(df: DataFrame, id_col: str = "line_id", fmt_col: str = "fmt", line_col: str = "line", spread_rows: bool = True) -> DataFrame:
    """One row per header or record: ``id_col, fmt, record_no, kind, vcf, sam, errors``. No shuffle.

    ``kind`` is ``header``, ``record`` or ``bad``; a valid record has its typed values in ``vcf`` or ``sam``, a bad one has its
    ``errors`` (reason, number of the field, offset in the text, message). A record with a ``quoting`` or ``column_count``
    error has that error only. A carriage return at a line's end is not part of it. A null line is an empty one and thus
    no valid record; an unknown format gives the reason ``format``. Further columns are ignored; repeated rows are kept.
    """
    safe = df.select(df[id_col].cast("string").alias("id"), df[fmt_col].cast("string").alias("fmt"), df[line_col].cast("string").alias("line"))
    names = ["reason", "field_no", "offset", "message"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, fmt, line in zip(pdf["id"], pdf["fmt"], pdf["line"]):
                fmt = None if pd.isna(fmt) else fmt
                for no, kind, vcf, sam, errors in parse_text(None if pd.isna(line) else line, fmt):
                    rows.append((i, fmt, no, kind, vcf, sam, [dict(zip(names, e)) for e in errors]))
            yield pd.DataFrame(rows, columns=["id", "fmt", "record_no", "kind", "vcf", "sam", "errors"])

    # ids travel as text: pandas would round large numbers beside nulls
    out = (spread(safe) if spread_rows else safe).mapInPandas(read, f"id string, fmt string, record_no int, kind string, vcf {VCF_TYPE}, sam {SAM_TYPE}, errors {ERROR_TYPE}")
    return out.withColumn("id", F.col("id").cast(df.schema[id_col].dataType)).withColumnRenamed("id", id_col)


def is_anchor(line: str, fmt: str) -> bool:
    """The line is a header, or begins a record: a name, a tab and a whole number."""
    return line.startswith(HEADER[fmt]) or _ANCHOR.match(line) is not None


def _units(text: str, fmt: str) -> Iterator[tuple]:
    """(line in the text from 0, number of lines, kind, vcf, sam, errors) of each unit of a stretch."""
    names = ["reason", "field_no", "offset", "message"]
    grammar, line, since = Grammar(text, fmt, True), 0, 0
    for unit in grammar.units():
        line += text.count("\n", since, unit.start)
        since = unit.start
        vcf = typed_vcf(unit) if unit.kind == "record" and not unit.errors and fmt == "vcf" else None
        sam = typed_sam(unit) if unit.kind == "record" and not unit.errors and fmt == "sam" else None
        errors = [dict(zip(names, (r, f, o - unit.start, m))) for r, f, o, m in unit.errors]
        yield line, text.count("\n", unit.start, grammar.at) + 1, "bad" if errors else unit.kind, vcf, sam, errors


def parse_files(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """Headers and records of text files: ``file, line_no, n_lines, kind, vcf, sam, errors``.

    ``line_no`` is the unit's first line in its file, from 1, ``n_lines`` how many it takes up: more than one if a quoted field runs over
    lines, or if lines up to the next anchor belong to a broken one. Files are read in splits; stretches between anchors are parsed
    where they are read, only the few lines around a split's border are shuffled and put together. A stretch without any
    anchor is held by one task. The result does not depend on the splits.
    """
    if fmt not in HEADER:
        raise ValueError(f"unknown format {fmt!r}")
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")
    names = ["file", "split", "role", "line", "text", "n_lines", "kind", "vcf", "sam", "errors"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, held, begun, n, anchored = None, [], 0, 0, False

        def border(role: str, text: str | None) -> tuple:
            return (*place, role, begun, text, n, None, None, None, None)

        def close() -> list[tuple]:
            """What is left of a split: its last stretch, and how many lines it had."""
            return [border("tail" if anchored else "head", "\n".join(held)), border("size", None)] if place else []

        for pdf in batches:
            rows: list[tuple] = []
            for file, split, value in zip(pdf["file"], pdf["split"], pdf["value"]):
                if (file, split) != place:
                    rows += close()
                    place, held, begun, n, anchored = (file, split), [], 0, 0, split == 0
                if held and is_anchor(value, fmt):
                    text = "\n".join(held)
                    if anchored:
                        rows += [(file, split, "unit", begun + k, None, m, *rest) for k, m, *rest in _units(text, fmt)]
                    else:
                        rows.append(border("head", text))
                    held, begun, anchored = [], n, True
                anchored = anchored or is_anchor(value, fmt)
                held.append(value)
                n += 1
            yield pd.DataFrame(rows, columns=names)
        yield pd.DataFrame(close(), columns=names)

    schema = f"file string, split long, role string, line int, text string, n_lines int, kind string, vcf {VCF_TYPE}, sam {SAM_TYPE}, errors {ERROR_TYPE}"
    found = lines.mapInPandas(read, schema)
    small = found.where("role != 'unit'").select("file", "split", "role", "line", "text", "n_lines")
    before = W.Window.partitionBy("file").orderBy("split").rowsBetween(W.Window.unboundedPreceding, -1)
    sizes = small.where("role = 'size'").select("file", "split", F.coalesce(F.sum("n_lines").over(before), F.lit(0)).alias("offset"))
    # a split's head continues the tail of the split before it; a split without an anchor is all head
    order = W.Window.partitionBy("file").orderBy("split", "line")
    edges = small.where("role != 'size'").withColumn("gap", F.count(F.when(F.col("role") == "tail", 1)).over(order)).join(sizes, ["file", "split"])
    edges = edges.groupBy("file", "gap").agg(F.array_sort(F.collect_list(F.struct("split", "line", "text", (F.col("offset") + F.col("line")).alias("at")))).alias("parts"))
    edges = edges.select("file", F.col("parts")[0]["at"].alias("at"), F.array_join(F.transform("parts", lambda x: x["text"]), "\n").alias("text"))

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(f, at + k, *rest) for f, at, text in zip(pdf["file"], pdf["at"], pdf["text"]) for k, *rest in _units(text, fmt)]
            yield pd.DataFrame(rows, columns=["file", "line_no", "n_lines", "kind", "vcf", "sam", "errors"])

    joined = edges.mapInPandas(join, f"file string, line_no long, n_lines int, kind string, vcf {VCF_TYPE}, sam {SAM_TYPE}, errors {ERROR_TYPE}")
    whole = found.where("role = 'unit'").join(sizes, ["file", "split"]).select("file", (F.col("offset") + F.col("line")).alias("line_no"), "n_lines", "kind", "vcf", "sam", "errors")
    return whole.unionAll(joined).withColumn("line_no", F.col("line_no") + 1)


def bad_lines(parsed: DataFrame, id_col: str = "line_id") -> DataFrame:
    """``id_col, record_no, reason, field_no, offset, message``: one row per error."""
    return parsed.select(id_col, "record_no", F.explode("errors").alias("e")).select(id_col, "record_no", "e.*")
