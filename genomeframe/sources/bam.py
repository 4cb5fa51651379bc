"""BAM files as a Spark data source: ``spark.read.format("bam")`` and ``df.write.format("bam")``.

Columns are the eleven of the BAM schema and ``data``, the further fields as the record holds them; the option ``tags`` adds
them typed (see ``tags``). Reading: files are cut by their size into ranges of blocks; each task finds the first record of its
range in the file's index (``<path>.bai``) or, without one, by looking for a place from which valid records follow each other.
With the option ``region`` ("chr1:1000-2000") only the chunks that the index names are read, and only records that overlap it
come out. Writing: each task writes a complete file, with the option ``index`` also its index; a column ``tags`` or else ``data`` gives the further
fields. Nothing is planned or indexed by reading files on the driver. Paths may be on any file system that Arrow reaches.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..functions.coords import Region
from . import files, parts, tags
from .bgzf import Reader, Writer
from .headers import SamHeader

SCHEMA = (
    "name binary, flags int, reference_sequence_id int, alignment_start int, mapping_quality smallint, cigar binary, "
    "mate_reference_sequence_id int, mate_alignment_start int, template_length int, sequence binary, quality_scores binary, data binary"
)
_ARROW = pa.schema(
    [(n, {"binary": pa.binary(), "int": pa.int32(), "smallint": pa.int16()}[t]) for n, t in (x.split(" ") for x in SCHEMA.split(", "))]
)
_FIXED = struct.Struct("<iiBBHHHiiii")
BATCH = 8192
#: Operations (codes of M, D, N, =, X) that advance on the reference.
_ON_REFERENCE = (0, 2, 3, 7, 8)
_TAGS = pa.list_(pa.struct([("tag", pa.string()), ("type", pa.string()), ("value", pa.string()), ("i", pa.int64()), ("f", pa.float64()), ("a", pa.list_(pa.float64()))]))


def read_header(path: str) -> tuple[SamHeader, list[str], int]:
    """(header, reference names by id, virtual position of the first record)."""
    with Reader(path) as r:
        if r.read(4) != b"BAM\1":
            raise ValueError(f"{path} is no BAM file")
        text = r.read(struct.unpack("<i", r.read(4))[0]).rstrip(b"\0").decode()
        names, lines = [], []
        for _ in range(struct.unpack("<i", r.read(4))[0]):
            name = r.read(struct.unpack("<i", r.read(4))[0])[:-1].decode()
            size = struct.unpack("<i", r.read(4))[0]
            names.append(name)
            lines.append(f"@SQ\tSN:{name}\tLN:{size}")
        header = SamHeader.parse(text) if text.strip() else SamHeader(tuple(lines))
        return header, names, r.tell()


def header_bytes(header: SamHeader) -> bytes:
    text, refs = str(header).encode(), header.reference_sequences()
    out = b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(refs))
    for name, size in refs.items():
        raw = name.encode() + b"\0"
        out += struct.pack("<i", len(raw)) + raw + struct.pack("<i", size)
    return out


def covered(cigar: bytes) -> int:
    return sum(w >> 4 for (w,) in struct.iter_unpack("<I", cigar) if w & 15 in _ON_REFERENCE)


def decode(body: bytes) -> tuple:
    """The columns of one record."""
    ref, pos, l_name, mapq, _, n_ops, flags, l_seq, mate_ref, mate_pos, length = _FIXED.unpack_from(body)
    at = _FIXED.size
    name = body[at : at + l_name - 1]
    at += l_name
    cigar = body[at : at + 4 * n_ops]
    at += 4 * n_ops
    half = (l_seq + 1) // 2
    quality = body[at + half : at + half + l_seq]
    return (
        None if name == b"*" else name, flags, None if ref < 0 else ref, None if pos < 0 else pos + 1, None if mapq == 255 else mapq, cigar,
        None if mate_ref < 0 else mate_ref, None if mate_pos < 0 else mate_pos + 1, length, body[at : at + half],
        b"" if quality.startswith(b"\xff") else quality, body[at + half + l_seq :],
    )


def _bin(start: int, end: int) -> int:
    """The smallest index bin (16 KiB up to 512 MiB) that holds the 0-based half-open interval."""
    end -= 1
    for shift, first in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)):
        if start >> shift == end >> shift:
            return first + (start >> shift)
    return 0


def _bins(start: int, end: int) -> set[int]:
    """All bins that may hold records overlapping the interval."""
    end = min(end, 1 << 29) - 1
    out = {0}
    for shift, first in ((26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)):
        out.update(range(first + (start >> shift), first + (end >> shift) + 1))
    return out


def encode(row: dict) -> bytes:
    name = bytes(row["name"] or b"*") + b"\0"
    cigar, seq, qual = (bytes(row[c] or b"") for c in ("cigar", "sequence", "quality_scores"))
    l_seq = len(qual) or (2 * len(seq) - (1 if seq and seq[-1] & 15 == 0 else 0))
    minus = lambda c: -1 if row[c] is None else row[c] - 1
    ident = lambda c: -1 if row[c] is None else row[c]
    pos = minus("alignment_start")
    body = _FIXED.pack(
        ident("reference_sequence_id"), pos, len(name), 255 if row["mapping_quality"] is None else row["mapping_quality"], _bin(pos, pos + max(1, covered(cigar))) if pos >= 0 else 4680,
        len(cigar) // 4, row["flags"] or 0, l_seq, ident("mate_reference_sequence_id"), minus("mate_alignment_start"), row["template_length"] or 0,
    )
    further = tags.encode(row["tags"]) if row.get("tags") is not None else bytes(row.get("data") or b"")
    body += name + cigar + seq + (qual or b"\xff" * l_seq) + further
    return struct.pack("<i", len(body)) + body


def records(path: str, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(virtual position, record) of those that begin in the range."""
    with Reader(path, start) as r:
        while (at := r.tell()) < end:
            size = r.read(4)
            if len(size) < 4:
                return
            yield at, r.read(struct.unpack("<i", size)[0])


def record_length(sizes: list[int]):
    """Tells whether a record may begin at a place, for a file with these references (see ``parts.record_start``)."""

    def length(data: bytes, i: int) -> int:
        if i + 36 > len(data):
            return 0
        size = struct.unpack_from("<i", data, i)[0]
        ref, pos, l_name, _, _, n_ops, _, l_seq, mate_ref, mate_pos, _ = _FIXED.unpack_from(data, i + 4)
        n = len(sizes)
        if not (-1 <= ref < n and -1 <= mate_ref < n and pos >= -1 and mate_pos >= -1 and l_name >= 1 and l_seq >= 0):
            return -1
        if size < 32 + l_name + 4 * n_ops + (l_seq + 1) // 2 + l_seq or ref >= 0 and pos > sizes[ref] or mate_ref >= 0 and mate_pos > sizes[mate_ref]:
            return -1
        name = data[i + 36 : i + 36 + l_name]
        if len(name) == l_name and (name[-1] != 0 or any(not 33 <= c <= 126 for c in name[:-1])):
            return -1
        return size + 4

    return length


class IndexBuilder:
    """Chunks by bin and the linear index, filled record by record in the order of the file."""

    def __init__(self, n_references: int):
        self.bins: list[dict[int, list[list[int]]]] = [{} for _ in range(n_references)]
        self.linear: list[list[int]] = [[] for _ in range(n_references)]

    def add(self, ref: int | None, start: int | None, cigar: bytes, begin: int, stop: int) -> None:
        """A record at virtual positions from ``begin`` to ``stop``; ``start`` is 1-based. Unplaced records have no entry."""
        if ref is None or start is None:
            return
        pos = start - 1
        last = pos + max(1, covered(cigar))
        chunks = self.bins[ref].setdefault(_bin(pos, last), [])
        if chunks and chunks[-1][1] == begin:
            chunks[-1][1] = stop
        else:
            chunks.append([begin, stop])
        slots = self.linear[ref]
        for w in range(pos >> 14, (last - 1 >> 14) + 1):
            slots += [0] * (w + 1 - len(slots))
            slots[w] = min(slots[w] or begin, begin)

    def to_bytes(self) -> bytes:
        out = b"BAI\1" + struct.pack("<i", len(self.bins))
        for b, slots in zip(self.bins, self.linear):
            out += struct.pack("<i", len(b))
            for k in sorted(b):
                out += struct.pack("<Ii", k, len(b[k])) + b"".join(struct.pack("<QQ", *c) for c in b[k])
            out += struct.pack("<i", len(slots)) + struct.pack(f"<{len(slots)}Q", *slots)
        return out


def index_file(path: str) -> int:
    """Write ``<path>.bai`` for one file sorted by reference and start; the number of its records. It runs where it is called."""
    _, names, first = read_header(path)
    builder, held, n = IndexBuilder(len(names)), None, 0
    for at, body in records(path, first, parts.END):
        if held is not None:
            builder.add(*held, at)
        row = decode(body)
        held, n = (row[2], row[3], row[5], at), n + 1
    if held is not None:
        with Reader(path) as r:
            builder.add(*held, r.size() << 16)
    with files.open_output(f"{path}.bai") as out:
        out.write(builder.to_bytes())
    return n


def write_indexes(spark: SparkSession, path: str) -> DataFrame:
    """Index all BAM files of a folder, one task a file: ``path, n_records`` (the work is done when the result is)."""
    return parts.for_each_file(spark, path, ".bam", index_file)


@dataclass
class Index:
    """Chunks by bin and the linear index of each reference."""

    bins: list[dict[int, list[tuple[int, int]]]]
    linear: list[list[int]]

    @classmethod
    def read(cls, path: str) -> Index:
        with files.open_input(path) as f:
            if f.read(4) != b"BAI\1":
                raise ValueError(f"{path} is no BAI file")
            take = lambda fmt: struct.unpack(fmt, f.read(struct.calcsize(fmt)))
            bins, linear = [], []
            for _ in range(take("<i")[0]):
                own = {}
                for _ in range(take("<i")[0]):
                    number, n = take("<Ii")
                    own[number] = [take("<QQ") for _ in range(n)]
                bins.append(own)
                linear.append(list(take(f"<{take('<i')[0]}Q")))
        return cls(bins, linear)

    def starts(self) -> list[int]:
        """Record starts, in the order of the file. Bin 37450 holds statistics, not chunks."""
        return sorted({c[0] for own in self.bins for k, cs in own.items() if k != 37450 for c in cs} | {x for slots in self.linear for x in slots if x})

    def chunks(self, reference: int, start: int, end: int) -> list[tuple[int, int]]:
        """Merged ranges that hold all records overlapping a 0-based half-open interval."""
        slots = self.linear[reference]
        least = slots[start >> 14] if start >> 14 < len(slots) else 0
        found = sorted(c for k in _bins(start, end) for c in self.bins[reference].get(k, []) if c[1] > least)
        out: list[tuple[int, int]] = []
        for a, b in found:
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
        return out


class BamReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.region, self.typed = options["path"], options.get("region"), options.get("tags", "false").lower() == "true"
        self.split_bytes = int(options.get("split_bytes", parts.SPLIT_BYTES))

    def partitions(self) -> list[InputPartition]:
        return parts.ranges(self.path, ".bam", self.split_bytes)

    def _places(self, part: parts.Range) -> Iterator[tuple[bytes, int, int, int]]:
        """Records of a part with the region asked for as (body, reference, first, last)."""
        header, names, first = read_header(part.path)
        index = Index.read(f"{part.path}.bai") if files.exists(f"{part.path}.bai") else None
        sizes = list(header.reference_sequences().values())
        if self.region and index is not None:
            region = Region.parse(self.region)
            if region.name in names:
                ref, a, b = names.index(region.name), region.start or 1, region.end or 1 << 60
                for low, high in parts.chunk_parts(part, index.chunks(ref, a - 1, min(b, 1 << 29)), first, record_length(sizes)):
                    for _, body in records(part.path, low, high):
                        yield body, ref, a, b
            return
        low, high = parts.bounds(part, index.starts() if index else (), first, record_length(sizes))
        ref, a, b = -1, 0, 0
        if self.region:
            region = Region.parse(self.region)
            if region.name not in names:
                return
            ref, a, b = names.index(region.name), region.start or 1, region.end or 1 << 60
        for _, body in records(part.path, low, high) if low < high else ():
            yield body, ref, a, b

    def read(self, partition: parts.Range) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for body, ref, a, b in self._places(partition) if partition.path else ():
            row = decode(body)
            if ref >= 0 and (row[2] != ref or row[3] is None or row[3] > b or row[3] + max(1, covered(row[5])) - 1 < a):
                continue
            rows.append(row)
            if len(rows) == BATCH:
                yield self._batch(rows)
                rows = []
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)]
        schema = _ARROW
        if self.typed:
            names = [f.name for f in _TAGS.value_type]
            columns.append(pa.array([[dict(zip(names, t)) for t in tags.decode(r[-1])] for r in rows], _TAGS))
            schema = _ARROW.append(pa.field("tags", _TAGS))
        return pa.RecordBatch.from_arrays(columns, schema=schema)


class BamWriter(parts.FileWriter):
    suffix, index_suffix = ".bam", ".bai"

    def fill(self, writer: Writer, rows: Iterator[dict]) -> bytes | None:
        header = SamHeader.parse(self.options.get("header", ""))
        builder = IndexBuilder(len(header.reference_sequences())) if self.options.get("index", "false").lower() == "true" else None
        writer.write(header_bytes(header))
        writer.flush()
        for record in rows:
            at = writer.tell()
            writer.write(encode(record))
            if builder is not None:
                builder.add(record["reference_sequence_id"], record["alignment_start"], bytes(record["cigar"] or b""), at, writer.tell())
        return builder.to_bytes() if builder is not None else None


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA + (f", tags {tags.TAG_TYPE}" if self.options.get("tags", "false").lower() == "true" else "")

    def reader(self, schema: StructType) -> BamReader:
        return BamReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> BamWriter:
        return BamWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BamSource)
