"""BCF files as a Spark data source: ``spark.read.format("bcf")`` and ``df.write.format("bcf")``.

The columns are those of VCF text (``vcf_columns``): six base columns, one ``INFO_<KEY>`` per INFO of the header and, with
samples, one ``FMT_<KEY>`` per FORMAT. The option ``filters`` adds ``filter``, an array of names; with ``info_arrays`` an INFO of
more than one number is an array, otherwise its first value. With both, a file that is read and written again loses nothing.
Splits, regions (by a CSI index, ``<path>.csi``) and writing work as for BAM (``bam``, ``parts``).
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..functions.coords import Region
from . import files, parts
from .bgzf import BLOCK, EOF, Reader, Writer, pack_block
from .headers import VcfHeader
from .numbers import short

_KINDS = {"Integer": ("int", pa.int32()), "Float": ("float", pa.float32()), "Flag": ("boolean", pa.bool_()), "String": ("string", pa.string()), "Character": ("string", pa.string())}
#: Fixed values of the format: codes of types with width, missing value and end of vector.
_INTS = {1: ("b", -128, -127), 2: ("h", -32768, -32767), 3: ("i", -(1 << 31), -(1 << 31) + 1)}
_FLOAT_MISSING, _FLOAT_END = 0x7F800001, 0x7F800002
_FIXED = struct.Struct("<iiifHHI")
_WIDTHS = {0: 0, 1: 1, 2: 2, 3: 4, 5: 4, 7: 1}
BATCH = 4096
#: Values of samples that a worker keeps, since few different ones make up most records; not those of many samples, which are long.
CACHED, CACHED_SAMPLES = 1024, 16


def columns(header: VcfHeader, filters: bool = False, info_arrays: bool = False) -> list[tuple[str, str, pa.DataType]]:
    base = [("chrom", "string", pa.string()), ("pos", "int", pa.int32()), ("id", "string", pa.string()), ("ref", "string", pa.string()), ("alt", "string", pa.string()), ("qual", "float", pa.float32())]
    if filters:
        base.append(("filter", "array<string>", pa.list_(pa.string())))
    several = header.info_lists() if info_arrays else ()
    for key, kind in header.info_fields():
        name, arrow = _KINDS.get(kind, _KINDS["String"])
        base.append((f"INFO_{key}", f"array<{name}>", pa.list_(arrow)) if key in several else (f"INFO_{key}", name, arrow))
    return base + ([(f"FMT_{k}", "string", pa.string()) for k, _ in header.format_fields()] if header.sample_names() else [])


def dictionary(header: VcfHeader) -> list[str]:
    """Names of filters and keys by number: PASS first, then in the order of the header."""
    out = ["PASS"]
    for line in header.lines:
        m = re.match(r"##(?:FILTER|INFO|FORMAT)=<ID=([^,>]+)", line)
        if m and m[1] not in out:
            out.append(m[1])
    return out


def read_header(path: str) -> tuple[VcfHeader, int]:
    with Reader(path) as r:
        if r.read(3) != b"BCF":
            raise ValueError(f"{path} is no BCF file")
        r.read(2)
        text = r.read(struct.unpack("<I", r.read(4))[0]).rstrip(b"\0").decode()
        return VcfHeader.parse(text), r.tell()


def _typed(data: bytes, at: int) -> tuple[int, int, int]:
    """(type, number of values, place of the values)."""
    b = data[at]
    n, at = b >> 4, at + 1
    if n == 15:
        kind, _, at = _typed(data, at)
        f = _INTS[kind][0]
        n = struct.unpack_from("<" + f, data, at)[0]
        at += struct.calcsize(f)
    return b & 15, n, at


def _values(data: bytes, kind: int, n: int, at: int) -> tuple[list | str, int]:
    """Values with None where missing, up to the end of the vector; text for characters."""
    if kind == 7:
        return data[at : at + n].rstrip(b"\0").decode(), at + n
    if kind == 0:
        return [], at
    if kind == 5:
        raw = struct.unpack_from(f"<{n}I", data, at)
        floats = struct.unpack_from(f"<{n}f", data, at)
        return [None if b == _FLOAT_MISSING else f for b, f in zip(raw, floats) if b != _FLOAT_END], at + 4 * n
    f, missing, end = _INTS[kind]
    raw = struct.unpack_from(f"<{n}{f}", data, at)
    return [None if x == missing else x for x in raw if x != end], at + n * struct.calcsize(f)


def _take(data: bytes, at: int) -> tuple[list | str, int]:
    kind, n, at = _typed(data, at)
    return _values(data, kind, n, at)


def _shown(x: object) -> str:
    if x is None:
        return "."
    if isinstance(x, float):
        return short(x)
    return str(x)


def genotype(values: list) -> str:
    out = ""
    for i, v in enumerate(values):
        v = v or 0
        out += ("|" if v & 1 else "/") if i else ""
        out += str((v >> 1) - 1) if v >> 1 else "."
    return out or "."


@lru_cache(CACHED)
def _shown_samples(data: bytes, kind: int, n: int, samples: int, is_genotype: bool) -> str:
    """The values of all samples of a record, joined by tabs."""
    shown, at = [], 0
    for _ in range(samples):
        value, at = _values(data, kind, n, at)
        shown.append(genotype(value) if is_genotype and not isinstance(value, str) else (value or ".") if isinstance(value, str) else ",".join(map(_shown, value)) or ".")
    return "\t".join(shown)


@dataclass
class Codec:
    """Rows of one header; keeps what is looked up for each record."""

    header: VcfHeader
    filters: bool = False
    info_arrays: bool = False
    words: list[str] = field(init=False)
    contigs: list[str] = field(init=False)
    names: list[str] = field(init=False)

    def __post_init__(self) -> None:
        self.words, self.contigs = dictionary(self.header), list(self.header.contigs())
        self.names = [c[0] for c in columns(self.header, self.filters)]
        self.several = self.header.info_lists() if self.info_arrays else frozenset()
        self.info, self.format = dict(self.header.info_fields()), dict(self.header.format_fields())
        self.samples = len(self.header.sample_names())
        self.numbers, self.places = {w: i for i, w in enumerate(self.words)}, {c: i for i, c in enumerate(self.contigs)}
        self.heads = {k: _put_ints([self.numbers[k]]) for k in (*self.info, *self.format) if k in self.numbers}
        self.empty = dict.fromkeys(self.names) | {f"INFO_{k}": False for k, t in self.info.items() if t == "Flag"}
        if self.samples:
            self.empty |= {f"FMT_{k}": "\t".join("." * self.samples) for k in self.format}

    def decode(self, shared: bytes, single: bytes) -> tuple[dict, int]:
        """(row, number of reference positions)."""
        chrom, pos, span, qual, n_info, n_allele, counts = _FIXED.unpack_from(shared)
        raw_qual = struct.unpack_from("<I", shared, 12)[0]
        ident, at = _take(shared, _FIXED.size)
        alleles = []
        for _ in range(n_allele):
            a, at = _take(shared, at)
            alleles.append(a or "")
        marks, at = _take(shared, at)
        row: dict = self.empty.copy()
        if self.filters:
            row["filter"] = [self.words[i] for i in marks] or None
        row |= {
            "chrom": self.contigs[chrom] if 0 <= chrom < len(self.contigs) else "", "pos": pos + 1 if pos >= 0 else None, "id": ident if ident and ident != "." else None,
            "ref": alleles[0] if alleles else "", "alt": ",".join(alleles[1:]) or None, "qual": None if raw_qual == _FLOAT_MISSING else qual,
        }
        for _ in range(n_info):
            key, at = _take(shared, at)
            value, at = _take(shared, at)
            name = self.words[key[0]]
            kind = self.info.get(name)
            if kind == "Flag":
                row[f"INFO_{name}"] = True
            elif name in self.several:
                row[f"INFO_{name}"] = list(value) or None
            elif kind in ("Integer", "Float"):
                row[f"INFO_{name}"] = value[0] if value else None
            elif kind and value:
                row[f"INFO_{name}"] = value if isinstance(value, str) else ",".join(map(_shown, value))
        at, shown = 0, _shown_samples if self.samples <= CACHED_SAMPLES else _shown_samples.__wrapped__
        for _ in range(counts >> 24 if self.samples else 0):
            key, at = _take(single, at)
            kind, n, at = _typed(single, at)
            name, end = self.words[key[0]], at + self.samples * n * _WIDTHS[kind]
            if name in self.format:
                row[f"FMT_{name}"] = shown(single[at:end], kind, n, self.samples, name == "GT")
            at = end
        return row, span

    def encode(self, row: dict) -> bytes:
        chrom, ref = row["chrom"], row["ref"] or "N"
        if chrom not in self.places:
            raise ValueError(f"the header has no contig {chrom!r}")
        alts = row["alt"].split(",") if row["alt"] else []
        info = b""
        n_info = 0
        for key, kind in self.info.items():
            v = row.get(f"INFO_{key}")
            if v is None or v is False:
                continue
            n_info += 1
            info += self.heads[key]
            values = list(v) if isinstance(v, (list, tuple)) else [v]
            if kind == "Flag":
                info += b"\0"
            elif kind in ("Integer", "Float"):
                info += _put_ints(values) if kind == "Integer" else _put_floats(values)
            else:
                info += _put_text(str(v))
        single, n_format, put = b"", 0, _put_samples if self.samples <= CACHED_SAMPLES else _put_samples.__wrapped__
        for key, kind in self.format.items() if self.samples else ():
            values = put(row.get(f"FMT_{key}"), self.samples, "GT" if key == "GT" else kind)
            if values:
                n_format += 1
                single += self.heads[key] + values
        qual = struct.pack("<I", _FLOAT_MISSING) if row["qual"] is None else struct.pack("<f", row["qual"])
        shared = struct.pack("<iii", self.places[chrom], (row["pos"] or 0) - 1, len(ref)) + qual
        shared += struct.pack("<HHI", n_info, 1 + len(alts), n_format << 24 | self.samples) + _put_text(row["id"] or ".")
        shared += b"".join(map(_put_text, [ref, *alts])) + self._marks(row.get("filter")) + info
        return struct.pack("<II", len(shared), len(single)) + shared + single

    def _marks(self, names: list[str] | None) -> bytes:
        """Filters as numbers of the dictionary; no filter at all is a missing value."""
        unknown = [n for n in names or () if n not in self.numbers]
        if unknown:
            raise ValueError(f"the header has no filter {unknown[0]!r}")
        return _put_ints([self.numbers[n] for n in names]) if names else b"\0"


def _head(kind: int, n: int) -> bytes:
    return bytes([n << 4 | kind]) if n < 15 else bytes([15 << 4 | kind]) + _put_ints([n])


def _int_kind(values: list) -> int:
    there = [v for v in values if v is not None] or [0]
    return 1 if -120 <= min(there) and max(there) < 128 else 2 if -32760 <= min(there) and max(there) < 32768 else 3


def _ints(values: list, kind: int, n: int) -> bytes:
    f, missing, end = _INTS[kind]
    full = [missing if v is None else v for v in values] + [end] * (n - len(values))
    return struct.pack(f"<{n}{f}", *full)


def _put_ints(values: list) -> bytes:
    if len(values) == 1 and values[0] is not None and -120 <= values[0] < 128:
        return bytes((17, values[0] & 255))
    kind = _int_kind(values)
    return _head(kind, len(values)) + _ints(values, kind, len(values))


def _floats(values: list, n: int) -> bytes:
    full = [struct.pack("<I", _FLOAT_MISSING) if v is None else struct.pack("<f", v) for v in values]
    return b"".join(full + [struct.pack("<I", _FLOAT_END)] * (n - len(values)))


def _put_floats(values: list) -> bytes:
    return _head(5, len(values)) + _floats(values, len(values))


def _put_text(text: str) -> bytes:
    raw = text.encode()
    return _head(7, len(raw)) + raw


@lru_cache(CACHED)
def _put_samples(text: str | None, samples: int, kind: str) -> bytes:
    """The values of all samples of a record, nothing if all are missing."""
    own = (text.split("\t") if text is not None else []) + ["."] * samples
    own = own[:samples]
    if all(x == "." for x in own):
        return b""
    if kind == "GT":
        lists = []
        for x in own:
            parts = x.replace("|", "\0|").replace("/", "\0/").split("\0")
            lists.append([(0 if p.strip("|/") in (".", "") else int(p.strip("|/")) + 1) << 1 | (p[:1] == "|") for p in parts])
    elif kind == "Integer":
        lists = [[None if p == "." else int(p) for p in x.split(",")] for x in own]
    elif kind == "Float":
        lists = [[None if p == "." else float(p) for p in x.split(",")] for x in own]
        n = max(map(len, lists))
        return _head(5, n) + b"".join(_floats(v, n) for v in lists)
    else:
        raw = [x.encode() for x in own]
        n = max(map(len, raw))
        return _head(7, n) + b"".join(x.ljust(n, b"\0") for x in raw)
    n = max(map(len, lists))
    code = _int_kind([v for vs in lists for v in vs])
    return _head(code, n) + b"".join(_ints(v, code, n) for v in lists)


def records(path: str, start: int, end: int) -> Iterator[tuple[int, bytes, bytes]]:
    with Reader(path, start) as r:
        while (at := r.tell()) < end:
            head = r.read(8)
            if len(head) < 8:
                return
            a, b = struct.unpack("<II", head)
            yield at, r.read(a), r.read(b)


MIN_SHIFT, DEPTH = 14, 5


def _bin(start: int, end: int, min_shift: int, depth: int) -> int:
    level, first, shift = depth, ((1 << depth * 3) - 1) // 7, min_shift
    end -= 1
    while level > 0:
        if start >> shift == end >> shift:
            return first + (start >> shift)
        level, shift = level - 1, shift + 3
        first -= 1 << level * 3
    return 0


class IndexBuilder:
    """Chunks by bin, filled record by record in the order of the file."""

    def __init__(self, n_contigs: int):
        self.bins: list[dict[int, list[list[int]]]] = [{} for _ in range(n_contigs)]

    def add(self, record: bytes, begin: int, stop: int) -> None:
        """The shared part of a record that lies at virtual positions from ``begin`` to ``stop``."""
        contig, pos, span = struct.unpack_from("<iii", record)
        chunks = self.bins[contig].setdefault(_bin(max(pos, 0), max(pos, 0) + max(1, span), MIN_SHIFT, DEPTH), [])
        if chunks and chunks[-1][1] == begin:
            chunks[-1][1] = stop
        else:
            chunks.append([begin, stop])

    def to_bytes(self) -> bytes:
        out = b"CSI\1" + struct.pack("<iiii", MIN_SHIFT, DEPTH, 0, len(self.bins))
        for own in self.bins:
            out += struct.pack("<i", len(own))
            for k in sorted(own):
                out += struct.pack("<IQi", k, own[k][0][0], len(own[k])) + b"".join(struct.pack("<QQ", *c) for c in own[k])
        return out


def record_length(header: VcfHeader):
    """Tells whether a record may begin at a place, for a file with this header (see ``parts.record_start``)."""
    n_contigs, n_words, n_samples = len(header.contigs()), len(dictionary(header)), len(header.sample_names())

    def length(data: bytes, i: int) -> int:
        if i + 33 > len(data):
            return 0
        shared, single = struct.unpack_from("<II", data, i)
        contig, pos, span, _, n_info, n_allele, counts = _FIXED.unpack_from(data, i + 8)
        if shared < 25 or shared > 1 << 28 or single > 1 << 30 or not (0 <= contig < n_contigs and pos >= -1 and span >= 0):
            return -1
        if counts & 0xFFFFFF != n_samples or n_allele < 1 or n_info > n_words or counts >> 24 > n_words or data[i + 32] & 15 not in (0, 7):
            return -1
        return shared + single + 8

    return length


def index_file(path: str) -> int:
    """Write ``<path>.csi`` for one file sorted by contig and position; the number of its records. It runs where it is called."""
    header, first = read_header(path)
    builder, held, n = IndexBuilder(len(header.contigs())), None, 0
    for at, shared, _ in records(path, first, parts.END):
        if held is not None:
            builder.add(*held, at)
        held, n = (shared, at), n + 1
    if held is not None:
        with Reader(path) as r:
            builder.add(*held, r.size() << 16)
    with Writer(f"{path}.csi") as w:
        w.write(builder.to_bytes())
    return n


def write_indexes(spark: SparkSession, path: str) -> DataFrame:
    """Index all BCF files of a folder, one task a file: ``path, n_records`` (the work is done when the result is)."""
    return parts.for_each_file(spark, path, ".bcf", index_file)


@dataclass
class Index:
    min_shift: int
    depth: int
    bins: list[dict[int, list[tuple[int, int]]]]

    @classmethod
    def read(cls, path: str) -> Index:
        with Reader(path) as r:
            if r.read(4) != b"CSI\1":
                raise ValueError(f"{path} is no CSI file")
            take = lambda fmt: struct.unpack(fmt, r.read(struct.calcsize(fmt)))
            min_shift, depth, extra = take("<iii")
            r.read(extra)
            bins = []
            for _ in range(take("<i")[0]):
                own = {}
                for _ in range(take("<i")[0]):
                    number, _, n = take("<IQi")
                    own[number] = [take("<QQ") for _ in range(n)]
                bins.append(own)
        return cls(min_shift, depth, bins)

    def _meta(self) -> int:
        return ((1 << (self.depth + 1) * 3) - 1) // 7 + 1

    def starts(self) -> list[int]:
        return sorted({c[0] for own in self.bins for k, cs in own.items() if k != self._meta() for c in cs})

    def chunks(self, contig: int, start: int, end: int) -> list[tuple[int, int]]:
        """Merged ranges that hold all records overlapping a 0-based half-open interval."""
        end = min(end, 1 << self.min_shift + 3 * self.depth) - 1
        ids, first = set(), 0
        for level in range(self.depth + 1):
            shift = self.min_shift + 3 * (self.depth - level)
            ids.update(range(first + (start >> shift), first + (end >> shift) + 1))
            first += 1 << 3 * level
        out: list[tuple[int, int]] = []
        for a, b in sorted(c for k, cs in self.bins[contig].items() if k in ids for c in cs):
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
        return out


def _flag(options: dict[str, str], name: str) -> bool:
    return options.get(name, "false").lower() == "true"


def _first_header(path: str) -> VcfHeader:
    found = files.listing(path, ".bcf")
    if not found:
        raise ValueError(f"no BCF file at {path}")
    return read_header(found[0][0])[0]


class BcfReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.region = options["path"], options.get("region")
        self.split_bytes = int(options.get("split_bytes", parts.SPLIT_BYTES))
        self.extras = _flag(options, "filters"), _flag(options, "info_arrays")
        self.codec = Codec(_first_header(self.path), *self.extras)

    def partitions(self) -> list[InputPartition]:
        return parts.ranges(self.path, ".bcf", self.split_bytes)

    def _places(self, part: parts.Range) -> Iterator[tuple[bytes, bytes, int, int, int]]:
        """Records of a part with the region asked for as (shared, single, contig, first, last)."""
        header, first = read_header(part.path)
        if list(header.contigs()) != self.codec.contigs or dictionary(header) != self.codec.words:
            raise ValueError(f"{part.path} numbers its contigs or keys otherwise than the first file")
        index = Index.read(f"{part.path}.csi") if files.exists(f"{part.path}.csi") else None
        contig, a, b = -1, 0, 0
        if self.region:
            region = Region.parse(self.region)
            if region.name not in self.codec.contigs:
                return
            contig, a, b = self.codec.contigs.index(region.name), region.start or 1, region.end or 1 << 60
        if index is not None and self.region:
            stretches = parts.chunk_parts(part, index.chunks(contig, a - 1, b), first, record_length(header))
        else:
            stretches = [parts.bounds(part, index.starts() if index else (), first, record_length(header))]
        for low, high in stretches:
            for _, shared, single in records(part.path, low, high) if low < high else ():
                yield shared, single, contig, a, b

    def read(self, partition: parts.Range) -> Iterator[pa.RecordBatch]:
        cols = columns(self.codec.header, *self.extras)
        schema = pa.schema([(n, t) for n, _, t in cols])
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, _, t in cols], schema=schema)
        rows: list[dict] = []
        for shared, single, wanted, a, b in self._places(partition) if partition.path else ():
            if wanted >= 0:
                contig, pos, span = struct.unpack_from("<iii", shared)
                if contig != wanted or pos + 1 > b or pos + max(1, span) < a:
                    continue
            rows.append(self.codec.decode(shared, single)[0])
            if len(rows) == BATCH:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)


class BcfWriter(parts.FileWriter):
    """Columns that the header does not know are an error, so nothing is lost unseen."""

    suffix, index_suffix = ".bcf", ".csi"

    def __init__(self, options: dict[str, str], overwrite: bool, names: list[str]):
        super().__init__(options, overwrite)
        header = VcfHeader.parse(options["header"])
        known = {c[0] for c in columns(header, True)} | {f"FMT_{k}" for k, _ in header.format_fields()}
        unknown = [n for n in names if n not in known]
        if unknown:
            raise ValueError(f"the header has no place for the column {unknown[0]!r}")

    def fill(self, writer: Writer, rows: Iterator[dict]) -> bytes | None:
        text = self.options["header"].encode() + b"\0"
        codec = Codec(VcfHeader.parse(self.options["header"]))
        builder = IndexBuilder(len(codec.contigs)) if _flag(self.options, "index") else None
        writer.write(b"BCF\2\2" + struct.pack("<I", len(text)) + text)
        writer.flush()
        for row in rows:
            record, at = codec.encode(row), writer.tell()
            writer.write(record)
            if builder is not None:
                builder.add(record[8:20], at, writer.tell())
        if builder is None:
            return None
        raw = builder.to_bytes()
        blocks = [pack_block(raw[i : i + BLOCK]) for i in range(0, len(raw), BLOCK)]
        return b"".join(blocks) + EOF


class BcfSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bcf"

    def schema(self) -> str:
        cols = columns(_first_header(self.options["path"]), _flag(dict(self.options), "filters"), _flag(dict(self.options), "info_arrays"))
        return ", ".join(f"`{n}` {t}" for n, t, _ in cols)

    def reader(self, schema: StructType) -> BcfReader:
        return BcfReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> BcfWriter:
        return BcfWriter(dict(self.options), overwrite, schema.names)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BcfSource)
