"""Headers of SAM and VCF text: small objects on the driver."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class SamHeader:
    """Lines that begin with ``@``."""

    lines: tuple[str, ...] = ()

    @classmethod
    def parse(cls, text: str) -> SamHeader:
        lines = tuple(x.rstrip("\r") for x in text.split("\n") if x.strip())
        for x in lines:
            if not re.fullmatch(r"@[A-Z][A-Z](\t.*)?", x):
                raise ValueError(f"not a header line: {x!r}")
        return cls(lines)

    @classmethod
    def of(cls, sizes: dict[str, int], sort_order: str = "unknown") -> SamHeader:
        return cls((f"@HD\tVN:1.6\tSO:{sort_order}", *(f"@SQ\tSN:{n}\tLN:{x}" for n, x in sizes.items())))

    def reference_sequences(self) -> dict[str, int]:
        """Name and length of each reference, in order."""
        out = {}
        for x in self.lines:
            if x.startswith("@SQ\t"):
                tags = dict(t.split(":", 1) for t in x.split("\t")[1:] if ":" in t)
                out[tags["SN"]] = int(tags["LN"])
        return out

    def chrom_sizes(self, spark: SparkSession) -> DataFrame:
        """``chrom, size``, as ``complement`` takes it."""
        return spark.createDataFrame(list(self.reference_sequences().items()), "chrom string, size long")

    def __str__(self) -> str:
        return "".join(f"{x}\n" for x in self.lines)


_META = re.compile(r"##(contig|INFO|FORMAT|FILTER)=<(.*)>")
_PART = re.compile(r'(\w+)=("(?:[^"\\]|\\.)*"|[^,]*)')


@dataclass(frozen=True)
class VcfHeader:
    """Lines that begin with ``#``; the last names the columns and samples."""

    lines: tuple[str, ...] = ("##fileformat=VCFv4.3", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO")
    _meta: dict = field(default_factory=dict, compare=False, repr=False)

    @classmethod
    def parse(cls, text: str) -> VcfHeader:
        lines = tuple(x.rstrip("\r") for x in text.split("\n") if x.strip())
        if not lines or not lines[0].startswith("##fileformat") or not lines[-1].startswith("#CHROM"):
            raise ValueError("a VCF header begins with ##fileformat and ends with #CHROM")
        return cls(lines)

    def _entries(self, kind: str) -> list[dict[str, str]]:
        found = (_META.fullmatch(x) for x in self.lines)
        return [{k: v.strip('"') for k, v in _PART.findall(m[2])} for m in found if m and m[1] == kind]

    def contigs(self) -> dict[str, int | None]:
        return {e["ID"]: int(e["length"]) if "length" in e else None for e in self._entries("contig")}

    def info_fields(self) -> list[tuple[str, str]]:
        return [(e["ID"], e["Type"]) for e in self._entries("INFO")]

    def info_lists(self) -> frozenset[str]:
        """Keys of INFO fields that may hold several numbers."""
        return frozenset(e["ID"] for e in self._entries("INFO") if e["Type"] in ("Integer", "Float") and e.get("Number", "1") not in ("0", "1"))

    def format_fields(self) -> list[tuple[str, str]]:
        return [(e["ID"], e["Type"]) for e in self._entries("FORMAT")]

    def sample_names(self) -> list[str]:
        return self.lines[-1].split("\t")[9:]

    def __str__(self) -> str:
        return "".join(f"{x}\n" for x in self.lines)
