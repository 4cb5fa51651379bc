"""Decoding and encoding of the binary alignment columns, by built-in functions but for the covered length (Arrow batches).

``cigar`` holds little-endian 32-bit words (length << 4 | operation), ``sequence`` two 4-bit bases a byte, ``quality_scores``
raw numbers. The text forms are those of SAM.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Operation letters and base letters of the BAM format, by code.
OPERATIONS = "MIDNSHP=X"
BASES = "=ACMGRSVTWYHKDBN"
#: Operations that advance on the reference.
ON_REFERENCE = "MDN=X"
_ADVANCING = [OPERATIONS.index(x) for x in ON_REFERENCE]
_CODES = "0123456789ABCDEF"


def _words(cigar: Column) -> Column:
    """The words of a raw cigar as eight hex digits each, the most significant first."""
    digits = F.regexp_replace(F.hex(cigar), "(..)(..)(..)(..)", "$4$3$2$1")
    n = F.floor(F.length(digits) / 8).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(digits, i * 8 + 1, F.lit(8)))).otherwise(F.array().cast("array<string>"))


def _length(word: Column) -> Column:
    return F.conv(F.substring(word, F.lit(1), F.lit(7)), 16, 10).cast("long")


def _operation(word: Column) -> Column:
    return F.translate(F.substring(word, F.lit(8), F.lit(1)), _CODES[: len(OPERATIONS)], OPERATIONS)


def cigar_text(cigar: Column) -> Column:
    """``36M2D``; ``*`` for an empty cigar, null for null."""
    text = F.array_join(F.transform(_words(cigar), lambda w: F.concat(_length(w).cast("string"), _operation(w))), "")
    return F.when(cigar.isNotNull(), F.when(text == "", F.lit("*")).otherwise(text))


def cigar_binary(text: Column) -> Column:
    """The raw cigar of ``36M2D``; empty for ``*``."""
    found = F.regexp_extract_all(text, F.lit("([0-9]+[MIDNSHP=X])"), 1)

    def word(item: Column) -> Column:
        op = F.instr(F.lit(OPERATIONS), F.right(item, F.lit(1))) - 1
        n = F.regexp_extract(item, "^[0-9]+", 0).cast("long") * 16 + op
        return F.regexp_replace(F.lpad(F.hex(n), 8, "0"), "(..)(..)(..)(..)", "$4$3$2$1")

    return F.when(text.isNotNull(), F.unhex(F.array_join(F.transform(found, word), "")))


def reference_length(cigar: Column) -> Column:
    """Positions of the reference that the alignment covers; 0 for an empty cigar.

    The words of a whole batch are added up at once where they lie in memory; no text is made of them.
    """

    @F.arrow_udf("bigint")
    def covered(cigars: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.binary_length(cigars), 0).to_numpy(zero_copy_only=False).astype(np.int64) // 4
        raw = b"".join(x[: len(x) // 4 * 4] for x in cigars.to_pylist() if x)
        words = np.frombuffer(raw, "<u4")
        sums = np.append(0, np.cumsum(np.where(np.isin(words & 15, _ADVANCING), words >> 4, 0).astype(np.int64)))
        ends = np.cumsum(sizes)
        return pa.array(sums[ends] - sums[ends - sizes], mask=cigars.is_null().to_numpy(zero_copy_only=False))

    return covered(cigar)


def sequence_text(sequence: Column, length: Column | None = None) -> Column:
    """Bases as letters; ``length`` drops the padding of an odd number of bases (else a trailing ``=`` is dropped)."""
    letters = F.translate(F.hex(sequence), _CODES, BASES)
    return F.substring(letters, F.lit(1), length.cast("int")) if length is not None else F.regexp_replace(letters, "=$", "")


def sequence_binary(text: Column) -> Column:
    """Letters packed two a byte, an odd number padded by 0; unknown letters count as N, ``*`` is empty."""
    known = F.regexp_replace(F.upper(F.when(text == "*", F.lit("")).otherwise(text)), f"[^{BASES}]", "N")
    digits = F.translate(known, BASES, _CODES)
    return F.unhex(F.concat(digits, F.when(F.length(digits) % 2 == 1, F.lit("0")).otherwise(F.lit(""))))


def quality_text(quality: Column) -> Column:
    """Raw qualities as text with an offset of 33; ``*`` where they are missing (bytes of 255)."""
    codes = F.split(F.regexp_replace(F.hex(quality), "(..)", "$1,"), ",")
    text = F.array_join(F.transform(F.filter(codes, lambda x: x != ""), lambda x: F.char(F.conv(x, 16, 10).cast("int") + 33)), "")
    return F.when(F.hex(quality).startswith("FF"), F.lit("*")).otherwise(text)


def quality_binary(text: Column) -> Column:
    """Raw qualities of text with an offset of 33; ``*`` is empty."""
    chars = F.filter(F.split(F.when(text == "*", F.lit("")).otherwise(text), ""), lambda c: c != "")
    return F.unhex(F.array_join(F.transform(chars, lambda c: F.lpad(F.hex(F.ascii(c) - 33), 2, "0")), ""))


def alignment_end(start: Column, cigar: Column) -> Column:
    """Last covered position, 1-based; an empty cigar covers one position, a null one has no end."""
    return F.when(cigar.isNotNull(), start + F.greatest(reference_length(cigar), F.lit(1)) - 1)
