"""Several values packed in one field: pick each field's dialect by minimum description length and split it.

A *dialect* is a separator (one of a fixed list, or any character that cannot be part of a value) with the quote marks
it knows. A parse under a dialect cuts a field into places; its length in bits is, for each place,

    separator + manner (bare, empty, or a quote mark) + the characters of the value + end of value

All bits come from counts over the whole table (``code_lengths``, one distributed aggregation, per field):

* characters of bare values, the first one and later ones apart, from fields that every dialect reads alike;
* characters of quoted values, separators and manners from the raw text of all other fields: pairs of quote marks, marks left
  over, separators that meet.

So a character that values of this table do not have is long in a value and short as a separator, if it is common there; no
penalty is set by hand. Before anything is seen, a symbol counts as ``SEEN`` times met, one that the rules keep out of values as ``UNSEEN``
times, which decides in tables too small to learn from. Counted are ASCII characters one by one and all others by kind, so the table of
lengths has at most about 140 rows a class, whatever the data. Every field is then parsed under the dialects that its
characters allow, and keeps the shortest parse. Fields that all dialects read alike never leave the JVM.

Rules of a parse: blanks (spaces) around a separator or at the ends mean nothing, blanks alone separate once. Text
between ``<`` and ``>`` is never split. A known quote mark that opens a place makes everything up to its closing mark one
value, without the marks, a doubled mark inside standing for one. An empty place and a lone ``.`` count as places but hold
no value. A mark that is never closed is an ordinary character.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread

#: The separators that form dialects of their own; ANY stands for every character that separates.
SEPARATORS = (",", ";", "|", "/", "&", "\t", " ")
ANY = "any"
QUOTES = ("", '"', "'", "\"'")
#: Besides letters and digits these are part of values.
VALUE_MARKS = "_-:.*'<>[]"
#: How often a symbol counts as seen beforehand.
SEEN, UNSEEN = 0.5, 2.0**-20
#: A field of these characters only, with no quote mark in front, is one place in every dialect; for the JVM.
PLAIN = r"^[\p{L}\p{N}_\-:.*<>\[\]][\p{L}\p{N}_\-:.*'<>\[\]]*\z"


def is_value_char(c: str) -> bool:
    return c.isalnum() or c in VALUE_MARKS


@lru_cache(maxsize=128)
def _pattern(separator: str, quotes: str, angles: bool) -> re.Pattern:
    """One place and the separator behind it. Every part is read once, so long fields cost linear time."""
    bare = r"[^\W]|[-:.*'<>\[\]]"
    if separator == ANY:
        known = '|"' if '"' in quotes else ""
        between, unit = rf" *(?!{bare}| {known}). *| +", bare
    elif separator == " ":
        between, unit = " +", "[^ ]"
    else:
        between, unit = rf" *{re.escape(separator)} *", f"[^{re.escape(separator)}]"
    if separator == ANY and '"' in quotes:  # a mark that opens nothing separates like any other character
        between += '|"'
    marks = "|".join(f"{q}(?P<q{i}>(?:[^{q}]|{q}{q})*){q}(?=(?:{between})|\\Z)" for i, q in enumerate(quotes))
    run = rf"(?P<bare>(?:{'<[^>]*>|' if angles else ''}{unit})*)"
    return re.compile(rf"(?:{marks + '|' if quotes else ''}{run})(?P<sep>{between}|\Z)", re.DOTALL)


def parse(text: str, separator: str, quotes: str) -> list[tuple[str, str, str]]:
    """Places of a field as (value, separator behind it, quote mark)."""
    text = text.strip(" ")
    out, at, pattern = [], 0, _pattern(separator, quotes, ">" in text)
    while True:
        m = pattern.match(text, at)
        if m is None:  # a character that this dialect cannot place: the rest is one bare value
            out.append((text[at:], "", ""))
            return out
        mark = ""
        value = (m["bare"] or "").rstrip(" ")  # blanks before a separator
        for i, q in enumerate(quotes):
            if m[f"q{i}"] is not None:
                value, mark = m[f"q{i}"].replace(q + q, q), q
        out.append((value, m["sep"].strip(" ") or m["sep"][:1], mark))
        at = m.end()
        if m["sep"] == "":
            return out


def candidates(text: str) -> list[tuple[str, str]]:
    """The dialects that can differ on this field: those of separators and quote marks that occur in it."""
    found = set(text.strip(" "))
    seps = [s for s in SEPARATORS if s in found]
    if any(not is_value_char(c) for c in found):
        seps.append(ANY)
    quotes = [q for q in QUOTES if all(c in found for c in q)]
    return [(s, q) for s in seps or [SEPARATORS[0]] for q in quotes]


def symbol(c: str) -> str:
    """The character itself if it is ASCII, else its kind; at most about 140 symbols."""
    return c if c < "\x80" else "letter" if c.isalpha() else "digit" if c.isdigit() else "other"


@lru_cache(maxsize=1)
def _symbols() -> tuple[list[str], list[str]]:
    """All symbols, those of values and the others. Values do not begin with a quote mark as a rule, but may hold one."""
    every = [chr(i) for i in range(128)] + ["letter", "digit", "other"]
    inside = [x for x in every if x in ("letter", "digit") or len(x) == 1 and is_value_char(x)]
    return inside, [x for x in every if x not in inside]


class Code:
    """Lengths in bits from counts of (field, class, symbol, number).

    Classes: ``b0`` and ``b1`` for the first and a later character (or the end) of a bare value, ``raw`` for any character of a field
    that is no single plain value, ``sep`` for its separators, ``manner`` for its places.
    """

    def __init__(self, counts: Sequence[tuple[str, str, str, int]]):
        inside, outside = _symbols()
        fields = {c[0] for c in counts}
        seen: dict[tuple[str, str], dict[str, float]] = {}
        for f in fields:
            seen[f, "b0"] = dict.fromkeys(inside, SEEN) | dict.fromkeys([*outside, "'"], UNSEEN)
            seen[f, "b1"] = dict.fromkeys([*inside, "end"], SEEN) | dict.fromkeys(outside, UNSEEN)
            seen[f, "raw"] = dict.fromkeys([*inside, *outside, "end"], SEEN)
            seen[f, "sep"] = dict.fromkeys(outside, SEEN)
            seen[f, "manner"] = dict.fromkeys(["bare", "empty", '"', "'"], SEEN)
        for f, kind, s, n in counts:
            seen[f, kind][s] += n
        self.bits = {k: self._lengths(v) for k, v in seen.items()}

    @staticmethod
    def _lengths(seen: dict[str, float]) -> dict[str, float]:
        total = sum(seen.values())
        return {s: -math.log2(n / total) for s, n in seen.items()}

    @classmethod
    def flat(cls, fields: Sequence[str]) -> Code:
        """Every symbol equally long: what is left when nothing is learned."""
        out = cls([(f, "b1", "end", 0) for f in fields])
        for table in out.bits.values():
            table.update(dict.fromkeys(table, math.log2(len(table))))
        return out

    def cost(self, field: str, places: list[tuple[str, str, str]]) -> float:
        first, later, raw, between, manner = (self.bits[field, k] for k in ("b0", "b1", "raw", "sep", "manner"))
        bits = 0.0
        for value, sep, mark in places:
            if sep:
                bits += between[symbol(sep)]
            if mark:
                bits += manner[mark] + raw["end"]
                bits += sum([raw[c] if c < "\x80" else raw[symbol(c)] for c in value])
            elif value:
                bits += manner["bare"] + (first[value[0]] if value[0] < "\x80" else first[symbol(value[0])]) + later["end"]
                bits += sum([later[c] if c < "\x80" else later[symbol(c)] for c in value[1:]])
            else:
                bits += manner["empty"]
        return bits


_EMPTY = re.compile(r"(?:^|[^\w\-:.*'<>\[\]\" ]) *(?=[^\w\-:.*'<>\[\]\" ]|$)")
_SEPARATOR = re.compile(r"[^\w\-:.*'<>\[\]\" ]| +(?=[\w\-:.*'<>\[\]\"])")


def count_field(text: str, field: str, counts: Counter) -> None:
    """Separators and manners of one field that is no plain value, without a parse of it."""
    text = text.strip(" ")
    doubles, singles, empty = text.count('"'), text.count("'") // 2, len(_EMPTY.findall(text))
    seps = _SEPARATOR.findall(text)
    for sep in seps:
        counts[field, "sep", symbol(sep[0])] += 1
    counts[field, "sep", '"'] += doubles % 2
    counts[field, "manner", '"'] += doubles // 2
    counts[field, "manner", "'"] += singles
    counts[field, "manner", "empty"] += empty
    counts[field, "manner", "bare"] += max(0, len(seps) + 1 - doubles // 2 - singles - empty)


def code_lengths(fields: DataFrame) -> Code:
    """Learn the code from all rows of ``field_name, text, plain`` (distributed counts; the result has a fixed bound)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            texts: dict[tuple[str, bool], list[str]] = {}
            for field, text, plain in zip(*(batch.column(c).to_pylist() for c in ("field_name", "text", "plain"))):
                texts.setdefault((field, plain), []).append(text)
            # the characters of a batch are joined, so that counting them is one call a class
            for (field, plain), own in texts.items():
                if plain:
                    parts = {"b0": [t[0] for t in own], "b1": [t[1:] for t in own]}
                else:
                    # each character counts once a field, so that a long field weighs no more than others
                    parts = {"raw": ["".join(set(t)) for t in own]}
                    for text in own:
                        count_field(text, field, counts)
                for kind, strings in parts.items():
                    for c, n in Counter("".join(strings)).items():
                        counts[field, kind, symbol(c)] += n
                    if kind != "b0":
                        counts[field, kind, "end"] += len(strings)
        names = ["field_name", "kind", "symbol"]
        columns = [pa.array([k[i] for k in counts], pa.string()) for i in range(3)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(list(counts.values()), pa.int64())], [*names, "n"])

    table = fields.select("field_name", "text", "plain").mapInArrow(count, "field_name string, kind string, symbol string, n long")
    return Code([tuple(r) for r in table.groupBy("field_name", "kind", "symbol").agg(F.sum("n").alias("n")).collect()])


def choose(field: str, text: str, code: Code) -> tuple[tuple[str, str], list[tuple[str, str, str]]]:
    """The dialect of the shortest parse, and the parse. Where all parses are alike, the first dialect stands for them."""
    parses: list[tuple[tuple[str, str], list[tuple[str, str, str]]]] = []
    for d in candidates(text):
        places = parse(text, *d)
        if all(places != p for _, p in parses):
            parses.append((d, places))
    return parses[0] if len(parses) == 1 else min(parses, key=lambda x: code.cost(field, x[1]))


def split_packed(df: DataFrame, id_col: str, columns: Sequence[str]) -> DataFrame:
    """``id_col, field_name, value_pos, value_text, n_values, dialect``: one row per value of the given string columns.

    ``value_pos`` counts places from 1, empty ones and lone dots too; ``n_values`` is the number of values of the field.
    ``dialect`` names the separator and the quote marks of the parse that was shortest. A null or blank field has no rows; a
    value that occurs twice gives two rows; rows with a null id are kept. Fields of any length are read whole.
    """
    safe = df.select(df[id_col].cast("string").alias("id"), *(df[c].cast("string").alias(f"c{i}") for i, c in enumerate(columns)))
    fields = F.explode(F.array(*(F.struct(F.lit(c).alias("field_name"), F.col(f"c{i}").alias("text")) for i, c in enumerate(columns))))
    fields = spread(safe).select("id", fields.alias("f")).select("id", "f.field_name", "f.text").where("text IS NOT NULL")
    fields = fields.withColumn("plain", F.col("text").rlike(PLAIN))
    code = code_lengths(fields)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "field_name", "dialect", "value_pos", "value_text", "n_values"]
        kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.int32()]
        for batch in batches:
            out: list[tuple] = []
            for i, field, text in zip(*(batch.column(c).to_pylist() for c in ("id", "field_name", "text"))):
                d, places = choose(field, text, code)
                values = [(k, v) for k, (v, _, mark) in enumerate(places, 1) if mark or v not in ("", ".")]
                out += [(i, field, f"{d[0]} {d[1]}", k, v, len(values)) for k, v in values]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    # ids travel as text, of any type
    packed = fields.where("NOT plain").select("id", "field_name", "text").mapInArrow(
        split, "id string, field_name string, dialect string, value_pos int, value_text string, n_values int"
    )
    single = fields.where("plain AND text != '.'").select(
        "id", "field_name", F.lit(f"{SEPARATORS[0]} ").alias("dialect"), F.lit(1).alias("value_pos"), F.col("text").alias("value_text"), F.lit(1).alias("n_values")
    )
    out = packed.unionAll(single)
    return out.select(F.col("id").cast(df.schema[id_col].dataType).alias(id_col), "field_name", "value_pos", "value_text", "n_values", "dialect")
