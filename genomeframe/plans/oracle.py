"""The same queries in SQL, to compare results with another engine."""

from __future__ import annotations

from . import formats
from .inputs import PLAIN_VIEWS, VIEWS


def _islands(source: str, keys: str) -> str:
    return f"""SELECT {keys}, min("start") AS "start", max("end") AS "end", any_value(g) AS g, list(rid) AS ids FROM (
  SELECT *, sum(CASE WHEN p IS NULL OR "start" >= p THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY "start", "end", rid ROWS UNBOUNDED PRECEDING) AS g FROM (
    SELECT *, max("end") OVER (PARTITION BY {keys} ORDER BY "start", "end", rid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p
    FROM (SELECT *, row_number() OVER () AS rid FROM ({source})))) GROUP BY {keys}, g"""


def _merge(source: str, keys: str = "chrom") -> str:
    return f'SELECT {keys}, "start", "end" FROM ({_islands(source, keys)})'


def _cluster(keys: str) -> str:
    source = "SELECT * FROM tn" + (" WHERE strand IS NOT NULL" if "strand" in keys else "")
    return VIEWS + f""", i AS (SELECT *, interval_id AS rid FROM ({source})),
f AS (SELECT *, max("end") OVER (PARTITION BY {keys} ORDER BY "start", "end", rid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM i),
n AS (SELECT rid, sum(CASE WHEN p IS NULL OR "start" >= p THEN 1 ELSE 0 END) OVER (ORDER BY {keys}, "start", "end", rid ROWS UNBOUNDED PRECEDING) - 1 AS cluster_id FROM f)
SELECT t.interval_id, CAST(n.cluster_id AS BIGINT) AS cluster_id FROM t LEFT JOIN n ON n.rid = t.interval_id"""


def _complement(sizes: bool) -> str:
    sql = VIEWS + f""", m AS ({_merge("SELECT * FROM tn")}),
g AS (SELECT chrom, greatest(coalesce(lag("end") OVER (PARTITION BY chrom ORDER BY "start"), 0), 0) AS "start", "start" AS "end" FROM m)
SELECT chrom, "start", "end" FROM g WHERE "start" < "end" """
    if sizes:
        sql += """UNION ALL SELECT chrom, l AS "start", seq_length AS "end" FROM (SELECT chrom, max("end") AS l FROM m GROUP BY chrom)
JOIN contigs ON contig_name = chrom WHERE l < seq_length"""
    return sql


def _coverage(source: str, keys: str, depth: bool, where: str = "depth > 0") -> str:
    return f"""SELECT {keys}, "start", "end"{", depth" if depth else ""} FROM (
  SELECT {keys}, pos AS "start", lead(pos) OVER w AS "end", CAST(sum(d) OVER (PARTITION BY {keys} ORDER BY pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth FROM (
    SELECT {keys}, pos, sum(d) AS d FROM (SELECT {keys}, "start" AS pos, 1 AS d FROM ({source}) UNION ALL SELECT {keys}, "end", -1 FROM ({source})) GROUP BY {keys}, pos)
  WINDOW w AS (PARTITION BY {keys} ORDER BY pos)) WHERE {where}"""


HIT = 'v.chrom = t.chrom AND v."start" < t."end" AND t."start" < v."end"'


def _nearest(extra: str) -> str:
    on = "v.chrom = t.chrom" + extra
    return VIEWS + f""", c AS (SELECT v.variant_id, t.interval_id, CASE WHEN {HIT} THEN 0 ELSE 1 END AS apart,
  greatest(t."start" - v."end", v."start" - t."end", 0) AS distance, abs((v."start" + v."end") // 2 - (t."start" + t."end") // 2) AS mid
  FROM vn v JOIN tn t ON {on}),
r AS (SELECT *, row_number() OVER (PARTITION BY variant_id ORDER BY apart, CASE WHEN apart = 0 THEN mid ELSE distance END, interval_id) AS k FROM c)
SELECT v.variant_id AS a_variant_id, r.interval_id AS b_interval_id, CAST(CASE WHEN apart = 0 THEN 0 ELSE distance END AS BIGINT) AS distance
FROM v LEFT JOIN r ON r.variant_id = v.variant_id AND r.k = 1"""


def _start_adjacent() -> str:
    return VIEWS + f""", s AS (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY "start", interval_id) AS no FROM tn),
p AS (SELECT v.variant_id, v.chrom, v."start", v."end", count(s.no) FILTER (s."start" < v."start") AS before, max(s.no) AS n FROM vn v JOIN s ON v.chrom = s.chrom GROUP BY ALL),
h AS (SELECT v.variant_id, t.interval_id, 0 AS far, abs((v."start" + v."end") // 2 - (t."start" + t."end") // 2) AS mid FROM vn v JOIN tn t ON {HIT}),
c AS (SELECT p.variant_id, s.interval_id, 1 AS apart, greatest(s."start" - p."end", p."start" - s."end", 0) AS far FROM p JOIN s ON s.chrom = p.chrom AND s.no IN (p.before, p.before + 1)
  WHERE p.variant_id NOT IN (SELECT variant_id FROM h) UNION ALL SELECT variant_id, interval_id, 0, mid FROM h),
r AS (SELECT *, row_number() OVER (PARTITION BY variant_id ORDER BY far, interval_id) AS k FROM c)
SELECT v.variant_id AS a_variant_id, r.interval_id AS b_interval_id, CAST(CASE WHEN apart = 0 THEN 0 ELSE far END AS BIGINT) AS distance
FROM v LEFT JOIN r ON r.variant_id = v.variant_id AND r.k = 1"""


def _geometry(start: str, end: str) -> str:
    return VIEWS + f"""SELECT interval_id, track_id, sample_id, chrom, CAST({start} AS INTEGER) AS "start", CAST({end} AS INTEGER) AS "end", strand FROM t"""


def _clamp(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE greatest({x}, 1) END"


def _rank(natural: bool) -> str:
    order = "chrom NULLS LAST"
    if natural:
        number = "coalesce(try_cast(regexp_extract(chrom, '([0-9]+)$', 1) AS BIGINT), 9223372036854775807)"
        order = f"regexp_replace(chrom, '[0-9]+$', '') NULLS LAST, CASE WHEN chrom IS NULL THEN NULL ELSE {number} END NULLS LAST"
    return VIEWS + f"""SELECT chrom, "start", count(*) AS n_rows, min(r) AS first_rank, max(r) AS last_rank
FROM (SELECT chrom, "start", row_number() OVER (ORDER BY {order}, "start" NULLS LAST) AS r FROM t) GROUP BY chrom, "start" """


_FLAGS = ("segmented", "properly_segmented", "unmapped", "mate_unmapped", "reverse_complemented", "mate_reverse_complemented",
          "first_segment", "last_segment", "secondary", "qc_fail", "duplicate", "supplementary")

_HEAVY = """SELECT '{t}' AS table_name, coalesce(CAST({k} AS VARCHAR), '*') AS key_value FROM {t} GROUP BY {k}
HAVING count(*) >= 0.05 * (SELECT count(*) FROM {t})"""

#: A place of a packed field with the separator behind it, by the written rules: quoted, or a run of value characters.
_VALUE = r"\p{L}\p{N}_\-:.*'<>\[\]"
_SEP = rf'(?: *[^{_VALUE} "] *| +|$)'
_UNIT = r"(?:[\p{L}\p{N}_\-:.*'>\[\]]|<[^>]*>|<)"
_QUOTED = {q: f"{q}(?:[^{q}]|{q}{q})*{q}" for q in "\"'"}
_PLACE = "|".join(q + _SEP for q in _QUOTED.values()) + rf'|{_UNIT}*(?: *[^{_VALUE} "] *| +|"|$)'


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _p1() -> str:
    cases = []
    for q, quoted in _QUOTED.items():
        inner = f"regexp_extract(place, {_text(f'^{q}((?:[^{q}]|{q}{q})*){q}')}, 1)"
        cases.append(f"WHEN regexp_full_match(place, {_text(quoted + _SEP)}) THEN replace({inner}, {_text(q + q)}, {_text(q)})")
    return f"""WITH f AS (SELECT variant_id, 'id' AS field_name, id AS t FROM variants UNION ALL SELECT variant_id, 'alt', alt FROM variants),
p AS (SELECT variant_id, field_name, regexp_extract_all(trim(t, ' '), {_text(_PLACE)}) AS places FROM f WHERE t IS NOT NULL),
x AS (SELECT variant_id, field_name, unnest(places) AS place, generate_subscripts(places, 1) AS value_pos FROM p),
v AS (SELECT variant_id, field_name, CAST(value_pos AS INTEGER) AS value_pos,
  CASE {" ".join(cases)} ELSE nullif(nullif(regexp_extract(place, {_text(f"^{_UNIT}*")}), ''), '.') END AS value_text FROM x)
SELECT * FROM v WHERE value_text IS NOT NULL QUALIFY count(*) OVER (PARTITION BY variant_id, field_name) >= 2"""


_PER_KEY = """SELECT '{t}' AS table_name, coalesce(CAST(k AS VARCHAR), '*') AS key, count(*) AS n_rows, (count(*) + 99999) // 100000 AS n_chunks, count(x) AS n_values,
CAST(arg_min(x, i) FILTER (x IS NOT NULL) AS DOUBLE) AS first_value, CAST(arg_max(x, i) FILTER (x IS NOT NULL) AS DOUBLE) AS last_value,
count(*) FILTER (x < p) AS inversions, CAST(max(x - p) AS DOUBLE) AS longest_step
FROM (SELECT {k} AS k, {x} AS x, {i} AS i, last_value({x} IGNORE NULLS) OVER (PARTITION BY {k} ORDER BY {i} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM {t}) GROUP BY k"""

_FIELD = r'(?:"(?:[^"]|"")*"|[^"\t][^\t]*|)'
_P5 = rf"""WITH l AS (SELECT line_id, fmt, regexp_replace(line, '\r$', '') AS line FROM raw_lines
  WHERE NOT starts_with(line, CASE fmt WHEN 'vcf' THEN '#' ELSE '@' END)),
v AS (SELECT line_id, line, NOT regexp_full_match(line, '{_FIELD}(?:\t{_FIELD})*') AS broken FROM l WHERE fmt = 'vcf'),
vf AS (SELECT line_id, regexp_full_match(line, '{_FIELD}(?:\t{_FIELD}){{7}}') AS whole,
  regexp_extract(line, '^{_FIELD}\t({_FIELD})', 1) AS pos, regexp_extract(line, '^{_FIELD}(?:\t{_FIELD}){{4}}\t({_FIELD})', 1) AS qual FROM v WHERE NOT broken),
vq AS (SELECT line_id, whole, regexp_replace(pos, '^"(.*)"$', '\1') AS pos, regexp_replace(qual, '^"(.*)"$', '\1') AS qual FROM vf),
s AS (SELECT line_id, string_split(line, chr(9)) AS f FROM l WHERE fmt = 'sam'),
sq AS (SELECT line_id, f, len(f) >= 11 AND len(list_filter(f[12:], lambda x: NOT regexp_full_match(x, '..:[AifZHB]:.*', 's'))) = 0 AS whole FROM s)
SELECT line_id, 'quoting' AS reason FROM v WHERE broken
UNION ALL SELECT line_id, 'column_count' FROM vq WHERE NOT whole
UNION ALL SELECT line_id, 'column_count' FROM sq WHERE NOT whole
UNION ALL SELECT line_id, 'pos' FROM vq WHERE whole AND NOT (regexp_full_match(pos, '[0-9]+') AND coalesce(try_cast(pos AS HUGEINT) BETWEEN 1 AND 2147483647, false))
UNION ALL SELECT line_id, 'qual' FROM vq WHERE whole AND qual <> '.' AND NOT regexp_full_match(qual, '[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?')
UNION ALL SELECT line_id, 'template_length' FROM sq WHERE whole
  AND NOT (regexp_full_match(f[9], '-?[0-9]+') AND coalesce(try_cast(f[9] AS HUGEINT) BETWEEN -2147483648 AND 2147483647, false))"""

#: Errors with their place: of a broken quote the field and where it begins, or what follows its closing mark.
_HEAD = rf"^(?:{_FIELD}\t)*"
_P5_LINES = rf"""WITH l AS (SELECT line_id, fmt, regexp_replace(coalesce(line, ''), '\r$', '') AS line FROM raw_lines
  WHERE NOT starts_with(coalesce(line, ''), CASE fmt WHEN 'vcf' THEN '#' ELSE '@' END)),
v AS (SELECT line_id, line, NOT regexp_full_match(line, '{_FIELD}(?:\t{_FIELD})*') AS broken, regexp_extract(line, '{_HEAD}') AS head FROM l WHERE fmt = 'vcf'),
f AS (SELECT line_id, line, regexp_extract_all(line || chr(9), '({_FIELD})\t', 1) AS f FROM v WHERE NOT broken),
vq AS (SELECT line_id, line, f, list_transform(f, lambda x: CASE WHEN starts_with(x, '"') THEN replace(x[2:-2], '""', '"') ELSE x END) AS q FROM f),
s AS (SELECT line_id, line, string_split(line, chr(9)) AS f FROM l WHERE fmt = 'sam'),
sb AS (SELECT *, list_position(list_transform(f[12:], lambda x: NOT regexp_full_match(x, '..:[AifZHB]:.*', 's')), true) AS odd FROM s)"""


def _offset(fields: str, n: str) -> str:
    """Code points before field n (from 1)."""
    return f"CAST(coalesce(list_sum(list_transform({fields}[1:{n} - 1], lambda x: length(x) + 1)), 0) AS INTEGER)"


_INT32 = "regexp_full_match({x}, '{p}') AND coalesce(try_cast({x} AS HUGEINT) BETWEEN {a} AND 2147483647, false)"
_POS = _INT32.format(x="q[2]", p="[0-9]+", a=1)
_TLEN = _INT32.format(x="f[9]", p="-?[0-9]+", a=-2147483648)
_QUAL = r"q[6] = '.' OR regexp_full_match(q[6], '[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?')"


def _p5_errors() -> str:
    row = "SELECT line_id, CAST(1 AS INTEGER) AS record_no, '{r}' AS reason, CAST({n} AS INTEGER) AS field_no, CAST({o} AS INTEGER) AS \"offset\", {m} AS message FROM {t} WHERE {w}"
    found = """regexp_extract(substr(line, length(head) + 1), '^"(?:[^"]|"")*"')"""
    # the first half of a doubled mark closes nothing
    closed = f"""CASE WHEN substr(line, length(head) + length({found}) + 1, 1) = '"' THEN '' ELSE {found} END"""
    return _P5_LINES + " " + " UNION ALL ".join([
        row.format(
            r="quoting", n="1 + length(head) - length(replace(regexp_replace(head, '\"(?:[^\"]|\"\")*\"', '', 'g'), chr(9), ''))", o=f"length(head) + length(({closed}))",
            m=f"CASE WHEN ({closed}) = '' THEN 'the quoted field is not closed' ELSE 'the quoted field goes on after its closing mark' END", t="v", w="broken",
        ),
        row.format(r="column_count", n="NULL", o=0, m="len(f) || ' fields instead of 8'", t="vq", w="len(f) <> 8"),
        row.format(r="pos", n=2, o=_offset("f", "2"), m="'not a whole number from 1 to 2147483647'", t="vq", w=f"len(f) = 8 AND NOT ({_POS})"),
        row.format(r="qual", n=6, o=_offset("f", "6"), m="'neither ''.'' nor an unsigned number'", t="vq", w=f"len(f) = 8 AND NOT ({_QUAL})"),
        row.format(r="column_count", n="NULL", o=0, m="len(f) || ' fields instead of at least 11'", t="sb", w="len(f) < 11"),
        row.format(r="column_count", n="11 + odd", o=_offset("f", "(11 + odd)"), m="'a further field that is no tag'", t="sb", w="len(f) >= 11 AND odd IS NOT NULL AND odd > 0"),
        row.format(r="template_length", n=9, o=_offset("f", "9"), m="'not a whole number within 32 bits'", t="sb", w=f"len(f) >= 11 AND coalesce(odd, 0) = 0 AND NOT ({_TLEN})"),
    ])


def _p5_vcf() -> str:
    dot = lambda i, n: f"nullif(q[{i}], '.') AS {n}"
    return _P5_LINES + f"""SELECT line_id, q[1] AS chrom, CAST(q[2] AS INTEGER) AS pos, {dot(3, "id")}, q[4] AS ref, {dot(5, "alt")}, CASE WHEN q[6] = '.' THEN NULL ELSE CAST(q[6] AS DOUBLE) END AS qual,
{dot(7, '"filter"')}, {dot(8, "info")} FROM vq WHERE len(f) = 8 AND ({_POS}) AND ({_QUAL})"""


def _p5_sam() -> str:
    whole = lambda i, low: f"CASE WHEN {_INT32.format(x=f'f[{i}]', p='[0-9]+', a=low)} THEN CAST(f[{i}] AS INTEGER) END"
    return _P5_LINES + f"""SELECT line_id, f[1] AS name, {whole(2, 0)} AS flags, nullif(f[3], '*') AS reference_sequence_name, {whole(4, 1)} AS alignment_start, nullif({whole(5, 0)}, 255) AS mapping_quality,
f[6] AS cigar, nullif(f[7], '*') AS mate_reference_sequence_name, {whole(8, 1)} AS mate_alignment_start, CAST(f[9] AS INTEGER) AS template_length, f[10] AS sequence, f[11] AS quality_scores,
array_to_string(f[12:], chr(9)) AS tags FROM sb WHERE len(f) >= 11 AND coalesce(odd, 0) = 0 AND ({_TLEN})"""


def _p5_files() -> str:
    """Stretches from anchor to anchor; the lines behind a broken quote, up to the next anchor, belong to it."""
    text = "regexp_replace(coalesce(line, ''), '\\r$', '')"
    head = "starts_with(line, CASE fmt WHEN 'vcf' THEN '#' ELSE '@' END)"
    return f"""WITH a AS (SELECT *, sum(CASE WHEN {head} OR regexp_matches(coalesce(line, ''), '^[^\t\n"]+\t[0-9]+([\t\r]|$)') THEN 1 ELSE 0 END) OVER w AS stretch FROM raw_lines WINDOW w AS (PARTITION BY fmt, file_name ORDER BY line_no)),
e AS ({_P5}),
b AS (SELECT a.*, max(CASE WHEN line_id IN (SELECT line_id FROM e WHERE reason = 'quoting') THEN 1 ELSE 0 END) OVER (PARTITION BY fmt, file_name, stretch ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS skipped FROM a),
k AS (SELECT *, coalesce(skipped, 0) = 1 AS gone FROM b), n AS (SELECT line_id, list(reason) AS reasons FROM e GROUP BY line_id)
SELECT fmt, file_name, count(*) FILTER (NOT gone AND {head}) AS n_headers, count(*) FILTER (NOT gone AND NOT {head} AND reasons IS NULL) AS n_records,
{", ".join(f"count(*) FILTER (NOT gone AND list_contains(reasons, '{r}')) AS n_{r}" for r in ("quoting", "column_count", "pos", "qual", "template_length"))},
count(*) FILTER (gone) AS n_skipped FROM k LEFT JOIN n USING (line_id) GROUP BY fmt, file_name"""


#: Raw cigars as lists of 32-bit words.
_WORDS = """SELECT *, list_transform(range(0, octet_length(cigar) // 4), lambda i: CAST('0x' || substr(hex(cigar), 8 * i + 7, 2) || substr(hex(cigar), 8 * i + 5, 2)
  || substr(hex(cigar), 8 * i + 3, 2) || substr(hex(cigar), 8 * i + 1, 2) AS BIGINT)) AS words FROM alignments"""
_COVERED = "coalesce(list_sum(list_transform(words, lambda x: CASE WHEN (x & 15) IN (0, 2, 3, 7, 8) THEN x >> 4 ELSE 0 END)), 0)"
_READS = f"""SELECT alignment_id, contig_name AS chrom, alignment_start - 1 AS "start", CAST(alignment_start - 1 + greatest({_COVERED}, 1) AS INTEGER) AS "end"
  FROM ({_WORDS}) JOIN contigs ON contig_id = reference_sequence_id WHERE alignment_start IS NOT NULL"""

ORACLE: dict[str, str] = formats.oracle(_COVERED, _WORDS) | {
    "decode_alignments": f"""SELECT alignment_id, CAST(name AS VARCHAR) AS name,
CASE WHEN len(words) = 0 THEN '*' ELSE array_to_string(list_transform(words, lambda x: CAST(x >> 4 AS VARCHAR) || substr('MIDNSHP=X', CAST((x & 15) + 1 AS BIGINT), 1)), '') END AS cigar_text,
CAST({_COVERED} AS BIGINT) AS reference_length,
substr(translate(hex(sequence), '0123456789ABCDEF', '=ACMGRSVTWYHKDBN'), 1, octet_length(quality_scores)) AS sequence_text FROM ({_WORDS})""",
    "coverage_alignments": _coverage(_READS, "chrom", True, "depth > 2"),
    "count_overlaps_reads": VIEWS + f""", r AS ({_READS})
SELECT r.alignment_id, r.chrom, r."start", r."end", count(v.variant_id) AS "count" FROM r LEFT JOIN v ON v.chrom = r.chrom AND v."start" < r."end" AND r."start" < v."end" GROUP BY ALL""",
    "overlap_join": VIEWS + f'SELECT v.variant_id AS a_variant_id, t.interval_id AS b_interval_id, v.chrom AS a_chrom, v."start" AS a_start, t."end" AS b_end FROM v JOIN t ON {HIT}',
    "overlap_join_on_cols": VIEWS + f"SELECT v.variant_id AS a_variant_id, t.interval_id AS b_interval_id, v.sample_id AS a_sample_id FROM v JOIN t ON {HIT} AND v.sample_id = t.sample_id",
    "overlap_semi": VIEWS + f"SELECT v.* FROM v WHERE EXISTS (SELECT 1 FROM t WHERE {HIT})",
    "subtract": VIEWS + f"SELECT v.* FROM vn v WHERE NOT EXISTS (SELECT 1 FROM t WHERE {HIT})",
    "count_overlaps": VIEWS + f'SELECT v.variant_id, v.chrom, v."start", v."end", v.sample_id, v.info_dp, count(t.interval_id) AS "count" FROM v LEFT JOIN t ON {HIT} GROUP BY ALL',
    "count_overlaps_on_cols": VIEWS + f'SELECT v.variant_id, v.chrom, v."start", v."end", v.sample_id, v.info_dp, count(t.interval_id) AS "count" FROM v LEFT JOIN t ON {HIT} AND v.sample_id = t.sample_id GROUP BY ALL',
    "nearest": _nearest(""),
    "nearest_on_cols": _nearest(" AND v.sample_id = t.sample_id"),
    "cluster": _cluster("chrom"),
    "cluster_on_cols": _cluster("chrom, strand"),
    "merge": VIEWS + _merge("SELECT * FROM tn"),
    "merge_on_cols": VIEWS + f'SELECT chrom, "start", "end", CAST(sample_id AS VARCHAR) AS sample_id FROM ({_merge("SELECT * FROM tn WHERE sample_id IS NOT NULL", "chrom, sample_id")})',
    "complement": _complement(False),
    "complement_sizes": _complement(True),
    "coverage": VIEWS + _coverage("SELECT * FROM tn", "chrom", True),
    "coverage_on_cols": VIEWS + _coverage("SELECT * FROM tn WHERE strand IS NOT NULL", "chrom, strand", True),
    "disjoin": VIEWS + _coverage("SELECT * FROM tn", "chrom", False),
    "intersect_ranges": VIEWS + _merge(
        'SELECT v.chrom, greatest(v."start", t."start") AS "start", least(v."end", t."end") AS "end" '
        f"FROM (SELECT * FROM tn WHERE strand = '+') v JOIN (SELECT * FROM tn WHERE strand = '-') t ON {HIT}"
    ),
    "union_ranges": VIEWS + _merge('SELECT chrom, "start", "end" FROM tn UNION ALL SELECT chrom, "start", "end" FROM vn'),
    "setdiff_ranges": VIEWS + f""", m AS ({_merge("SELECT * FROM vn")}),
h AS (SELECT t.interval_id, t.chrom, t."start", t."end", m."start" AS ms, m."end" AS me FROM tn t LEFT JOIN m ON t.chrom = m.chrom AND t."start" < m."end" AND m."start" < t."end"),
g AS (SELECT *, greatest("start", coalesce(lag(me) OVER w, "start")) AS reached, lead(ms) OVER w AS nxt FROM h WINDOW w AS (PARTITION BY interval_id ORDER BY ms))
SELECT chrom, reached AS "start", ms AS "end" FROM g WHERE reached < ms
UNION ALL SELECT chrom, greatest("start", coalesce(me, "start")), "end" FROM g WHERE nxt IS NULL AND greatest("start", coalesce(me, "start")) < "end" """,
    "expand": _geometry(_clamp('"start" - 100'), '"end" + 100'),
    "expand_asym": _geometry(_clamp('"start" - 5000000'), '"end" + 7'),
    "shift_left_clamp": _geometry(_clamp('"start" - 9000000'), 'CASE WHEN "start" - 9000000 < 1 THEN "end" - "start" + 1 ELSE "end" - 9000000 END'),
    "shift_right": _geometry(_clamp('"start" + 500'), '"end" + 500'),
    "flank_up": _geometry(_clamp('"start" - 200'), '"start"'),
    "flank_down": _geometry('"end"', '"end" + 200'),
    "set_width_start": _geometry('"start"', '"start" + 75'),
    "set_width_end": _geometry(_clamp('"end" - 75'), '"end"'),
    "set_width_center": _geometry(_clamp('("start" + "end") // 2 - 37'), '("start" + "end") // 2 + 38'),
    "tile": VIEWS + """SELECT interval_id, track_id, sample_id, chrom, CAST(x AS INTEGER) AS "start", CAST(least(x + 1000, "end") AS INTEGER) AS "end", strand
FROM (SELECT *, unnest(range("start", "end", 1000)) AS x FROM t WHERE "start" < "end")""",
    "sort_natural": _rank(True),
    "sort_lex": _rank(False),
    "flags_predicates": "SELECT alignment_id, " + ", ".join(f"(flags & {1 << i}) <> 0 AS is_{n}" for i, n in enumerate(_FLAGS)) + ", CAST(nullif(mapping_quality, 255) AS INTEGER) AS mapq FROM alignments",
    "region_filter": "SELECT variant_id, chrom, pos FROM variants WHERE chrom = 'chr1' AND pos <= 60000000 AND pos + length(ref) - 1 >= 1000000",
    "sam_round_trip": """SELECT alignment_id, CAST(name AS VARCHAR) AS name, flags, contig_name AS reference, alignment_start, CAST(nullif(mapping_quality, 255) AS INTEGER) AS mapping_quality,
mate_alignment_start, template_length, true AS same_cigar, true AS same_sequence, true AS same_quality_scores FROM alignments LEFT JOIN contigs ON contig_id = reference_sequence_id""",
    "fastq_round_trip": """SELECT alignment_id, coalesce(CAST(name AS VARCHAR), '') AS name, 'ref ' || contig_name AS description, CAST(octet_length(quality_scores) AS INTEGER) AS n_bases,
CASE WHEN hex(quality_scores) NOT LIKE 'FF%' THEN CAST(octet_length(quality_scores) AS INTEGER) END AS n_qualities FROM alignments LEFT JOIN contigs ON contig_id = reference_sequence_id""",
    "vcf_parse_info": """SELECT variant_id, chrom, pos, nullif(nullif(id, '.'), '') AS id, ref, nullif(nullif(alt, '.'), '') AS alt, qual,
info_dp AS "INFO_NREADS", CAST(sample_id AS VARCHAR) AS "INFO_ORIGIN" FROM variants""",
    "bam_round_trip": """SELECT CAST(name AS VARCHAR) AS name, flags, reference_sequence_id, alignment_start, CAST(nullif(mapping_quality, 255) AS INTEGER) AS mapping_quality,
hex(cigar) AS cigar, mate_reference_sequence_id, mate_alignment_start, template_length, hex(sequence) AS sequence, CASE WHEN hex(quality_scores) LIKE 'FF%' THEN '' ELSE hex(quality_scores) END AS quality_scores FROM alignments""",
    "bcf_round_trip": """SELECT chrom, pos, nullif(nullif(id, '.'), '') AS id, ref, nullif(alt, '') AS alt, qual, info_dp AS "INFO_DP" FROM variants WHERE chrom IS NOT NULL""",
    "track_annotation": VIEWS + f"SELECT t.track_id, count(*) AS n_hits, count(DISTINCT v.variant_id) AS n_variants, max(v.info_dp) AS most_reads FROM t JOIN v ON {HIT} GROUP BY t.track_id",
    "chrom_sizes": 'SELECT contig_name AS chrom, CAST(seq_length AS BIGINT) AS "size" FROM contigs',
    "overlap_reads": VIEWS + f""", r AS ({_READS})
SELECT t.interval_id, count(*) AS n_reads, min(r.alignment_id) AS first_read, max(r.alignment_id) AS last_read FROM t JOIN r ON {HIT.replace("v.", "r.")} GROUP BY t.interval_id""",
    "nearest_start_adjacent": _start_adjacent(),
    "overlap_orders_events": PLAIN_VIEWS + f"SELECT v.id AS a_id, t.id AS b_id FROM v JOIN t ON {HIT}",
    "nearest_orders_events": PLAIN_VIEWS + f""", c AS (SELECT v.id AS a_id, t.id AS b_id, CASE WHEN {HIT} THEN 0 ELSE 1 END AS apart,
  greatest(t."start" - v."end", v."start" - t."end", 0) AS distance, abs((v."start" + v."end") // 2 - (t."start" + t."end") // 2) AS mid FROM v JOIN t ON v.chrom = t.chrom)
SELECT v.id AS a_id, b_id, CAST(CASE WHEN apart = 0 THEN 0 ELSE distance END AS BIGINT) AS distance FROM v LEFT JOIN c ON c.a_id = v.id
QUALIFY row_number() OVER (PARTITION BY v.id ORDER BY apart, CASE WHEN apart = 0 THEN mid ELSE distance END, b_id) = 1""",
    "subtract_on_cols": VIEWS + f"SELECT v.* FROM vn v WHERE sample_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM t WHERE {HIT} AND v.sample_id = t.sample_id)",
    "complement_on_cols": VIEWS + f""", m AS ({_merge("SELECT * FROM tn WHERE strand IS NOT NULL", "chrom, strand")}),
g AS (SELECT chrom, strand, greatest(coalesce(lag("end") OVER (PARTITION BY chrom, strand ORDER BY "start"), 0), 0) AS "start", "start" AS "end" FROM m)
SELECT chrom, "start", "end", strand FROM g WHERE "start" < "end" UNION ALL SELECT chrom, l AS "start", seq_length AS "end", strand
FROM (SELECT chrom, strand, max("end") AS l FROM m GROUP BY chrom, strand) JOIN contigs ON contig_name = chrom WHERE l < seq_length""",
    "disjoin_on_cols": VIEWS + _coverage("SELECT * FROM tn WHERE strand IS NOT NULL", "chrom, strand", False),
    "p1_found": _p1(),
    "p2_found": f"""WITH i AS (SELECT * FROM track_intervals WHERE track_id IS NOT NULL AND chrom IS NOT NULL AND "start" IS NOT NULL AND "end" > "start"),
m AS ({_merge("SELECT * FROM i", "track_id, chrom")})
SELECT track_id, chrom, 'period' AS kind, "start" AS seg_start, "end" AS seg_end FROM m
UNION ALL SELECT track_id, chrom, 'gap', p, "start" FROM (SELECT *, lag("end") OVER (PARTITION BY track_id, chrom ORDER BY "start") AS p FROM m) WHERE p < "start" """,
    "p3_found": _HEAVY.format(t="alignments", k="reference_sequence_id") + " UNION ALL " + _HEAVY.format(t="variants", k="chrom"),
    "p3_per_key": _PER_KEY.format(t="alignments", k="reference_sequence_id", x="alignment_start", i="alignment_id")
    + " UNION ALL " + _PER_KEY.format(t="variants", k="chrom", x="pos", i="variant_id"),
    "p4_bounds": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{dim}' AS dimension, CAST({key} AS VARCHAR) AS key, '{m}' AS metric, count({m}) AS n, true AS within_bound FROM {t} WHERE {m} IS NOT NULL GROUP BY {key}"
        for t, m, keys in (
            ("alignments", "mapping_quality", ("reference_sequence_id", "sample_id", "CAST(sequenced_at AS DATE)")),
            ("alignments", "template_length", ("reference_sequence_id", "sample_id", "CAST(sequenced_at AS DATE)")),
            ("variants", "qual", ("chrom", "sample_id", "CAST(called_at AS DATE)")),
        )
        for dim, key in zip(("reference", "sample", "day"), keys)
    ),
    "p5_found": _P5,
    "p5_errors": _p5_errors(),
    "p5_vcf_records": _p5_vcf(),
    "p5_sam_records": _p5_sam(),
    "p5_files": _p5_files(),
}
