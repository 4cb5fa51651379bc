"""Record grammar: reasons by case, recovery at anchors, and agreement with plain splitting on unquoted lines."""

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from genomeframe.operators import records as R

VCF = "chr1\t100\t.\tA\tG\t30\tPASS\tDP=1"
SAM = "r1\t99\tchr1\t5\t60\t5M\t=\t9\t-12\tACGTA\tIIIII"


def reasons(text, fmt):
    return [[e[0] for e in errors] for _, _, _, _, errors in R.parse_text(text, fmt)]


def put(line, i, value):
    f = line.split("\t")
    f[i] = value
    return "\t".join(f)


@pytest.mark.parametrize(
    ("line", "want"),
    [
        (VCF, []), (VCF + "\r", []), ("#CHROM\tx", []), ("", ["column_count"]), (VCF + "\tx", ["column_count"]), (VCF.rpartition("\t")[0], ["column_count"]),
        (put(VCF, 7, '"DP=1;N=""a\tb"""'), []), (put(VCF, 7, '"DP'), ["quoting"]), (put(VCF, 2, '"a"b'), ["quoting"]), (put(VCF, 7, '"DP=64""'), ["quoting"]),
        (put(VCF, 7, 'D"P'), []), (put(VCF, 2, '""'), []), (put(VCF, 1, '"7"'), []), (put(VCF, 7, '"a"\r'), []),
        *((put(VCF, 1, x), ["pos"]) for x in ("0", "", ".", "+5", "-5", "2147483648", "1e6", "5 ", "٣", "000")), *((put(VCF, 1, x), []) for x in ("007", "2147483647", "1")),
        *((put(VCF, 5, x), ["qual"]) for x in ("", "-1", "+1", "1.", ".5", "1e", "NaN", "inf", "1,5", "1 ", "１")), *((put(VCF, 5, x), []) for x in (".", "0", "1.5", "3e+02", "2E3", "5.1e-4", "001")),
        (put(put(VCF, 1, "x"), 5, "y"), ["pos", "qual"]), (put(put(VCF, 1, "x"), 7, '"y'), ["quoting"]),
    ],
)
def test_vcf(line, want):
    assert reasons(line, "vcf") == [want]


@pytest.mark.parametrize(
    ("line", "want"),
    [
        (SAM, []), (SAM + "\r", []), ("@SQ\tx", []), (" ", ["column_count"]), (SAM + "\tNM:i:0\tCO:Z:he said \"x\"", []), (SAM + "\tNM", ["column_count"]), (SAM + "\t", ["column_count"]),
        (SAM + "\tABC:Z:x", ["column_count"]), (SAM + "\tNM:q:0", ["column_count"]), (SAM + "\tXA:Z:", []), (SAM.rpartition("\t")[0], ["column_count"]),
        *((put(SAM, 8, x), ["template_length"]) for x in ("", "+5", "--5", "5-", "2147483648", "-2147483649", "1.5", "0x1", "−5", "- 5")), *((put(SAM, 8, x), []) for x in ("-2147483648", "2147483647", "0", "-0", "0007")),
        (put(SAM, 8, "x") + "\tNM", ["column_count"]),
    ],
)
def test_sam(line, want):
    assert reasons(line, "sam") == [want]


def test_recovery_at_anchors():
    broken = put(VCF, 7, '"DP=1')
    text = "\n".join([VCF, broken, "rest of the field", put(VCF, 0, "chr2"), "", "#x", VCF])
    assert reasons(text, "vcf") == [[], ["quoting"], [], ["column_count"], [], []]
    out = R.parse_text(text, "vcf")
    assert [x[2]["chrom"] for x in out if x[2]] == ["chr1", "chr2", "chr1"]
    place = out[1][4][0]
    assert place[1] == 8 and text[place[2]] == '"'
    assert reasons(broken + "\nno anchor", "vcf") == [["quoting"]]


def test_files_across_lines_and_splits(spark, tmp_path):
    """Quotes that run over lines, quotes that never close, and borders of splits anywhere: the same as one parse of each whole file."""
    r = random.Random(4)
    for k in range(3):
        lines = ["#CHROM\tx"]
        for i in range(400):
            line = put(VCF, 1, str(i + 1))
            x = r.random()
            if x < 0.2:
                line = put(line, 7, '"one\ntwo ""2""\n\tthree"' + ("\r" if x < 0.05 else ""))
            elif x < 0.3:
                line = put(line, 2, '"open')
            elif x < 0.35:
                line = put(line, 2, '"a"b')
            elif x < 0.45:
                line = r.choice(["", "no record", "x\t5", '"\t', "rest\tof\tit", "##note"])
            lines.append(line)
        (tmp_path / f"f{k}.vcf").write_text("\n".join(lines) + "\n")
    want = Counter()
    for k in range(3):
        text = (tmp_path / f"f{k}.vcf").read_bytes().decode().removesuffix("\n")
        grammar = R.Grammar(text, "vcf", True)
        for unit in grammar.units():
            if unit.kind == "record" and not unit.errors:
                R.typed_vcf(unit)
            start = text.count("\n", 0, unit.start) + 1
            want[f"f{k}.vcf", start, text.count("\n", unit.start, grammar.at) + 1, "bad" if unit.errors else unit.kind, ",".join(e[0] for e in unit.errors)] += 1
    assert any(x[3] == "record" and x[2] == 3 for x in want) and any(x[4] == "quoting" and x[2] > 1 for x in want)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("900", "4000", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = R.parse_files(spark, str(tmp_path), "vcf").collect()
            found = Counter((x["file"].rpartition("/")[2], x["line_no"], x["n_lines"], x["kind"], ",".join(e["reason"] for e in x["errors"])) for x in got)
            assert found == want
            assert any(x["vcf"] and x["vcf"]["info"] == 'one\ntwo "2"\n\tthree' for x in got)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    with pytest.raises(ValueError):
        R.parse_files(spark, str(tmp_path), "bed")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='a1"\t.\r#', max_size=30))
def test_quoting_agrees_with_a_pattern(line):
    import re

    body = line[:-1] if line.endswith("\r") else line
    if line.startswith("#"):
        return
    whole = r'(?:"(?:[^"]|"")*"|[^"\t][^\t]*|)'
    ok = re.fullmatch(rf"{whole}(?:\t{whole})*", body, re.DOTALL) is not None
    assert (reasons(line, "vcf")[0] == ["quoting"]) == (not ok)


def test_table(spark):
    rows = [(1, "vcf", VCF), (1, "vcf", VCF), (2, "sam", SAM), (3, "vcf", None), (4, "bed", "x"), (5, None, "x"), (None, "vcf", put(VCF, 1, "x")), (2**60 + 1, "vcf", "x" * 100000)]
    df = spark.createDataFrame(rows, "line_id long, fmt string, line string").withColumnRenamed("line", "line")
    out = R.parse_records(df)
    got = out.collect()
    assert len(got) == 8
    assert sorted((r["line_id"] or 0, r["reason"]) for r in R.bad_lines(out).collect()) == [(0, "pos"), (3, "column_count"), (4, "format"), (5, "format"), (2**60 + 1, "column_count")]
    vcf = next(r["vcf"] for r in got if r["line_id"] == 1)
    assert (vcf["chrom"], vcf["pos"], vcf["id"], vcf["qual"], vcf["info"]) == ("chr1", 100, None, 30.0, "DP=1")
    sam = next(r["sam"] for r in got if r["line_id"] == 2)
    assert (sam["flags"], sam["template_length"], sam["tags"]) == (99, -12, [])
    assert R.parse_records(df.limit(0)).collect() == []
