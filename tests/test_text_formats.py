"""SAM, VCF and FASTQ text: literal expectations and round trips."""

import pytest
from pyspark.sql import functions as F

from genomeframe.functions import alignment
from genomeframe.sources import headers as H
from genomeframe.sources import text as X

SAM = "@HD\tVN:1.6\tSO:unsorted\n@SQ\tSN:ctgA\tLN:5000\n@SQ\tSN:ctgB\tLN:777\n@PG\tID:maker\n"
READS = (
    "".join(f"w{i}\t16\tctgB\t{31 * i + 1}\t{7 * i}\t2S4M\t=\t{9 + i}\t-{40 + i}\tGGATCC\tA#B#C!\tZQ:i:{-i}\tZT:Z:a b:c\tZF:f:2.5\tZA:B:s,-3,{i}\n" for i in range(4))
    + "lost\t4\t*\t0\t255\t*\t*\t0\t0\tTTGCA\t*\n*\tnone\tctgA\t12\t0\t3M1D\tctgB\t5\t?\tCCG\t;;;\r\n"
)
VCF = """##fileformat=VCFv4.3
##contig=<ID=ctgA,length=5000>
##contig=<ID=ctgB>
##FILTER=<ID=thin,Description="Too few, by far">
##FILTER=<ID=odd,Description="Odd">
##INFO=<ID=RD,Number=1,Type=Integer,Description="Reads, all of them">
##INFO=<ID=SH,Number=.,Type=Float,Description="Shares">
##INFO=<ID=KN,Number=0,Type=Flag,Description="Known">
##INFO=<ID=WHO,Number=1,Type=String,Description="Who said so">
##FORMAT=<ID=CN,Number=1,Type=Integer,Description="Copies">
##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tleft\tright\tthird
ctgA\t17\tv%3B1\tT\tTA,C\t8.25\tthin;odd\tKN;SH=0.75,.,0.125;WHO=a%3Bb;RD=6\tGT:CN\t1/0:2\t.|1:.\t0/0:3
ctgB\t700\tv2;v3\tGG\t<DEL>\t.\tPASS\tRD=.;WHO=me\tCN\t1\t.\t4
ctgB\t0\t.\tC\t.\t-\t.\t.\tGT\t.\t.\t.
"""


def put(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_sam(spark, tmp_path):
    path = put(tmp_path, "a.sam", SAM + READS)
    header = X.read_sam_header(spark, path)
    assert header.reference_sequences() == {"ctgA": 5000, "ctgB": 777} and str(header) == SAM
    df = X.read_sam(spark, path, tags=True)
    rows = {bytes(r["name"] or b"*"): r for r in df.collect()}
    assert len(rows) == 6 and tuple(df.columns[:-1]) == X.SAM_COLUMNS
    r = rows[b"w2"]
    assert (r["flags"], bytes(r["reference_sequence_name"]), r["alignment_start"], r["mapping_quality"], bytes(r["cigar"]), bytes(r["sequence"])) == (16, b"ctgB", 63, 14, b"2S4M", b"GGATCC")
    assert (bytes(r["mate_reference_sequence_name"]), r["mate_alignment_start"], r["template_length"]) == (b"ctgB", 11, -42)
    assert [tuple(t) for t in r["data"]] == [
        ("ZQ", "i", "-2", -2, None, None) if t["tag"] == "ZQ" and t["f"] is None else tuple(t) for t in r["data"]
    ]
    assert [(t["tag"], t["type"], t["value"]) for t in r["data"]] == [("ZQ", "i", "-2"), ("ZT", "Z", "a b:c"), ("ZF", "f", "2.5"), ("ZA", "Bs", "s,-3,2")]
    assert (r["data"][0]["i"], r["data"][2]["f"], r["data"][3]["a"], r["data"][1]["i"]) == (-2, 2.5, [-3.0, 2.0], None)
    u = rows[b"lost"]
    assert u["reference_sequence_name"] is None and u["alignment_start"] is None and u["mapping_quality"] is None and bytes(u["quality_scores"]) == b"" and bytes(u["cigar"]) == b""
    o = rows[b"*"]
    assert (o["flags"], o["template_length"], o["mapping_quality"], bytes(o["mate_reference_sequence_name"]), bytes(o["quality_scores"])) == (0, 0, 0, b"ctgB", b";;;")
    X.write_sam(df, str(tmp_path / "out"), header)
    assert X.read_sam_header(spark, str(tmp_path / "out")) == header
    back = X.read_sam(spark, str(tmp_path / "out"), tags=True)
    assert back.exceptAll(df).count() == 0 and back.count() == 6
    assert header.chrom_sizes(spark).count() == 2
    with pytest.raises(ValueError):
        H.SamHeader.parse("no header")
    with pytest.raises(ValueError):
        X.write_sam(df.withColumn("more", F.lit(1)), str(tmp_path / "bad"), header)


def test_long_headers_and_files_without_one(spark, tmp_path):
    many = "".join(f"@SQ\tSN:c{i}\tLN:{i + 1}\n" for i in range(3000))
    assert len(X.read_sam_header(spark, put(tmp_path, "many.sam", many + READS)).reference_sequences()) == 3000
    assert X.read_sam_header(spark, put(tmp_path, "none.sam", READS)).lines == ()
    assert X.header_lines(spark, put(tmp_path, "empty.sam", ""), "@") == []


def test_binary_columns_round_trip(spark):
    rows = [("5S300M2I", "ACGTN", "I!5#~"), ("*", "*", "*"), ("1M", "acgx", "II@I"), (None, None, None)]
    df = spark.createDataFrame(rows, "c string, s string, q string")
    out = df.select(
        alignment.cigar_text(alignment.cigar_binary(F.col("c"))).alias("c"), alignment.sequence_text(alignment.sequence_binary(F.col("s")), F.length("s")).alias("s"),
        alignment.quality_text(alignment.quality_binary(F.col("q"))).alias("q"),
    ).collect()
    assert [r["c"] for r in out] == ["5S300M2I", "*", "1M", None]
    assert [r["s"] for r in out] == ["ACGTN", "", "ACGN", None]
    assert [r["q"] for r in out][:3] == ["I!5#~", "", "II@I"]


def test_vcf(spark, tmp_path):
    path = put(tmp_path, "a.vcf", VCF)
    h = X.read_vcf_header(spark, path)
    assert h.contigs() == {"ctgA": 5000, "ctgB": None} and h.sample_names() == ["left", "right", "third"]
    assert h.info_fields() == [("RD", "Integer"), ("SH", "Float"), ("KN", "Flag"), ("WHO", "String")] and h.format_fields() == [("CN", "Integer"), ("GT", "String")]
    assert X.read_vcf(spark, path).columns == ["chrom", "pos", "id", "ref", "alt", "qual"]
    df = X.read_vcf(spark, path, h)
    a, b, c = sorted(df.collect(), key=lambda r: r["pos"] or 10**9)
    assert (a["pos"], a["id"], a["INFO_RD"], a["INFO_SH"], a["INFO_KN"], a["INFO_WHO"], a["FMT_GT"], a["FMT_CN"]) == (17, "v;1", 6, 0.75, True, "a;b", "1/0\t.|1\t0/0", "2\t.\t3")
    assert (b["id"], b["alt"], b["qual"], b["INFO_KN"], b["INFO_RD"], b["INFO_SH"], b["FMT_CN"], b["FMT_GT"]) == ("v2;v3", "<DEL>", None, False, None, None, "1\t.\t4", ".\t.\t.")
    assert (c["pos"], c["id"], c["alt"], c["qual"], c["INFO_WHO"]) == (None, None, None, None, None)
    full = X.read_vcf(spark, path, h, filters=True, info_arrays=True)
    more = full.where("pos = 17").first()
    assert more["filter"] == ["thin", "odd"] and more["INFO_SH"] == [0.75, None, 0.125] and more["INFO_RD"] == 6
    X.write_vcf(full, str(tmp_path / "out"), h)
    assert X.read_vcf_header(spark, str(tmp_path / "out")) == h
    back = X.read_vcf(spark, str(tmp_path / "out"), h, filters=True, info_arrays=True)
    assert back.exceptAll(full).count() == 0 and back.count() == 3
    lines = sorted(r["value"] for r in spark.read.text(str(tmp_path / "out")).collect() if not r["value"].startswith("#"))
    assert lines[0] == "ctgA\t17\tv;1\tT\tTA,C\t8.25\tthin;odd\tRD=6;SH=0.75,.,0.125;KN;WHO=a%3Bb\tGT:CN\t1/0:2\t.|1:.\t0/0:3"
    for unknown in ("INFO_ZZ", "FMT_ZZ", "zz"):
        with pytest.raises(ValueError):
            X.write_vcf(full.withColumn(unknown, F.lit("x")), str(tmp_path / "bad"), h)
    with pytest.raises(ValueError):
        H.VcfHeader.parse("chr1\t5")


def test_vcf_without_samples_and_with_awkward_text(spark, tmp_path):
    h = H.VcfHeader.parse('##fileformat=VCFv4.3\n##INFO=<ID=WHO,Number=1,Type=String,Description="x">\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO')
    rows = [("c", 5, "a\tb%09", "A", "x\ny", 1.0, "k=v;w\t100%"), (None, None, "", None, None, None, None), ("c", 5, ".", "A", "", None, "")]
    df = spark.createDataFrame(rows, "chrom string, pos int, id string, ref string, alt string, qual float, INFO_WHO string")
    X.write_vcf(df, str(tmp_path / "out"), h)
    out = [tuple(r) for r in X.read_vcf(spark, str(tmp_path / "out"), h).orderBy("qual", "chrom").collect()]
    assert rows[0] in out and (".", None, None, "N", None, None, None) in out and len(out) == 3


def test_fastq(spark, tmp_path):
    path = put(tmp_path, "a.fastq", "@s1\nGGA\n+\n@+@\n@s2 lane 3\nTTTT\n+s2\n+@!+\n@s3\n\n+\n\n")
    rows = {bytes(r["name"]): r for r in X.read_fastq(spark, path).collect()}
    assert rows[b"s1"]["description"] is None and bytes(rows[b"s1"]["quality_scores"]) == b"@+@"
    assert bytes(rows[b"s2"]["description"]) == b"lane 3" and bytes(rows[b"s2"]["sequence"]) == b"TTTT" and bytes(rows[b"s3"]["sequence"]) == b""
    many = "".join(f"@r{i} x\n{'ACGT' * (i % 5 + 1)}\n+\n{'@+' * 2 * (i % 5 + 1)}\n" for i in range(3000))
    path = put(tmp_path, "b.fastq", many)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("20000", "333", "60"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            if size != "20000":
                path = put(tmp_path, f"{size}.fastq", many[: int(size) * 40].rpartition("@r")[0])
            df = X.read_fastq(spark, path)
            n = open(path).read().count("@r")
            assert spark.read.text(path).rdd.getNumPartitions() > 3
            assert df.count() == n and df.distinct().count() == n and df.where("length(sequence) != length(quality_scores)").count() == 0
        X.write_fastq(df, str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert X.read_fastq(spark, str(tmp_path / "out")).exceptAll(df).count() == 0


def test_vcf_line_is_split_once(spark, tmp_path):
    """Reading splits a line once and not for each use of a field; the columns are those of ``vcf_columns``, for odd lines too."""
    header = H.VcfHeader.parse("\n".join([
        "##fileformat=VCFv4.3", '##INFO=<ID=ab.c,Number=1,Type=String,Description="x">', '##INFO=<ID=AB.C,Number=.,Type=Integer,Description="x">',
        '##INFO=<ID=ON,Number=0,Type=Flag,Description="x">', '##FORMAT=<ID=q,Number=1,Type=Integer,Description="x">', '##FORMAT=<ID=Q,Number=1,Type=String,Description="x">',
        "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tone\ttwo",
    ]))
    body = [
        "c\t7\ti\tA\tC,G\t1e3\tPASS\tab.c=x%3By;AB.C=1,.,z;ON\tQ:q\ta:1\t.:2", "c\t0\t.\tA\t.\t.\t.\t.\t.\t.\t.", "c\tx\t%25\tA\tC\tx\ta;b\tab.c=1;ab.c=2;AB.C=;ON=1\tq\t5",
        "c\t5\ti\tA", "c", "c\t5\ti\tA\tC\t3\t.\tab.c=.;ab.cd=4\tq:Q\t:\t1:2:3\t9",
    ]
    path = tmp_path / "a.vcf"
    path.write_text(str(header) + "\n".join(body) + "\n")
    found = X.read_vcf(spark, str(path), header, filters=True, info_arrays=True)
    lines = spark.createDataFrame([(x,) for x in body], "value string")
    want = lines.select(*X.vcf_columns(F.col("value"), header, True, True))
    assert found.columns == want.columns
    rows = [tuple(r) for r in found.collect()]
    assert sorted(map(repr, rows)) == sorted(repr(tuple(r)) for r in want.collect())
    assert rows[0] == ("c", 7, "i", "A", "C,G", 1000.0, ["PASS"], "x;y", [1, None, None], True, "1\t2", "a\t.")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1
