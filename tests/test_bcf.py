"""BCF: VCF text to BCF and back, typed values, index splits and regions."""

import random
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from genomeframe.sources import bcf, files
from genomeframe.sources import text as X
from genomeframe.sources.headers import VcfHeader

HEADER = """##fileformat=VCFv4.3
##FILTER=<ID=thin,Description="Too few">
##FILTER=<ID=odd,Description="Odd">
##contig=<ID=ctgA,length=500000>
##contig=<ID=ctgB,length=500000>
##INFO=<ID=RD,Number=1,Type=Integer,Description="Reads, all">
##INFO=<ID=SH,Number=.,Type=Float,Description="Shares">
##INFO=<ID=CNT,Number=R,Type=Integer,Description="Counts">
##INFO=<ID=KN,Number=0,Type=Flag,Description="Known">
##INFO=<ID=WHO,Number=1,Type=String,Description="Who said so">
##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">
##FORMAT=<ID=CN,Number=1,Type=Integer,Description="Copies">
##FORMAT=<ID=PR,Number=R,Type=Integer,Description="Pairs">
##FORMAT=<ID=WT,Number=1,Type=Float,Description="Weight">
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tleft\tright
"""


@pytest.fixture(scope="module")
def calls(spark, tmp_path_factory):
    r = random.Random(2)
    lines = []
    for chrom in ("ctgA", "ctgB"):
        for pos in sorted(r.sample(range(1, 400_000), 900)):
            ref = "ACGTTG"[: r.randrange(1, 6)]
            alt = r.choice(["A", "G,TT", "."])
            info = r.choice([".", "RD=6;SH=0.75,.,0.125;KN;WHO=me", "RD=70000;CNT=1,300,.", f"WHO={'y' * 40}", "RD=-5;KN;SH=2", "CNT=-70000,4"])
            gt, other = r.choice([("GT:CN:PR", "0/1:40:3,9\t1|1:300:.,1"), ("GT", "./.\t0|2"), ("WT:CN", "0.25:.\t.:7"), ("CN", "1\t2")])
            marks = r.choice([".", "PASS", "thin", "thin;odd"])
            lines.append(f"{chrom}\t{pos}\t{r.choice(['.', 'v1', 'v1;v2'])}\t{ref}\t{alt}\t{r.choice(['.', '30.0', '12.5'])}\t{marks}\t{info}\t{gt}\t{other}")
    base = tmp_path_factory.mktemp("bcf")
    (base / "a.vcf").write_text(HEADER + "\n".join(lines) + "\n")
    header = X.read_vcf_header(spark, str(base / "a.vcf"))
    df = X.read_vcf(spark, str(base / "a.vcf"), header, filters=True, info_arrays=True)
    bcf.register(spark)
    path = str(base / "out")
    df.coalesce(1).write.format("bcf").mode("overwrite").option("header", str(header)).option("index", "true").save(path)
    return df, path, header


def read(spark, path, **options):
    return spark.read.format("bcf").options(filters="true", info_arrays="true", **options).load(path)


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def test_round_trip(spark, calls):
    df, path, header = calls
    back = read(spark, path)
    assert back.columns == df.columns and back.count() == 1800 and same(back, df)
    assert back.where("size(INFO_SH) = 3 AND INFO_SH[1] IS NULL").count() > 100 and back.where("size(filter) = 2").count() > 100
    (file,) = files.listing(path, ".bcf")
    assert bcf.read_header(file[0])[0] == header
    back.repartition(2, "pos").write.format("bcf").mode("overwrite").option("header", str(header)).save(f"{path}2")
    assert same(read(spark, f"{path}2"), df)
    # without the extras: no filter, the first of several numbers
    plain = spark.read.format("bcf").load(path)
    first = df.drop("filter").withColumns({c: F.get(c, F.lit(0)) for c in ("INFO_SH", "INFO_CNT")})
    assert plain.columns == first.columns and same(plain, first)
    with pytest.raises(Exception, match="no place for the column"):
        df.withColumn("INFO_ZZ", F.lit(1)).write.format("bcf").mode("overwrite").option("header", str(header)).save(f"{path}3")


def test_appends_keep_what_is_there(spark, calls):
    df, path, header = calls
    for _ in range(2):
        df.limit(100).coalesce(1).write.format("bcf").mode("append").option("header", str(header)).save(f"{path}-more")
    assert read(spark, f"{path}-more").count() == 200


def test_splits_and_regions(spark, calls):
    df, path, header = calls
    df.coalesce(1).write.format("bcf").mode("overwrite").option("header", str(header)).save(f"{path}-alone")
    for where in (path, f"{path}-alone"):
        parts = read(spark, where, split_bytes="2000")
        assert parts.rdd.getNumPartitions() > 1 and same(parts, df)
    assert [r["n_records"] for r in bcf.write_indexes(spark, path).collect()] == [1800]
    last = F.col("pos") + F.length("ref") - 1
    for region, chrom, a, b in (("ctgA:1000-20000", "ctgA", 1000, 20000), ("ctgB", "ctgB", 1, 10**9), ("ctgB:399000", "ctgB", 399000, 10**9)):
        want = df.where((F.col("chrom") == chrom) & (F.col("pos") <= b) & (last >= a))
        for where in (path, f"{path}-alone"):
            for size in ("2000", "100000000"):
                assert same(read(spark, where, region=region, split_bytes=size), want)
    assert read(spark, path, region="ctgZ").count() == 0


def test_values():
    assert bcf.genotype([2, 4]) == "0/1" and bcf.genotype([2, 5]) == "0|1" and bcf.genotype([0, 0]) == "./." and bcf.genotype([]) == "."
    assert bcf._shown(30.0) == "30" and bcf._shown(0.1) == "0.1" and bcf._shown(None) == "." and bcf._shown(7) == "7"
    assert bcf.dictionary(VcfHeader.parse(HEADER))[:5] == ["PASS", "thin", "odd", "RD", "SH"]
    with pytest.raises(ValueError):
        bcf.Codec(VcfHeader.parse(HEADER)).encode({"chrom": "zzz", "pos": 1, "id": None, "ref": "A", "alt": None, "qual": None})
    codec = bcf.Codec(VcfHeader.parse(HEADER), True)
    with pytest.raises(ValueError):
        codec.encode({"chrom": "ctgA", "pos": 1, "id": None, "ref": "A", "alt": None, "qual": None, "filter": ["unheard"]})


def test_source_workers_need_no_pandas():
    """The driver keeps a worker for each step of a source; each would hold pandas, which no step needs."""
    root = Path(bcf.__file__).parents[2]
    code = "import sys, genomeframe.sources.bcf; sys.exit('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0
