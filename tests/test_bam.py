"""BGZF and BAM: round trips, splits at index offsets, and region scans against a plain filter."""

import random

import pytest
from pyspark.sql import functions as F

from genomeframe.functions import alignment
from genomeframe.sources import bam, bgzf, convert, files, tags
from genomeframe.sources.headers import SamHeader
from genomeframe.sources.text import SAM_COLUMNS


@pytest.mark.parametrize("data", [b"", b"hello bgzf", b"A" * 65536 + b"B" * 1000, random.Random(1).randbytes(200_000), b"line\nnext\nend"])
@pytest.mark.parametrize("level", [bgzf.NONE, bgzf.FAST, bgzf.BEST])
def test_bgzf(tmp_path, data, level):
    path = str(tmp_path / "x.gz")
    with bgzf.Writer(path, level) as w:
        w.write(data)
        place = w.virtual_position()
        w.write(b"tail")
    with bgzf.Reader(path) as r:
        assert r.read_all() == data + b"tail"
        r.seek(place)
        assert r.read(9) == b"tail"
        r.seek(0)
        assert r.read_line() == (data + b"tail").split(b"\n")[0] + (b"\n" if b"\n" in data + b"tail" else b"")
    import gzip

    assert gzip.open(path).read() == data + b"tail"
    with pytest.raises(ValueError):
        bgzf.Writer(path, 10)


def test_offset_index(tmp_path):
    path, data = str(tmp_path / "x.gz"), random.Random(5).randbytes(200_000)
    with bgzf.Writer(path) as w:
        w.write(data)
    bgzf.OffsetIndex.of_file(path).write(path + ".gzi")
    index = bgzf.OffsetIndex.from_path(path + ".gzi")
    assert len(index) == 5
    with bgzf.Reader(path) as r:
        for at in (0, 1, 65279, 65280, 65281, 150_000, 199_999):
            r.seek(index.query(at))
            assert r.read(3) == data[at : at + 3]


TAGS = [("XA", "A", "q"), ("XI", "i", "-70000"), ("XU", "i", "4000000000"), ("XF", "f", "0.1"), ("XZ", "Z", "two words"), ("XH", "H", "1AE3"), ("XB", "BS", "S,0,65535"), ("XD", "Bf", "f,2.5,-1")]


def test_tags():
    raw = tags.encode(TAGS)
    back = tags.decode(raw)
    assert [t[:3] for t in back] == TAGS and tags.encode(back) == raw
    assert (back[1][3], back[3][4], back[6][5], back[4][3]) == (-70000, pytest.approx(0.1), [0.0, 65535.0], None)
    assert tags.decode(None) == tags.decode(b"") == [] and tags.encode(None) == b""
    for n in (-128, 127, 128, 255, 256, -32768, 65535, 65536, -(1 << 31), (1 << 32) - 1):
        assert tags.decode(tags.encode([("XX", "i", str(n))]))[0][3] == n
    with pytest.raises(ValueError):
        tags.encode([("XX", "i", str(1 << 32))])
    with pytest.raises(ValueError):
        tags.decode(b"XXqz")


@pytest.fixture(scope="module")
def reads(spark, tmp_path_factory):
    r = random.Random(3)
    rows = []
    for i in range(3000):
        n = r.randrange(1, 60)
        ref = r.choice([0, 0, 0, 1])
        further = bytearray(tags.encode(r.sample(TAGS, r.randrange(4))))
        rows.append((f"w{i}".encode(), r.randrange(4096), ref, r.randrange(1, 400_000), r.choice([None, 0, 60]), f"{n}M{r.randrange(1, 9)}D1M", None, r.choice([None, 5]), r.randrange(-9, 9), "".join(r.choice("ACGT") for _ in range(n + 1)), "I" * (n + 1), further))
    rows += [(b"u", 4, None, None, None, "*", None, None, 0, "ACGT", "*", bytearray()), (None, 4, None, None, None, "*", None, None, 0, "*", "*", bytearray())]
    df = spark.createDataFrame(rows, "name binary, flags int, ref int, pos int, mapq int, c string, mref int, mpos int, tlen int, s string, q string, data binary")
    df = df.select(
        "name", "flags", F.col("ref").alias("reference_sequence_id"), F.col("pos").alias("alignment_start"), F.col("mapq").cast("short").alias("mapping_quality"),
        alignment.cigar_binary(F.col("c")).alias("cigar"), F.col("mref").alias("mate_reference_sequence_id"), F.col("mpos").alias("mate_alignment_start"),
        F.col("tlen").alias("template_length"), alignment.sequence_binary(F.col("s")).alias("sequence"), alignment.quality_binary(F.col("q")).alias("quality_scores"), "data",
    )
    bam.register(spark)
    path = str(tmp_path_factory.mktemp("bam") / "out")
    header = SamHeader.of({"ctgA": 500_000, "ctgB": 500_000}, "coordinate")
    ordered = df.coalesce(1).sortWithinPartitions(F.col("reference_sequence_id").asc_nulls_last(), "alignment_start")
    ordered.write.format("bam").mode("overwrite").option("header", str(header)).option("index", "true").save(path)
    return df, path, header


def the_file(path):
    (found,) = files.listing(path, ".bam")
    return found[0]


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def test_round_trip(spark, reads):
    df, path, header = reads
    back = spark.read.format("bam").load(path)
    assert back.count() == 3002 and same(back, df)
    assert bam.read_header(the_file(path))[0] == header
    back.repartition(3).write.format("bam").mode("overwrite").option("header", str(header)).save(f"{path}3")
    again = spark.read.format("bam").load(f"{path}3")
    assert again.rdd.getNumPartitions() == 3 and same(again, df)
    typed = spark.read.format("bam").option("tags", "true").load(path)
    assert typed.columns == [*df.columns, "tags"]
    assert typed.where(F.exists("tags", lambda t: (t["tag"] == "XI") & (t["i"] == -70000))).count() == df.where(F.hex("data").contains("5849")).count() > 100
    typed.drop("data").write.format("bam").mode("overwrite").option("header", str(header)).save(f"{path}4")
    assert same(spark.read.format("bam").load(f"{path}4"), df)


def test_appends_keep_what_is_there(spark, reads):
    df, path, header = reads
    part = df.where("reference_sequence_id = 1").coalesce(2)
    for _ in range(2):
        part.write.format("bam").mode("append").option("header", str(header)).save(f"{path}-more")
    assert spark.read.format("bam").load(f"{path}-more").count() == 2 * part.count()
    part.write.format("bam").mode("overwrite").option("header", str(header)).save(f"{path}-more")
    assert same(spark.read.format("bam").load(f"{path}-more"), part)


def test_splits_without_an_index(spark, reads):
    df, path, header = reads
    alone = f"{path}-alone"
    df.coalesce(1).write.format("bam").mode("overwrite").option("header", str(header)).save(alone)
    for size in (3_000, 20_000, 50_000):
        parts = spark.read.format("bam").option("split_bytes", size).load(alone)
        assert parts.rdd.getNumPartitions() > 1 and same(parts, df)
    assert spark.read.format("bam").option("split_bytes", 20_000).option("region", "ctgB:1-1000").load(alone).count() == df.where("reference_sequence_id = 1 AND alignment_start <= 1000").count()


def test_index_splits_and_regions(spark, reads):
    df, path, _ = reads
    file = the_file(path)
    written = open(f"{file}.bai", "rb").read()
    assert [r["n_records"] for r in bam.write_indexes(spark, path).collect()] == [3002]
    assert bam.Index.read(f"{file}.bai").starts()[0] == bam.read_header(file)[2] and len(open(f"{file}.bai", "rb").read()) == len(written)
    parts = spark.read.format("bam").option("split_bytes", 20_000).load(file)
    assert parts.rdd.getNumPartitions() > 3 and same(parts, df)
    end = alignment.alignment_end(F.col("alignment_start"), F.col("cigar"))
    for region, ref, a, b in (("ctgA:1000-20000", 0, 1000, 20000), ("ctgB", 1, 1, 10**9), ("ctgA:399990", 0, 399990, 10**9), ("ctgB:16384-16385", 1, 16384, 16385)):
        want = df.where((F.col("reference_sequence_id") == ref) & (F.col("alignment_start") <= b) & (end >= a))
        for size in (20_000, 1 << 26):
            assert same(spark.read.format("bam").option("region", region).option("split_bytes", size).load(file), want)
    assert spark.read.format("bam").option("region", "ctgZ").load(file).count() == 0
    index = bam.Index.read(f"{file}.bai")
    assert len(index.bins) == 2 and index.starts() == sorted(index.starts())
    few = sum((b >> 16) - (a >> 16) for a, b in index.chunks(0, 1000, 20000))
    assert few < 0.5 * files.listing(file, ".bam")[0][1]


def test_conversions(spark, reads):
    df, path, header = reads
    text = convert.bam_to_sam(df, header)
    assert text.columns == [*SAM_COLUMNS, "data"]
    assert text.where("reference_sequence_name = 'ctgB'").count() == df.where("reference_sequence_id = 1").count()
    back = convert.sam_to_bam(text, header)
    assert back.columns == df.columns and same(back, df)
