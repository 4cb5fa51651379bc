"""Streams give what the batch operators give over the same rows."""

from genomeframe.operators import overlap
from genomeframe.operators.records import bad_lines, parse_records
from genomeframe.streaming import intervals as S


def drain(spark, df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_overlap_and_records(spark, tmp_path):
    rows = [("chr1", 10 * i, 10 * i + 15, i) for i in range(60)]
    path = str(tmp_path / "iv")
    spark.createDataFrame(rows, "chrom string, start int, end int, id int").repartition(3).write.parquet(path)
    fixed = spark.createDataFrame([("chr1", 5, 40, 1), ("chr1", 300, 301, 2)], "chrom string, start int, end int, gene int")
    batch = spark.read.parquet(path)
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = drain(spark, S.stream_overlap(stream, fixed), "hits")
    want = overlap(batch, fixed)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0

    lines = [(1, "vcf", "chr1\t5\t.\tA\tG\t.\t.\t."), (2, "vcf", "chr1\tx\t.\tA\tG\t.\t.\t."), (3, "sam", "broken")]
    path = str(tmp_path / "lines")
    spark.createDataFrame(lines, "line_id long, fmt string, line string").write.parquet(path)
    batch = spark.read.parquet(path)
    stream = spark.readStream.schema(batch.schema).parquet(path)
    got = drain(spark, bad_lines(S.stream_records(stream)), "bad")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, bad_lines(parse_records(batch)).collect()))


def test_text_and_windows(spark, tmp_path):
    d = tmp_path / "text"
    d.mkdir()
    (d / "a.vcf").write_text("#h\nchr1\t5\trs1\tA\tG\t7\t.\t.\n")
    got = drain(spark, S.stream_vcf(spark.readStream.text(str(d))), "vcf").collect()
    assert [(r["chrom"], r["pos"], r["qual"]) for r in got] == [("chr1", 5, 7.0)]
    (tmp_path / "sam").mkdir()
    (tmp_path / "sam" / "a.sam").write_text("@HD\nr\t0\tchr1\t5\t60\t1M\t*\t0\t0\tA\tI\n")
    assert drain(spark, S.stream_sam(spark.readStream.text(str(tmp_path / "sam"))), "sam").count() == 1
    path = str(tmp_path / "events")
    spark.sql("SELECT timestamp '2026-01-01 05:00:00' + make_interval(0,0,0,id) AS at, id % 2 AS k FROM range(10)").write.parquet(path)
    batch = spark.read.parquet(path)
    got = drain(spark, S.window_counts(spark.readStream.schema(batch.schema).parquet(path), "at", "k", "5 days"), "windows", "complete")
    assert got.groupBy().sum("n").first()[0] == 10
