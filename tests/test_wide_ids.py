"""Row ids beyond 32 bits, which no Integer of VCF and BCF holds, come out of the format queries whole."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from genomeframe.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
FAR = 3_000_000_000
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables are not here")


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """The tables with the ids of the second half of the variants, in order of the ids, shifted."""
    base = tmp_path_factory.mktemp("wide")
    os.symlink(f"{FOLDER}/contigs.parquet", base / "contigs.parquet")
    v = spark.read.parquet(f"{FOLDER}/variants.parquet")
    v.withColumn("variant_id", F.when(F.col("variant_id") > 300, F.col("variant_id") + FAR).otherwise(F.col("variant_id"))).write.parquet(f"{base}/variants.parquet")
    return str(base)


@pytest.mark.parametrize("name, ids", [("bcf_region_scan", ("variant_id",)), ("vcf_bcf_overlap", ("a_variant_id", "first_hit")), ("vcf_rewrite_by_qual", ("INFO_ROW",)), ("vcf_to_bcf", ("INFO_ROW",))])
def test_wide_ids(spark, wide, name, ids):
    near, far = QUERIES[name](spark, FOLDER), QUERIES[name](spark, wide)
    assert all(dict(near.dtypes)[c] == "int" and dict(far.dtypes)[c] == "bigint" for c in ids)
    moved = near.withColumns({c: F.when(F.col(c) > 300, F.col(c) + F.lit(FAR)).otherwise(F.col(c).cast("bigint")) for c in ids})
    rows = Counter(map(str, far.collect()))
    assert rows == Counter(map(str, moved.collect())) and any(r[ids[0]] > FAR for r in moved.collect())
