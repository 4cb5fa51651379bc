"""Named queries of the text operators over ``documents``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from . import mixing, packing, sentences

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _containers(spark: SparkSession, d: str) -> dict[str, int]:
    """The capacities are parameters: a handful of rows."""
    return {r["container_kind"]: r["capacity_tokens"] for r in _table(spark, d, "containers").collect()}


def p6_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(_table(spark, d, "documents"), _containers(spark, d))


def p6_fill(spark: SparkSession, d: str) -> DataFrame:
    containers = _containers(spark, d)
    return packing.fill(packing.pack(_table(spark, d, "documents"), containers), containers)


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(mixing.sized(_table(spark, d, "documents")), _table(spark, d, "mix_targets"))


def p7_mix_reachable(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(mixing.sized(_table(spark, d, "documents")), _table(spark, d, "mix_targets"), "reachable")


def _shares(spark: SparkSession, d: str, total: str) -> DataFrame:
    docs, targets = mixing.sized(_table(spark, d, "documents")), _table(spark, d, "mix_targets")
    return mixing.shares(docs, targets, mixing.mix(docs, targets, total), total)


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return _shares(spark, d, "all")


def p7_shares_reachable(spark: SparkSession, d: str) -> DataFrame:
    return _shares(spark, d, "reachable")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentences(_table(spark, d, "documents"))


def p6_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Per capacity: documents that came out, containers that hold too much, documents cut that would fit, documents without tokens."""
    containers = _containers(spark, d)
    packed = packing.pack(_table(spark, d, "documents"), containers)
    capacity = F.create_map(*(F.lit(x) for kv in containers.items() for x in kv))[F.col("container_kind")]
    over = packed.where("container_id IS NOT NULL").groupBy("container_kind", "container_id").agg(F.sum("n_tokens").alias("used")).where(F.col("used") > capacity)
    over = over.groupBy("container_kind").agg(F.count("*").alias("n_over"))
    docs = packed.groupBy("container_kind", "doc_id").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("size"), F.count("container_id").alias("placed"))
    docs = docs.groupBy("container_kind").agg(
        F.count("*").alias("n_documents"), F.count(F.when((F.col("n") > 1) & (F.col("size") <= capacity), 1)).alias("n_cut"), F.count(F.when(F.col("placed") == 0, 1)).alias("n_empty")
    )
    out = docs.join(over, "container_kind", "left")
    return out.select("container_kind", capacity.cast("long").alias("capacity"), "n_documents", F.coalesce("n_over", F.lit(0)).cast("long").alias("n_over"), "n_cut", "n_empty")


def p7_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Per target: no record is used too often; the budget is met to half of the longest record, or all records are used up."""
    docs, targets = mixing.sized(_table(spark, d, "documents")), _table(spark, d, "mix_targets")
    mixed = mixing.mix(docs, targets)
    uses = mixed.groupBy("mix_name", "source", "doc_id").agg(F.count("*").alias("n"), F.count_distinct("epoch").alias("epochs"))
    uses = uses.groupBy("mix_name", "source").agg(F.max("n").alias("most"), F.min(F.col("n") == F.col("epochs")).alias("one_each"))
    longest = docs.groupBy("source").agg(F.max("n_tokens").alias("longest"))
    out = mixing.shares(docs, targets, mixed).join(uses, ["mix_name", "source"], "left").join(longest, "source", "left")
    miss = 2 * F.abs(F.col("budget") - F.col("tokens_used")) <= F.coalesce("longest", F.lit(0))
    used_up = (F.col("budget") > F.col("tokens_used")) & (F.col("tokens_used") == F.col("available") * F.col("max_repeats"))
    kept = F.coalesce((F.col("most") <= F.col("max_repeats")) & F.col("one_each"), F.lit(True))
    return out.select("mix_name", "source", kept.alias("repeats_kept"), (miss | used_up | (F.col("budget") == 0)).alias("budget_kept"))


#: White space as Python's ``str.isspace`` has it.
_WHITE = r"[\x09-\x0d\x1c-\x20\x{85}\p{Z}]"


def p8_cover(spark: SparkSession, d: str) -> DataFrame:
    """Per document: code points in its sentences that are no white space, sentences that begin in another or have white ends."""
    docs = _table(spark, d, "documents").select("doc_id", "text")
    found = p8_found(spark, d).join(docs, "doc_id").withColumn("own", F.expr("substring(text, sent_start + 1, sent_end - sent_start)"))
    before = F.lag("sent_end").over(W.Window.partitionBy("doc_id").orderBy("sent_start"))
    found = found.withColumn("wrong", (F.col("sent_start") < F.coalesce(before, F.lit(0))) | F.col("own").rlike(rf"^{_WHITE}|{_WHITE}\z"))
    kept = F.length(F.regexp_replace("own", _WHITE, ""))
    return found.groupBy("doc_id").agg(F.sum(kept).alias("n_covered"), F.count(F.when(F.col("wrong"), 1)).alias("n_wrong"))


QUERIES: dict[str, Query] = {
    "p6_packing": p6_packing,
    "p6_fill": p6_fill,
    "p7_mix": p7_mix,
    "p7_mix_reachable": p7_mix_reachable,
    "p7_shares": p7_shares,
    "p7_shares_reachable": p7_shares_reachable,
    "p8_found": p8_found,
    "p6_invariants": p6_invariants,
    "p7_invariants": p7_invariants,
    "p8_cover": p8_cover,
}
#: SQL has no tokenizer and no sentences; it tells what must hold of the results. Tests hold the operators against brute force.
ORACLE: dict[str, str] = {
    "p6_invariants": """SELECT container_kind, CAST(capacity_tokens AS BIGINT) AS capacity, (SELECT count(*) FROM documents) AS n_documents, CAST(0 AS BIGINT) AS n_over,
CAST(0 AS BIGINT) AS n_cut, (SELECT count(*) FROM documents WHERE text IS NULL OR text = '') AS n_empty FROM containers""",
    "p7_invariants": "SELECT DISTINCT mix_name, source, true AS repeats_kept, true AS budget_kept FROM mix_targets",
    "p8_cover": f"""SELECT doc_id, length(regexp_replace(text, '{_WHITE}', '', 'g')) AS n_covered, CAST(0 AS BIGINT) AS n_wrong FROM documents
WHERE length(regexp_replace(text, '{_WHITE}', '', 'g')) > 0""",
}
