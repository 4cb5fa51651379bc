"""Records of several sources mixed to target shares of the total size.

Method: every record gets a hash-random key; the records of each source are ordered by it (range buckets of the hash, see
``prefix``); distributed prefix sums of token counts give each record its place on its source's line; the line is cut at
exactly the source's budget, going round again (an *epoch* more for each record) where the source is smaller than its
budget, up to ``max_repeats`` times.

Budgets are ``target_share * total``. ``total`` is by default the number of tokens of all records. With
``total="reachable"`` it is the largest total at which every source of the mix that has records reaches its share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, spread
from .prefix import bits_for, random_key, with_running
from .tokens import DEFAULT_VOCABULARY, with_token_count

#: Targets with at most so many rows are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 100_000


#: What tells a record apart from others; records that are equal in all of it are copies, whose order does not matter.
IDENTITY = ("doc_id", "source", "n_tokens")


def sized(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``doc_id, source, n_tokens`` of every record, written once; tokenizing is the costly part."""
    return cut(with_token_count(spread(df.select(id_col, source_col, text_col)), text_col, {"doc_id": id_col, "source": source_col}, vocabulary))


def budgets(docs: DataFrame, targets: DataFrame, total: int | str = "all") -> DataFrame:
    """``mix_name, source, target_share, max_repeats, available, budget`` for each target; budgets in tokens.

    Targets are a small table of parameters (mixes times sources). A target that is repeated counts with its first share.
    """
    targets = targets.select("mix_name", "source", F.col("target_share").cast("double"), F.col("max_repeats").cast("long")).dropDuplicates(["mix_name", "source"])
    have = docs.where("source IS NOT NULL AND n_tokens > 0").groupBy("source").agg(F.sum("n_tokens").alias("available"))
    out = targets.join(have, "source", "left").withColumn("available", F.coalesce("available", F.lit(0)))
    if total == "reachable":
        limit = F.when((F.col("target_share") > 0) & (F.col("available") > 0), F.col("available") * F.col("max_repeats") / F.col("target_share"))
        size = out.groupBy("mix_name").agg(F.coalesce(F.min(limit), F.lit(0.0)).alias("total"))
        out = out.join(size, "mix_name")
    elif total == "all":
        out = out.withColumn("total", F.coalesce(docs.agg(F.sum("n_tokens")).scalar(), F.lit(0)).cast("double"))
    else:
        out = out.withColumn("total", F.lit(float(total)))
    return out.withColumn("budget", F.floor(F.greatest(F.col("target_share"), F.lit(0.0)) * F.col("total") + 1e-6).cast("long"))


def mix(docs: DataFrame, targets: DataFrame, total: int | str = "all", seed: int = 0) -> DataFrame:
    """``mix_name, source, doc_id, epoch, n_tokens``: one row for each use of a record, epochs from 1.

    In each mix a source gives the records whose middle on its line lies within its budget; so the budget is met to within
    half of one record, unless the repeats do not allow it. No record is used more than ``max_repeats`` times, none is cut.
    Records without a source or without tokens are in no mix. Repeated rows are records of their own. The order is that of a hash
    of the record, so the result is the same on any cluster and for any split of the input.
    """
    plan = budgets(docs, targets, total).where("available > 0 AND budget > 0 AND max_repeats > 0")
    lines = docs.where("source IS NOT NULL AND n_tokens > 0").withColumn("key", random_key(seed, *IDENTITY))
    lines = with_running(lines, ["source"], "key", {"before": "n_tokens"}, bits_for(docs.count()), ties=IDENTITY)
    # the plan has one row per mix and source; its size is checked before it is broadcast
    plan = plan.select("mix_name", "source", "max_repeats", "available", "budget")
    used = lines.join(F.broadcast(plan) if targets.count() <= BROADCAST_ROWS else plan, "source")
    # uses: whole rounds, and one more if the record's middle lies within what is left of the budget
    rounds = F.floor(F.col("budget") / F.col("available"))
    left = F.col("budget") - rounds * F.col("available")
    uses = F.least(rounds + F.when(2 * F.col("before") + F.col("n_tokens") <= 2 * left, 1).otherwise(0), F.col("max_repeats")).cast("int")
    used = used.withColumn("uses", uses).where("uses > 0")
    return used.select("mix_name", "source", "doc_id", F.explode(F.sequence(F.lit(1), F.col("uses"))).alias("epoch"), "n_tokens")


def shares(docs: DataFrame, targets: DataFrame, mixed: DataFrame, total: int | str = "all") -> DataFrame:
    """Per mix and source: target and actual share, budget and tokens used, records, epochs, and whether the budget is reached.

    A source counts as reached if it misses its budget by no more than half of its longest record.
    """
    plan = budgets(docs, targets, total)
    got = mixed.groupBy("mix_name", "source").agg(F.sum("n_tokens").alias("tokens_used"), F.count("*").alias("n_uses"), F.max("epoch").alias("epochs"))
    longest = docs.where("source IS NOT NULL").groupBy("source").agg(F.max("n_tokens").alias("longest"))
    sums = got.groupBy("mix_name").agg(F.sum("tokens_used").alias("mix_tokens"))
    out = plan.join(got, ["mix_name", "source"], "left").join(longest, "source", "left").join(sums, "mix_name", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    out = out.withColumns({"tokens_used": zero("tokens_used"), "n_uses": zero("n_uses"), "epochs": zero("epochs")})
    share = F.when(F.col("mix_tokens") > 0, F.col("tokens_used") / F.col("mix_tokens")).otherwise(F.lit(0.0))
    reached = (F.col("budget") == 0) | (2 * (F.col("budget") - F.col("tokens_used")) <= F.coalesce("longest", F.lit(0)))
    return out.select(
        "mix_name", "source", "target_share", share.alias("actual_share"), "budget", "tokens_used", "available", "n_uses", "epochs", "max_repeats", reached.alias("reached")
    )
