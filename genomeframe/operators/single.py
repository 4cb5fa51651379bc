"""Operators on one set of intervals: cluster, merge, complement, coverage, disjoin.

Rows with a null chromosome, key, start or end take no part (``cluster`` keeps them with a null id). Touching intervals
are never joined. With ``on_cols`` the extra key columns come out as columns of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..roles import bare, check_on_cols, complete, key_names, pack, unpack
from . import carry, islands


def _named(df: DataFrame, on_cols: Sequence[str], *more: str) -> DataFrame:
    """``chrom, start, end`` first, then the on_cols, then what the operator adds."""
    added = {"chrom", "start", "end", *more}
    labels = [c if c.lower() not in added else f"{c}_in" for c in on_cols]
    return df.select(
        F.col("k0").alias("chrom"), F.col("s").alias("start"), F.col("e").alias("end"),
        *(F.col(f"k{i + 1}").alias(c) for i, c in enumerate(labels)), *more,
    )


def merge(df: DataFrame, on_cols: Sequence[str] | None = None) -> DataFrame:
    """Unions of overlapping intervals: ``chrom, start, end, on_cols...``."""
    on_cols, keys = check_on_cols(df, on_cols), key_names(on_cols)
    flagged = islands.flagged_starts(bare(df, on_cols), keys)
    return _named(islands.periods(flagged, keys), on_cols)


def cluster(df: DataFrame, on_cols: Sequence[str] | None = None) -> DataFrame:
    """The input's rows with ``cluster_id``: 0-based, dense, in the order of (chromosome, on_cols, start).

    A row without a chromosome, key or coordinate gets a null id. An input column named ``cluster_id`` comes out as
    ``cluster_id_in``.
    """
    on_cols, keys = check_on_cols(df, on_cols), key_names(on_cols)
    packed = pack(df, on_cols)
    whole = " AND ".join(f"{c} IS NOT NULL" for c in [*keys, "s", "e"])
    # the numbering needs only distinct starts (zero-length intervals count each), the rows join it by their start
    flagged = islands.flagged_starts(bare(df, on_cols), keys)
    flagged = flagged.withColumn("new", F.when(F.col("opens"), F.col("n")).otherwise(F.lit(0)).cast("long"))
    numbered = carry.with_carry(
        flagged, keys, {"bin_new": F.sum("new")},
        {"carried_new": lambda spec: F.coalesce(F.sum("bin_new").over(carry.before(spec)), F.lit(0))},
    )
    upto = F.sum("new").over(carry.upto(carry.inside(keys, "s", "e")))
    numbered = numbered.withColumn("last_no", upto + F.col("carried_new"))
    sizes = flagged.groupBy(*keys).agg(F.sum("new").alias("islands"))
    # ids continue from chromosome to chromosome, and inside one from key to key
    by_chrom = sizes.groupBy("k0").agg(F.sum("islands").alias("total"))
    by_chrom = by_chrom.select("k0", F.coalesce(F.sum("total").over(carry.before(W.Window.orderBy("k0"))), F.lit(0)).alias("offset"))
    if len(keys) > 1:
        inner = F.coalesce(F.sum("islands").over(carry.before(W.Window.partitionBy("k0").orderBy(*keys[1:]))), F.lit(0))
        offsets = sizes.withColumn("inner", inner).join(by_chrom, "k0").select(*keys, (F.col("inner") + F.col("offset")).alias("offset"))
    else:
        offsets = by_chrom
    ids = numbered.join(offsets, keys).select(*keys, "s", (F.col("s") >= F.col("e")).alias("empty"), (F.col("last_no") - 1 + F.col("offset")).alias("last_id"), "opens", "n")
    rows = packed.where(whole).withColumn("empty", F.col("s") >= F.col("e"))
    joined = rows.join(ids, [*keys, "s", "empty"])
    # uncovered zero-length intervals at one place have an id each
    copy = F.row_number().over(W.Window.partitionBy(*keys, "s", "empty").orderBy(F.lit(1)))
    lone = joined.where("empty AND opens").withColumn("cluster_id", F.col("last_id") - F.col("n") + copy)
    rest = joined.where("NOT (empty AND opens)").withColumn("cluster_id", F.col("last_id"))
    none = packed.where(f"NOT ({whole})").withColumn("cluster_id", F.lit(None).cast("long"))
    out = rest.select("row", "cluster_id").unionAll(lone.select("row", "cluster_id")).unionAll(none.select("row", "cluster_id"))
    return out.select(*unpack(df.columns, new=["cluster_id"]), "cluster_id")


def complement(df: DataFrame, chrom_sizes: DataFrame | dict[str, int] | None = None, on_cols: Sequence[str] | None = None) -> DataFrame:
    """What the intervals of each key leave free, from 0 on; with ``chrom_sizes`` also up to the chromosome's end.

    ``chrom_sizes`` is a dict or a DataFrame with ``chrom`` and ``size``. A chromosome without intervals gives no rows.
    """
    on_cols, keys = check_on_cols(df, on_cols), key_names(on_cols)
    flagged = islands.flagged_starts(bare(df, on_cols), keys)
    free_from = F.greatest(F.lit(0), F.coalesce("prev_end", F.lit(0)))
    kind = flagged.schema["s"].dataType
    out = flagged.where(F.col("opens") & (F.col("s") > free_from)).select(*keys, free_from.cast(kind).alias("s"), F.col("s").alias("e"))
    if chrom_sizes is not None:
        if isinstance(chrom_sizes, dict):
            chrom_sizes = df.sparkSession.createDataFrame([(k, int(v)) for k, v in chrom_sizes.items()], "chrom string, size long")
        sizes = chrom_sizes.select(F.col("chrom").cast("string").alias("k0"), F.col("size").cast(kind).alias("size")).dropna().groupBy("k0").agg(F.max("size").alias("size"))
        last = flagged.groupBy(*keys).agg(F.greatest(F.lit(0), F.max("e")).cast(kind).alias("s")).join(sizes, "k0").where("s < size")
        out = out.unionAll(last.select(*keys, "s", F.col("size").alias("e")))
    return _named(out, on_cols)


def _segments(df: DataFrame, on_cols: list[str]) -> DataFrame:
    keys = key_names(on_cols)
    steps = bare(df, on_cols).select(*keys, F.explode(F.array(F.struct(F.col("s").alias("pos"), F.lit(1).alias("d")), F.struct(F.col("e").alias("pos"), F.lit(-1).alias("d")))).alias("x"))
    # places whose steps cancel out stay: a segment ends at every endpoint
    steps = steps.groupBy(*keys, F.col("x.pos").alias("pos")).agg(F.sum("x.d").alias("d"))
    steps = carry.with_bin(steps, "pos")
    steps = carry.with_carry(
        steps, keys, {"bin_d": F.sum("d"), "bin_pos": F.min("pos")},
        {
            "carried_d": lambda spec: F.coalesce(F.sum("bin_d").over(carry.before(spec)), F.lit(0)),
            "next_pos": lambda spec: F.lead("bin_pos").over(spec),
        },
    )
    spec = carry.inside(keys, "pos")
    depth = F.sum("d").over(carry.upto(spec)) + F.col("carried_d")
    end = F.coalesce(F.lead("pos").over(spec), F.col("next_pos"))
    return steps.select(*keys, F.col("pos").alias("s"), end.alias("e"), depth.alias("depth")).where("depth > 0")


def coverage(df: DataFrame, on_cols: Sequence[str] | None = None) -> DataFrame:
    """``chrom, start, end, on_cols..., depth`` between every two neighbouring endpoints that some interval covers.

    Neighbouring segments of equal depth stay apart; depth 0 is not reported.
    """
    on_cols = check_on_cols(df, on_cols)
    return _named(_segments(df, on_cols), on_cols, "depth")


def disjoin(df: DataFrame, on_cols: Sequence[str] | None = None) -> DataFrame:
    """The elementary segments between neighbouring endpoints that some interval covers."""
    on_cols = check_on_cols(df, on_cols)
    return _named(_segments(df, on_cols), on_cols)
