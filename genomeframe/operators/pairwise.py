"""Operators on two sets of intervals: overlap, nearest, count_overlaps, subtract.

Two intervals overlap when they have the same chromosome and ``on_cols`` and ``a.start < b.end AND b.start < a.end``.

*Pairs* come from an equi-join on bins whose width grows with the interval: one of width w lies in at most two bins of its
own level, and is listed under at most two bins of every coarser level that the other side has. A pair counts at the
coarser of its two levels, in its first common bin there, so no shuffle for duplicates is needed and an interval as long as
a chromosome makes a few rows.

*Counts, semi and anti joins* never form pairs: the number of hits is the number of starts before an interval's end less the
number of ends up to its start, two running sums of one sweep, carried from bin to bin (``carry``). The sweep sees each
distinct interval once, without the rest of its row; rows join their count by their coordinates, the hottest
ones salted.

*Nearest* takes the neighbours on either side from one sweep over distinct intervals, and the best overlapping target from
pairs of distinct intervals that are reduced where they arise; rows and targets are joined at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..roles import check_on_cols, complete, key_names, pack, unpack
from . import carry

#: Width of the narrowest bins; a power of two. Each level's bins are 2 ** LEVEL_BITS times as wide as the one before.
DEFAULT_BIN_WIDTH = 1024
LEVEL_BITS = 3


#: A key of rows is hot if it has more rows than HOT_ROWS; the HOT_GROUPS largest of these are salted, so the list that is broadcast
#: has a fixed bound, and any other key has less than one row in HOT_GROUPS.
HOT_ROWS, HOT_GROUPS, MOST_SALTS = 5_000, 1_000, 4_096


def suggest_bin_width(*frames: DataFrame, share: float = 0.5) -> int:
    """The power of two above the given quantile of all widths, from one aggregation of two columns (an action)."""
    widths = [complete(pack(f), ["k0"]).select((F.col("e") - F.col("s")).cast("long").alias("w")) for f in frames]
    union = widths[0]
    for w in widths[1:]:
        union = union.unionAll(w)
    w = union.agg(F.percentile_approx("w", share).alias("w")).first()["w"]
    return 1 << max(6, int(w or 1).bit_length())


def _shifts(width: int, kind: T.DataType) -> list[int]:
    """Bits of the bins of each level."""
    most = 31 if isinstance(kind, T.IntegerType) else 62
    return [*range(max(0, width - 1).bit_length(), most, LEVEL_BITS), most]


def _with_level(packed: DataFrame, shifts: Sequence[int]) -> DataFrame:
    """Add ``own``, the bits of the narrowest bins that are at least as wide as the interval."""
    w = F.col("e").cast("long") - F.col("s").cast("long")
    steps = [F.when(w > F.lit(1 << b).cast("long"), LEVEL_BITS).otherwise(0) for b in shifts[:-1]]
    own = F.lit(shifts[0])
    for step in steps:
        own = own + step
    return packed.withColumn("own", F.least(own, F.lit(shifts[-1])))


def _binned(packed: DataFrame, other: DataFrame, shifts: Sequence[int]) -> DataFrame:
    """One row per level and bin: the interval's own level and all coarser ones that ``other`` has."""
    if other.isStreaming:
        there = F.array(*map(F.lit, shifts))
    else:
        # at most one number a level
        there = F.coalesce(other.select("own").distinct().agg(F.collect_set("own")).scalar(), F.array().cast("array<int>"))
    rows = packed.withColumn("level", F.explode(F.array_union(F.array("own"), there))).where("level >= own")
    low, high = (F.call_function("shiftright", c.cast("long"), F.col("level")) for c in (F.col("s"), F.greatest(F.col("s"), F.col("e") - 1)))
    return rows.withColumn("bin", F.explode(F.sequence(low, high)))


def _pairs(a: DataFrame, b: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """Overlapping pairs of two packed frames, columns prefixed ``a_`` and ``b_``."""
    kinds = [x.schema[c].dataType for x in (a, b) for c in "se"]
    shifts = _shifts(width, max(kinds, key=lambda k: isinstance(k, T.LongType)))
    a, b = _with_level(complete(a, keys), shifts), _with_level(complete(b, keys), shifts)
    left, right = _binned(a, b, shifts), _binned(b, a, shifts)
    left = left.select(*(F.col(c).alias(f"a_{c}") for c in left.columns))
    right = right.select(*(F.col(c).alias(f"b_{c}") for c in right.columns))
    on = [F.col(f"a_{k}") == F.col(f"b_{k}") for k in [*keys, "level", "bin"]]
    on += [F.col("a_s") < F.col("b_e"), F.col("b_s") < F.col("a_e"), F.col("a_level") == F.greatest("a_own", "b_own")]
    first = F.call_function("shiftright", F.greatest("a_s", "b_s").cast("long"), F.col("a_level"))
    return left.join(right, [*on, F.col("a_bin") == first])


def overlap(a: DataFrame, b: DataFrame, how: str = "join", on_cols: Sequence[str] | None = None, bin_width: int = DEFAULT_BIN_WIDTH) -> DataFrame:
    """``join``: every overlapping pair, a's columns prefixed ``a_``, b's ``b_``. ``semi``: the rows of a with a hit.

    Rows with a null chromosome, key or coordinate match nothing. Repeated rows give repeated pairs.
    """
    if how not in ("join", "semi"):
        raise ValueError("how must be 'join' or 'semi'")
    check_on_cols(a, on_cols), check_on_cols(b, on_cols)
    keys = key_names(on_cols)
    if how == "semi":
        return _counted(complete(pack(a, on_cols), keys), pack(b, on_cols), keys, "hits > 0").select(*unpack(a.columns))
    pairs = _pairs(pack(a, on_cols), pack(b, on_cols), keys, bin_width)
    return pairs.select(*unpack(a.columns, "a_", "a_row"), *unpack(b.columns, "b_", "b_row"))


def _salted_join(rows: DataFrame, values: DataFrame, on: Sequence[str], groups: DataFrame, how: str = "inner") -> DataFrame:
    """``rows JOIN values USING (on)``, where ``groups`` (on, n_rows) tells how many rows have each key.

    Rows of the hottest keys are spread over salts, and these keys' values copied to each salt. Adaptive execution cannot do
    this here, since the values come straight from an aggregation. The list of hot keys is short, so it is broadcast.
    """
    hot = groups.where(f"n_rows > {HOT_ROWS}").orderBy(F.desc("n_rows"), *on).limit(HOT_GROUPS)
    hot = F.broadcast(hot.select(*on, F.least(F.lit(MOST_SALTS), F.ceil(F.col("n_rows") / HOT_ROWS)).cast("int").alias("salts")))
    rows = rows.withColumn("at", F.monotonically_increasing_id()).join(hot, list(on), "left")
    rows = rows.withColumn("salt", F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.col("at"), F.col("salts"))).cast("int")).drop("at", "salts")
    values = values.join(hot, list(on), "left")
    values = values.withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    return rows.join(values, [*on, "salt"], how).drop("salt")


#: Order of events at one position: a row's end is met before the starts there, its start after the ends there; a
#: zero-length row of a does not meet the zero-length rows of b at its place.
_A_END, _B_EDGE, _A_START_EMPTY, _B_EDGE_EMPTY, _A_START = range(5)


def _groups(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct intervals of packed rows with their number ``n_rows``."""
    return rows.groupBy(*keys, "s", "e").agg(F.count("*").alias("n_rows"))


def _events(rows: DataFrame, keys: Sequence[str], points: Sequence[dict[str, Column]], *more: str) -> DataFrame:
    """One row per point of each row."""
    fields = F.array(*(F.struct(*(c.alias(n) for n, c in p.items())) for p in points))
    return rows.select(*keys, *more, F.explode(fields).alias("x")).select(*keys, *more, "x.*")


def _counted(a: DataFrame, b: DataFrame, keys: Sequence[str], keep: str | None = None) -> DataFrame:
    """a's complete packed rows with ``hits``, the number of rows of b that overlap each; only those for which ``keep`` holds."""
    is_empty, one, zero = F.col("s") >= F.col("e"), F.lit(1).cast("long"), F.lit(0).cast("long")
    edges = _events(
        complete(b, keys).select(*keys, "s", "e"), keys,
        [
            {"pos": F.col("s"), "rank": F.lit(_B_EDGE), "begun": one, "over": zero},
            {"pos": F.col("e"), "rank": F.when(is_empty, _B_EDGE_EMPTY).otherwise(_B_EDGE), "begun": zero, "over": one},
        ],
    )
    edges = edges.groupBy(*keys, "pos", "rank").agg(F.sum("begun").alias("begun"), F.sum("over").alias("over"))
    groups = _groups(a, keys)
    probes = _events(
        groups, keys,
        [
            {"pos": F.col("e"), "rank": F.lit(_A_END), "at_end": F.lit(True)},
            {"pos": F.col("s"), "rank": F.when(is_empty, _A_START_EMPTY).otherwise(_A_START), "at_end": F.lit(False)},
        ],
        "s", "e",
    )
    both = carry.with_bin(probes.unionByName(edges, allowMissingColumns=True), "pos")
    total = lambda c: lambda spec: F.coalesce(F.sum(c).over(carry.before(spec)), F.lit(0))
    both = carry.with_carry(
        both, keys, {"bin_begun": F.sum("begun"), "bin_over": F.sum("over")},
        {"carried_begun": total("bin_begun"), "carried_over": total("bin_over")},
    )
    spec = carry.upto(carry.inside(keys, "pos", "rank"))
    seen = lambda c: F.coalesce(F.sum(c).over(spec), F.lit(0)) + F.coalesce(f"carried_{c}", F.lit(0))
    part = F.when(F.col("at_end"), F.col("n_begun")).otherwise(-F.col("n_over"))
    hits = both.withColumns({"n_begun": seen("begun"), "n_over": seen("over")}).where("at_end IS NOT NULL")
    hits = hits.groupBy(*keys, "s", "e").agg(F.sum(part).alias("hits"))
    return _salted_join(a, hits.where(keep) if keep else hits, [*keys, "s", "e"], groups)


def count_overlaps(a: DataFrame, b: DataFrame, on_cols: Sequence[str] | None = None) -> DataFrame:
    """All rows of a with ``count``, 0 where nothing overlaps or a key or coordinate is null.

    An input column named ``count`` comes out as ``count_in``.
    """
    check_on_cols(a, on_cols), check_on_cols(b, on_cols)
    keys, packed = key_names(on_cols), pack(a, on_cols)
    whole = " AND ".join(f"{c} IS NOT NULL" for c in [*keys, "s", "e"])
    counted = _counted(packed.where(whole), pack(b, on_cols), keys).select("row", F.col("hits").cast("long").alias("count"))
    rest = packed.where(f"NOT ({whole})").select("row", F.lit(0).cast("long").alias("count"))
    return counted.unionAll(rest).select(*unpack(a.columns, new=["count"]), "count")


def subtract(a: DataFrame, b: DataFrame, on_cols: Sequence[str] | None = None) -> DataFrame:
    """The rows of a that overlap no row of b, whole. Rows of a with a null key or coordinate are dropped."""
    check_on_cols(a, on_cols), check_on_cols(b, on_cols)
    keys = key_names(on_cols)
    return _counted(complete(pack(a, on_cols), keys), pack(b, on_cols), keys, "hits = 0").select(*unpack(a.columns))


def _half(c: Column) -> Column:
    return F.when(c < 0, -F.shiftright(-c, 1)).otherwise(F.shiftright(c, 1))


def _identified(df: DataFrame, packed: DataFrame, id_col: str | None) -> DataFrame:
    if id_col is None:
        return packed.withColumn("id", F.monotonically_increasing_id())
    return packed.withColumn("id", F.col(f"row.c{df.columns.index(id_col)}").cast("long"))


def _neighbours(groups: DataFrame, targets: DataFrame, keys: Sequence[str], adjacent: bool) -> DataFrame:
    """Distinct queries with ``up`` and ``down``, the structs of the targets next to them on either side."""
    s, e, no = F.col("s").cast("long"), F.col("e").cast("long"), F.col("id")
    edge = lambda c, n, *more: F.struct(c.alias("edge"), n.alias("no"), *more)
    if adjacent:  # neighbours in the order of (start, id)
        points = [{"pos": s, "up": edge(s, no, e.alias("far")), "down": edge(s, no, e.alias("far"))}]
    else:
        none = F.lit(None).cast("struct<edge:bigint,no:bigint>")
        points = [{"pos": e, "up": edge(e, -no), "down": none}, {"pos": s, "up": none, "down": edge(s, no)}]
    known = _events(targets, keys, points)
    # a start at the query's own start does not precede it: there the query is met one position earlier
    places = (s - 1, s) if adjacent else (s, e)
    probes = _events(groups, keys, [{"pos": p, "role": F.lit(i)} for i, p in enumerate(places)], "s", "e")
    both = carry.with_bin(probes.unionByName(known, allowMissingColumns=True), "pos")
    both = carry.with_carry(
        both, keys, {"bin_up": F.max("up"), "bin_down": F.min("down")},
        {"carried_up": lambda spec: F.max("bin_up").over(carry.before(spec))},
        backward={"carried_down": lambda spec: F.min("bin_down").over(carry.before(spec))},
    )
    forth = carry.upto(carry.inside(keys, F.col("pos").asc(), F.col("role").asc_nulls_first()))
    back = carry.upto(carry.inside(keys, F.col("pos").desc(), F.col("role").asc_nulls_first()))
    both = both.withColumns({"up": F.greatest(F.max("up").over(forth), "carried_up"), "down": F.least(F.min("down").over(back), "carried_down")})
    pick = lambda c, role: F.max(F.when(F.col("role") == role, F.col(c))).alias(c)
    return both.where("role IS NOT NULL").groupBy(*keys, "s", "e").agg(pick("up", 0), pick("down", 1))


def nearest(
    query: DataFrame, target: DataFrame, on_cols: Sequence[str] | None = None, candidate: str = "nearest",
    query_id: str | None = None, target_id: str | None = None, bin_width: int = DEFAULT_BIN_WIDTH,
) -> DataFrame:
    """One row per query row with its nearest target: ``a_*, b_*, distance``.

    An overlapping target has distance 0, and the one with the closest midpoint is taken. Otherwise the distance is the
    free space between the two. Ties go to the smaller ``target_id``; without one, to the row that is read first.
    Without a target of the same key, or with a null in the query's key or coordinates, ``b_*`` and ``distance`` are null.

    ``candidate='start_adjacent'`` looks, of the targets that do not overlap, only at the last that starts before the
    query and the first that does not. ``target_id`` must be unique; without it the target must read the same each time.
    ``query_id`` is accepted for symmetry: equal queries have equal answers.
    """
    if candidate not in ("nearest", "start_adjacent"):
        raise ValueError("candidate must be 'nearest' or 'start_adjacent'")
    check_on_cols(query, on_cols), check_on_cols(target, on_cols), check_on_cols(query, [query_id] if query_id else [])
    keys, adjacent = key_names(on_cols), candidate == "start_adjacent"
    a = pack(query, on_cols)
    b = complete(_identified(target, pack(target, on_cols), target_id), keys)
    whole = " AND ".join(f"{c} IS NOT NULL" for c in [*keys, "s", "e"])
    groups = _groups(a.where(whole), keys)
    slim = b.select(*keys, "s", "e", "id")
    found = _neighbours(groups, slim, keys, adjacent)
    # of equal targets only the first can be chosen
    pairs = _pairs(groups.drop("n_rows"), slim.groupBy(*keys, "s", "e").agg(F.min("id").alias("id")), keys, bin_width)
    far = F.abs(_half(F.col("a_s").cast("long") + F.col("a_e")) - _half(F.col("b_s").cast("long") + F.col("b_e")))
    own = [*(F.col(f"a_{k}").alias(k) for k in keys), F.col("a_s").alias("s"), F.col("a_e").alias("e")]
    hits = pairs.groupBy(*own).agg(F.min(F.struct(far.alias("far"), F.col("b_id").alias("no"))).alias("hit"))
    q = found.join(hits, [*keys, "s", "e"], "left")
    s, e = F.col("s").cast("long"), F.col("e").cast("long")
    case = lambda ok, far, no: F.when(ok, F.struct(far.alias("far"), no.alias("no")))
    zero = F.lit(0).cast("long")
    up_edge, up_no = (F.col("up.far"), F.col("up.no")) if adjacent else (F.col("up.edge"), -F.col("up.no"))
    apart = F.least(
        case(F.col("up").isNotNull(), F.greatest(s - up_edge, zero), up_no), case(F.col("down").isNotNull(), F.greatest(F.col("down.edge") - e, zero), F.col("down.no"))
    )
    q = q.select(*keys, "s", "e", "hit", apart.alias("apart"))
    q = q.select(*keys, "s", "e", F.coalesce("hit.no", "apart.no").alias("id"), F.when(F.col("hit").isNotNull(), zero).otherwise(F.col("apart.far")).alias("distance"))
    q = q.where("id IS NOT NULL")
    chosen = q.join(b.select("id", F.col("row").alias("t_row")), "id").drop("id")
    matched = _salted_join(a.where(whole), chosen, [*keys, "s", "e"], groups, "left").select("row", "t_row", "distance")
    none = a.where(f"NOT ({whole})").select("row", F.lit(None).cast(b.schema["row"].dataType).alias("t_row"), F.lit(None).cast("long").alias("distance"))
    out = matched.unionAll(none)
    return out.select(*unpack(query.columns, "a_", new=["distance"]), *unpack(target.columns, "b_", "t_row", new=["distance"]), "distance")
