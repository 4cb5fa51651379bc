"""Documents of varying length put together into containers of fixed capacity.

Method: shortest-pack-first over the histogram of lengths. Lengths are placed longest first, all documents of a length at
once: they go to the packs that are shortest so far, if they fit there, else to new packs. A *pattern* is a list of lengths
and the number of packs that have it; placing a length changes counts of patterns only, so the work depends on the number
of distinct lengths, at most the capacity, not on the number of documents. The driver holds the histogram and the
patterns (at most two patterns per length placed), never documents.

Documents then join their places by rank: the documents of one length are ranked in random order, and the slots for that
length in the patterns take the ranks one after the other.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, spread
from .prefix import bits_for, random_key, with_running
from .tokens import DEFAULT_VOCABULARY, with_token_count


@dataclass
class Pattern:
    """``count`` containers that hold these lengths (the longest first)."""

    lengths: tuple[tuple[int, int], ...]  # (length, how often)
    used: int
    count: int


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns for ``{length: number of items}``; lengths must be from 1 to the capacity.

    An item joins the shortest pack; if that has no room for it, no other has, and a new pack is begun. Several items of one
    length join a pack together, as many as fit or are left for each pack.
    """
    packs: list[tuple[int, int, Pattern]] = []  # by used space
    serial = 0

    def push(p: Pattern) -> None:
        nonlocal serial
        heapq.heappush(packs, (p.used, serial, p))
        serial += 1

    done = []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if not 1 <= length <= capacity:
            raise ValueError(f"length {length} is not from 1 to {capacity}")
        while left:
            if packs and packs[0][0] + length <= capacity:
                _, _, p = heapq.heappop(packs)
                fit = 1
            else:
                p, fit = Pattern((), 0, left // max(1, capacity // length) or 1), capacity // length
            each = min(fit, left // p.count if left >= p.count else 1) if fit > 1 else 1
            n = min(p.count, left // each)
            if n < p.count and p.used:
                push(Pattern(p.lengths, p.used, p.count - n))
            lengths = list(p.lengths)
            if lengths and lengths[-1][0] == length:
                lengths[-1] = (length, lengths[-1][1] + each)
            else:
                lengths.append((length, each))
            q = Pattern(tuple(lengths), p.used + each * length, n)
            left -= n * each
            (done.append if q.used == capacity else push)(q)
    return done + [p for _, _, p in sorted(packs, key=lambda x: x[:2])]


def slots(patterns: Sequence[Pattern]) -> pd.DataFrame:
    """One row per pattern and length in it: the items of ``length`` from rank ``low`` on go to containers from ``first`` on.

    The first ``count`` of them take place ``place`` in one container each, the next ``count`` the place behind it, and so on.
    """
    taken: dict[int, int] = {}
    rows, first = [], 0
    for p in patterns:
        place = 0
        for length, times in p.lengths:
            low = taken.get(length, 0)
            rows.append((length, low, p.count, times, first, place))
            taken[length] = low + p.count * times
            place += times
        first += p.count
    return pd.DataFrame(rows, columns=["length", "low", "count", "times", "first", "place"], dtype="int64")


class Plan:
    """Where the items of one kind of container go: item r of a length stands at ``base[length] + r`` on one line of all slots."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        table = slots(pack_histogram(histogram, capacity)).sort_values(["length", "low"], ignore_index=True)
        length, low, self.count, times, self.first, self.place = (table[c].to_numpy() for c in table.columns)
        self.begin = np.append(0, np.cumsum(self.count * times))[:-1].astype(np.int64)
        self.base = np.zeros(capacity + 1, np.int64)
        opening = np.flatnonzero(low == 0)
        self.base[length[opening]] = self.begin[opening]

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(container, place in it) of items."""
        at = self.base[length] + rank
        i = np.searchsorted(self.begin, at, "right") - 1
        return self.first[i] + (at - self.begin[i]) % self.count[i], (self.place[i] + (at - self.begin[i]) // self.count[i]).astype(np.int32)


def _pieces(docs: DataFrame, containers: dict[str, int]) -> DataFrame:
    """``kind, doc_id, piece_no, piece_start, n_tokens``: documents longer than a capacity cut into full pieces and a rest."""
    kinds = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(c).cast("long").alias("capacity")) for k, c in containers.items())))
    long = docs.select("doc_id", "n_tokens", kinds.alias("x")).select("doc_id", "n_tokens", "x.*").where("n_tokens > capacity")
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_tokens") - 1, F.col("capacity")))
    long = long.withColumn("piece_start", start)
    return long.select(
        "kind", "doc_id", (F.col("piece_start") / F.col("capacity")).cast("int").alias("piece_no"), "piece_start",
        F.least(F.col("n_tokens") - F.col("piece_start"), F.col("capacity")).alias("n_tokens"),
    )


def pack_sized(docs: DataFrame, containers: dict[str, int], seed: int = 0) -> DataFrame:
    """Pack ``doc_id, n_tokens`` (read several times, see ``cut``) into containers of each capacity.

    Documents are ranked once among those of their length, for all capacities; in each length the pieces of longer documents
    come behind them.
    """
    largest = max(containers.values())
    pieces = _pieces(docs, containers)
    # at most as many rows as the largest capacity, and as all capacities together
    whole = {r["n_tokens"]: r["n"] for r in docs.where(f"n_tokens BETWEEN 1 AND {largest}").groupBy("n_tokens").agg(F.count("*").alias("n")).collect()}
    rest = {(r["kind"], r["n_tokens"]): r["n"] for r in pieces.groupBy("kind", "n_tokens").agg(F.count("*").alias("n")).collect()}
    plans = {}
    for kind, capacity in containers.items():
        histogram = {n: c for n, c in whole.items() if n <= capacity}
        for (k, n), c in rest.items():
            if k == kind:
                histogram[n] = histogram.get(n, 0) + c
        plans[kind] = Plan(histogram, capacity)
    shared = docs.sparkSession.sparkContext.broadcast((plans, whole))
    # equal documents may change places: what comes out is the same
    ranked = docs.where(f"n_tokens BETWEEN 1 AND {largest}").withColumn("key", random_key(seed, "doc_id", "n_tokens"))
    ranked = with_running(ranked, ["n_tokens"], "key", {"rank": "1"}, bits_for(sum(whole.values())), ties=["doc_id"])
    cuts = pieces.withColumn("key", random_key(seed, "doc_id", "piece_no"))
    cuts = with_running(cuts, ["kind", "n_tokens"], "key", {"rank": "1"}, bits_for(sum(rest.values())), ties=["doc_id", "piece_no"])
    columns = ["kind", "doc_id", "piece_no", "piece_start", "n_tokens"]

    def place_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plans, whole = shared.value
        for pdf in batches:
            for kind, plan in plans.items():
                is_piece = pdf["kind"].notna()
                own = pdf[(pdf["kind"] == kind) | (~is_piece & (pdf["n_tokens"] <= containers[kind]))]
                if not len(own):
                    continue
                length = own["n_tokens"].to_numpy(np.int64)
                behind = own["n_tokens"].map(whole).fillna(0).to_numpy(np.int64) * own["kind"].notna().to_numpy()
                container, place = plan.places(length, own["rank"].to_numpy(np.int64) + behind)
                yield own[columns].assign(kind=kind, container_id=container, place=place)

    docs_in = ranked.select(F.lit(None).cast("string").alias("kind"), F.col("doc_id").cast("string"), F.lit(0).alias("piece_no"), F.lit(0).cast("long").alias("piece_start"), "n_tokens", "rank")
    cuts_in = cuts.select("kind", F.col("doc_id").cast("string"), "piece_no", "piece_start", "n_tokens", "rank")
    out = docs_in.unionAll(cuts_in).mapInPandas(place_all, "kind string, doc_id string, piece_no int, piece_start long, n_tokens long, container_id long, place int")
    doc_id = F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id")
    return out.select(F.col("kind").alias("container_kind"), "container_id", "place", doc_id, "piece_no", "piece_start", "n_tokens")


def pack(df: DataFrame, containers: dict[str, int], id_col: str = "doc_id", text_col: str = "text", vocabulary: str = DEFAULT_VOCABULARY, seed: int = 0) -> DataFrame:
    """``container_kind, container_id, place, doc_id, piece_no, piece_start, n_tokens`` for each capacity.

    Every document is in the containers of each kind, whole unless it alone exceeds the capacity; then its pieces (from token
    ``piece_start`` on) are full but for the last. Documents without tokens (null or empty text) need no container: they
    come out with a null ``container_id`` and ``place``, and 0 tokens. Repeated rows are packed each. The order among documents
    of one length is that of a hash of the document, so the result is the same on any cluster and for any split of the input.
    """
    for kind, capacity in containers.items():
        if capacity < 1:
            raise ValueError(f"the capacity of {kind} must be positive")
    docs = cut(with_token_count(spread(df.select(id_col, text_col)), text_col, {"doc_id": id_col}, vocabulary))
    kinds = F.explode(F.array(*map(F.lit, containers)))
    empty = docs.where("n_tokens = 0").select(
        kinds.alias("container_kind"), F.lit(None).cast("long").alias("container_id"), F.lit(None).cast("int").alias("place"),
        "doc_id", F.lit(0).alias("piece_no"), F.lit(0).cast("long").alias("piece_start"), "n_tokens",
    )
    return pack_sized(docs, containers, seed).unionAll(empty)


def fill(packed: DataFrame, containers: dict[str, int]) -> DataFrame:
    """Per kind: containers used, tokens, fill, and the fewest containers that could hold the tokens."""
    capacity = F.create_map(*(F.lit(x) for kv in containers.items() for x in kv))
    per = packed.where("container_id IS NOT NULL").groupBy("container_kind", "container_id").agg(F.sum("n_tokens").alias("used"), F.count("*").alias("items"))
    per = per.withColumn("capacity", capacity[F.col("container_kind")].cast("long"))
    out = per.groupBy("container_kind", "capacity").agg(
        F.count("*").alias("n_containers"), F.sum("used").alias("n_tokens"), F.sum("items").alias("n_items"), F.max("used").alias("fullest"),
    )
    return out.withColumns({
        "fill": F.col("n_tokens") / (F.col("n_containers") * F.col("capacity")),
        "fewest_possible": F.ceil(F.col("n_tokens") / F.col("capacity")).cast("long"),
    })
