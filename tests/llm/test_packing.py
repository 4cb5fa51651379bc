"""Packing: every item once, capacities kept, patterns against brute-force placement."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from genomeframe.llm import packing, tokens


@pytest.mark.parametrize("seed", range(8))
def test_patterns_hold_every_item_once(seed):
    r = random.Random(seed)
    cap = r.choice([1, 7, 64, 256])
    hist = {x: r.randrange(1, 50) for x in r.sample(range(1, cap + 1), min(cap, 40))}
    patterns = packing.pack_histogram(hist, cap)
    held = Counter()
    for p in patterns:
        assert p.count > 0 and p.used == sum(x * n for x, n in p.lengths) <= cap
        for x, n in p.lengths:
            held[x] += n * p.count
    assert held == hist
    assert len(patterns) <= 2 * len(hist) + 1
    # no two packs could be one
    least = sorted(p.used for p in patterns for _ in range(min(p.count, 2)))
    assert len(least) < 2 or least[0] + least[1] > cap


def test_few_packs():
    r = random.Random(0)
    hist = Counter(min(256, int(r.lognormvariate(4, 0.8)) + 1) for _ in range(20000))
    packs = sum(p.count for p in packing.pack_histogram(hist, 256))
    assert packs <= 1.02 * -(-sum(x * n for x, n in hist.items()) // 256)


def test_slots_cover_ranks():
    hist = {3: 11, 5: 4, 8: 2}
    table = packing.slots(packing.pack_histogram(hist, 10))
    for length, n in hist.items():
        own = table[table["length"] == length].sort_values("low")
        ranks = [x for _, t in own.iterrows() for x in range(t["low"], t["low"] + t["count"] * t["times"])]
        assert ranks == list(range(n))


def test_every_place_is_taken_once():
    r = random.Random(3)
    hist = {x: r.randrange(1, 90) for x in range(1, 30)}
    plan = packing.Plan(hist, 64)
    used, taken = Counter(), set()
    for length, n in hist.items():
        container, place = plan.places(np.full(n, length), np.arange(n))
        for c, p in zip(container, place):
            assert (c, p) not in taken
            taken.add((c, p))
            used[c] += length
    assert max(used.values()) <= 64 and sorted(used) == list(range(len(used)))


def test_same_result_however_the_input_is_split(spark):
    r = random.Random(5)
    rows = [(i % 180, "fair words " * r.choice([1, 2, 5, 30])) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    results = [Counter(map(tuple, packing.pack(df.repartition(n, "text"), {"k": 32}).collect())) for n in (1, 3, 7)]
    assert results[0] == results[1] == results[2]


def test_bad_length():
    with pytest.raises(ValueError):
        packing.pack_histogram({9: 1}, 8)


def test_pack(spark):
    r = random.Random(4)
    words = "the filter fixed a quick lid".split()
    rows = [(i, " ".join(r.choice(words) for _ in range(r.choice([1, 2, 5, 30, 90]))), "x") for i in range(150)]
    rows += [(900, None, "x"), (901, "", "x"), (902, "same", "x"), (902, "same", "x"), (903, "word " * 5000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, container_id string")
    kinds = {"small": 16, "large": 64}
    out = packing.pack(df, kinds).collect()
    size = {i: tokens.count_tokens(t) for i, t, _ in rows}
    for kind, cap in kinds.items():
        own = [x for x in out if x["container_kind"] == kind]
        used, placed, pieces = Counter(), set(), defaultdict(list)
        for x in own:
            if x["container_id"] is None:
                assert x["doc_id"] in (900, 901) and x["n_tokens"] == 0
                continue
            used[x["container_id"]] += x["n_tokens"]
            assert (x["container_id"], x["place"]) not in placed
            placed.add((x["container_id"], x["place"]))
            pieces[x["doc_id"]].append((x["piece_start"], x["n_tokens"]))
        assert max(used.values()) <= cap and sorted(used) == list(range(len(used)))
        assert sum(x["container_id"] is None for x in own) == 2
        for i, ps in pieces.items():
            if i == 902:
                assert ps == [(0, size[i])] * 2
                continue
            assert len(ps) == -(-size[i] // cap)
            assert sorted(ps) == [(k * cap, min(cap, size[i] - k * cap)) for k in range(len(ps))]
        assert set(pieces) == {i for i, t, _ in rows if size[i]}
    fill = {x["container_kind"]: x for x in packing.fill(packing.pack(df, kinds), kinds).collect()}
    assert fill["small"]["fullest"] <= 16 and fill["small"]["n_containers"] >= fill["small"]["fewest_possible"]
    assert packing.pack(df.limit(0), kinds).collect() == []
    with pytest.raises(ValueError):
        packing.pack(df, {"none": 0})


def test_counts_equal_the_encoder_on_whole_texts():
    for t in ("To be fair, 3 stars.", "これは良い。", "word " * 9000, "\ud800 lone", "<|endoftext|>", "ดีมากครับ" * 7333, "a" * 100_000, " " * 60_000 + "x"):
        whole = tokens._encoding(tokens.DEFAULT_VOCABULARY).encode_ordinary(t.encode("utf-8", "replace").decode())
        assert tokens.count_tokens(t) == len(whole)
    assert tokens.count_tokens(None) == tokens.count_tokens("") == 0
