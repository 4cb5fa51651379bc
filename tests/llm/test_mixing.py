"""Mixing: shares, caps on repeats, and equality with a plain sequential cut."""

from collections import Counter, defaultdict

import pytest

from genomeframe.llm import mixing, prefix


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "abc"[min(2, i % 7 // 3)], 1 + i * 7919 % 23) for i in range(700)] + [(800, None, 9), (801, "a", 0), (802, "c", 5), (802, "c", 5)]
    return spark.createDataFrame(rows, "doc_id long, source string, n_tokens long").coalesce(2)


TARGETS = [
    ("m", "a", 0.2, 1), ("m", "b", 0.3, 2), ("m", "c", 0.5, 9), ("once", "a", 0.9, 1), ("once", "c", 0.1, 1),
    ("gone", "zzz", 0.5, 3), ("gone", "b", 0.5, 1), ("none", "a", 0.0, 5), ("none", "b", 1.0, 0),
]


@pytest.mark.parametrize("total", ["all", "reachable", 1234])
def test_mix(spark, docs, total):
    targets = spark.createDataFrame(TARGETS, "mix_name string, source string, target_share double, max_repeats int")
    rows = docs.withColumn("key", prefix.random_key(0, *mixing.IDENTITY)).collect()
    lines = defaultdict(list)
    for x in rows:
        if x["source"] is not None and x["n_tokens"]:
            lines[x["source"]].append((x["key"], x["doc_id"], x["n_tokens"]))
    have = {s: sum(x[2] for x in v) for s, v in lines.items()}
    want, spent = Counter(), {}
    for mix in {t[0] for t in TARGETS}:
        own = [t for t in TARGETS if t[0] == mix]
        if total == "all":
            size = sum(x["n_tokens"] for x in rows)
        elif total == "reachable":
            size = min((have[s] * r / p for _, s, p, r in own if p > 0 and s in have), default=0)
        else:
            size = total
        for _, s, p, most in own:
            budget, used, sofar = int(p * size + 1e-6), 0, 0
            uses = Counter()
            for epoch in range(most):
                for _, i, n in sorted(lines.get(s, [])):
                    # the middle of the record on a line that goes round and round
                    if 2 * sofar + n <= 2 * budget or budget >= (epoch + 1) * have[s]:
                        uses[i] += 1
                        want[mix, s, i, epoch + 1] += 1
                        used += n
                    sofar += n
            spent[mix, s] = used
    mixed = mixing.mix(docs, targets, total)
    got = Counter((x["mix_name"], x["source"], x["doc_id"], x["epoch"]) for x in mixed.collect())
    assert got == want
    shares = {(x["mix_name"], x["source"]): x for x in mixing.shares(docs, targets, mixed, total).collect()}
    assert set(shares) == {t[:2] for t in TARGETS}
    for k, x in shares.items():
        assert x["tokens_used"] == spent[k] and x["epochs"] <= x["max_repeats"]
        whole = sum(v for (m, _), v in spent.items() if m == k[0])
        assert abs(x["actual_share"] - (spent[k] / whole if whole else 0)) < 1e-12
    assert not shares["gone", "zzz"]["reached"] or total == "reachable" and shares["gone", "zzz"]["budget"] == 0


def test_same_result_however_the_input_is_split(spark, docs):
    targets = spark.createDataFrame(TARGETS, "mix_name string, source string, target_share double, max_repeats int")
    results = [Counter(map(tuple, mixing.mix(docs.repartition(n, "n_tokens"), targets).collect())) for n in (1, 3, 7)]
    assert results[0] == results[1] == results[2]


def test_empty(spark, docs):
    targets = spark.createDataFrame(TARGETS, "mix_name string, source string, target_share double, max_repeats int")
    assert mixing.mix(docs.limit(0), targets).collect() == []
    assert mixing.mix(docs, targets.limit(0)).collect() == []
    assert len(mixing.shares(docs.limit(0), targets, mixing.mix(docs.limit(0), targets)).collect()) == len(TARGETS)


def test_running_sums_over_buckets(spark, monkeypatch):
    rows = [(i % 3 == 0, i, i % 11) for i in range(500)]
    df = spark.createDataFrame(rows, "g boolean, i long, n long").withColumn("key", prefix.random_key(1, "i"))
    for bits, window in ((1, 16), (4, 16), (9, 16), (9, 4), (9, 2)):
        monkeypatch.setattr(prefix, "WINDOW_BITS", window)
        out = prefix.with_running(df, ["g"], "key", {"rank": "1", "before": "n"}, bits).collect()
        for g in (True, False):
            own = sorted((x for x in out if x["g"] == g), key=lambda x: x["key"])
            assert [x["rank"] for x in own] == list(range(len(own)))
            assert [x["before"] for x in own] == [sum(y["n"] for y in own[:k]) for k in range(len(own))]
