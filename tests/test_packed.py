"""Packed fields: the cheapest dialect against a plain machine that follows the rules character by character."""

import random
import re
from collections import Counter

import pytest

from genomeframe.operators import packed as P

VALUE = "_-:.*'<>[]"


def plain(text):
    """Places by the written rules, one character at a time."""
    t, i, places = text.strip(" "), 0, []
    is_value = lambda c: c.isalnum() or c in VALUE
    while True:
        value = None
        if i < len(t) and t[i] in "\"'":
            q, j, kept, closed = t[i], i + 1, [], False
            while j < len(t):
                if t[j] == q and t[j : j + 2] == q + q:
                    kept.append(q)
                    j += 2
                elif t[j] == q:
                    closed = True
                    break
                else:
                    kept.append(t[j])
                    j += 1
            if closed:
                value, quoted, i = "".join(kept), True, j + 1
        if value is None:
            j = i
            while j < len(t) and (is_value(t[j]) or t[j] == "<"):
                j = t.index(">", j) + 1 if t[j] == "<" and ">" in t[j:] else j + 1
            value, quoted, i = t[i:j], False, j
        places.append((value, quoted))
        if i >= len(t):
            break
        j = i
        while j < len(t) and t[j] == " ":
            j += 1
        if j < len(t) and not is_value(t[j]) and t[j] != '"':
            j += 1
            while j < len(t) and t[j] == " ":
                j += 1
        i = j
    return [(k, v) for k, (v, q) in enumerate(places, 1) if q or v not in ("", ".")]


def fields(seed, n):
    """Fields in one manner each, at times in two."""
    r = random.Random(seed)
    item = lambda: r.choice([f"lv{r.randrange(10**r.randrange(2, 7))}", f"hp{r.choice('35')}'utr_{r.randrange(999)}", f"kx_{r.randrange(999)}.1", "<INS:ME,B2>", "<A B>", "*", "]chr1:55]T", "Ünö9", "."])
    inner = lambda: r.choice(["see 1; 2", "9,5", 'tag "x" old', "a|b", "lot (no. 3)", "plain", "it's"])
    out = []
    for _ in range(n):
        sep = r.choice([",", ";", "|", "/", "&", "\t", " ", ", ", " / ", " ;", ";;"])
        parts = []
        for _ in range(r.choice([1, 1, 2, 3, 6])):
            x = r.random()
            if x < 0.15:
                q = r.choice("\"'")
                parts.append(q + inner().replace(q, q + q) + q)
            else:
                parts.append(item() if x < 0.95 else "")
        text = sep.join(parts)
        if r.random() < 0.1:
            text += r.choice([",", " | ", "\t"]) + item()
        out.append(text)
    return out


def learn(texts):
    counts, plain_field = Counter(), re.compile(P.PLAIN.replace(r"\p{L}\p{N}_", r"\w").replace(r"\z", r"\Z"))
    for t in texts:
        if plain_field.match(t):
            counts["f", "b0", P.symbol(t[0])] += 1
            counts.update(("f", "b1", P.symbol(c)) for c in t[1:])
            counts["f", "b1", "end"] += 1
        else:
            counts.update(("f", "raw", P.symbol(c)) for c in set(t))
            counts["f", "raw", "end"] += 1
            P.count_field(t, "f", counts)
    return P.Code([(*k, n) for k, n in counts.items()])


def values(places):
    return [(k, v) for k, (v, _, q) in enumerate(places, 1) if q or v not in ("", ".")]


@pytest.mark.parametrize(("seed", "n"), [(1, 2000), (2, 60), (3, 400)])
def test_shortest_parse_follows_the_rules(seed, n):
    texts = fields(seed, n)
    code = learn(texts)
    wrong = [t for t in texts if values(P.choose("f", t, code)[1]) != plain(t)]
    assert wrong == []


def test_learned_lengths_decide():
    """The same fields under a code in which all symbols are equally long: the split then no longer follows the rules."""
    texts = fields(5, 600)
    learned, flat = learn(texts), P.Code.flat(["f"])
    wrong = lambda code: sum(values(P.choose("f", t, code)[1]) != plain(t) for t in texts)
    assert wrong(learned) == 0 and wrong(flat) > 30
    assert values(P.choose("f", "lv1;lv2,lv3", flat)[1]) != plain("lv1;lv2,lv3")
    # what a table's values hold decides: where ids have a plus sign in them, it is no separator
    sums = P.Code([("f", "b0", "letter", 9000), ("f", "b1", "+", 9000), ("f", "b1", "end", 9000), ("f", "raw", "a", 50), ("f", "sep", ",", 50)])
    assert P.choose("f", "a+b,a+c", sums)[1] == [("a+b", ",", ""), ("a+c", "", "")]


def test_named_cases():
    places = lambda t: [(v, bool(q)) for v, _, q in P.parse(t, *P.candidates(t)[-1])]
    assert places('"tag ""5064"" old";;.') == [('tag "5064" old', True), ("", False), (".", False)]
    assert places("hp5'utr_1, 'x, y'") == [("hp5'utr_1", False), ("x, y", True)]
    assert places(" A  B ,C") == [("A", False), ("B", False), ("C", False)]
    assert places("<INS:ME,B2>;G") == [("<INS:ME,B2>", False), ("G", False)]
    assert P.parse("a;b,c", ";", "") == [("a", ";", ""), ("b,c", "", "")]


def test_table(spark):
    texts = [*fields(9, 150), "", "   ", None, "A" * 30000 + "," + "B" * 30000, '"open', "a,a", "a,a", "line\n"]
    rows = [(i if i else None, t, None, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "variant_id long, id string, alt string, dialect string")
    out = P.split_packed(df, "variant_id", ["id", "alt"]).collect()
    got = {}
    for r in out:
        got.setdefault(r["variant_id"] or 0, []).append((r["value_pos"], r["value_text"]))
        assert r["field_name"] == "id"
    for i, t in enumerate(texts):
        if t != '"open':
            assert sorted(got.get(i, [])) == (sorted(plain(t)) if t else []), t
    assert all(r["n_values"] == len(got[r["variant_id"] or 0]) for r in out)
    assert P.split_packed(df.limit(0), "variant_id", ["id", "alt"]).collect() == []


@pytest.mark.parametrize("unit", ["a", " ", "a,", '"', "'", "<", "<a", "a b ", '",', ";;", "(", ", "])
def test_work_is_linear(unit):
    import time

    code, took = learn(["a,b", "'x;y'"]), []
    for n in (5_000, 20_000):
        text, began = "a," + unit * n + "b", time.process_time()
        for d in P.candidates(text):
            code.cost("f", P.parse(text, *d))
        took.append(time.process_time() - began)
    assert took[1] < 10 * max(took[0], 0.1)
