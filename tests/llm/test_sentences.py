"""Sentences: hand-made cases in many scripts, and properties that hold for any text."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from genomeframe.llm import sentences as S

# word statistics as a corpus would give them
WORDS = S.Words(
    {"etc": (60, 200), "approx": (0, 90), "min": (20, 90), "u.s": (40, 120), "waited..": (30, 30), "well..": (0, 30), "done": (80, 85), "first": (90, 92), "in": (0, 60)},
    {"honestly": (90, 92), "the": (60, 300), "and": (1, 400), "my": (50, 300), "it": (60, 250), "i": (90, 250), "with": (1, 90), "without": (0, 80)},
)

# | marks where a sentence ends
CASES = [
    "It works.| It was made in the U.S. and packed here.| Made in the U.S.| Honestly, fine.",
    "Dr. Velm paid approx. 13.50 for it.| A.J. Velm said no.| No. 5 is fine.",
    "It broke (after 5 days!) and nobody cared.| (The knob is sold apart.)| Fine",
    'The label reads: "Do not wash. Do not iron."| I keep it.| Is it "new"?| Yes!!',
    "“bent!” was all he wrote.| Next one.",
    "I waited and waited...| My wife too.| Well... it works, more or less.| So ... my son fixed it.",
    "See www.shop.example/a.html and read.me.txt first.| Done. 😀| Next 👍👍",
    "One line\nbreak stays.|\n\nBlank line ends|\n \nAgain",
    "1. First point.| 2. Second point here!| 3. Third.",
    "On day 13.| The rest came.",
    "it came first.| honestly, i am glad.| we paid approx. 5 euros etc. without trouble.",
    "Am 20. Juni kam er, z. B. für den Garten, ca. 5 Std. später.| Gut.",
    "„Ist er leise?“, fragte sie.| »Nie wieder«, sagte er.| Auf dem Zettel steht: „Nicht waschen. Nicht bügeln.“| Gut so.",
    "¿Lo compraría otra vez?| ¡Sí!| Mi hermana dijo: «¡Es ligero!» y se lo quedó.| El Sr. Velm no.",
    "C'est parfait !| Ma fille a écrit : « Plus jamais. » et c'est tout.| M. Velm, p. ex., dit non.",
    "Магазин на ул. Полевая, д. 23.| «Больше никогда!» — сказала сестра.| Нет.",
    "充电只要39.63小时，好用。|妈妈说：“真不错！”然后就收下了。|（电池要另买。）|很满意!|和No.45相比，很好.|等啊等……终于到了。|真的吗？！|好",
    "同僚は「軽い！」と喜んでいました。|サイズは2.9cmです．|まあ…使えます。|「もう買わない。」と言いました。",
    'यह अच्छा है।| डॉ. Velm ने कहा, "यह हल्की है।" और रख ली।| 81 रु. में ठीक है ।| नहीं',
    "هل أشتريها مرة أخرى؟| قالت أمي: «إنها خفيفة!» واحتفظت بها.| كما قال د. Velm، جيدة…| لا.",
    "What a mess!No space here.| One more",
]
CASES[-1] = "What a mess!|No space here.| One more.|Nothing else"


@pytest.mark.parametrize("case", CASES)
def test_cases(case):
    text, want, at = case.replace("|", ""), [], 0
    for part in case.split("|"):
        stripped = part.strip()
        start = at + part.index(stripped)
        want.append(text[start : start + len(stripped)])
        at += len(part)
    assert [text[a:b] for a, b in S.split_text(text, WORDS)] == want


def properties(text):
    spans, at = S.split_text(text, WORDS), 0
    for a, b in spans:
        assert a < b and text[at:a].strip() == "" and text[a:b] == text[a:b].strip()
        at = b
    assert text[at:].strip() == ""
    for a, b in S.paragraphs(text):
        assert a in {x for x, _ in spans} and b in {y for _, y in spans}


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("aA b1.!?…。」「\"“”«»()（）'\n\r\t  😀❤️ไทๆ,:-é،؟।"), max_size=60))
def test_any_text_is_covered(text):
    properties(text)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=40))
def test_any_characters(text):
    properties(text)


def test_a_bracket_or_quotation_with_many_marks_is_kept():
    for inner in ("a! " * 60, "a! " * 400):
        text = f"He said (and {inner}so on) to all. Next."
        assert [text[a:b] for a, b in S.split_text(text, WORDS)] == [text[:-6], "Next."]


def test_long_text():
    text = "This is one of many sentences. " * 3000
    assert len(S.split_text(text, WORDS)) == 3000
    properties("x" * 100000)
    properties("(" * 300 + "a. B" * 300)


@pytest.mark.parametrize("unit", ["a.b", "a. (", ") ", "“A! ", "了", "了。", "! ", "x", "1. ", "😀", ".", "a.B ", "\n"])
def test_work_is_linear(unit):
    import time
    from collections import Counter

    took = []
    for n in (2_000, 8_000):
        text, began = unit * n, time.process_time()
        S.split_text(text, WORDS)
        S._count(text, Counter(), Counter(), Counter())
        took.append(time.process_time() - began)
    assert took[1] < 10 * max(took[0], 0.1)


def test_table(spark):
    rows = [(1, "One. Two! 😀 Three", 5), (1, "One. Two! 😀 Three", 5), (2, None, 5), (3, "", 5), (4, " \n\n ", 5), (None, "Four.", 5), (2**62 + 1, "Five.", 5), (6, "Fünf 𝔘 neu. Sechs.", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sent_start int")
    out = sorted(((r["doc_id"] or 0, r["sent_start"], r["sent_end"]) for r in S.sentences(df).collect()))
    assert out == [(0, 0, 5), *sorted([(1, 0, 4), (1, 5, 11), (1, 12, 17)] * 2), (6, 0, 11), (6, 12, 18), (2**62 + 1, 0, 5)]
    assert S.sentences(df.limit(0)).collect() == []


def test_statistics_count_all_rows(spark):
    rows = [(i, "It took 5 min. and broke. The lid is fine, with a new seam. It took 6 min. The end.") for i in range(40)]
    w = S.word_statistics(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert w.close["min"] == pytest.approx(0.0) and w.close["broke"] > 3 and w.opening["with"] < -3 and w.opening["it"] > 2
