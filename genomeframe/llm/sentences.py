"""Sentence boundaries in texts of any script.

Method: semi-Markov dynamic programming. A blank line always ends a sentence. Between blank lines every end mark (and, in a
script that uses none, every space) is a *candidate*; the best way to cut a paragraph into whole spans between candidates
maximises the sum of span scores. A span's score joins

* its closing words: the end mark, and how often the word before it has been seen to close a sentence;
* the opening word of what follows: its case, and how often it has been seen to open a sentence;
* balance: a span that holds half of a quotation or bracket is penalised, and a quotation that closes the span counts
  differently if it opened the span than if it began inside it;
* length: spans without a letter or digit, lone list numbers and very long spans are penalised.

The search goes back from each candidate until no earlier start can still win, since all that a span's start may add is at most
0, or the span is longer than ``SPAN``, the longest that the model knows. The two word statistics come from one pass over all documents (``word_statistics``). Every task gets the table of the
``WORDS`` words of either kind that were counted most often; a word that is not in it counts as unknown.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, spread

#: Size of the table of words that all tasks get, for closing and for opening words each. A word counted less than LEAST times is unknown.
WORDS, LEAST = 200_000, 3
#: No word that a table or list knows is as long as this.
LONGEST_TOKEN = 64
#: The longest span, in code points, that the model joins over a candidate; without candidates in it a span has any length.
SPAN = 2_000
#: Score of a place at which a word list or a mark behind it speaks against a boundary.
AGAINST = -15.0

#: End marks that always end, and marks that depend on what is around them.
STRONG = "!?。！？｡।॥؟۔‼⁇⁈⁉"
WEAK = ".．…‥"
_STRONG, _MARKS = frozenset(STRONG), frozenset(STRONG + WEAK)
OPENERS = "([{（［｛「『【《〈“„«‹¿¡‘"
CLOSERS = ")]}）］｝」』】》〉”»›’"
#: Abbreviations that stand before a name, whatever its case.
TITLES = frozenset(
    "mr mrs ms dr prof st sr sra srta d dª mm mme mlle mgr me hr fr frau herr dott sig ing lic gen col capt lt sgt rev hon "
    "ул пр пер г гр им тов проф акад डॉ श्री प्रो पं د أ".split()
)
#: Abbreviations that stand before a number.
BEFORE_NUMBER = frozenset(
    "no nos nr n p pp pg pág págs s seite fig figs abb abs art bd vol gr kap ch sec eq tab apt dpto ca env aprox approx "
    "c vers ver стр с рис табл гл п № д кв т jan feb mar apr jun jul aug sep sept oct nov dec".split()
)
#: Abbreviations that always go on.
NEVER = frozenset("vgl bzw cf vs e.g i.e d.h z.b c.-à-d p.ex p.ej т.е approx env aprox ca inkl incl resp zzgl".split())
#: Abbreviations that seldom end a sentence, unless a capital or a known opening word follows.
INSIDE = frozenset(
    "e.g i.e vs cf etc esp resp incl inkl ca bzw usw z.b d.h u.a o.ä evtl ggf vgl std min sek str nr ltd inc corp co dept est "
    "p.ex ex c.-à-d env av bd tél ej p.ej ee uu aprox pág núm tel ext т.е т.д т.п и.о тыс млн млрд руб коп шт мин сек ч см рис стр "
    "रु कि.मी कि.ग्रा a.m p.m in ft lb lbs oz approx apt pic fig".split()
)
#: Names of months after which an ordinal's point does not end a sentence (German).
MONTHS = frozenset("januar februar märz april mai juni juli august september oktober november dezember".split())

_EMOJI = "[\U0001f000-\U0001faff☀-➿⬀-⯿️‍⃣\U000e0020-\U000e007f]"
_BLANK = re.compile(r"(?:\r\n|[\n\r ])[^\S\n\r ]*(?:(?:\r\n|[\n\r ])\s*)+| \s*")
_END = re.compile(rf"[{re.escape(STRONG + WEAK)}]+|{_EMOJI}+")
#: The same marks where a text has ASCII characters only, and the words of such a text.
_ASCII_END = re.compile(r"[!?.]+")
_ASCII_WORD = re.compile(r"[a-z]+(?:['\-][a-z]+)*")
_TRAIL = re.compile(rf"[^\S\n]*{_EMOJI}+")
_LETTER_POINT = re.compile(r"(?<![^\W\d_])[^\W\d_]\.\s+\Z")
_INITIALS = re.compile(r"(?:[^\W\d_]\.)+[^\W\d_]")
_WORD = re.compile(r"[^\W\d_]+(?:['’\-][^\W\d_]+)*")
_TOKEN_STOPS = frozenset("\"“”„«»‹›()（）[]「」")
_LIST_NO = re.compile(r"(?:^|[\s])\d{1,3}[.)]\Z")
_QUOTES = {c: k for k, cs in {"g": "«»‹›", "d": "“”„", "s": '"', "c": "「」", "e": "『』"}.items() for c in cs}
_ROUND = {"(": 1, "（": 1, ")": -1, "）": -1}
_ANY_MARK = re.compile("[" + re.escape("".join([*_QUOTES, *_ROUND])) + "]")


def is_cased(c: str) -> bool:
    return c.lower() != c.upper()


#: Letters of Thai, Lao, Burmese and Khmer, which use no end marks, and of all scripts without spaces.
_MARKLESS_LETTERS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff"
_SPACELESS_LETTERS = _MARKLESS_LETTERS + "\u2e80-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
_MARKLESS = re.compile(f"[{_MARKLESS_LETTERS}]")
_SPACELESS = re.compile(f"[{_SPACELESS_LETTERS}]")
_SPACED_WORD = re.compile(rf"[^\W\d_{_SPACELESS_LETTERS}]+(?:['’\-][^\W\d_{_SPACELESS_LETTERS}]+)*")
_OPENING = frozenset(OPENERS + "\"' ")
_TAIL_STOP = re.compile(r"[\s/.@]")
_TAIL_MARKS = STRONG + WEAK + CLOSERS + ",;:\""
_TAIL_END = re.compile(rf"[{re.escape(_TAIL_MARKS)}]+(?=\s|\Z)")
_ALNUM = re.compile(r"[^\W_]")


def spaceless(c: str) -> bool:
    """A letter of a script that puts no spaces between words."""
    return _SPACELESS.match(c) is not None


def markless(c: str) -> bool:
    return _MARKLESS.match(c) is not None


#: 1 for capital and 2 for small letters, by code point; letters behind the table have no case.
_CASE = np.array([1 if c.isupper() else 2 if c.islower() else 0 for c in map(chr, range(0x1E950))] + [0], np.uint8)


def style(text: str) -> str:
    """``mixed`` if case tells something, else ``lower`` or ``upper``; ``none`` for scripts without case."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    _, upper, lower = np.bincount(_CASE[np.minimum(points, len(_CASE) - 1)], minlength=3)
    if upper + lower == 0:
        return "none"
    return "lower" if upper == 0 else "upper" if lower <= upper * 0.05 else "mixed"


def paragraphs(text: str) -> Iterator[tuple[int, int]]:
    """Stretches between blank lines, without white space at either end."""
    at = 0
    for m in [*_BLANK.finditer(text), None]:
        stop = m.start() if m else len(text)
        part = text[at:stop]
        if part.strip():
            yield at + len(part) - len(part.lstrip()), at + len(part.rstrip())
        at = m.end() if m else stop


@dataclass
class Candidate:
    """A place where a sentence may end: what is known of it whatever the span that it would close."""

    end: int
    start_next: int
    score: float
    opener: int = -1
    opener_kind: str = ""
    #: added if the quotation or bracket that closes here opened inside the span
    inside: float = 0.0
    #: added if it opened the span
    opened: float = 0.0


class Words:
    """How often words close and open sentences, as log-odds."""

    def __init__(self, close: dict[str, tuple[int, int]], opening: dict[str, tuple[int, int]]):
        odds = lambda a, n: max(-5.0, min(5.0, math.log((a + 0.5) / (n - a + 0.5))))
        self.close = {k: odds(*v) for k, v in close.items()}
        self.opening = {k: odds(*v) for k, v in opening.items()}


def _token_before(text: str, start: int, at: int) -> str:
    """What stands before ``at`` without a space, quotation mark or bracket in it; of what is longer than any word the end."""
    start = max(start, at - LONGEST_TOKEN)
    near = text[max(start, at - 24) : at].rsplit(None, 1)
    if near and near[-1].isalnum() and len(near[-1]) < 24 and not text[at - 1].isspace():
        return near[-1]
    low = at
    while low > start and text[low - 1] not in _TOKEN_STOPS and not text[low - 1].isspace():
        low -= 1
    return text[low:at].lstrip("¿¡'‘")


def _next_letter(text: str, at: int, stop: int) -> int:
    """Index of the first character of what follows that is no space or opening mark."""
    while at < stop and (text[at].isspace() or text[at] in OPENERS or text[at] in "\"'*-–—"):
        at += 1
    return at


def _key(token: str, dots: str) -> str:
    return token.casefold().strip("'’") + (".." if len(dots) > 1 or dots in "…‥" else "")


class Paragraph:
    """Candidates of one paragraph and the best way to cut it."""

    def __init__(self, text: str, start: int, stop: int, kind: str, words: Words):
        self.text, self.start, self.stop, self.kind, self.words = text, start, stop, kind, words
        self.marks: dict[str, list[int]] = {}
        self.round: list[int] = []
        self.depth = [0]
        #: matching brackets, either way
        self.partner: dict[int, int] = {}
        opened: list[int] = []
        for m in _ANY_MARK.finditer(text, start, stop):
            c, p = m.group(), m.start()
            if c in _ROUND:
                self.round.append(p)
                self.depth.append(self.depth[-1] + _ROUND[c])
                if _ROUND[c] > 0:
                    opened.append(p)
                elif opened:
                    q = opened.pop()
                    self.partner[p], self.partner[q] = q, p
            else:
                self.marks.setdefault(_QUOTES[c], []).append(p)
        self.candidates = self.find()

    def odd(self, kind: str, at: int) -> bool:
        """A quotation of this kind is open before ``at``."""
        return bisect_left(self.marks.get(kind, ()), at) % 2 == 1

    def closing(self, at: int) -> tuple[int, int, str]:
        """(end, opener, kind) of the closing marks from ``at`` on."""
        text, opener, kind = self.text, -1, ""
        while at < self.stop:
            c, p = text[at], at
            if c in "   " and at + 1 < self.stop and text[at + 1] in "»«" and self.odd("g", at + 1):
                p, c = at + 1, text[at + 1]  # a space inside the marks
            if c in _QUOTES and self.odd(_QUOTES[c], p):
                marks = self.marks[_QUOTES[c]]
                opener, kind = marks[bisect_left(marks, p) - 1], "quote"
            elif c in ")）":
                if p in self.partner:
                    opener, kind = self.partner[p], "bracket"
            elif c not in CLOSERS or c in _QUOTES:
                break
            at = p + 1
        return at, opener, kind

    def find(self) -> list[Candidate]:
        out, text, stop = [], self.text, self.stop
        plain = text.isascii()
        for m in (_ASCII_END if plain else _END).finditer(text, self.start, stop):
            if out and m.start() < out[-1].end:
                continue
            marks, end = m.group(), m.end()
            emoji = marks[0] not in _MARKS
            if end >= stop:
                break
            opener, kind, nxt = -1, "", end
            if text[end] != " " or end + 1 >= stop or not text[end + 1].isalnum():  # else a space and a word follow
                end, opener, kind = self.closing(end)
                if end < stop and text[end] in _MARKS:
                    continue  # the cluster goes on behind the closing mark
                while not plain and (t := _TRAIL.match(text, end, stop)):
                    end = t.end()
                if end >= stop:
                    break
                nxt = end
            while text[nxt].isspace():
                nxt += 1
            c = self.judge(m.start(), marks, m.end(), end, nxt, opener, kind, emoji, out)
            if c is not None:
                out.append(c)
        if not plain and _MARKLESS.search(text, self.start, stop):
            out += self.spaces()
            out.sort(key=lambda c: c.end)
        return out

    def spaces(self) -> Iterator[Candidate]:
        """Spaces between two stretches of a script without end marks."""
        text = self.text
        taken = {c.start_next for c in self.candidates} if hasattr(self, "candidates") else set()
        for m in re.finditer(r"[^\S\n]+", text[self.start : self.stop]):
            p, q = self.start + m.start(), self.start + m.end()
            if p > self.start and q < self.stop and q not in taken and markless(text[p - 1]) and markless(text[q]) and text[p - 1] != "ๆ" and text[q] != "ๆ":
                yield Candidate(p, q, 0.8)

    def judge(self, at: int, marks: str, mark_end: int, end: int, nxt: int, opener: int, kind: str, emoji: bool, out: list[Candidate]) -> Candidate | None:
        text, words = self.text, self.words
        adjacent = nxt == end
        follow = _next_letter(text, nxt, self.stop)
        c = text[follow] if follow < self.stop else ""
        strong = marks[0] in _STRONG or any(x in _STRONG for x in marks)
        word = _WORD.match(text, follow, self.stop) if c.isalpha() and (c < "\u0e00" or not spaceless(c)) else None
        opening = words.opening.get(word.group().casefold(), -1.0) if word else 0.0
        cased_style = self.kind == "mixed"
        token = "" if strong or emoji else _token_before(text, self.start, at)
        dots = marks if not strong else ""
        key = _key(token, dots)
        ellipsis = key.endswith("..") and not strong
        before = text[at - 1] if at > self.start else ""
        if emoji:
            score = 1.0
        elif strong:
            score = 4.0
        else:
            plain = key[:-2] if ellipsis else key
            if not ellipsis and adjacent and not (spaceless(c) or spaceless(before)) and end == mark_end:
                return self.unspaced(before, token, c, follow, nxt, end, opening)
            if not ellipsis and adjacent and c.isdigit() and (before.isdigit() or marks == "."):
                return None
            if ellipsis and adjacent:
                return None  # a pause inside the sentence
            learned = words.close.get(key)
            score = 3.0 if learned is None else 1.5 + learned
            if ellipsis:
                score = 2.0 if learned is None or not is_cased(before) else learned
            elif plain in TITLES and (c.isupper() or not cased_style or not is_cased(c)):
                score = AGAINST
            elif plain in NEVER or (plain in BEFORE_NUMBER and c.isdigit()):
                score = AGAINST
            elif plain == "no" and opening > -1.0:
                score = 3.0  # the answer, not the abbreviation
            elif plain in INSIDE and word and word.group().casefold() in INSIDE and text.startswith(".", word.end()):
                score = AGAINST  # an abbreviation of several words
            elif len(plain) == 1 and plain.isalpha() and not spaceless(plain):
                numbered = text[max(self.start, at - 2) : at - 1].isspace() and text[max(self.start, at - 3) : at - 2].isdigit()
                if not (numbered and c.isupper()):
                    # the last of several single letters ("u. a.") may end a sentence
                    pair = before.islower() and _LETTER_POINT.search(text, max(self.start, at - 6), at - 1)
                    if c.isupper() and (pair or opening > 1.0 and before.islower()):
                        score = max(score, -2.0)
                    elif before.isupper() or not is_cased(before) or learned is None:
                        score = -4.0
            elif plain.isdigit() and _LIST_NO.search(text, max(self.start, at - 5), mark_end) and self.opens_list(at - len(plain), out):
                score = AGAINST
            elif plain.isdigit() and len(plain) <= 2 and word and word.group().casefold() in MONTHS:
                score = AGAINST
            elif _INITIALS.fullmatch(plain) and (learned is None or learned > 2.0) and (before.isupper() if cased_style else plain not in INSIDE):
                score = AGAINST  # initials: what follows is always a name, or unknown
            elif plain in INSIDE and learned is None:
                score = -2.0
        # what follows
        quoted_next = text[nxt] in _QUOTES and not adjacent
        if text[nxt] in ",;:،、，；：" or (kind == "quote" and text[nxt] in "-–—"):
            score = AGAINST
        if score == AGAINST or not c or not (c.isalnum()):
            pass
        elif c.isdigit():
            score += 0.0
        elif not is_cased(c):
            score += 1.0
        elif cased_style:
            mixed_word = word is not None and word.group()[:1].islower() and any(x.isupper() for x in word.group())
            if c.isupper() or mixed_word:
                score += 4.0 + max(-1.0, min(1.0, opening / 3))
            else:
                score -= 2.0 if quoted_next else 9.0
        else:
            score += 1.0 + (max(opening, -1.0) if quoted_next else opening) * (0.3 if strong and not kind else 1.0)
        if score == AGAINST:
            return Candidate(end, nxt, score)
        if text[nxt] in "¿¡" and not adjacent:
            score = max(score, 4.0)
        if text[nxt] in "(（" and self.whole_bracket(nxt):
            score = max(score, 4.0)  # a bracket that is a sentence by itself
        found = Candidate(end, nxt, score, opener, kind)
        if kind == "quote":
            told = not is_cased(c) and c.isalpha()
            if told and adjacent:
                found.inside = found.opened = -12.0
            elif told:
                found.inside, found.opened = -9.0, -7.0
            elif not cased_style and c.isalpha():
                found.inside = found.opened = -2.0 + min(0.0, opening)
        elif kind == "bracket":
            found.inside = -9.0 if not (cased_style and c.isupper()) else -4.0
        return found

    def opens_list(self, at: int, found: list[Candidate]) -> bool:
        """The number at ``at`` stands at the start of the paragraph or behind a likely end of a sentence."""
        return at <= self.start or bool(found) and found[-1].start_next == at and found[-1].score > 0

    def whole_bracket(self, at: int) -> bool:
        """The bracket that opens at ``at`` ends with an end mark inside."""
        end = self.partner.get(at)
        return end is not None and self.text[end - 1] in STRONG + WEAK

    def unspaced(self, before: str, token: str, c: str, follow: int, nxt: int, end: int, opening: float) -> Candidate | None:
        """A point with no space behind it: most often part of a name or number, at times a forgotten space."""
        text, stop = self.text, self.stop
        if follow != nxt:  # an opening mark follows
            return Candidate(end, nxt, 2.0 if c.isupper() else -2.0)
        # the rest of the word: no point, slash or at sign in it but for end marks at its end
        found = _TAIL_STOP.search(text, end, stop)
        rest = found.start() if found else stop
        if found and not found.group().isspace():
            if found.group() != "." or not _TAIL_END.match(text, rest, stop):
                return None
        if not c.isalpha() or len(token) < 2 or "." in token or "/" in token:
            return None
        tail = text[end:rest].rstrip(_TAIL_MARKS)
        if not is_cased(c):
            return Candidate(end, nxt, 2.0)
        if self.kind == "mixed":
            return Candidate(end, nxt, 3.0) if c.isupper() and (before.islower() or before.isdigit()) and not tail.isupper() else None
        # without case only a known opening word behind a known closing word tells
        if opening > -1.5 and self.words.close.get(token.casefold(), -1.0) > 0.5:
            return Candidate(end, nxt, 1.0 + opening)
        return None

    def _places(self, at: list[int]) -> tuple[list[int], list[int]]:
        """Of each position: the kinds of quotation that are open there, as bits, and its place among the brackets."""
        masks = [0] * len(at)
        for bit, marks in enumerate(self.marks.values()):
            for k, p in enumerate(at):
                masks[k] |= (bisect_left(marks, p) & 1) << bit
        return masks, [bisect_left(self.round, p) for p in at] if self.round else [0] * len(at)

    def _falls(self) -> list[int]:
        """For each place among the brackets the next one where fewer are open."""
        out, stack = [len(self.depth)] * len(self.depth), []
        for k, d in enumerate(self.depth):
            while stack and self.depth[stack[-1]] > d:
                out[stack.pop()] = k
            stack.append(k)
        return out

    def _opened_from(self, opener: int) -> int:
        """The first position from which only opening marks stand before ``opener``."""
        while opener > self.start and self.text[opener - 1] in _OPENING:
            opener -= 1
        return opener

    def cut(self) -> list[tuple[int, int]]:
        """The spans of the best segmentation."""
        cands, text = self.candidates, self.text
        if not cands:
            return [(self.start, self.stop)]
        starts, ends = [self.start, *(c.start_next for c in cands)], [*(c.end for c in cands), self.stop]
        marked = bool(self.marks or self.round)
        if marked:
            (open_s, round_s), (open_e, round_e), depth, falls = self._places(starts), self._places(ends), self.depth, self._falls()
        # where the first letter or digit from each start on stands
        solid, at = [], -1
        for s in starts:
            if at < s:
                m = _ALNUM.search(text, s, self.stop)
                at = m.start() if m else self.stop
            solid.append(at)
        best, most, back = [0.0], [0.0], [0]
        for k, end in enumerate(ends, 1):
            c = cands[k - 1] if k <= len(cands) else None
            opened_from = self._opened_from(c.opener) if c is not None and c.opener >= 0 else -1
            top, arg = -math.inf, k - 1
            for i in range(k - 1, -1, -1):
                s = starts[i]
                n = end - s
                over = (n - 400) / 100 if n > 400 else 0.0
                if most[i] - over < top - 1e-9 or n > SPAN and i < k - 1:
                    break  # no earlier start can reach the top: all else that a span adds here is at most 0
                score = best[i] - over
                if solid[i] >= end:
                    score -= 12.0
                elif n < 8:
                    if n <= 4 and text[s:end].rstrip(".)").isdigit():
                        score -= 6.0
                    elif markless(text[s]):
                        score -= 2.0
                if marked:
                    bad = (open_s[i] ^ open_e[k - 1]).bit_count()
                    a, b = round_s[i], round_e[k - 1]
                    if a != b and (depth[a] != depth[b] or falls[a] <= b):
                        bad += 1
                    score -= 6.0 * bad
                if opened_from >= 0:
                    score += c.opened if s >= opened_from else c.inside
                if score > top + 1e-9:
                    top, arg = score, i
                elif score >= top - 1e-9:
                    arg = i
            best.append(top + c.score if c is not None else top)
            most.append(max(most[-1], best[-1]))
            back.append(arg)
        spans, k = [], len(ends)
        while k > 0:
            spans.append((starts[back[k]], ends[k - 1]))
            k = back[k]
        return spans[::-1]


def split_text(text: str | None, words: Words) -> list[tuple[int, int]]:
    """Sentences as code point offsets, end exclusive."""
    if not text or text.isspace():
        return []
    kind, out = style(text), []
    for start, stop in paragraphs(text):
        out += Paragraph(text, start, stop, kind, words).cut()
    return out


_SEEN = re.compile(r"(?<=[^\W\d_])([.…]+|[!?]+)[\"”»)]*\s+[\"“„«(¿¡]*([^\W_])")


def _count(text: str, close: Counter, opening: Counter, total: Counter) -> None:
    """Count words that close and open sentences where case or a strong mark tells, and all words in ``total``."""
    kind = style(text)
    for start, stop in paragraphs(text):
        part = text[start:stop]
        sure = {0}
        for m in _SEEN.finditer(part):
            marks, c = m.group(1), m.group(2)
            strong = marks[0] in "!?"
            if strong and (kind != "mixed" or c.isupper()):
                sure.add(m.start(2))
            elif not strong and kind == "mixed" and (is_cased(c) or c.isdigit()):
                token = _token_before(part, 0, m.start())
                key = _key(token, marks) if token else ""
                plain = key.rstrip(".")
                if not plain or not c.isdigit() and (plain in TITLES or (len(plain) == 1 and c.isupper())):
                    continue
                close[key, 1] += 1
                if c.isupper():
                    close[key, 0] += 1
                    sure.add(m.start(2))
        for at in sure:
            m = _SPACED_WORD.search(part, at) if at == 0 else _SPACED_WORD.match(part, at)
            if m:
                opening[m.group().casefold()] += 1
    total.update((_ASCII_WORD if text.isascii() else _SPACED_WORD).findall(text.casefold()))


def word_statistics(df: DataFrame, text_col: str = "text") -> Words:
    """Count over all texts which words close and which open sentences; one small aggregation with map-side sums."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        close, opening, total = Counter(), Counter(), Counter()
        for pdf in batches:
            for text in pdf["text"]:
                if text:
                    _count(text, close, opening, total)
        rows = [("close", w, close[w, 0], n) for (w, what), n in close.items() if what == 1] + [("open", w, opening[w], n) for w, n in total.items()]
        yield pd.DataFrame(rows, columns=["kind", "word", "hits", "n"])

    texts = spread(df.select(df[text_col].cast("string").alias("text")).where("text IS NOT NULL"))
    counts = texts.mapInPandas(count, "kind string, word string, hits long, n long").groupBy("kind", "word").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n"))
    # counted once, read for either kind
    counts = cut(counts.where(f"n >= {LEAST}"))

    def most_often(kind: str) -> dict[str, tuple[int, int]]:
        rows = counts.where(F.col("kind") == kind).orderBy(F.desc("n"), "word").limit(WORDS).collect()
        return {r["word"]: (r["hits"], r["n"]) for r in rows}

    return Words(most_often("close"), most_often("open"))


def sentences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: Words | None = None) -> DataFrame:
    """``id_col, sent_start, sent_end``: one row per sentence, offsets in code points, end exclusive.

    Spans have no white space at either end and together cover the text except white space. Null, empty and blank texts
    have none. Rows with equal ids are split each; texts of any length are read whole; other columns are ignored.
    """
    words = words or word_statistics(df, text_col)
    safe = spread(df.select(df[id_col].cast("string").alias("id"), df[text_col].cast("string").alias("text")).where("text IS NOT NULL"))
    table = df.sparkSession.sparkContext.broadcast(words)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = table.value
        for pdf in batches:
            rows = [(i, a, b) for i, t in zip(pdf["id"], pdf["text"]) for a, b in split_text(t, known)]
            yield pd.DataFrame(rows, columns=["id", "sent_start", "sent_end"])

    # ids travel as text: pandas would round large numbers beside nulls
    out = safe.mapInPandas(split, "id string, sent_start int, sent_end int")
    return out.select(F.col("id").cast(df.schema[id_col].dataType).alias(id_col), "sent_start", "sent_end")
