"""Sentence units across languages and scripts by semi-Markov dynamic programming.

Possible ends are the terminators of a line (and the blanks of scripts that put
nothing else between sentences).  Whole spans between two possible ends are scored
jointly – length, opening word, closing word, balanced quotations and brackets, a
quotation that is the whole span – and the best sequence of spans is selected.

The scores of opening and closing words are learned from all the texts at hand,
without labels: a line's first and last words are sure openings and closings, so a
word that stands before a full stop inside lines, but never at their end, closes no
sentence.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter, deque
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Words before a full stop that never end a sentence, and those that may, by language.
NEVER_FINAL = {
    "en": "dr prof mr mrs ms st no nos vol vols p pp fig figs cf vs approx incl capt gen col sgt rev hon ed eds sec ch ca c i.e e.g viz",
    "de": "dr prof hr fr nr bd s vgl ca z b d h u st abb bzw sog evtl ggf hl dipl ing z.b d.h",
    "fr": "m mm mme mlle dr pr t p pp cf pl env chap fig vol no n° av éd j.-b",
    "es": "sr sra srta dr dra d dª núm pág págs vol cap fig aprox ed prof gral",
    "ru": "см рис с стр тыс экз руб коп им ул т ок гл ср проф акад напр е",
    "ar": "د ص أ م",
    "hi": "डॉ पं पृ श्री",
}
MAYBE_FINAL = {
    "en": "etc co jr sr inc ltd a.m p.m u.s",
    "de": "usw a co jh",
    "fr": "etc",
    "es": "etc h a.m p.m cía",
    "ru": "д г гг п др",
}
GERMAN_DATES = frozenset("Januar Jänner Februar März April Mai Juni Juli August September Oktober November Dezember Jahrhundert Jahrhunderts Jahrhunderte Jh Jhd".split())
#: Verb-final languages in which a quotation is followed by its verb of saying.
QUOTE_THEN_VERB = frozenset({"am", "ja"})
#: Scripts that put nothing but white space between sentences.
BLANK_ENDS = frozenset({"th", "lo", "km"})

_NEVER = {k: frozenset(v.split()) for k, v in NEVER_FINAL.items()}
_MAYBE = {k: frozenset(v.split()) for k, v in MAYBE_FINAL.items()}
_ANY_NEVER = frozenset().union(*_NEVER.values()) - frozenset().union(*_MAYBE.values()) - frozenset("h b d s u c e t m p".split())

_PAIRS = {"(": ")", "[": "]", "（": "）", "「": "」", "『": "』", "«": "»", "“": "”", "„": "“", "《": "》", "【": "】", "‘": "’", "〈": "〉", "‹": "›"}
_CLOSERS = frozenset(_PAIRS.values()) - {"“", "’"}
_END = regex.compile(r"(?:[.!?…]+|[。！？｡．।॥።፧؟۔‼⁇⁈⁉]+[.!?…。！？]*)")
_TAIL = regex.compile(r"""(?:[”"’'」』）)\]】》〉›]|\s?»)*""")
_TAIL_LOW = regex.compile(r"""(?:[”"’'」』）)\]】》〉›“]|\s?»)*""")
_SPACELESS = frozenset("。！？｡．")
_THAI_BLANK = regex.compile(r"\s+")
_WORD = regex.compile(r"[^\s“”„\"«»()（）「」『』\[\]‘‹›—–]+$")
_OPEN_MARKS = "“”„\"«»(（「『[‘'‹¿¡—–-"
_LINE = regex.compile(r"[^\n\r  \x0b\x0c\x85]+")
_THAI = regex.compile(r"\p{Thai}|\p{Lao}|\p{Khmer}")

#: Spans cost nothing for their length from SHORT to LONG characters.
SHORT, LONG = 8, 600
#: Words rarer than this share of their kind get no learned score, which bounds the table to 1/RARE rows a kind and language.
RARE, LEAST_SEEN = 1e-4, 4


def _language(lang: str | None, text: str) -> str:
    lang = (lang or "").strip().lower()[:2]
    return lang or ("th" if _THAI.search(text) else "")


def _quotations(line: str) -> list[tuple[int, int]]:
    """Matched quotations and brackets of a line as (start, end); unmatched marks are ignored."""
    stack: list[tuple[str, int]] = []
    found = []
    low = "„" in line
    for m in regex.finditer(r"""[()\[\]（）「」『』«»“”„《》【】‘’〈〉‹›"']""", line):
        ch, i = m.group(), m.start()
        if ch in "\"'":
            before, after = line[i - 1 : i], line[i + 1 : i + 2]
            closes = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == ch), None)
            if closes is not None and not (ch == "'" and after.isalnum()):
                found.append((stack[closes][1], i + 1))
                del stack[closes:]
            elif (not before or before.isspace() or before in "(（[—–:：“«") and after and not after.isspace():
                stack.append((ch, i))
            continue
        closes = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == ch), None)
        if closes is not None:
            found.append((stack[closes][1], i + 1))
            del stack[closes:]
        elif ch in _PAIRS:
            stack.append((_PAIRS[ch] if ch != "“" or not low else "”", i))
    return found


class _Cut:
    """A possible end: of the unit's text (``end``), and the start of what follows (``next``)."""

    __slots__ = ("end", "initial", "mark", "next", "word")


def _skip_marks(text: str, at: int) -> int:
    """Where the first word after opening quotes, brackets and dashes starts."""
    while at < len(text) and (text[at] in _OPEN_MARKS or text[at].isspace() and text[at - 1] in "—–-«"):
        at += 1
    return at


def _opening(text: str, at: int, lang: str) -> str:
    """The word that opens what starts at ``at``: to the next blank, two characters in scripts without blanks."""
    k = _skip_marks(text, at)
    head = text[k : k + 24]
    if lang in BLANK_ENDS:
        return head[:3]
    if head and ("぀" <= head[0] <= "鿿" or "豈" <= head[0] <= "﫿"):
        return head[:2]
    word = regex.match(r"[^\s.,;:!?…。！？、，।።؟]+", head)
    found = word.group() if word else head[:1]
    return "0" * len(found) if found.isdigit() else found


def _closing(text: str, at: int) -> str:
    """The word that ends at ``at``, the terminator excluded."""
    word = _WORD.search(text, max(0, at - 24), at)
    return word.group().lower().strip(".,;") if word else ""


def _cuts(line: str, lang: str) -> list[_Cut]:
    found = []
    tail = _TAIL_LOW if "„" in line else _TAIL
    n = len(line)
    for m in _END.finditer(line):
        i = m.start()
        mark = m.group()
        end = tail.match(line, m.end()).end()
        k = end
        while k < n and line[k].isspace():
            k += 1
        if k >= n:
            break
        if k == end and mark[0] not in _SPACELESS and not (mark[0] in "!?" and not line[i - 1 : i].isascii() and not line[k].isascii()):
            continue
        c = _Cut()
        c.end, c.next, c.mark = end, k, mark
        c.word = _closing(line, i) if mark == "." else ""
        c.initial = len(c.word) == 1 and line[i - 1].isupper()
        found.append(c)
    if lang in BLANK_ENDS:
        known = {c.next for c in found}
        for m in _THAI_BLANK.finditer(line):
            if 0 < m.start() and m.end() < n and m.end() not in known:
                c = _Cut()
                c.end, c.next, c.mark, c.word, c.initial = m.start(), m.end(), " ", "", False
                found.append(c)
        found.sort(key=lambda c: c.end)
    return found


def _local(line: str, c: _Cut, lang: str, closings: dict, openings: dict) -> float:
    """Score of ending at ``c`` from the closing word, the mark and the opening word."""
    nxt = line[c.next]
    k = _skip_marks(line, c.next)
    first = line[k] if k < len(line) else nxt
    kind = unicodedata.category(first)
    cased = kind in ("Lu", "Lt")
    if c.mark == " ":
        score = 2.0 - 3.0 * line[c.end - 1].isdigit() - 6.0 * nxt.isdigit()
    elif c.mark == ".":
        w = c.word
        score = 3.0 + closings.get(w, 0.0)
        if w in (_NEVER.get(lang, ()) if lang else _ANY_NEVER):
            score = -8.0
        elif c.initial:
            score = -5.0
        elif w in _MAYBE.get(lang, ()):
            score = 1.0
        elif len(w) == 1 and w.isalpha() and w not in "'":
            score = -5.0
        elif "." in w:
            score = -1.0 if regex.search(r"\d", w) is None else 3.0
        elif lang == "de" and w.isdigit() and len(w) <= 2 and _opening(line, c.next, lang) in GERMAN_DATES:
            score = -8.0
    elif c.mark[0] in ".…":
        score = 2.0 if c.next > c.end else -4.0
    else:
        score = 4.0
    if kind == "Ll":
        score -= 8.0
    elif cased or kind == "Lo":
        score += 2.0 if cased else 1.0
    elif kind == "Nd":
        score -= 1.0 if c.mark != " " else 0.0
    elif kind[0] == "P" and first not in "¿¡#*•":
        score -= 8.0
    if lang in QUOTE_THEN_VERB and c.end and line[c.end - 1] in "”」』\"»" and c.mark != " ":
        score -= 8.0
    return score + openings.get(_opening(line, c.next, lang), 0.0)


class _Before:
    """The best start of a span that ends at a given place, among all starts before it.

    Starts come in order and so do the ends asked for.  Between SHORT and LONG the length
    costs nothing, so a queue of falling values gives the best.  Beyond, the cost grows as
    the logarithm: an older start that once beats a newer one does so ever after, and a
    stack whose top is the best at present is enough.  Of equal starts the first is taken.
    """

    def __init__(self, starts: list[int], values: list[float]):
        self.starts, self.values = starts, values
        self.queue: deque[int] = deque()
        self.stack: list[int] = []
        self.entered = self.aged = 0
        self.highest: list[float] = []

    def _value(self, i: int, end: int) -> float:
        return self.values[i] - _length(end - self.starts[i])

    def _overtakes(self, i: int, k: int) -> float:
        """From which end on the older start ``i`` beats ``k``."""
        ratio = math.exp(min(0.0, self.values[k] - self.values[i]))
        return (self.starts[k] - ratio * self.starts[i]) / (1.0 - ratio) if ratio < 1.0 else math.inf

    def _push(self, k: int, end: int) -> None:
        stack = self.stack
        self._settle(end)
        if stack and self._value(stack[-1], end) >= self._value(k, end):
            return
        while len(stack) > 1 and self._overtakes(stack[-2], stack[-1]) <= self._overtakes(stack[-1], k):
            stack.pop()
        if len(stack) == 1 and self._overtakes(stack[0], k) == math.inf:
            stack.pop()
        stack.append(k)

    def _settle(self, end: int) -> None:
        stack = self.stack
        while len(stack) > 1 and self._value(stack[-2], end) >= self._value(stack[-1], end):
            stack.pop()

    def best(self, j: int, end: int, lone: int | None) -> tuple[float, int]:
        """Value and number of the best of the starts up to ``j``; the one at ``lone`` counts 10 less."""
        starts, values, queue = self.starts, self.values, self.queue
        self.highest.append(max(values[j], self.highest[-1]) if j else values[0])
        while self.entered <= j and end - starts[self.entered] >= SHORT:
            while queue and values[queue[-1]] < values[self.entered]:
                queue.pop()
            queue.append(self.entered)
            self.entered += 1
        while self.aged <= j and end - starts[self.aged] > LONG:
            self._push(self.aged, end)
            self.aged += 1
        while queue and queue[0] < self.aged:
            queue.popleft()
        if lone is not None:
            return self._scan(j, end, lone)
        found = []
        self._settle(end)
        if self.stack:
            found.append((self._value(self.stack[-1], end), self.stack[-1]))
        if queue:
            found.append((self._value(queue[0], end), queue[0]))
        found += [(self._value(i, end), i) for i in range(self.entered, j + 1)]
        return max(found, key=lambda f: (f[0], -f[1]))

    def _scan(self, j: int, end: int, lone: int) -> tuple[float, int]:
        """The same by going back until no older start can be as good."""
        top, arg = -math.inf, j
        for i in range(j, -1, -1):
            n = end - self.starts[i]
            if n >= SHORT and self.highest[i] - _length(n) < top:
                break
            value = self._value(i, end) - 10.0 * (self.starts[i] == lone)
            if value >= top:
                top, arg = value, i
        return top, arg


def split_line(line: str, lang: str, closings: dict, openings: dict) -> list[tuple[int, int]]:
    """Best spans of one line (without outer blanks), as offsets into it."""
    cuts = _cuts(line, lang)
    if not cuts:
        return [(0, len(line))]
    pairs = _quotations(line)
    whole = {a: b for a, b in pairs if line[a] not in "([（【"}
    ends = []
    for c in cuts:
        score = _local(line, c, lang, closings, openings)
        # A boundary within a quotation or bracket leaves both parts unbalanced.
        score -= 12.0 * sum(a < c.end < b or a < c.next <= b - 1 for a, b in pairs)
        ends.append((c.end, c.next, score))
    ends.append((len(line), len(line), 0.0))
    starts = [0, *(e[1] for e in ends[:-1])]
    quoted = {b: a for a, b in whole.items()}
    best, back = [0.0], [0]
    before = _Before(starts, best)
    for j, (end, nxt, score) in enumerate(ends):
        # A quotation that is all of the span while text follows: its verb of saying comes next.
        lone = quoted.get(end) if nxt < len(line) and not line[nxt].isupper() and line[nxt] not in _OPEN_MARKS else None
        top, arg = before.best(j, end, lone)
        best.append(top + score)
        back.append(arg)
    spans, j = [], len(ends)
    while j:
        i = back[j]
        spans.append((starts[i], ends[j - 1][0]))
        j = i
    return spans[::-1]


@lru_cache(4096)
def _length(n: int) -> float:
    """Cost of a span's length: very short and very long sentences are rare."""
    return 2.0 * (n < 3) + 0.5 * (n < SHORT) + (math.log(n / LONG) if n > LONG else 0.0)


def split_text(text: str | None, lang: str | None = None, model: dict | None = None) -> list[tuple[int, int]]:
    """Sentence units of a text as code-point offsets without outer white space.

    Null, empty and blank texts have none.  Units never span lines; together with the
    white space between them they make up the text.
    """
    if not text:
        return []
    lang = _language(lang, text)
    closings, openings = (model or {}).get(lang, ({}, {}))
    units = []
    for m in _LINE.finditer(text):
        raw = m.group()
        line = raw.strip()
        if line:
            at = m.start() + len(raw) - len(raw.lstrip())
            units.extend((at + a, at + b) for a, b in split_line(line, lang, closings, openings))
    return units


def _observe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of words at line edges and at possible boundaries outside quotations."""
    for pdf in batches:
        seen: Counter = Counter()
        for text, lang in zip(pdf["text"], pdf["lang"]):
            if not text:
                continue
            lang = _language(lang, text)
            for m in _LINE.finditer(text):
                line = m.group().strip()
                if not line:
                    continue
                seen[lang, "open", _opening(line, 0, lang), True] += 1
                last = regex.search(r"\.[”\"’'」』）)\]»]*$", line)
                if last and line[last.start() - 1 : last.start()] != ".":
                    seen[lang, "close", _closing(line, last.start()), True] += 1
                pairs = _quotations(line)
                for c in _cuts(line, lang):
                    if any(a < c.end < b for a, b in pairs):
                        continue
                    seen[lang, "open", _opening(line, c.next, lang), False] += 1
                    if c.word:
                        seen[lang, "close", c.word, False] += 1
        if seen:
            yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["lang", "kind", "word", "edge", "n"])


def learn(docs: DataFrame, text: str, lang: str) -> dict:
    """Learned scores of closing and opening words by language, from all rows of ``docs``.

    Words under ``RARE`` of their language's places or seen fewer than ``LEAST_SEEN``
    times inside lines score 0, so the table stays below 2/RARE rows a language.
    """
    counts = (
        docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).mapInPandas(_observe, "lang string, kind string, word string, edge boolean, n bigint")
        .groupBy("lang", "kind", "word").agg(F.sum(F.expr("if(edge, n, 0)")).alias("edge"), F.sum(F.expr("if(edge, 0, n)")).alias("mid"))
    )
    totals = counts.groupBy("lang", "kind").agg(F.sum("edge").alias("edges"), F.sum("mid").alias("mids"))
    kept = counts.join(totals, ["lang", "kind"]).where(f"mid >= {LEAST_SEEN} and mid >= {RARE} * mids")
    model: dict = {}
    for r in kept.collect():
        ratio = max(r.edges, 1) / max(r.mids, 1)
        score = 2 * math.log((r.edge + 0.5) / (r.mid * ratio + 0.5))
        closings, openings = model.setdefault(r.lang, ({}, {}))
        if r.kind == "close":
            closings[r.word] = min(0.0, max(-8.0, score))
        else:
            openings[r.word] = min(1.0, max(-8.0, score))
    return model


def sentence_units(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """``(key, start_pos, end_pos)`` of every sentence unit of every row of ``docs``.

    Offsets are zero-based, half-open code points.  Null, empty and blank texts give
    no row; a null language is guessed from the script; repeated rows repeat their
    units; other columns are ignored.  ``docs`` is read twice (learning, splitting).
    """
    model = learn(docs, text, lang)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys, starts, ends = [], [], []
            for k, t, g in zip(pdf["key"], pdf["text"], pdf["lang"]):
                for a, b in split_text(t, g, model):
                    keys.append(k)
                    starts.append(a)
                    ends.append(b)
            yield pd.DataFrame({"key": pd.Series(keys, dtype=object), "start_pos": pd.Series(starts, dtype="int32"), "end_pos": pd.Series(ends, dtype="int32")})

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    return rows.mapInPandas(run, f"key {kind}, start_pos int, end_pos int").withColumnRenamed("key", key)
