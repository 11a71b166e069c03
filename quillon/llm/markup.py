"""Markup residue in texts: leaf blocks of a tolerant DOM, labelled by a conditional random field.

One scan takes out what is not to be read as markup (comments, scripts, code,
escaped passages) and the formula candidates; the rest is cut at lines and block
tags into leaf blocks that know their ancestors.  HTML, Markdown, wiki and LaTeX
share this one block model.  Whether a block is a heading, a list item, code, a
formula, other markup or plain text is decided jointly for the whole page: ``# x``
is a list item among wiki blocks and a heading among Markdown ones.
"""

from __future__ import annotations

import html
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm import crf

LABELS = ("text", "heading", "list_item", "code", "formula", "other")
UNITS = ("heading", "list_item", "code", "formula")

# Names of HTML and wiki tags, and LaTeX names that need no argument.
TAGS = (
    "a abbr address article aside b big blockquote body br button caption center cite code col colgroup dd del details dfn div dl dt em "
    "figcaption figure font footer form gallery h1 h2 h3 h4 h5 h6 head header hr html i iframe img imagemap includeonly input ins kbd label "
    "li link main map mark math meta nav noinclude nowiki ol onlyinclude option p param poem pre q ref references rp rt ruby s samp score script "
    "section select small source span strike strong style sub summary sup syntaxhighlight table tbody td textarea tfoot th thead time "
    "title tr tt u ul var video wbr mi mo mn mrow msup msub mfrac msqrt"
)
DECLARATIONS = "it bf em tt rm sf sc sl maketitle item par noindent newpage clearpage tableofcontents centering appendix LaTeX TeX ldots dots quad qquad hline bigskip medskip smallskip today textit textbf emph"
SECTIONS = "part|chapter|section|subsection|subsubsection|paragraph|subparagraph"
CODE_TAGS = "pre|source|syntaxhighlight|listing|xmp"
CODE_ENVIRONMENTS = r"verbatim\*?|Verbatim|lstlisting|minted|alltt"
MATH_ENVIRONMENTS = "equation|align|gather|multline|eqnarray|displaymath|math|alignat|flalign"

_OPAQUE = regex.compile(
    rf"""
      (?P<comment><!--.*?-->)
    | (?P<script><(?P<st>script|style|textarea)\b[^>]*>.*?</(?P=st)\s*>)
    | (?P<nowiki><(?P<nw>nowiki)\s*>.*?</(?P=nw)\s*>)
    | (?P<codetag><(?P<ct>{CODE_TAGS})\b[^>]*(?<!/)>(?:.*?</(?P=ct)\s*>|.*\Z))
    | (?P<codespan><(?P<cs>code|tt|kbd|samp)\b[^>]*>.*?</(?P=cs)\s*>)
    | (?P<fence>^[ ]{{0,3}}(?P<fe>`{{3,}}+|~{{3,}}+)[^`\n]*\n(?:.*?^[ ]{{0,3}}(?P=fe)[`~]*[ \t]*$|.*\Z))
    | (?P<codeenv>\\begin\{{(?P<ce>{CODE_ENVIRONMENTS})\}}(?:.*?\\end\{{(?P=ce)\}}|.*\Z))
    | (?P<verb>\\(?:verb|lstinline)\*?(?P<vd>[|!+/"])[^\n]*?(?P=vd))
    | (?P<mathtag><math\b[^>]*(?<!/)>.*?</math\s*>)
    | (?P<mathenv>\\begin\{{(?P<me>(?:{MATH_ENVIRONMENTS})\*?)\}}.*?\\end\{{(?P=me)\}})
    | (?P<mathdelim>(?<!\\)\\\[.*?\\\]|(?<!\\)\\\([^\n]*?\\\))
    | (?P<dollars>(?<![\\$])\$\$(?!\$)[^$]+\$\$)
    | (?P<dollar>(?<![\\$\w])\$(?![\s$])[^$\n]*?(?<![\s\\])\$(?![\w$]))
    | (?P<tick>(?<!`)(?P<tk>`{{1,2}})(?!`)[^\n]*?(?<!`)(?P=tk)(?!`))
    | (?P<texcomment>^%[^\n]*$)
    | (?P<indented>(?:(?<=\n[ \t]*\n)|\A)(?:[ ]{{4}}[^\n]*\S[^\n]*(?:\n|\Z))+)
    | (?P<escape>\\[\\`*_{{}}\[\]()\#+.!$%&|~-](?!\[))
    | (?P<private>\ue000)
    """,
    regex.X | regex.S | regex.M | regex.I,
)
#: Where a span of ``_OPAQUE`` can begin, and what one that needs a closing mark begins with.
_START = regex.compile(r"[<`~\\$%\ue000]|^[ ]", regex.M)
_OPENER = regex.compile(r"<(!--|[a-z]+)|\\begin\{([a-z]+\*?)\}|\\([\[(])", regex.I)


def _opaque(text: str) -> Iterator[regex.Match]:
    """Matches of ``_OPAQUE`` in order, in time linear in the text: a span whose closing mark does not follow any more is never tried."""
    lower, last = text.lower(), {}
    if len(lower) != len(text):
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    last[">"] = text.rfind(">")
    pos = 0
    while (start := _START.search(text, pos)) is not None:
        at = start.start()
        opener = _OPENER.match(lower, at)
        if opener is not None:
            tag, env, delim = opener.groups()
            close = "-->" if tag == "!--" else f"</{tag}" if tag else f"\\end{{{env}}}" if env else {"[": "\\]", "(": "\\)"}[delim]
            if close not in last:
                last[close] = lower.rfind(close)
            if tag not in (None, "!--") and last[">"] < at or last[close] <= at and tag not in _OPEN_ENDED and env not in _OPEN_ENDED:
                pos = at + 1
                continue
        m = _OPAQUE.match(text, at)
        if m is None:
            pos = at + 1
        else:
            yield m
            pos = m.end() if m.end() > at else at + 1


_OPEN_ENDED = frozenset((*CODE_TAGS.split("|"), "verbatim", "verbatim*", "lstlisting", "minted", "alltt"))
_BLOCK_TAG = regex.compile(r"<(/?)(li|h[1-6]|p|ul|ol|div|table|tr|td|th|blockquote|dl|dt|dd|br|hr|section|article|gallery|body|html)\b[^<>]*>", regex.I)
_CONTAINERS = frozenset("li ul ol blockquote table td th dl dd dt h1 h2 h3 h4 h5 h6 gallery".split())
_INLINE = regex.compile(
    rf"""
      </?(?:{TAGS.replace(' ', '|')})(?:\s[^<>]*)?/?>
    | <!-- | -->
    | &(?:\#\d+|\#x[0-9a-f]+|[a-z][a-z0-9]{{1,30}});
    | \[\[ | \]\] | \{{\{{ | \}}\}} | ''+(?!s\b) | \[(?:https?:|ftp:|mailto:|//)[^\s\]]+
    | __[A-Z]{{3,}}__ | ~~(?=\S) | (?<=\S)~~ | (?<![\w_])__(?=[^\s_]) | (?<=[^\s_])__(?![\w_])
    | \*\*+(?=[^\s*]) | (?<=[^\s*])\*\*+ | (?<![\w*\s])\*(?=[^\s*])[^*\n]+(?<=\S)\*(?!\w) | (?<![\w*])\*[^\s*][^*\n]*?[^\s*]\*(?![\w*])
    | !?\[[^\[\]\n]*\]\([^\s()]+[^()\n]*\) | !?\[[^\[\]\n]+\]\[[^\[\]\n]*\] | ^\[[^\[\]\n]+\]:\s
    | (?<![:\\])\\[a-z]+\*?(?:\[[^\]\n]*\])?\{{ | (?<![\w:\\])\\(?:{DECLARATIONS.replace(' ', '|')})\b | \\\\[ \t]*$ | ^\{{\| | ^\|[-}}] | ^\|[^|\n]*\|
    | `
    """,
    regex.X | regex.M | regex.I,
)
#: A text without any of these holds no markup; the filter that keeps most plain texts from Python.
SUSPECT = r"[<>{}\[\]|*#=_`~$\\&^%]|''|(?m:^\s*[-+>:;]\s)|(?m:^\s*\d+[.)]\s)|(?m:^-{3,}\s*$)|(?m:^ {4})"

_LINE_KIND = regex.compile(
    rf"""
      (?P<eq>(={{1,6}})[^=\n](?:.*[^=\n])?\2[ \t]*$)
    | (?P<hash>\#{{1,6}}[ \t]+\S)
    | (?P<rule>(?:-[ ]*){{3,}}$|(?:\*[ ]*){{3,}}$|(?:_[ ]*){{3,}}$|={{3,}}[ ]*$)
    | (?P<stars>\*{{2,6}}(?=[^\s*]?[ ])[ ]?\S) | (?P<hashes>\#{{2,6}}[*:;]*[ ]?\S) | (?P<star>\*[ \t]*(?=[^\s*]))(?!\S[^*\n]*\*)
    | (?P<plus>\+[ \t]+\S) | (?P<dash>-[ \t]+\S) | (?P<number>\d{{1,9}}[.)][ \t]+\S)
    | (?P<sec>\\(?:{SECTIONS})\*?(?:\[[^\]\n]*\])?\{{) | (?P<item>\\item\b)
    | (?P<env>\\(?:begin|end)\{{\w+\*?\}}) | (?P<quote>>[ ]?) | (?P<indent>[:;]+[ ]?\S)
    | (?P<table>\{{\||\|[-}}]|\||!(?!\[)) | (?P<template>\{{\{{)
    | (?P<switch>__[A-Z]+__)
    """,
    regex.X,
)
_SPACES = regex.compile(r"[ \t]*")
_MARK = "\ue000"
_WIKI = regex.compile(r"\[\[|''|\{\{|^={2,6}[^=\n]+={2,6}\s*$|^\{\||<ref|__[A-Z]+__|</?nowiki", regex.M)
_MD = regex.compile(r"\*\*\S|\]\(|\]\[|~~\S|(?<![\w_])__[^\s_A-Z]|^\s*(?:```|~~~)|^\|[-: |]+\|\s*$|^#{2,6} [^\n]|^(?:={3,}|-{3,})\s*$|^> ", regex.M)
_TEX = regex.compile(r"\\(?:begin|end|section|chapter|subsection|cite|label|footnote|href|item|emph|text\w+|maketitle)\b|\{\\(?:it|bf|em)\b")
#: Pages built of these indent tags, not code.
_NESTED_HTML = regex.compile(r"<(?:p|ul|ol|div|table)\b", regex.I)
_HTML = regex.compile(r"</?(?:p|ul|ol|li|h[1-6]|div|table|span)\b", regex.I)


class Piece:
    """A line, or what block tags leave of one: where it starts in the reduced text, its text, the block made of it, the held spans in it."""

    __slots__ = ("at", "block", "line", "spans")

    def __init__(self, at: int, line: str):
        self.at, self.line, self.block, self.spans = at, line, None, []


class Block:
    """A leaf block: where it starts, its shape, its innermost container, blanks around it, its text."""

    __slots__ = ("after", "before", "body", "deep", "held", "shape", "start")

    def __init__(self, start: int, shape: str, held: str, deep: int, before: bool, body: str):
        self.start, self.shape, self.held, self.deep, self.before, self.after, self.body = start, shape, held, deep, before, False, body


def _formula_shape(kind: str, body: str) -> str:
    inner = body.strip("$")
    rich = bool(regex.search(r"[\\^_={}<>+*/]|^[A-Za-z]\w?$", inner))
    return f"{kind}:{'rich' if rich else 'bare'}"


def blocks(text: str) -> tuple[list[Block], bool]:
    """Leaf blocks in order, and whether inline markup of any sort was seen outside them."""
    return scan(text)[:2]


def scan(text: str) -> tuple[list[Block], bool, str, list[Piece]]:
    """``blocks``, the reduced text, and its pieces; a span is ``(kind, text, block or None)``, one for each ``_MARK`` of the piece."""
    held: list[tuple[int, str, str]] = []
    marked = False
    nested = _NESTED_HTML.search(text) is not None
    pieces, last = [], 0
    for m in _opaque(text):
        kind, body = m.lastgroup, m.group()
        # lastgroup is the innermost named group that closed last: the outer ones are looked up.
        kind = next(k for k in _KINDS if m.group(k) is not None)
        if kind == "escape" and not regex.match(r"\\[#$%&_{}*`\[\]]", body):
            continue
        if kind == "indented" and nested:
            continue
        if kind == "codespan" and "\n" in body:
            kind = "codetag"
        if kind == "dollar" and not _FORMULA.search(body):
            continue
        pieces.append(text[last : m.start()])
        pieces.append(_MARK + "\n" if kind == "indented" else _MARK)
        held.append((m.start(), kind, body))
        last = m.end()
    pieces.append(text[last:])
    reduced = "".join(pieces)
    if any(kind != "private" for _, kind, _ in held) or _INLINE.search(reduced):
        marked = True
    found: list[Block] = []
    layout: list[Piece] = []
    if "<" in reduced:
        segments = _segments(reduced)
    else:
        segments = [(a, line, "", 0, "") for a, line in _lines(reduced)]
    blank, n = True, 0
    # Offsets of the reduced text are good enough for order; ``start`` is looked up for held spans.
    for at, line, inside, deep, opened in segments:
        piece = Piece(at, line)
        layout.append(piece)
        body = line.strip()
        if not body:
            if not opened:
                blank = True
                if found:
                    found[-1].after = True
                continue
        lead = len(line) - len(line.lstrip(" \t"))
        shape = ""
        if opened:
            shape = opened
        elif body:
            m = _LINE_KIND.match(body)
            if m:
                shape = next((k for k in _LINE_KINDS if m.group(k) is not None), "")
                if shape == "rule":
                    shape = "eqrule" if body[0] == "=" else "dashrule" if body[0] == "-" else "rule"
                if shape == "hash":
                    shape = "hash1" if not body.startswith("##") else "hash2"
            if lead >= 4 and "\t" not in line[:lead] and (not shape or shape not in ("item", "env", "sec")):
                shape = "deep" + (":list" if shape in _LISTS else "")
        only = body.strip(_MARK + " .,;") == "" and _MARK in body
        if body and not (only and not shape):
            found.append(Block(at, shape or "plain", inside, deep, blank, body))
            piece.block = found[-1]
            blank = False
        for ch in body:
            if ch == _MARK:
                start, kind, raw = held[n]
                n += 1
                if kind in ("dollar", "dollars", "mathtag", "mathenv", "mathdelim"):
                    found.append(Block(at, _formula_shape(kind, raw), inside, deep, only, raw))
                elif kind in ("codetag", "fence", "codeenv", "indented"):
                    found.append(Block(at, kind, inside, deep, only, raw))
                else:
                    piece.spans.append((kind, raw, None))
                    continue
                piece.spans.append((kind, raw, found[-1]))
                blank = False
    return found, marked, reduced, layout


_KINDS = ("comment", "script", "nowiki", "codetag", "codespan", "fence", "codeenv", "verb", "mathtag", "mathenv", "mathdelim", "dollars", "dollar", "tick", "texcomment", "indented", "escape", "private")
_LINE_KINDS = ("eq", "hash", "rule", "stars", "hashes", "star", "plus", "dash", "number", "sec", "item", "env", "quote", "indent", "table", "template", "switch")
_LISTS = frozenset(("star", "stars", "plus", "dash", "number", "hash", "hash1", "hashes", "item", "li"))
_FORMULA = regex.compile(r"[\\^_={}<>+*/]|^\$[A-Za-z]\w?\$$")


def _lines(text: str) -> Iterator[tuple[int, str]]:
    at = 0
    for line in text.split("\n"):
        yield at, line
        at += len(line) + 1


def _segments(text: str) -> Iterator[tuple[int, str, str, int, str]]:
    """Lines cut at block tags: (offset, text, innermost container, depth, tag that opens it)."""
    stack: list[str] = []
    for at, line in _lines(text):
        last, opened = 0, ""
        for m in _BLOCK_TAG.finditer(line):
            name, closing = m.group(2).lower(), m.group(1)
            piece = line[last : m.start()]
            if piece.strip() or opened:
                yield at + last, piece, stack[-1] if stack else "", len(stack), opened
            opened, last = "", m.end()
            if closing:
                if name in stack:
                    del stack[len(stack) - 1 - stack[::-1].index(name) :]
            elif name in _CONTAINERS:
                if name == "li" and stack and stack[-1] == "li":
                    stack.pop()
                stack.append(name)
                if name == "li":
                    opened = "li"
                elif name[0] == "h" and name[1:].isdigit():
                    opened = "h"
        rest = line[last:]
        if rest.strip() or opened or last == 0:
            yield at + last, rest, stack[-1] if stack else "", len(stack), opened


def features(found: list[Block], text: str) -> list[list[str]]:
    """Feature names of every block: shape, ancestor, page syntax, neighbours, text."""
    page = "".join(c for c, r in (("w", _WIKI), ("m", _MD), ("t", _TEX), ("h", _HTML)) if r.search(text))
    shapes = ["^", *(b.shape for b in found), "$"]
    out = []
    for i, b in enumerate(found):
        s, prev, nxt = shapes[i + 1], shapes[i], shapes[i + 2]
        n = len(b.body)
        joined = i + 1 < len(found) and not found[i + 1].before
        names = [
            "s=" + s, f"s={s}|page={page}", f"s={s}|in={b.held}", f"s={s}|prev={prev}", f"s={s}|next={nxt}|{joined}",
            f"s={s}|blank={b.before}", f"s={s}|blank={b.before}|prev={prev}", f"s={s}|len={min(6, n // 20)}",
            f"s={s}|end={b.body[-1:] in '.!?。！？।።؟…'}",
        ]
        names += [f"s={s}|has={c}" for c in page]
        names.append(f"s={s}|alone={s not in (prev, nxt)}|{b.before}{b.after}")
        if s in ("hash1", "hash2"):
            names.append(f"closed={b.body[-1] == '#'}|{s}")
        out.append(names)
    return out


@lru_cache(1)
def model() -> crf.Chain:
    """The field trained on ``TRAINING_PAGES`` labelled pages (see ``markup_pages``)."""
    from quillon.llm.markup_pages import TRAINING_PAGES, labelled_pages

    chains, tags = [], []
    for text, spans in labelled_pages(TRAINING_PAGES, seed=1):
        found, _ = blocks(text)
        chains.append(features(found, text))
        tags.append(align(text, found, spans))
    return crf.train(chains, tags, LABELS, rounds=150)


def align(text: str, found: list[Block], spans: list[tuple[str, str]]) -> list[str]:
    """Labels of the blocks of a training page: its blocks carry serial words that name their label."""
    known = dict(spans)
    out = []
    for b in found:
        word = regex.search(r"q[a-z]{6}q", b.body)
        label = known.get(word.group(), "text") if word else "other"
        if b.shape.partition(":")[0] in ("dollar", "dollars", "mathtag", "mathenv", "mathdelim"):
            label = "formula"
        elif label == "formula":
            label = "text"
        out.append(label)
    return out


def label_texts(texts: list[str], field: crf.Chain | None = None) -> list[tuple[bool, list[tuple[str, Block]]]]:
    """For each text: whether it holds markup, and its labelled blocks."""
    field = field or model()
    parsed = [blocks(t) for t in texts]
    decoded = field.decode([features(b, t) for (b, _), t in zip(parsed, texts)])
    return [(marked or any(x != "text" for x in labels), list(zip(labels, found))) for (found, marked), labels in zip(parsed, decoded)]


def markup_units(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, kind, pos)``: one ``markup`` row (pos 0) for every text that holds markup, and its units.

    Kinds are heading, list_item, code and formula; ``pos`` counts from 0 within text
    and kind.  Null, empty and plain texts give no row.  Repeated rows give their rows
    once; other columns are ignored.  Whole texts are read.
    """
    field = model()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys, kinds, places = [], [], []
            for k, (marked, labelled) in zip(pdf["key"], label_texts(pdf["text"].tolist(), field)):
                if not marked:
                    continue
                keys.append(k)
                kinds.append("markup")
                places.append(0)
                seen = dict.fromkeys(UNITS, 0)
                for label, _ in labelled:
                    if label in seen:
                        keys.append(k)
                        kinds.append(label)
                        places.append(seen[label])
                        seen[label] += 1
            yield pd.DataFrame({"key": pd.Series(keys, dtype=object), "kind": pd.Series(kinds, dtype=object), "pos": pd.Series(places, dtype="int32")})

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("key").isNotNull() & F.col("text").rlike(SUSPECT))
    return rows.mapInPandas(run, f"key {kind}, kind string, pos int").distinct().withColumnRenamed("key", key)
