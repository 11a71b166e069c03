"""Sentences and tokens with offsets: a registry of annotators by language."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass

# Languages split by the Chinese rule, and marks that stay within a token or stand alone.
CHINESE = frozenset(("zh", "gan", "wuu", "zh-yue", "zh-classical"))
GLUED = frozenset("ʼ’‘´′'")
ALONE = frozenset("።፡")

_SHORT = frozenset("dr mr mrs ms prof st no vol fig vs jr sr co inc etc al cf e.g i.e approx capt gen".split())


def split_sentences(paragraph: str) -> list[str]:
    """Rule for languages with full stops: terminator, blank, then no lower-case letter; short forms do not end one."""
    out, at = [], 0
    for m in re.finditer(r"[.!?。！？।።؟]+[\"'”’»)\]]*(?:\s+|$)", paragraph):
        word = re.search(r"(\S+?)[.!?]+$", paragraph[at : m.end()].rstrip())
        nxt = paragraph[m.end() : m.end() + 1]
        if m.group()[0] == "." and word and (word.group(1).lower() in _SHORT or len(word.group(1)) == 1 and word.group(1).isupper()):
            continue
        if nxt.islower():
            continue
        out.append(paragraph[at : m.end()].rstrip())
        at = m.end()
    if paragraph[at:].strip():
        out.append(paragraph[at:])
    return out


def split_chinese(paragraph: str) -> list[str]:
    """Sentences end after 。！？; a tail without terminator is a sentence."""
    return re.findall(r"[^。！？]*[。！？]|[^。！？]+$", paragraph)


def tokenize(text: str) -> list[tuple[str, int, int]]:
    """Blank-separated words, every punctuation mark or symbol a token of its own; offsets into ``text``."""
    out, start = [], None
    for i, ch in enumerate(text):
        single = ch not in GLUED and (unicodedata.category(ch)[0] in "PS" or ch in ALONE)
        if (single or ch.isspace()) and start is not None:
            out.append((text[start:i], start, i))
            start = None
        if single:
            out.append((ch, i, i + 1))
        elif not ch.isspace() and start is None:
            start = i
    if start is not None:
        out.append((text[start:], start, len(text)))
    return out


@dataclass(frozen=True)
class Annotator:
    segment: Callable[[str], list[str]] = split_sentences
    tokens: Callable[[str], list[tuple[str, int, int]]] = tokenize


#: Annotators by language; others can be registered.
REGISTRY: dict[str, Annotator] = {**{k: Annotator(split_chinese, lambda t: tokenize(t)) for k in CHINESE}}


def annotator(lang: str | None) -> Annotator:
    return REGISTRY.get((lang or "").lower(), Annotator())


def annotate(text: str, links: list[tuple[int, int]], lang: str | None = None) -> list[dict]:
    """Sentences ``{start, end, paragraph_index, tokens}`` of a text.

    Paragraphs are its non-blank lines.  A boundary inside a link is undone.  Token
    offsets count from the sentence, and ``_`` never occurs in a token.
    """
    a = annotator(lang)
    out, at, index = [], 0, 0
    for line in text.split("\n"):
        if line.strip():
            place = at
            spans: list[list[int]] = []
            for s in a.segment(line):
                start = text.index(s, place)
                end = start + len(s)
                place = end
                if spans and any(b < e and start > b and spans[-1][1] < e and spans[-1][1] > b for b, e in links):
                    spans[-1][1] = end
                else:
                    spans.append([start, end])
            for start, end in spans:
                tokens = [{"text": t, "start": b, "end": e} for t, b, e in a.tokens(text[start:end].replace("_", " "))]
                out.append({"start": start, "end": end, "paragraph_index": index, "tokens": tokens})
            index += 1
        at += len(line) + 1
    return out
