"""Wiki markup to clean text with offset-annotated links: plain functions ``str -> value``.

The scanners share one idea: a single pass collects the delimiters of a construct,
a depth counter turns them into outermost spans, and the spans are cut out at once.
Links travel through the pipeline as private-use markers that hold an index into a
list, so later steps change labels but never targets.
"""

from __future__ import annotations

import html.entities
import re
from dataclasses import dataclass, field

# Element, protocol, namespace and switch names that decide what is removed.
DISCARDED = (
    "gallery timeline noinclude pre table tr td th caption div form input select option textarea "
    "ul li ol dl dt dd menu dir ref references img imagemap source small"
).split()
IGNORED = (
    "abbr b big blockquote center cite div em font h1 h2 h3 h4 hiero i kbd nowiki p plaintext s span "
    "strike strong sub sup tt u var code"
).split()
SELF_CLOSING = "br hr nobr ref references nowiki".split()
PROTOCOLS = (
    "bitcoin: ftp:// ftps:// geo: git:// gopher:// http:// https:// irc:// ircs:// magnet: mailto: mms:// news: "
    "nntp:// redis:// sftp:// sip: sips: sms: ssh:// svn:// tel: telnet:// urn: worldwind:// xmpp: //"
).split()
DROPPED_NAMESPACES = frozenset(("category", "file", "image"))
KEPT_NAMESPACES = frozenset(("w", "wiktionary", "wikt"))
SWITCHES = (
    "NOTOC FORCETOC TOC NEWSECTIONLINK NONEWSECTIONLINK NOGALLERY HIDDENCAT NOCONTENTCONVERT NOCC NOTITLECONVERT "
    "NOTC START END INDEX NOINDEX STATICREDIRECT DISAMBIG"
).split()

_OPEN, _LABEL, _CLOSE = "", "", ""
_EXTERNAL = re.compile(
    r"\[((?i:" + "|".join(map(re.escape, PROTOCOLS)) + r")[^\]\[<>\"\x00-\x20\x7f\s]+)\s*([^\]\x00-\x08\x0a-\x1f]*?)\]"
)
_SWITCH = re.compile("|".join(f"__{s}__" for s in SWITCHES))
_ENTITY = re.compile(r"&(?:#x([0-9a-fA-F]+)|#([0-9]+)|(\w+));")
_COMMENT = re.compile(r"<!--.*?-->", re.S)
_SELF = re.compile(r"<\s*(?:" + "|".join(SELF_CLOSING) + r")\b[^>]*/\s*>", re.S | re.I)
_IGNORED_OPEN = re.compile(r"<\s*(?:" + "|".join(IGNORED) + r")\b[^>/]*>", re.S | re.I)
_IGNORED_CLOSE = re.compile(r"<\s*/\s*(?:" + "|".join(IGNORED) + r")\s*>", re.S | re.I)
_FORMULA = re.compile(r"<\s*math(?:\s+[^>]*)?>.*?<\s*/\s*math\s*>", re.S | re.I)
_CODE_SHOWN = re.compile(r"&lt;syntaxhighlight .*?&gt;.*?&lt;/syntaxhighlight&gt;", re.S)
_SECTION = re.compile(r"(==+)\s*(.*?)\s*\1")
_CATEGORY = re.compile(r"\[\[Category:[^\[\]]*\]\]")
_ANCHOR = re.compile(f"{_OPEN}([ie])([0-9]+){_LABEL}(.*?){_CLOSE}", re.S)


def outer_spans(text: str, opening: str, closing: str) -> list[tuple[int, int]]:
    """Outermost balanced spans (delimiters are patterns, case is ignored).

    Surplus closings belong to no span.  When the text ends inside a block that saw a
    closing, the block ends at that closing; if yet another block opened after it,
    everything from the first span on up to that closing is one span.
    """
    spans: list[tuple[int, int]] = []
    depth = start = last = 0
    reopened = False
    for m in re.finditer(f"({opening})|({closing})", text, re.I):
        if m.group(1) is not None:
            if not depth:
                start, last = m.start(), 0
            depth, reopened = depth + 1, True
        elif depth:
            depth, last, reopened = depth - 1, m.end(), False
            if not depth:
                spans.append((start, last))
    if depth and last:
        spans = [(spans[0][0] if spans else start, last)] if reopened else [*spans, (start, last)]
    return spans


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the spans; spans inside or across an earlier one are swallowed by it."""
    out, at = [], 0
    for a, b in sorted(spans, key=lambda s: (s[0], -s[1])):
        if a >= at:
            out.append(text[at:a])
            at = b
    return "".join(out) + text[at:]


def drop_nested(text: str, opening: str, closing: str) -> str:
    return cut(text, outer_spans(text, opening, closing))


def balanced(text: str, opening: str = "[[", closing: str = "]]") -> list[tuple[int, int]]:
    """Outermost balanced ``[[…]]`` spans; nothing is found from the first opening that never closes."""
    spans, depth, start = [], 0, 0
    for m in re.finditer(f"{re.escape(opening)}|{re.escape(closing)}", text):
        if m.group() == opening:
            if not depth:
                start = m.start()
            depth += 1
        elif depth:
            depth -= 1
            if not depth:
                spans.append((start, m.end()))
    return spans


def unescape(text: str) -> str:
    """Character references of HTML 4 and numeric ones (hexadecimal with a small x); others stay."""

    def one(m: re.Match) -> str:
        try:
            if m.group(1):
                return chr(int(m.group(1), 16))
            if m.group(2):
                return chr(int(m.group(2)))
            return chr(html.entities.name2codepoint[m.group(3)])
        except (KeyError, ValueError, OverflowError):
            return m.group()

    return _ENTITY.sub(one, text)


@dataclass
class Links:
    """Targets of the anchors in a text, by kind and index."""

    internal: list[str] = field(default_factory=list)
    external: list[str] = field(default_factory=list)

    def anchor(self, kind: str, target: str, label: str) -> str:
        targets = self.internal if kind == "i" else self.external
        targets.append(target)
        return f"{_OPEN}{kind}{len(targets) - 1}{_LABEL}{label}{_CLOSE}"


def mark_external(text: str, links: Links) -> str:
    """``[url label]`` to anchors; an empty label becomes ``external_link_N``; bare URLs stay."""
    unnamed = 0

    def one(m: re.Match) -> str:
        nonlocal unnamed
        label = m.group(2)
        if not label:
            unnamed += 1
            label = f"external_link_{unnamed}"
        return links.anchor("e", m.group(1), label.replace("[[", "").replace("]]", ""))

    return _EXTERNAL.sub(one, text)


def split_link(inner: str) -> tuple[str, str]:
    """Target and label of what stands between ``[[`` and ``]]``.

    The label starts after the first bar, or after the last one before a nested link.
    """
    target, bar, rest = inner.partition("|")
    if not bar:
        return inner, inner
    cut_at, floor = 0, 0
    for a, b in balanced(rest):
        last = rest.rfind("|", floor, a)
        if last >= 0:
            cut_at = last + 1
        floor = b
    return target.rstrip(), rest[cut_at:].strip()


def mark_internal(text: str, links: Links) -> str:
    """``[[target|label]]`` to anchors, without those of dropped namespaces (captions included)."""
    out, at = [], 0
    for a, b in balanced(text):
        target, label = split_link(text[a + 2 : b - 2])
        colon = target.find(":")
        out.append(text[at:a])
        at = b
        if colon > 0 and target[:colon].lower() in DROPPED_NAMESPACES:
            continue
        second = target.find(":", 1) if colon == 0 else -1
        out.append(label if second > 1 and target[1:second] not in KEPT_NAMESPACES else links.anchor("i", target, label))
    return "".join(out) + text[at:]


def drop_quotes(text: str) -> str:
    """Bold marks go, italics become straight double quotes (once, even around quoted text)."""
    for pattern, form in (
        (r"'''''([^']*?)'''''", r"\1"), (r"'''(.*?)'''", r"\1"), (r"''\"(.*?)\"''", r'"\1"'), (r"''([^']*)''", r'"\1"'), (r'""(.*?)""', r'"\1"'),
    ):
        text = re.sub(pattern, form, text)
    return text.replace("'''", "").replace("''", '"')


def drop_tags(text: str) -> str:
    """Comments, self-closing tags and the tags of ignored elements go; their content stays."""
    spans = [m.span() for p in (_COMMENT, _SELF, _IGNORED_OPEN, _IGNORED_CLOSE) for m in p.finditer(text)]
    return cut(text, spans)


def number_formulas(text: str) -> str:
    """Every ``<math>`` element becomes ``formula_N``; equal elements share the first number."""
    for n, whole in enumerate([m.group() for m in _FORMULA.finditer(text)], 1):
        text = text.replace(whole, f"formula_{n}")
    return text


def tidy(text: str) -> str:
    """Guillemets, blanks, dots, lines of punctuation and doubled commas."""
    text = text.replace("<<", "«").replace(">>", "»").replace("\t", " ")
    text = re.sub(r" {2,}", " ", text)
    text = re.sub(r"\.{4,}", "...", text)
    text = re.sub(r"\n\W+?\n", "\n", text)
    return text.replace(",,", ",").replace(",.", ".")


def clean(markup: str, links: Links | None = None, escape: bool = False) -> str:
    """Markup to text that still holds link markers and headings (see ``compact`` and ``resolve_links``)."""
    links = Links() if links is None else links
    text = drop_nested(markup, r"\{\{", r"\}\}")
    text = drop_nested(text, r"\{\|", r"\|\}")
    text = _SWITCH.sub("", mark_internal(mark_external(text, links), links))
    parts, at = [], 0
    for m in _CODE_SHOWN.finditer(text):
        parts += [unescape(text[at : m.start()]), m.group()]
        at = m.end()
    text = drop_quotes("".join(parts) + unescape(text[at:]))
    text = drop_tags(text)
    for tag in DISCARDED:
        text = drop_nested(text, rf"<\s*{tag}\b[^>/]*>", rf"<\s*/\s*{tag}>")
    text = tidy(number_formulas(unescape(text)))
    return html.escape(text, quote=False) if escape else text


_HEADING = re.compile(r"(==+)\s*(.*?)\s*\1")


def compact(text: str, mark_headers: bool = False) -> list[str]:
    """Content lines; a heading is kept only if content follows before a heading of its level or above."""
    out: list[str] = []
    waiting: dict[int, str] = {}
    for line in text.split("\n"):
        if not line:
            continue
        m = _HEADING.match(line)
        if m:
            level = len(m.group(1))
            waiting = {k: v for k, v in waiting.items() if k < level}
            waiting[level] = f"{m.group(1)}{m.group(2)}{m.group(1)}" if mark_headers else m.group(2)
        elif line.startswith("++"):
            title = line[2:-2]
            if title:
                out.append(title if title[-1] in "!?" else title + ".")
        elif line[0] in ":;":
            out.append(line.lstrip(":;"))
        elif line[0] in "{|" or line[-1] == "}":
            continue
        elif line[0] == "(" and line[-1] == ")" or not line.strip(".-"):
            continue
        else:
            out.extend(waiting[k] for k in sorted(waiting))
            waiting = {}
            out.append(line)
    return out


def normalize_title(title: str) -> str:
    """The title form of ``functions.text.normalize_title``, for use inside scanners."""
    t = title.replace("_", " ").strip()
    return t[:1].upper() + t[1:]


def resolve_links(text: str, links: Links) -> tuple[str, list[tuple], list[tuple]]:
    """Text without markers; internal ``(text, start, end, title)`` and external ``(text, start, end, url)`` links.

    An anchor without target leaves its label; one without label shows its target.
    """
    out, inner, outer, at, size = [], [], [], 0, 0
    for m in _ANCHOR.finditer(text):
        before = text[at : m.start()]
        target = (links.internal if m.group(1) == "i" else links.external)[int(m.group(2))]
        label = _ANCHOR.sub(lambda x: x.group(3), m.group(3)) or target
        at = m.end()
        out += [before, label]
        start = size + len(before)
        size = start + len(label)
        if m.group(1) == "i" and target:
            inner.append((label, start, size, normalize_title(unescape(target))))
        elif m.group(1) == "e":
            outer.append((label, start, size, target))
    out.append(text[at:])
    return "".join(out), inner, outer


def sections(text: str) -> list[tuple]:
    """``(text, start, end, title, level)`` of every heading mark anywhere in the text."""
    return [(m.group(), m.start(), m.end(), m.group().replace("=", "").strip(), m.group().count("=") // 2) for m in _SECTION.finditer(text)]


def categories(markup: str) -> list[str]:
    """Names of ``[[Category:…]]`` in raw markup, up to a bar."""
    names = (m.group()[len("[[Category:") : -2].partition("|")[0] for m in _CATEGORY.finditer(markup))
    return [n.strip() for n in names if n]


def infobox(markup: str) -> str | None:
    """The first infobox template from its braces to their balance; None if there is none or it never closes."""
    m = re.search(r"\{\{infobox", markup, re.I)
    if not m:
        return None
    depth = 0
    for b in re.finditer(r"[{}]", markup[m.start() :]):
        depth += 1 if b.group() == "{" else -1
        if not depth:
            return markup[m.start() : m.start() + b.end()]
    return None


def parse_page(markup: str | None) -> dict:
    """Article, links, external links, sections, categories and infobox of a page's markup."""
    markup = markup or ""
    links = Links()
    lines = compact(clean(markup, links), mark_headers=True)
    article, inner, outer = resolve_links("\n".join(lines), links)
    return {
        "article": article, "links": inner, "external_links": outer, "sections": sections(article),
        "categories": categories(markup), "infobox": infobox(markup),
    }


# ---- templates and parser functions ----------------------------------------------------------


def _split_top(text: str) -> list[str]:
    """Split at bars that stand outside nested braces and links."""
    out, depth, at = [], 0, 0
    for m in re.finditer(r"\{\{|\[\[|\}\}|\]\]|\|", text):
        if m.group() == "|":
            if not depth:
                out.append(text[at : m.start()])
                at = m.end()
        else:
            depth += 1 if m.group() in ("{{", "[[") else -1
    return [*out, text[at:]]


class _Calculator:
    """Arithmetic of ``#expr`` by precedence climbing; no Python evaluation."""

    LEVELS = ({"or"}, {"and"}, {"=", "<>", "!=", "<", ">", "<=", ">="}, {"round"}, {"+", "-"}, {"*", "/", "div", "mod"}, {"^"})

    def __init__(self, text: str):
        self.tokens = re.findall(r"\d+\.?\d*(?:e[+-]?\d+)?|\.\d+|[a-z]+|<>|!=|<=|>=|\S", text.lower())
        self.at = 0

    def peek(self) -> str:
        return self.tokens[self.at] if self.at < len(self.tokens) else ""

    def level(self, n: int) -> float:
        if n == len(self.LEVELS):
            return self.atom()
        left = self.level(n + 1)
        while self.peek() in self.LEVELS[n]:
            op = self.peek()
            self.at += 1
            left = self.apply(op, left, self.level(n + 1))
        return left

    def atom(self) -> float:
        t = self.peek()
        self.at += 1
        if t in ("-", "+", "not"):
            v = self.level(len(self.LEVELS) - 1)
            return -v if t == "-" else v if t == "+" else float(not v)
        if t == "(":
            v = self.level(0)
            if self.peek() != ")":
                raise ValueError(")")
            self.at += 1
            return v
        return float(t)

    @staticmethod
    def apply(op: str, a: float, b: float) -> float:
        if op in ("/", "div"):
            return a / b
        if op == "round":
            return round(a, int(b))
        if op == "^":
            return a**b
        table = {"+": a + b, "-": a - b, "*": a * b, "=": a == b, "<>": a != b, "!=": a != b, "<": a < b, ">": a > b, "<=": a <= b, ">=": a >= b, "and": bool(a and b), "or": bool(a or b)}
        return float(table[op]) if op != "mod" else float(int(a) % int(b))

    def value(self) -> str:
        v = self.level(0)
        if self.at != len(self.tokens):
            raise ValueError("trailing")
        return str(int(v)) if v == int(v) else f"{v:.12g}"


def expression(text: str) -> str:
    try:
        return _Calculator(text).value() if text.strip() else ""
    except (ValueError, ZeroDivisionError, OverflowError, KeyError):
        return '<span class="error"></span>'


def parser_function(name: str, args: list[str]) -> str:
    """``#if``, ``#ifeq``, ``#iferror``, ``#switch``, ``#expr`` and the case functions; '' for all others."""
    args = [a.strip() for a in args]
    get = lambda i: args[i] if i < len(args) else ""
    if name == "#if":
        return get(1) if get(0) else get(2)
    if name == "#ifeq":
        return get(2) if get(0) == get(1) else get(3)
    if name == "#iferror":
        bad = 'class="error"' in get(0)
        return get(1) if bad else (get(2) if len(args) > 2 else get(0))
    if name == "#expr":
        return expression(get(0))
    if name == "#switch":
        return _switch(args)
    first = get(0)
    simple = {"lc": first.lower(), "uc": first.upper(), "lcfirst": first[:1].lower() + first[1:], "ucfirst": first[:1].upper() + first[1:]}
    if name in simple:
        return simple[name]
    if name == "urlencode":
        from urllib.parse import quote

        return quote(first.replace(" ", "_"))
    if name == "int":
        return str(int(first)) if re.fullmatch(r"[+-]?\d+", first) else ""
    return ""


def _switch(args: list[str]) -> str:
    """First case equal to the subject; cases without value fall through; ``#default`` or a last bare case else."""
    subject, matched, default = args[0] if args else "", False, ""
    for i, case in enumerate(args[1:], 1):
        key, eq, value = (x.strip() for x in case.partition("="))
        if not eq:
            if i == len(args) - 1:
                return key if not matched and key != subject else key
            matched = matched or key == subject
            continue
        if matched or key == subject:
            return value
        if key == "#default":
            default = value
    return default


def expand_templates(text: str, templates: dict[str, str], depth: int = 30) -> str:
    """Templates and parser functions replaced by their value; unknown ones and those below ``depth`` vanish."""
    out, at = [], 0
    for a, b in balanced(text, "{{", "}}"):
        out.append(text[at:a])
        at = b
        inner = text[a + 2 : b - 2]
        if depth <= 0:
            continue
        parts = _split_top(inner)
        name = expand_templates(parts[0], templates, depth - 1).strip()
        head, colon, first = name.partition(":")
        if colon and (head.startswith("#") or head.lower() in ("lc", "uc", "lcfirst", "ucfirst", "urlencode", "int")):
            args = [first, *(expand_templates(p, templates, depth - 1) for p in parts[1:])]
            out.append(parser_function(head if head.startswith("#") else head.lower(), args))
            continue
        body = templates.get(name[:1].upper() + name[1:])
        if body is None:
            continue
        params, n = {}, 0
        for p in parts[1:]:
            key, eq, value = p.partition("=")
            if eq and "{{" not in key and "[[" not in key:
                params[key.strip()] = expand_templates(value, templates, depth - 1).strip()
            else:
                n += 1
                params[str(n)] = expand_templates(p, templates, depth - 1)
        out.append(expand_templates(_fill(body, params), templates, depth - 1))
    return "".join(out) + text[at:]


def _fill(body: str, params: dict[str, str]) -> str:
    """``{{{name|default}}}`` replaced from the inside out."""
    pattern = re.compile(r"\{\{\{([^{}|]*)(\|[^{}]*)?\}\}\}")
    for _ in range(20):
        new = pattern.sub(lambda m: params.get(m.group(1).strip(), (m.group(2) or "|")[1:] if m.group(2) else ""), body)
        if new == body:
            break
        body = new
    return body


def template_body(page: str) -> str | None:
    """What a template page contributes where it is used; None for a redirect."""
    if re.match(r"\s*#redirect", page, re.I):
        return None
    text = _COMMENT.sub("", page)
    text = re.sub(r"<noinclude>.*?</noinclude>|<noinclude\s*/>", "", text, flags=re.S | re.I)
    only = re.findall(r"<onlyinclude>(.*?)</onlyinclude>", text, re.S | re.I)
    if only:
        text = "".join(only)
    return re.sub(r"</?includeonly>", "", text, flags=re.I)


# ---- simple cleaner ----------------------------------------------------------------------------


def drop_templates(text: str) -> str:
    """Templates by brace depth; one that never closes takes the rest of the text with it."""
    out, depth, at = [], 0, 0
    for m in re.finditer(r"\{\{|\}\}", text):
        if m.group() == "{{":
            if not depth:
                out.append(text[at : m.start()])
            depth += 1
        elif depth:
            depth -= 1
            at = m.end()
    return "".join(out) + (text[at:] if not depth else "")


def file_captions(text: str) -> tuple[str, list[str]]:
    """Text without file and image links, and the captions after their last bar."""
    spans, captions = [], []
    for a, b in balanced(text):
        inner = text[a + 2 : b - 2]
        if re.match(r"(file|image):", inner, re.I):
            spans.append((a, b))
            if "|" in inner:
                captions.append(split_link(inner)[1].rpartition("|")[2].strip() if "[[" not in inner else split_link(inner)[1])
    return cut(text, spans), [c for c in captions if c]


def piped_links(text: str) -> list[tuple]:
    """``(anchor, start, end, title)`` of ``[[title|anchor]]`` and ``[[title]]``, with offsets into the markup."""
    out = []
    for a, b in balanced(text):
        title, label = split_link(text[a + 2 : b - 2])
        if title:
            out.append((re.sub(r"\s+", " ", label).strip(), a, b, normalize_title(title.lstrip(":"))))
    return out


def references(text: str) -> list[str]:
    """The ``<ref>…</ref>`` elements of a text."""
    return [m.group() for m in re.finditer(r"<ref(?:\s[^>]*)?(?<!/)>.*?</ref>", text, re.S)]


def strip_markup(text: str) -> str:
    """A second, simpler cleaner: templates, tables, references, tags and marks go, file captions move to the end."""
    text = re.sub(r"(?:\n\[\[[a-z][a-z][\w-]*:[^:\]]+\]\])+$", "", text)
    text, captions = file_captions(drop_templates(text))
    text = drop_nested(text, r"\{\|", r"\|\}")
    text = _COMMENT.sub("", text)
    text = re.sub(r"<(ref|nowiki|math)\b(?:[^>]*/>|.*?</\1>)", "", text, flags=re.S)
    text = _CATEGORY.sub("", text)
    text = re.sub(r"<[^<>]*>", "", text)
    text = re.sub(r"\[\[:?([^\[\]|]*)\]\]", r"\1", text)
    text = re.sub(r"\[\[:?[^\[\]]*?\|([^\[\]]*)\]\]", r"\1", text)
    text = re.sub(r"\[\w+://[^\s\]]*\s?([^\]]*)\]", r"\1", text)
    text = drop_quotes(text)
    text = re.sub(r" \(\s*\)|（\s*）", "", unescape(text))
    return "\n".join([text.strip(), *(c if c.endswith(".") else c + "." for c in captions)]).strip()
