"""Clean text of pages with markup, rendered from the blocks the field of ``markup`` labelled.

Inline markup, comments and scripts go; headings, list items, code blocks and formulas
stay, in one form whatever the page's syntax: ``# heading``, ``* item`` (two blanks a
level), fenced code, ``$formula$`` in a line and ``$$formula$$`` on its own.  Notes
(``<ref>``, ``\\footnote``), citations, templates and categories are no running text and
go too; cells of tables stay as lines.
"""

from __future__ import annotations

import html
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm import crf
from quillon.llm.markup import _MARK, _TEX, CODE_TAGS, DECLARATIONS, SUSPECT, TAGS, UNITS, Block, features, model, scan

_LEVELS = {"part": 1, "chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 5, "subparagraph": 6}
_TAG = regex.compile(rf"</?(?:{TAGS.replace(' ', '|')})(?:\s[^<>]*)?/?>", regex.I)
_REF = regex.compile(r"<ref\b[^<>]*/>|<ref\b[^<>]*>.*?</ref\s*>", regex.I | regex.S)
_BREAK = regex.compile(r"<(?:br|wbr)\b[^<>]*>", regex.I)
_REFERENCE = regex.compile(r"&(?:\#\d+|\#x[0-9a-f]+|[a-z][a-z0-9]{1,30});", regex.I)
_DRESSED = regex.compile(r"<(b|i|em|strong|u|s|small|big|sup|sub|tt|font|span)(?:\s[^<>]*)?>([^<>]*)</\1\s*>", regex.I)
_TEMPLATE = regex.compile(r"\{\{([^{}]*)\}\}")
_LINK = regex.compile(r"\[\[([^\[\]]*)\]\]")
_OUTER = regex.compile(r"\[(?:https?:|ftp:|mailto:|//)[^\s\]]+(?:\s+([^\]]*))?\]", regex.I)
_DROPPED_LINK = regex.compile(r"\s*(?:File|Image|Category|Datei|Bild|Kategorie|Fichier|Catégorie|Archivo|Categoría|Файл|Категория|文件|分类|ファイル|カテゴリ)\s*:", regex.I)
_MD_LINK = regex.compile(r"!?\[([^\[\]\n]*)\]\([^\s()]+[^()\n]*\)|!?\[([^\[\]\n]+)\]\[[^\[\]\n]*\]")
_MD_TARGET = regex.compile(r"^\s*\[[^\[\]\n]+\]:\s\s*\S.*$")
_STAR = regex.compile(r"(?<![\w*\s])\*(?=[^\s*])([^*\n]+)(?<=\S)\*(?!\w)|(?<![\w*])\*([^\s*](?:[^*\n]*[^\s*])?)\*(?![\w*])")
_TOKENS = regex.compile(r"\*\*+(?=[^\s*])|(?<=[^\s*])\*\*+|~~(?=\S)|(?<=\S)~~|(?<![\w_])__(?=[^\s_])|(?<=[^\s_])__(?![\w_])|''+(?!s\b)|\[\[|\]\]|\{\{|\}\}|<!--|-->|`")
_SWITCH = regex.compile(r"__[A-Z]{3,}__")
_TEX_GONE = regex.compile(r"[~ ]?(?<![:\\])\\(?:cite[a-z]*|label|footnote|footnotetext|index|bibliography|bibliographystyle|usepackage|documentclass|includegraphics|vspace|hspace|pagestyle)\*?(?:\[[^\]\n]*\])*\{[^{}]*\}")
_TEX_LINK = regex.compile(r"\\(?:href|textcolor)\{[^{}]*\}\{([^{}]*)\}")
_TEX_ARGUMENT = regex.compile(r"(?<![:\\])\\[a-z]+\*?(?:\[[^\]\n]*\])?\{([^{}]*)\}", regex.I)
_TEX_OPEN = regex.compile(r"(?<![:\\])\\[a-z]+\*?(?:\[[^\]\n]*\])?\{", regex.I)
_TEX_GROUP = regex.compile(r"\{\\(?:it|bf|em|tt|rm|sf|sc|sl)\b\s*([^{}]*)\}")
_TEX_WORDS = {"LaTeX": "LaTeX", "TeX": "TeX", "ldots": "…", "dots": "…", "quad": " ", "qquad": " "}
_TEX_DECLARATION = regex.compile(rf"(?<![\w:\\])\\({DECLARATIONS.replace(' ', '|')})\b\s?")
_ENVIRONMENT = regex.compile(r"\\(?:begin|end)\{[^{}]*\}(?:\[[^\]\n]*\]|\{[^{}]*\})*")
_CODE_OPEN = regex.compile(rf"^<(?:{CODE_TAGS}|code|tt|kbd|samp)\b[^>]*>|</(?:{CODE_TAGS}|code|tt|kbd|samp)\s*>$", regex.I)
_INNER_CODE = regex.compile(r"\A\s*<code\b[^>]*>|</code\s*>\s*\Z", regex.I)
_SPAN = regex.compile(_MARK + r"(\d+);")
_FORMULAS = ("dollar", "dollars", "mathtag", "mathenv", "mathdelim")
_CODES = ("codetag", "fence", "codeenv", "indented")
#: Templates that only dress their last or first argument.
_LAST, _FIRST = frozenset(("lang", "transl", "transliteration")), frozenset(("nowrap", "nobr", "nobreak", "small", "big", "smaller", "larger", "em", "strong", "math", "mvar", "abbr"))


def _references(t: str) -> str:
    """Character references, also those escaped twice; pairs of escaped dressing tags go, other escaped tags become text."""
    for _ in range(2):
        if _REFERENCE.search(t):
            t = _until_still(_DRESSED, r"\2", html.unescape(t))
    return t


def _template(m: regex.Match) -> str:
    name, *args = (x.strip() for x in m.group(1).split("|"))
    if args and name.lower() in _LAST:
        return args[-1]
    return args[0] if args and name.lower() in _FIRST else ""


def _wiki_link(m: regex.Match) -> str:
    body = m.group(1)
    return "" if _DROPPED_LINK.match(body) else (body.rpartition("|")[2].strip() or body.partition("|")[0].strip()).lstrip(":")


def _until_still(pattern: regex.Pattern, by, t: str) -> str:
    """Innermost first, until nothing matches."""
    while (new := pattern.sub(by, t)) != t:
        t = new
    return t


def plain(t: str, tex: bool = False) -> str:
    """A line without its inline markup."""
    t = _REF.sub("", t)
    t = _BREAK.sub(" ", t)
    t = _TAG.sub("", t)
    t = _until_still(_TEMPLATE, _template, t)
    t = _until_still(_LINK, _wiki_link, t)
    t = _MD_TARGET.sub("", t)
    t = _OUTER.sub(lambda m: m.group(1) or "", t)
    t = _until_still(_MD_LINK, lambda m: m.group(1) or m.group(2) or "", t)
    if "\\" in t:
        t = _ENVIRONMENT.sub("", t)
        before = None
        while t != before:
            before = t
            t = _TEX_GONE.sub("", t)
            t = _TEX_LINK.sub(r"\1", t)
            t = _TEX_GROUP.sub(r"\1", t)
            t = _TEX_ARGUMENT.sub(r"\1", t)
        t = _TEX_OPEN.sub("", t)
        t = _TEX_DECLARATION.sub(lambda m: _TEX_WORDS.get(m.group(1), ""), t)
        t = regex.sub(r"\\\\[ \t]*$", "", t)
    if tex:
        t = regex.sub(r"(?<=\S)~(?=\S)", " ", t)
    t = _SWITCH.sub("", t)
    t = _until_still(_STAR, lambda m: m.group(1) or m.group(2), t)
    t = _TOKENS.sub("", t)
    return regex.sub(r"[ \t]{2,}", " ", _references(t)).strip()


def _fenced(body: str) -> str:
    body = body.strip("\n")
    marks = "`" * max(3, 1 + max((len(x) for x in regex.findall(r"`+", body)), default=0))
    return f"\n{marks}\n{body}\n{marks}\n"


def _code(kind: str, raw: str) -> str:
    """What a code block holds."""
    if kind == "codetag":
        wiki = regex.match(r"<(?:source|syntaxhighlight)\b", raw, regex.I)
        body = _INNER_CODE.sub("", _CODE_OPEN.sub("", raw))
        return body if wiki else html.unescape(body)
    if kind == "fence":
        lines = raw.split("\n")
        return "\n".join(lines[1:-1] if len(lines) > 2 and regex.match(r"\s*[`~]{3,}[`~]*\s*$", lines[-1]) else lines[1:])
    if kind == "codeenv":
        return regex.sub(r"\A\\begin\{[^{}]*\}(?:\[[^\]\n]*\])?|\\end\{[^{}]*\}\Z", "", raw)
    return regex.sub(r"(?m)^ {4}", "", raw)


def _formula(kind: str, raw: str) -> str:
    if kind == "mathtag":
        inner = regex.sub(r"\A<math\b[^>]*>|</math\s*>\Z", "", raw, flags=regex.I)
        if "<" in inner and regex.search(r"<m[a-z]+\b", inner):
            return raw
        own = regex.match(r"<math\b[^>]*display\s*=\s*[\"']?block", raw, regex.I)
        inner = html.unescape(inner).strip()
        return f"$${inner}$$" if own else f"${inner}$"
    if kind == "mathenv":
        return f"$${raw}$$"
    if kind == "mathdelim":
        inner = raw[2:-2].strip()
        return f"$${inner}$$" if raw[1] == "[" else f"${inner}$"
    return f"$${raw.strip('$').strip()}$$" if kind == "dollars" else raw


def _span(kind: str, raw: str, label: str | None) -> str:
    """A held span as it comes out; ``label`` is that of the block it is."""
    if kind in _FORMULAS:
        return _formula(kind, raw) if label == "formula" else raw
    if kind in _CODES:
        body = _code(kind, raw)
        return _fenced(body) if label == "code" else body
    if kind == "nowiki":
        return regex.sub(r"\A<nowiki\s*>|</nowiki\s*>\Z", "", raw, flags=regex.I)
    if kind == "codespan":
        return html.unescape(_CODE_OPEN.sub("", raw))
    if kind == "tick":
        return raw.strip("`").strip()
    if kind == "verb":
        return regex.sub(r"\A\\(?:verb|lstinline)\*?", "", raw)[1:-1]
    if kind == "escape":
        return raw[1:]
    return raw if kind == "private" else ""


def _over_lines(reduced: str) -> list[tuple[int, int]]:
    """Ranges of templates and notes that go over several lines, and of tags broken over lines."""
    out, stack = [], []
    for m in regex.finditer(r"(?<![\\\w}])\{\{(?=\s*[\w#:])|\}\}", reduced):
        if m.group() == "{{":
            stack.append(m.start())
        elif stack:
            a = stack.pop()
            out.append((a, m.end()))
    out += [m.span() for m in _REF.finditer(reduced)] + [m.span() for m in _TAG.finditer(reduced)]
    return [(a, b) for a, b in out if "\n" in reduced[a:b]]


def _item(block: Block, line: str, body: str, tex: bool) -> str:
    lead = len(line) - len(line.lstrip(" \t"))
    depth, mark = lead // 2, "*"
    if m := regex.match(r"(?:[*#:;]{2,6})(?=[^*#])", body) if block.shape in ("stars", "hashes") else None:
        depth, body = len(m.group()) - 1, body[m.end() :]
    elif block.shape == "li":
        depth = max(0, (block.deep - 1) // 2)
    elif m := regex.match(r"\d{1,9}[.)](?=[ \t])", body):
        mark, body = m.group(), body[m.end() :]
    elif m := regex.match(r"\\item\b(?:\[([^\]\n]*)\])?", body):
        body = f"{m.group(1) or ''} {body[m.end():]}"
    elif m := regex.match(r"[*+#-]+(?=[ \t]|\w|$)|[*#]", body):
        body = body[m.end() :]
    return f"{'  ' * depth}{mark} {plain(body, tex) or body.strip()}"


def _heading(block: Block, after: str, body: str, tex: bool) -> str:
    level = 1
    if m := regex.match(r"(={1,6})(.*?)(={1,6})\s*$", body) if block.shape == "eq" else None:
        level, body = len(m.group(1)), m.group(2)
    elif m := regex.match(r"(#{1,6})[ \t]+(.*?)(?:[ \t]+#+)?\s*$", body):
        level, body = len(m.group(1)), m.group(2)
    elif m := regex.match(r"\\([a-z]+)\*?(?:\[[^\]\n]*\])?\{", body) if block.shape == "sec" else None:
        level = _LEVELS.get(m.group(1), 2)
    elif regex.fullmatch("h[1-6]", block.held):
        level = int(block.held[1])
    elif after == "dashrule":
        level = 2
    return f"{'#' * level} {plain(body, tex) or body.strip()}"


def _rest(shape: str, body: str, tex: bool) -> str:
    """Blocks labelled other: what is text in them."""
    if shape in ("rule", "dashrule", "eqrule", "switch") or regex.match(r"\{\||\|[-}]+", body) and not regex.match(r"\|-+[^|]*[^|\s-][^|]*\|", body):
        return ""
    if shape == "quote":
        body = body.lstrip("> ")
    elif shape == "indent":
        body = body.lstrip(":; ")
    elif shape == "table":
        if regex.fullmatch(r"\|?[\s:|-]*-[\s:|-]*\|?", body):
            return ""
        body = regex.sub(r"\[\[[^\[\]]*\]\]|\{\{[^{}]*\}\}", lambda m: m.group().replace("|", "\ue002"), body)
        cells = regex.split(r"\|\||!!|\|", body.lstrip("|!").rstrip("|"))
        cells = [c for c in cells if not regex.match(r"\s*[a-z-]+\s*=\s*[\"']?[\w%#-]", c)]
        return " | ".join(x for x in (plain(c.replace("\ue002", "|"), tex) for c in cells) if x)
    elif "&" in body and regex.search(r"\\\\\s*$", body):
        return " | ".join(x for x in (plain(c, tex) for c in regex.split(r"(?<!\\)&(?!\w+;)", body)) if x)
    return plain(body, tex)


def render(text: str, found: list[Block], labels: list[str], reduced: str, layout: list) -> str:
    """The clean text of one page that holds markup."""
    label = {id(b): x for b, x in zip(found, labels)}
    after = {id(a): b.shape for a, b in zip(found, found[1:])}
    tex, gone = _TEX.search(text) is not None, bytearray(len(reduced))
    for a, b in _over_lines(reduced):
        gone[a:b] = b"\1" * (b - a)
    out = []
    for piece in layout:
        block = piece.block
        kind = label[id(block)] if block else "text"
        line, n = [], 0
        # Held spans are numbered, so that what goes with a note or template is known.
        for i, ch in enumerate(piece.line):
            if ch == _MARK:
                line.append(f"{_MARK}{n};")
                n += 1
            elif kind in UNITS or not gone[piece.at + i]:
                line.append(ch)
        line = "".join(line)
        body = line.strip()
        if kind == "heading":
            new = _heading(block, after.get(id(block), ""), body, tex)
        elif kind == "list_item":
            new = _item(block, line, body, tex)
        elif kind == "code":
            new = _fenced(regex.sub(r"^ {4}", "", line))
        elif kind == "formula":
            new = body
        else:
            new = _rest(block.shape, body, tex) if kind == "other" else plain(body, tex)
        kept = {int(x) for x in _SPAN.findall(new)}
        # A formula or code block is never lost with what it stands in.
        for k, (_, _, unit) in enumerate(piece.spans):
            if k not in kept and unit is not None and label[id(unit)] in ("code", "formula"):
                new += f" {_MARK}{k};"
        shown = [_span(k, raw, label[id(unit)] if unit is not None else None) for k, raw, unit in piece.spans]
        new = _SPAN.sub(lambda m: shown[int(m.group(1))], new)
        # A line that held nothing but markup leaves no line.
        if new.strip() or not piece.line.strip():
            out.append(new)
    return regex.sub(r"\n{3,}", "\n\n", "\n".join(out)).strip("\n")


def clean_texts(texts: list[str], field: crf.Chain | None = None) -> list[str]:
    """Each text rendered from its labelled blocks; texts without markup come out as they are."""
    field = field or model()
    parsed = [scan(t) for t in texts]
    decoded = field.decode([features(p[0], t) for p, t in zip(parsed, texts)])
    return [
        render(t, found, labels, reduced, layout) if marked or any(x != "text" for x in labels) else t
        for t, (found, marked, reduced, layout), labels in zip(texts, parsed, decoded)
    ]


def clean_pages(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, text)``: every row of ``docs`` with its clean text; null stays null.

    Repeated rows come out once; rows without a key are left out; other columns are ignored.
    """
    field = model()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"key": pdf["key"], "text": pd.Series(clean_texts(pdf["text"].tolist(), field), index=pdf.index, dtype=object)})

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("key").isNotNull())
    suspect = F.coalesce(F.col("text").rlike(SUSPECT), F.lit(False))
    cleaned = rows.where(suspect).distinct().mapInPandas(run, f"key {kind}, text string")
    return rows.where(~suspect).distinct().unionByName(cleaned).withColumnRenamed("key", key)
