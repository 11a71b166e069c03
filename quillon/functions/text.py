"""Column functions on titles and mentions (no Python at run time)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python's ``str.strip`` and ``split`` take as white space, as a Java character class.
BLANK = r"[\s\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    """Without outer white space of any kind."""
    return F.regexp_replace(_c(x), rf"^{BLANK}+|{BLANK}+\z", "")


def normalize_title(x: Column | str) -> Column:
    """Title normal form: ``_`` is a blank, outer blanks go, the first letter is upper case.

    Inner runs of blanks stay.  Null stays null, a title of blanks becomes ''.
    """
    t = strip(F.translate(_c(x), "_", " "))
    return F.concat(F.upper(F.substring(t, 1, 1)), t.substr(F.lit(2), F.length(t)))


def langlink_title(x: Column | str) -> Column:
    """Title of a language link: backslashes go, ``_`` is a blank."""
    return F.translate(_c(x), "_\\", " ")


# Words left out of a mention's second variant.
STOP_WORDS = (
    "a an and are as at be by for from has he i in is it its of on that the their we to was were with you your "
    "yours our ours theirs her hers his him mine or but though since"
).split()


def strip_mention(x: Column | str) -> Column:
    """Mention in lower case, without outer blanks and backslashes, inner blanks single."""
    t = F.lower(F.regexp_replace(_c(x), r"[\t\n\r]", " "))
    return F.regexp_replace(F.translate(strip(t), "\\", ""), rf"{BLANK}+", " ")


def expand_mention(x: Column | str) -> Column:
    """Two variants of a stripped mention: without parentheses, tags and punctuation; without stop words."""
    bare = F.regexp_replace(F.regexp_replace(_c(x), r""" \([^)]*\)|<[^)]*>|[,".':-]""", ""), r"\s+", " ")
    words = F.filter(F.split(_c(x), rf"{BLANK}+"), lambda w: ~w.isin(STOP_WORDS))
    return F.array(F.trim(bare), F.array_join(words, " "))


def mention_set(x: Column | str, expand: bool = True) -> Column:
    """Distinct non-empty forms under which a link text is counted; the text itself without ``expand``."""
    if not expand:
        return F.filter(F.array(_c(x)), lambda m: F.length(m) > 0)
    s = strip_mention(x)
    return F.array_distinct(F.filter(F.concat(F.array(s), expand_mention(s)), lambda m: F.length(m) > 0))


def category_names(x: Column | str) -> Column:
    """Names of ``[[Category:…]]`` in raw markup, up to a bar, trimmed; nameless ones are left out."""
    names = F.regexp_extract_all(_c(x), F.lit(r"\[\[Category:([^\[\]|]*)(?:\|[^\[\]]*)?\]\]"), F.lit(1))
    return F.transform(F.filter(names, lambda n: F.length(n) > 0), lambda n: F.trim(n))


def section_marks(x: Column | str) -> Column:
    """Every ``==…==`` mark of a text (the whole match)."""
    return F.regexp_extract_all(_c(x), F.lit(r"((==+)\s*(.*?)\s*\2)"), F.lit(1))


def page_url(base: Column | str, page_id: Column | str) -> Column:
    return F.concat(_c(base), F.lit("?curid="), _c(page_id))


def upper_first(x: Column | str) -> Column:
    return F.concat(F.upper(F.substring(_c(x), 1, 1)), _c(x).substr(F.lit(2), F.length(_c(x))))


def lower_first(x: Column | str) -> Column:
    return F.concat(F.lower(F.substring(_c(x), 1, 1)), _c(x).substr(F.lit(2), F.length(_c(x))))


def namespace_title(x: Column | str) -> Column:
    """Canonical title with both sides of a namespace colon capitalised and blank runs collapsed."""
    t = F.regexp_replace(strip(F.translate(_c(x), "_", " ")), r"\s+", " ")
    head, tail = F.regexp_extract(t, r"^([^:]+):", 1), F.regexp_replace(t, r"^[^:]+:\s*", "")
    return F.when(F.length(head) > 0, F.concat(upper_first(head), F.lit(":"), upper_first(tail))).otherwise(upper_first(t))


def is_disambiguation(markup: Column | str, redirect: Column | str) -> Column:
    """Whether the markup has one of the disambiguation templates and the page is no redirect."""
    found = F.coalesce(_c(markup), F.lit("")).rlike(r"(?i)\{\{disambiguation.*?\}\}|\{\{.*?disambiguation\}\}|\{\{hndis.*?\}\}")
    return found & (F.coalesce(_c(redirect), F.lit("")) == "")


def contains_range(a_start, a_end, b_start, b_end) -> Column:
    """Whether [a_start, a_end) lies within [b_start, b_end)."""
    return (_c(a_start) >= _c(b_start)) & (_c(a_end) <= _c(b_end))


def overlaps_range(a_start, a_end, b_start, b_end) -> Column:
    return F.greatest(_c(a_start), _c(b_start)) < F.least(_c(a_end), _c(b_end))
