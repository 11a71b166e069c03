"""One consistent form for texts that look the same.

A precomputed mapping sends every code point of interest – full- and half-width
forms, ligatures, odd blanks, invisible characters, look-alike letters, letters with
accents – to its plain parts, and a second one every pair that composes to the
composed character.  Both are checked when they are built: no code point gets two
images, and images are final, so that the form of a form is itself.  They are the
tables of a transducer that reads a text once: it takes the longest run of base and
marks (the grapheme clusters that hold anything but plain characters, found by one
compiled expression), holds back the base and composes it on as far as pairs go, and
writes the rest.  Nothing is normalised at run time; images of clusters are kept for
their next occurrence.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters of other alphabets that common fonts draw like a Latin letter.
LOOKALIKES = (
    # Cyrillic
    ("а", "a"), ("е", "e"), ("о", "o"), ("р", "p"), ("с", "c"), ("у", "y"), ("х", "x"), ("ѕ", "s"), ("і", "i"),
    ("ј", "j"), ("һ", "h"), ("ԁ", "d"), ("ԛ", "q"), ("ԝ", "w"), ("ӏ", "l"),
    ("А", "A"), ("В", "B"), ("Е", "E"), ("К", "K"), ("М", "M"), ("Н", "H"), ("О", "O"), ("Р", "P"), ("С", "C"),
    ("Т", "T"), ("У", "Y"), ("Х", "X"), ("Ѕ", "S"), ("І", "I"), ("Ј", "J"),
    # Greek
    ("α", "a"), ("ο", "o"), ("ν", "v"), ("ρ", "p"),
    ("Α", "A"), ("Β", "B"), ("Ε", "E"), ("Ζ", "Z"), ("Η", "H"), ("Ι", "I"), ("Κ", "K"), ("Μ", "M"), ("Ν", "N"),
    ("Ο", "O"), ("Ρ", "P"), ("Τ", "T"), ("Υ", "Y"), ("Χ", "X"),
    # Armenian, and letters of the phonetic alphabet
    ("օ", "o"), ("Օ", "O"), ("ս", "u"), ("հ", "h"), ("ɑ", "a"), ("ɡ", "g"),
    # Hyphens that only differ in where a line may break
    ("‐", "-"), ("‑", "-"),
    # The kana drawn alike in both syllabaries
    ("へ", "ヘ"),
)
# Invisible although no format character, and visible although one.
INVISIBLE = "͏ᅟᅠ឴឵᠋᠌᠍᠎᠏ㅤ" + "".join(map(chr, range(0xFE00, 0xFE10)))
VISIBLE_FORMATS = range(0x600, 0x606)
# The blocks outside which no code point is a blank, a format character, half or full width or a look-alike.
BLOCKS = (range(0xA0, 0x3400), range(0xA000, 0xAC00), range(0xF900, 0x20000), range(0xE0000, 0xE1000))


def _image_of(ch: str, alike: dict[str, str]) -> str | None:
    """What a code point turns into by the first rule that concerns it; None if none does."""
    kind, decomposed = unicodedata.category(ch), unicodedata.decomposition(ch)
    images = []
    if kind == "Zs" and ch != " ":
        images.append(" ")
    if kind == "Cf" and ord(ch) not in VISIBLE_FORMATS and ch not in "۝܏࣢" or ch in INVISIBLE:
        images.append("")
    if decomposed.startswith(("<wide>", "<narrow>")) and not images or "ﬀ" <= ch <= "ﬆ":
        images.append(unicodedata.normalize("NFKC", ch))
    if ch in alike:
        images.append(alike[ch])
    if len(set(images)) > 1:
        raise ValueError(f"conflicting images of U+{ord(ch):04X}: {images}")
    return images[0] if images else None


@cache
def mapping() -> dict[str, str]:
    """Code point to final image, for all code points that have one."""
    alike: dict[str, str] = {}
    for a, b in LOOKALIKES:
        if alike.setdefault(a, b) != b:
            raise ValueError(f"conflicting look-alikes of U+{ord(a):04X}")
    found = {chr(c): image for block in BLOCKS for c in block if (image := _image_of(chr(c), alike)) is not None}
    for ch, image in found.items():
        for _ in range(4):
            image = "".join(found.get(x, x) for x in unicodedata.normalize("NFD", image))
        if any(x in found for x in image):
            raise ValueError(f"no final image of U+{ord(ch):04X}")
        found[ch] = unicodedata.normalize("NFC", image)
    return found


@cache
def parts() -> dict[str, str]:
    """Code point to the bases and marks it is read as, for all that are not read as themselves."""
    image = mapping()
    found = {}
    for block in BLOCKS:
        for c in block:
            ch = chr(c)
            plain = unicodedata.normalize("NFD", "".join(image.get(x, x) for x in unicodedata.normalize("NFD", ch)))
            if plain != ch:
                found[ch] = plain
    return found


@cache
def pairs() -> dict[tuple[str, str], str]:
    """Two characters to the one they compose to; syllables of jamo follow by arithmetic."""
    found: dict[tuple[str, str], str] = {}
    for block in BLOCKS:
        for c in block:
            split = unicodedata.decomposition(chr(c)).split()
            if len(split) == 2 and split[0][0] != "<":
                both = (chr(int(split[0], 16)), chr(int(split[1], 16)))
                if unicodedata.normalize("NFC", "".join(both)) == chr(c) and found.setdefault(both, chr(c)) != chr(c):
                    raise ValueError(f"conflicting compositions of {both}")
    for lead in range(19):
        for vowel in range(21):
            found[chr(0x1100 + lead), chr(0x1161 + vowel)] = chr(0xAC00 + (lead * 21 + vowel) * 28)
    for syllable in range(0xAC00, 0xD7A4, 28):
        for final in range(1, 28):
            found[chr(syllable), chr(0x11A7 + final)] = chr(syllable + final)
    return found


@cache
def classes() -> dict[str, int]:
    """Combining classes of the marks that have one: marks of different classes look alike in any order."""
    return {chr(c): k for block in BLOCKS for c in block if (k := unicodedata.combining(chr(c)))}


class Transducer:
    """Compiled longest-match rewriting of grapheme clusters; ``images`` keeps what was seen."""

    #: Clusters kept at most; the set is emptied beyond it, which changes no result.
    KEPT = 200_000

    def __init__(self):
        self.parts, self.pairs, self.classes = parts(), pairs(), classes()
        gone = "".join(map(regex.escape, (c for c, image in mapping().items() if not image)))
        # Marks, voicing marks of half-width kana and vowel and final jamo of either width stay with their base.
        joined = rf"[\p{{M}}ﾞﾟ\u1160-\u11ff\ud7b0-\ud7fb\uffa0-\uffdc{gone}]"
        self.cluster = regex.compile(rf"[^\x00-\x7f]{joined}*|[\x00-\x7f]{joined}+")
        self.images: dict[str, str] = {}

    def image(self, cluster: str) -> str:
        """Reads the cluster once; ``base`` is held back while it composes, ``marks`` wait for the next base in order of class."""
        out: list[str] = []
        base, marks = "", []
        for ch in cluster:
            for x in self.parts.get(ch, ch):
                k = self.classes.get(x, 0)
                if k:
                    at = len(marks)
                    while at and marks[at - 1][0] > k:
                        at -= 1
                    marks.insert(at, (k, x))
                    continue
                if marks:
                    base, marks = self._compose(base, marks)
                both = self.pairs.get((base, x)) if not marks else None
                if both is not None:
                    base = both
                else:
                    out.append(base)
                    out.extend(m for _, m in marks)
                    base, marks = x, []
        base, marks = self._compose(base, marks)
        return "".join(out) + base + "".join(m for _, m in marks)

    def _compose(self, base: str, marks: list[tuple[int, str]]) -> tuple[str, list[tuple[int, str]]]:
        """The base with every mark that composes with it and is not kept from it by one of its own class."""
        left, last = [], 0
        for k, x in marks:
            both = self.pairs.get((base, x)) if base and k != last else None
            if both is not None:
                base = both
            else:
                left.append((k, x))
                last = k
        return base, left

    def __call__(self, text: str) -> str:
        if text.isascii():
            return text
        images = self.images
        if len(images) > self.KEPT:
            images.clear()

        def one(m):
            cluster = m.group()
            if (found := images.get(cluster)) is None:
                found = images[cluster] = self.image(cluster)
            return found

        return self.cluster.sub(one, text)


@cache
def _transducer() -> Transducer:
    return Transducer()


def canonical(text: str | None) -> str | None:
    """The consistent form of a text; null for null.  Case, digits' height and visible accents stay."""
    return None if text is None else _transducer()(text)


def _rewrite(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    form = _transducer()
    for texts in batches:
        yield texts.map(lambda t: None if t is None else form(t))


def canonical_form(text: str) -> Column:
    """``canonical`` of a column.  ASCII texts, which are their own form, are not sent to Python."""
    rewrite = F.pandas_udf(_rewrite, "string")
    return F.coalesce(rewrite(F.when(F.col(text).rlike(r"[^\x00-\x7f]"), F.col(text))), F.col(text))


def look_alikes(items: DataFrame, key: str, text: str) -> DataFrame:
    """``(key_a, key_b)``, key_a < key_b: keys that carry different texts of the same form.

    Distinct pairs.  Rows with a null key or text, repeated rows and identical texts
    give nothing; an empty table gives an empty result; other columns are ignored.
    Texts are compared without outer blanks, which cannot be seen; texts that are
    empty after that are no case.
    """
    kept = _mixed(items, key, text)
    # A form carried by very many rows is paired in blocks: one side split by salt, the other sent to every part.
    a = kept.withColumn("salt", F.pmod(F.xxhash64("key"), F.col("parts"))).select("form", "salt", F.col("key").alias("key_a"), F.col("text").alias("text_a"))
    b = kept.select("form", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("salt"), F.col("key").alias("key_b"), F.col("text").alias("text_b"))
    return a.join(b, ["form", "salt"]).where("key_a < key_b and text_a <> text_b").select("key_a", "key_b").distinct()


#: Rows of one form and of one part of it that meet all others of the form in a task.
PART_ROWS = 5000


def _mixed(items: DataFrame, key: str, text: str) -> DataFrame:
    """``(form, key, text, parts)`` of the forms that are written in two ways; no other can pair."""
    rows = items.select(F.col(key).alias("key"), F.col(text).alias("text")).where("key is not null and text is not null").distinct()
    forms = rows.withColumn("form", F.trim(canonical_form("text"))).where("form <> ''")
    mixed = forms.groupBy("form").agg(F.min("text").alias("lo"), F.max("text").alias("hi"), F.ceil(F.count("*") / PART_ROWS).alias("parts"))
    return forms.join(mixed.where("lo <> hi").select("form", "parts"), "form")


def look_alike_classes(items: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, text, form, others)``: each row of a form that is written in two ways, with the number of its other rows of another text.

    The linear counterpart of ``look_alikes`` for forms on very many keys: rows of one ``form``
    are one class, and rows of a class pair if their texts differ.  Nulls, repeats and blanks as there.
    """
    kept = _mixed(items, key, text).drop("parts")
    same = kept.groupBy("form", "text").agg(F.count("*").alias("same"))
    whole = same.groupBy("form").agg(F.sum("same").alias("whole"))
    return kept.join(same.join(whole, "form").select("form", "text", (F.col("whole") - F.col("same")).alias("others")), ["form", "text"]).select("key", "text", "form", "others")
