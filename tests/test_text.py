import pytest
from pyspark.sql import functions as F

from quillon.functions import text as T
from quillon.functions import wikitext as W
from quillon.functions.annotate import annotate, split_chinese, tokenize
from quillon.functions.phonetic import nysiis


def one(spark, make, *values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(make(F.col("x"))).collect()]


def test_titles(spark):
    assert one(spark, T.normalize_title, "apple_inc.", " _foo  bar_ ", "", None, "_") == ["Apple inc.", "Foo  bar", "", None, ""]
    assert one(spark, T.langlink_title, "Foo_\\'bar") == ["Foo 'bar"]
    assert one(spark, T.namespace_title, "talk: foo_bar", "plain  x") == ["Talk:Foo bar", "Plain x"]


def test_mentions(spark):
    assert one(spark, T.strip_mention, " New\tYork\\ City ", "a  b　") == ["new york city", "a b"]
    assert [set(x) for x in one(spark, T.mention_set, "the u.s. (country)", "the", "  ")] == [{"the u.s. (country)", "the us", "u.s. (country)"}, {"the"}, set()]


def test_column_scanners(spark):
    text = "[[Category:Foo|bar]] [[Category: Baz ]] [[category:no]] [[Category:|x]]"
    assert one(spark, T.category_names, text) == [["Foo", "Baz"]]
    assert one(spark, T.section_marks, "==A==\ntext\n=== B ===") == [["==A==", "=== B ==="]]
    flags = one(spark, lambda c: T.is_disambiguation(c, F.lit(None).cast("string")), "{{Disambiguation|geo}}", "{{Place name disambiguation}}", "{{hndis|x}}", "{{geodis}}", None)
    assert flags == [True, True, True, False, False]


@pytest.mark.parametrize(("a", "b"), [
    ("a {{b {{c}} d}} e", "a  e"), ("{{a {{b}} c", " c"), ("a {{x}} b }} c", "a  b }} c"), ("{{x}} a {{b", " a {{b"), ("{{x}} keep {{ {{y}} z {{w", " z {{w"),
])
def test_nested(a, b):
    assert W.drop_nested(a, r"\{\{", r"\}\}") == b


@pytest.mark.parametrize(("a", "b"), [
    ("'''B''' and ''i''", 'B and "i"'), ('A<ref name="x">q</ref>B<ref name="y" />C', "ABC"), ('A<ref name="a/b">q</ref>', 'A<ref name="a/b">q</ref>'),
    ("<math>a</math> <math>b</math>", "formula_1 formula_2"), ("<math>a</math> <math>a</math>", "formula_1 formula_1"), ("&lt;b&gt;x", "x"),
    ("&amp;lt;b&amp;gt;", "<b>"), ("&apos;", "&apos;"), ("&#x41;", "A"), ("&#X41;", "&#X41;"), ("", ""), ("a__TOC__b", "ab"),
])
def test_clean(a, b):
    assert W.clean(a) == b


@pytest.mark.parametrize(("a", "b"), [
    ("== A ==\n\n== B ==\ntext", ["==B==", "text"]), ("== A ==\n=== B ===\ntext", ["==A==", "===B===", "text"]),
    ("== A ==\n: ind\ntext", [" ind", "==A==", "text"]), ("* item\n{| junk\n(note)\n--", ["* item"]),
])
def test_compact(a, b):
    assert W.compact(a, True) == b


def test_page():
    p = W.parse_page("[[car]]s [[A|b|c]] [[File:x.jpg|thumb|cap [[Z]]]][[:Category:X|Y]] [[:Foo]] [http://x.org] [http://x.org Lab el] [[Category:K]] {{Infobox a|{{b}}}}")
    assert p["article"].startswith("cars b|c Y :Foo external_link_1 Lab el")
    assert p["links"] == [("car", 0, 3, "Car"), ("b|c", 5, 8, "A"), (":Foo", 11, 15, ":Foo")]
    assert [x[3] for x in p["external_links"]] == ["http://x.org", "http://x.org"]
    assert p["categories"] == ["K"] and p["infobox"] == "{{Infobox a|{{b}}}}"
    assert W.infobox("{{infobox a") is None and W.parse_page(None)["article"] == ""
    assert W.sections("a == b == c") == [("== b ==", 2, 9, "b", 2)]


def test_templates():
    assert W.expand_templates("x {{T|p|k=v}} {{U}}", {"T": "<{{{1}}}-{{{k|d}}}-{{{z|d}}}>"}) == "x <p-v-d> "
    assert W.expand_templates("{{A}}", {"A": "{{A}}"}) == ""
    assert [W.expression(e) for e in ("1 + 2*3", "7 mod 4", "(2+3)^2 / 5", "1/0", "__import__('os')", "")] == ["7", "3", "5", '<span class="error"></span>', '<span class="error"></span>', ""]
    assert W.parser_function("#switch", ["b", "a", "b=1", "#default=2"]) == "1" and W.parser_function("#ifeq", ["a", "a", "y", "n"]) == "y"
    assert W.template_body("a<noinclude>b</noinclude><includeonly>c</includeonly><!-- d -->") == "ac" and W.template_body("#REDIRECT [[X]]") is None
    assert W.strip_markup("[[File:a.jpg|thumb|cap]]'''T''' {{t}}[[A|b]] ( )<ref>r</ref>") == "T b\ncap."
    assert W.drop_templates("a {{b {{c}} d") == "a " and W.references("x<ref>a</ref><ref name='q'/>") == ["<ref>a</ref>"]


def test_annotation():
    assert tokenize("It's 3.5%!") == [("It's", 0, 4), ("3", 5, 6), (".", 6, 7), ("5", 7, 8), ("%", 8, 9), ("!", 9, 10)]
    assert split_chinese("甲。乙！丙") == ["甲。", "乙！", "丙"]
    found = annotate("Go to New York. Bye.\n\nx", [(6, 14)], "en")
    assert [(s["start"], s["end"], s["paragraph_index"]) for s in found] == [(0, 15, 0), (16, 20, 0), (22, 23, 1)]
    assert annotate("A b. C d.", [(2, 7)])[0]["end"] == 9


def test_nysiis():
    assert [nysiis(x) for x in ("Brian", "Brown", "Brun", "Knight", "MacDonald", "", None, "123")] == ["BRAN", "BRAN", "BRAN", "NAGT", "MCDANALD", "", "", ""]
