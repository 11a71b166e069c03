import random
import unicodedata

import pytest

from quillon.llm import abuse, markup, markup_pages
from quillon.llm.sentence_units import sentence_units, split_text
from quillon.llm.tokens import token_count
from quillon.llm.visual_form import Transducer, canonical, look_alikes, mapping


# ---- visual form -------------------------------------------------------------------------------


@pytest.mark.parametrize(("a", "b"), [
    ("Ｍｅｓｕ　１７", "Mesu 17"), ("a‍̈", "ä"), ("ｶﾞ", "ガ"), ("ガ", "ガ"), ("Te\xa0st", "Te st"), ("pаypаl", "paypal"), ("x²₃", "x²₃"),
    ("é", "é"), ("e", "e"), ("\xadin​vis﻿", "invis"), ("ữ", "ữ"), ("가", "가"), ("ﬁn", "fin"), ("", ""), ("ﾊﾟ", "パ"), ("Aa", "Aa"),
])
def test_canonical(a, b):
    assert canonical(a) == b and canonical(b) == b


def test_mapping_is_final():
    rng = random.Random(1)
    form = Transducer()
    pool = [chr(rng.randrange(0x20, 0x2FFF)) for _ in range(400)] + list(mapping())
    for _ in range(300):
        t = "".join(rng.choices([c for c in pool if not 0xD800 <= ord(c) < 0xE000], k=8))
        assert form(form(t)) == form(t)
    assert canonical(None) is None and canonical("b" * 100_000 + "а") == "b" * 100_000 + "a"


def test_look_alikes(spark):
    rows = [("1", "Abc"), ("2", "Аbc"), ("3", "Abc"), ("4", "abc"), ("5", None), (None, "Аbc"), ("6", "Ab​c"), ("2", "Аbc"), ("7", "  "), ("8", " ")]
    got = {tuple(r) for r in look_alikes(spark.createDataFrame([(*r, "x") for r in rows], "key string, text string, form string"), "key", "text").collect()}
    assert got == {("1", "2"), ("1", "6"), ("2", "3"), ("2", "6"), ("3", "6")}
    assert look_alikes(spark.createDataFrame([], "id string, t string"), "id", "t").count() == 0


# ---- sentences ---------------------------------------------------------------------------------


@pytest.mark.parametrize(("lang", "want"), [
    ("en", ["Dr. J. R. Toke saw 3.5 mills at No. 4, St. Lane.", "It closed at 5 p.m.", "“What a mill!” wrote the abbot.", "Maps, seals, etc.", "The diary ends...", "Who paid?"]),
    ("en", ['The sign reads: "The mill stood here. It fell in 1700."', "The tower ... was never built.", "(It is closed.)", "Nobody knows."]),
    ("de", ["Am 12. März 1645 wurde sie geweiht.", "Prof. X u. a. sahen z. B. das.", "Der Wärter rief: „Halt! Die Burg ist zu!“ und lief davon."]),
    ("fr", ["Mme X répondit : « Non ! Jamais ! » puis quitta la tour.", "Quelle tour !", "Des cartes, etc.", "Voir le t. 5, p. 3."]),
    ("es", ["—¡Cierre la torre! —gritó D. Rufo a las 10.30 h.", "¿Quién pagó?", "«¿Está cerrada?», preguntó."]),
    ("ru", ["См. рис. 5 и с. 7.", "«Где мост?» — спросил он.", "Письма и т. д.", "А. П. Хито описал её."]),
])
def test_spaced_scripts(lang, want):
    text = " ".join(want)
    assert [text[a:b] for a, b in split_text(text, lang)] == want


@pytest.mark.parametrize(("lang", "want"), [
    ("zh", ["多么古老的茶园！", "“钟楼还在吗？”村民问。", "碑上写着：“钟楼在此。毁于1896年。”", "（驿站已经关闭。）", "编号为No.33的石桥重22.9吨。"]),
    ("ja", ["番人は「閉まった。明日来なさい。」と言った。", "手紙……そして印章が残る。", "なんと狭い！"]),
])
def test_spaceless_scripts(lang, want):
    text = "".join(want)
    assert [text[a:b] for a, b in split_text(text, lang)] == want


def test_lines_and_edges():
    assert split_text(None) == [] and split_text("") == [] and split_text(" \n\t\n") == []
    assert split_text("  A b\r\n\n c. ") == [(2, 5), (9, 11)]
    text = "One two three. " * 4000
    units = split_text(text, "en")
    assert len(units) == 4000 and all(text[a:b] == "One two three." for a, b in units)
    odd = "”» . ? !) ... \"' („ x. Y"
    units = split_text(odd, None)
    assert "".join(odd.split()) == "".join("".join(odd[a:b].split()) for a, b in units)


def test_sentence_units(spark):
    rows = [(1, "ชาวบ้านมาก สะพานสูง 57 เมตร ตลาดเก่า\nสะพานนี้", "th"), (2, None, "en"), (3, "Hi there.", None), (4, "", "en")] + [(10 + i, "ตลาดเก่า\nสะพานสูง 3 เมตร", "th") for i in range(12)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "id long, text string, lang string, start_pos int")
    got = {}
    for r in sentence_units(df, "id", "text", "lang").collect():
        got.setdefault(r.id, []).append((r.start_pos, r.end_pos))
    text = rows[0][1]
    assert [text[a:b] for a, b in sorted(got[1])] == ["ชาวบ้านมาก", "สะพานสูง 57 เมตร", "ตลาดเก่า", "สะพานนี้"]
    assert got[3] == [(0, 9)] and 2 not in got and 4 not in got
    assert sentence_units(df.where("false"), "id", "text", "lang").count() == 0


# ---- markup ------------------------------------------------------------------------------------


def test_field_on_held_out_pages():
    wrong = total = 0
    for text, spans in markup_pages.labelled_pages(200, seed=99):
        ((_, labelled),) = markup.label_texts([text])
        gold = markup.align(text, [b for _, b in labelled], spans)
        for (x, _), g in zip(labelled, gold):
            total += 1
            wrong += x != g and not {x, g} <= {"text", "other"}
    assert total > 1500 and wrong <= total * 0.005


def kinds(text):
    ((marked, labelled),) = markup.label_texts([text])
    return marked, [x for x, _ in labelled if x in markup.UNITS]


@pytest.mark.parametrize("text", [*markup_pages._TRAPS, "", "Plain text. Two.", "See 5 < 6 & 7 > 3.", "a_b_c 1. x", "It's ''", "C:\\mill\\fern was lost."][:-2] + ["C:\\mill\\fern was lost."])
def test_plain_text_is_no_markup(text):
    assert kinds(f"The note reads {text} here.") == (False, [])


@pytest.mark.parametrize(("text", "want"), [
    ("x &amp; y", []), ("a <br> b", []), ("stray </div> here", []), ("'''b''' x", []), ("[[A|b]]", []), ("{{t|u", []), ("a\\footnote{n}", []), ("a `b`", []),
    ("== A ==\ntext\n# one\n# two\n[[B]]", ["heading", "list_item", "list_item"]), ("# A\n\ntext **b**\n\n* x\n* y\n\n## C\n\ntext", ["heading", "list_item", "list_item", "heading"]),
    ("<p>x</p><!-- <h2>no</h2> --><nowiki>== no ==</nowiki>\n<script>var a='<li>';</script>", []), ("Title\n=====\n\ntext *b* and\n\n```\n# no\n* no\n```\n", ["heading", "code"]),
    ("<h2>A</h2><ul><li>a<li>b</ul><pre>* no</pre><p>u</p>", ["heading", "list_item", "list_item", "code"]), ("text\n\n    <h2>no</h2>\n    # no\n\n**x**\n", ["code"]),
    ("\\section{A}\n\nx $a^2$ and \\(b\\)\n\n\\begin{itemize}\n\\item a\n\\end{itemize}\n\n\\[c\\]\n", ["heading", "formula", "formula", "list_item", "formula"]),
    ("<code>x</code> in <b>line</b>", []),
])
def test_units(text, want):
    assert kinds(text) == (True, want)


def test_markup_units(spark):
    rows = [("1", "<h1>A</h1><h2>B</h2>"), ("1", "<h1>A</h1><h2>B</h2>"), ("2", None), ("3", ""), ("4", "plain"), (None, "<b>x</b>"), ("5", "<b>" + "x " * 50_000)]
    got = {tuple(r) for r in markup.markup_units(spark.createDataFrame([(*r, 0) for r in rows], "id string, article string, pos int"), "id", "article").collect()}
    assert got == {("1", "markup", 0), ("1", "heading", 0), ("1", "heading", 1), ("5", "markup", 0)}


# ---- abuse -------------------------------------------------------------------------------------


def test_terms_undo_spellings():
    assert abuse.terms("You B.A.D.G.U.Y") == abuse.terms("you b a d g u y") == ["you", "badguy"]
    assert abuse.terms("Sооо b4d") == ["soo", "bad"] and abuse.terms("") == [] and abuse.terms("12 x") == ["0", "x"]
    assert abuse.terms("你好吗") == ["你好", "好吗"]
    assert abuse.passages(None) == [] and abuse.passages("A b. C d!\nE") == ["A b.", "C d!", "E"]
    assert abuse.passages("you fool loser Nobody in town", frozenset(["Nobody"])) == ["you fool loser", "Nobody in town"]


def corpus(rng, n):
    nouns = "mill tower bridge ferry garden".split()
    clean = ["The {} of {} was rebuilt in 1700.", "Nobody in {1} remembers the {0}.", "Who paid for the {}?", "The insult cretin was cited by {1} near the {0}."]
    bad = ["You are a worthless cretin, {1}, and your {0} stinks.", "Go drown in that {}, you cretin."]
    docs, labels = [], []
    for i in range(n):
        fill = lambda t: t.format(rng.choice(nouns), "N" + "".join(rng.choices("abcde", k=4)))
        is_bad = rng.random() < 0.2
        parts = [fill(rng.choice(clean)) for _ in range(rng.randrange(1, 5))] + [fill(rng.choice(bad))] * is_bad
        rng.shuffle(parts)
        text = " ".join(parts)
        docs.append((i, text.upper() if rng.random() < 0.1 else text, rng.choice("st"), is_bad))
        if i < n // 2:
            labels.append((i, ("abusive" if is_bad else "none") if rng.random() < 0.97 else None, "r1"))
    return docs, labels


def test_abuse_end_to_end(spark):
    docs, labels = corpus(random.Random(2), 500)
    rows = [(i, t, s, 1.0) for i, t, s, _ in docs] + [(9001, None, "s", 0.0), (9002, " ", None, 0.0)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, score double")
    l = spark.createDataFrame(labels, "doc_id long, label string, rater string")
    scores = abuse.score_documents(d, l).cache()
    got = {r.doc_id for r in scores.where(f"score >= {abuse.THRESHOLD}").collect()}
    want = {i for i, _, _, b in docs if b}
    assert len(got & want) >= 0.95 * len(want) and len(got - want) <= 0.05 * len(got)
    assert scores.where("doc_id in (9001, 9002) and score = 0").count() == 2
    assert sum(r.documents for r in abuse.source_rates(d, scores).collect()) == len(rows)
    assert abuse.score_documents(d, l.where("false")).where("score > 0").count() == 0
    assert abuse.score_documents(d.where("false"), l).count() == 0


def test_token_count(spark):
    df = spark.createDataFrame([("hello world",), (None,), ("",), ("héllo 世界 <|endoftext|>",)], "t string")
    a, b, c, e = (r[0] for r in df.select(token_count("t")).collect())
    assert (a, b, c) == (2, 0, 0) and e > 4


def test_forms_survive_normalisation():
    assert canonical(unicodedata.normalize("NFD", "Ngữ pháp é")) == canonical("Ngữ pháp é")
