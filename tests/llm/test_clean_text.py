import pytest
import regex

from quillon.llm import markup, markup_pages
from quillon.llm.clean_text import clean_pages, clean_texts


@pytest.mark.parametrize(("text", "want"), [
    ("== A ==\ntext [[B|b]] '''c'''<ref>n</ref> {{t|u}}\n# one\n# two\n** deep\n[[Category:B]]", "## A\ntext b c\n* one\n* two\n  * deep"),
    ("# A\n\ntext **b** and `c`, [d](http://e.f)\n\n* x\n* y\n\n### C ###\n\ntext", "# A\n\ntext b and c, d\n\n* x\n* y\n\n### C\n\ntext"),
    ("Title\n=====\n\ntext *b* and\n\n~~~\n# no\n* no\n~~~\n", "# Title\n\ntext b and\n\n```\n# no\n* no\n```"),
    ("<p>x<!-- <h2>no</h2> --> a&amp;b</p><script>var a='<li>';</script>\n<h2>A</h2><ul><li>a<li>b</ul><pre>* &lt;b&gt;</pre><p>u", "x a&b\n\n## A\n* a\n* b\n\n```\n* <b>\n```\n\nu"),
    ("\\section{A}\n\nx $a^2$ and \\emph{\\textbf{b}}~\\cite{k}, \\(c\\)\n\n\\begin{itemize}\n\\item a\n\\end{itemize}\n\n\\[d_1\\]\n", "## A\n\nx $a^2$ and b, $c$\n\n* a\n\n$$d_1$$"),
    ("'''A''' is <nowiki>== no ==</nowiki> and \ue000 too\n{{Infobox\n| a = b\n}}\n<math>x^2</math>", "A is == no == and \ue000 too\n\n$x^2$"),
])
def test_every_syntax(text, want):
    squeeze = lambda t: regex.sub(r"\n+", "\n", t)
    assert squeeze(clean_texts([text])[0]) == squeeze(want)


def test_units_of_held_out_pages_are_kept():
    pages = [t for t, _ in markup_pages.labelled_pages(150, seed=5)]
    for text, out, (_, labelled) in zip(pages, clean_texts(pages), markup.label_texts(pages)):
        kept = set(regex.findall(r"q[a-z]{6}q", out))
        fences = regex.findall(r"(?ms)^(`{3,})\n.*?^\1$", out)
        assert len(fences) == sum(x == "code" for x, _ in labelled)
        for label, block in labelled:
            if label in ("heading", "list_item", "code"):
                words = set(regex.findall(r"q[a-z]{6}q", block.body))
                assert words <= kept, (block.body, out)
        # Plain words are never lost.
        for label, block in labelled:
            if label == "text" and block.shape == "plain" and not regex.search(r"[\[{<\\\ue000]", block.body):
                assert set(regex.findall(r"q[a-z]{6}q", block.body)) <= kept, (block.body, out)


def test_clean_pages(spark):
    rows = [("1", "<h1>A</h1>x"), ("1", "<h1>A</h1>x"), ("2", None), ("3", ""), ("4", "plain"), (None, "<b>x</b>"), ("5", "5 * 3 * 2 = 30"), ("6", "<b>" + "x " * 50_000)]
    got = {r.id: r.text for r in clean_pages(spark.createDataFrame([(*r, 0) for r in rows], "id string, article string, pos int"), "id", "article").collect()}
    assert got == {"1": "# A\nx", "2": None, "3": "", "4": "plain", "5": "5 * 3 * 2 = 30", "6": ("x " * 50_000).strip()}
    assert clean_pages(spark.createDataFrame([], "id string, article string"), "id", "article").count() == 0
