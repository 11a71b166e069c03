"""Labelled pages for the markup field: composed by rule, so every block's label is known.

Each unit holds a serial word ``q……q`` that names its label.  The four syntaxes are
mixed with what looks like markup but is none, unclosed and stray marks, blank lines
that are left out, and units inside code, comments and escaped passages.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

#: Bound of the labelled sample the field is fitted on.
TRAINING_PAGES = 900

_FORMULAS = ("x_{i+1} = x_i - 1", "a^2 + b^2", "\\frac{1}{2} m", "p < q", "\\sqrt{2}", "n", "\\alpha + \\beta", "y = 3")
_CODE = ("for k in v:\n    go(k)", "# note\nrun()", "== no ==\n* y", "echo $A and $B\n- x", "<h2>t</h2>\n<li>u</li>", "\\section{t}\nint x = 3;", "x = [1, 2]\n\ny = x")


class _Page:
    def __init__(self, rng: random.Random):
        self.rng, self.labels, self.count = rng, [], 0

    def word(self, label: str) -> str:
        """A serial word no other block of the page has."""
        self.count += 1
        n, letters = self.rng.randrange(26**3) * 1000 + self.count, []
        for _ in range(6):
            n, d = divmod(n, 26)
            letters.append(chr(97 + d))
        w = "q" + "".join(letters) + "q"
        self.labels.append((w, label))
        return w

    def few(self, label: str) -> str:
        return " ".join([self.word(label), *self.rng.choices(("tor", "mira lo", "ken", "väl", "рот", "桥楼", "ubi"), k=self.rng.randrange(3))])

    def sentence(self, inline: tuple[str, ...], label: str = "text") -> str:
        r = self.rng
        words = [self.word(label), *r.choices(("the", "old", "mill", "was", "seen", "near", "town", "1733", "大きな", "башня"), k=r.randrange(4, 14))]
        if inline and r.random() < 0.35:
            words.insert(r.randrange(1, 5), r.choice(inline))
        if r.random() < 0.12:  # captions, fragments, lines of verse
            return " ".join(words[: r.randrange(1, 6)])
        return " ".join(words) + r.choice((".", ".", "!", "?", "。"))

    def paragraph(self, inline: tuple[str, ...]) -> str:
        return " ".join(self.sentence(inline) for _ in range(self.rng.randrange(1, 4)))


_TRAPS = ("5 * 3 * 2 = 30", "$20 and $30", "C# minor", "ranked #1", "a < b and c > d", "file_name_old", "R&D", "& Co.", "C:\\tmp\\x", "2^10 | 7", "3 ~ 4", "[sic]", "(7; 9}")
_INLINES = {
    "html": ("<b>x</b>", "a&nbsp;b", "<br>", "&amp;", "<i>y", "<!-- <h2>z</h2> -->", "<span class='k'>u</span>"),
    "md": ("**x**", "`y`", "[a](http://b.c)", "[a][r-1]", "~~u~~", "__w__", "![i](j.png)"),
    "wiki": ("[[A|b]]", "'''x'''", "''y''", "{{t|u}}", "<ref>n</ref>", "<nowiki>== z ==</nowiki>", "[http://b.c d]", "&nbsp;"),
    "tex": ("\\textbf{x}", "\\emph{y}", "~\\cite{k1}", "\\footnote{n}", "{\\it z}", "\\href{http://b.c}{d}", "\\verb|x|"),
    "plain": _TRAPS,
}


def _inner(p: _Page, syntax: str, inline: tuple[str, ...]) -> str:
    """One block of a page in the given syntax."""
    r = p.rng
    kind = r.choice(("text", "text", "heading", "list", "code", "formula", "other"))
    if syntax == "plain" or kind == "text":
        body = p.paragraph(inline)
        return f"<p>{body}</p>" if syntax == "html" and r.random() < 0.8 else body
    if kind == "heading":
        t = p.few("heading")
        if syntax == "html":
            n = r.randrange(1, 7)
            return r.choice((f"<h{n}>{t}</h{n}>", f'<h{n} id="s"><span>{t}</span></h{n}>', f"<H{n}>{t}</H{n}>"))
        if syntax == "wiki":
            marks, gap = "=" * r.randrange(2, 6), r.choice(("", " "))
            return f"{marks}{gap}{t}{gap}{marks}" + r.choice(("", " "))
        if syntax == "tex":
            return f"\\{r.choice(('chapter', 'section', 'subsection', 'section*', 'paragraph'))}{{{t}}}"
        marks = "#" * r.randrange(1, 7)
        return r.choice((f"{marks} {t}", f"{marks} {t} {marks}", f"{t}\n{r.choice('=-') * 8}"))
    if kind == "list":
        n = r.randrange(1, 6)
        if syntax == "html":
            tag = r.choice(("ul", "ol"))
            close, gap = r.choice(("</li>", "")), r.choice(("", "\n"))
            return f"<{tag}>{gap}" + gap.join(f"<li>{p.few('list_item')}{close}" for _ in range(n)) + f"{gap}</{tag}>"
        if syntax == "tex":
            env = r.choice(("itemize", "enumerate"))
            return f"\\begin{{{env}}}\n" + "\n".join(f"\\item {p.few('list_item')}" for _ in range(n)) + f"\n\\end{{{env}}}"
        mark = r.choice("*#") if syntax == "wiki" else r.choice(("*", "-", "+", "1."))
        rows = []
        for k in range(n):
            sub = k and r.random() < 0.3
            if syntax == "wiki":
                rows.append(f"{mark * (2 if sub else 1)} {p.few('list_item')}")
            else:
                rows.append(f"{'  ' if sub else ''}{f'{k + 1}.' if mark == '1.' else mark} {p.few('list_item')}")
        return "\n".join(rows)
    if kind == "code":
        body = f"{p.word('code')}\n{r.choice(_CODE)}"
        if syntax == "html":
            return r.choice((f"<pre>{body}</pre>", f"<pre><code>{body}</code></pre>", f'<PRE class="s">{body}</PRE>'))
        if syntax == "wiki":
            return r.choice((f"<pre>\n{body}\n</pre>", f'<source lang="c">\n{body}\n</source>', f'<syntaxhighlight lang="python">\n{body}\n</syntaxhighlight>'))
        if syntax == "tex":
            env = r.choice(("verbatim", "lstlisting"))
            return f"\\begin{{{env}}}\n{body}\n\\end{{{env}}}"
        fence = r.choice(("```", "~~~"))
        if r.random() < 0.6:
            return f"{fence}{r.choice(('', 'python'))}\n{body}\n{fence}"
        return "\n" + "\n".join("    " + x for x in body.replace("\n\n", "\n").split("\n")) + "\n"
    if kind == "formula":
        f, t = r.choice(_FORMULAS), p.sentence(())
        if syntax == "html":
            return r.choice((f"<p>{t}</p><div class=\"math\">\\[{f}\\]</div>", "<p><math><mi>x</mi><mo>=</mo></math></p>"))
        if syntax == "wiki":
            return r.choice((f"{t} <math>{f}</math>", f'{t} <math display="block">{f}</math>'))
        if syntax == "tex":
            return r.choice((f"{t} ${f}$", f"\\[{f}\\]", f"\\begin{{equation}}\n{f}\n\\end{{equation}}", f"\\begin{{align*}}\n{f}\n\\end{{align*}}"))
        return r.choice((f"{t} ${f}$", f"$${f}$$", f"$$\n{f}\n$$"))
    w = p.word("other")
    if syntax == "html":
        return r.choice((f"<blockquote>{p.few('other')}</blockquote>", f"<table><tr><td>{w}</td><td>{p.word('other')}</td></tr></table>", "<hr>", '<script>var x = "<h3>";</script>', f"<div class='n'>{w}</div>"))
    if syntax == "wiki":
        return r.choice((f'{{| class="wikitable"\n! {w}\n|-\n| {p.word("other")}\n|}}', f"[[Category:{w}]]", f"{{{{main|{w}}}}}", "__TOC__", f"<!-- == {w} == -->", f"{{{{unclosed|{w}", f"<gallery>\n{w}.png\n</gallery>"))
    if syntax == "tex":
        return r.choice((f"\\begin{{tabular}}{{ll}}\n{w} & {p.word('other')} \\\\\n\\end{{tabular}}", "\\maketitle", f"% {w}"))
    return r.choice((f"| {w} | {p.word('other')} |\n|---|---|\n| 1 | 2 |", f"> {p.few('other')}", "***", "---"))


def labelled_pages(n: int, seed: int) -> Iterator[tuple[str, list[tuple[str, str]]]]:
    """``(text, [(serial word, label), …])`` of ``n`` pages, the same for the same seed."""
    rng = random.Random(seed)
    for _ in range(n):
        page = _Page(rng)
        syntax = rng.choice(("html", "md", "wiki", "tex", "plain"))
        inline = _INLINES[syntax] + (_TRAPS[:3] if rng.random() < 0.3 else ())
        gap = rng.choice(("\n", "\n\n", "\n\n"))
        if syntax in ("md", "tex"):
            gap = "\n\n"
        parts = [_inner(page, syntax, inline) for _ in range(rng.randrange(2, 12))]
        tail = [page.sentence(("A", "B")) for _ in range(rng.randrange(0, 4))]
        yield gap.join(parts) + "\n" * rng.randrange(1, 3) + "\n".join(tail), page.labels
