"""Markup that never closes is read in linear time, and as the single expression would read it."""

import time

import pytest

from quillon.llm import markup, markup_pages


@pytest.mark.parametrize("unit", ["<math> x ", "\\begin{equation} ", "<!-- ", "\\[ a ", "<code>x ", "<script> ", "``x ", "<pre", "~~~", "<li>", "\\( "])
def test_unclosed_marks(unit):
    """Half a megabyte; trying every mark again up to the end would take minutes."""
    began = time.time()
    markup.scan("</math> --> \\] \\)\n" + unit * (500_000 // len(unit)))
    assert time.time() - began < 20


def test_same_spans():
    texts = [t for t, _ in markup_pages.labelled_pages(150, seed=9)] + ["<math>a</math> <math>b", "<PRE>x", "İ <math>a</MATH> <!-- b --> <!--", "$$a$$ $b$ `c` ``d", "", "    x\n\n    y"]
    for t in texts:
        assert [m.span() for m in markup._opaque(t)] == [m.span() for m in markup._OPAQUE.finditer(t)]
