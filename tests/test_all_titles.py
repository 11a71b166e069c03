"""The queries on made markup run over every page with a title, whatever its script."""

from datetime import datetime

import pytest

from quillon.plans import encyclopedia

TITLES = ("Plain Title", "Ébène 12", "茶园钟楼", "Мост (река)", "A/B-c, d.e", "สะพาน 7", "C++", "ßa", "\"Q\" & R", "𐐨x", "बाग!")
WANTED = {
    "clean_templates": lambda t: f"a {t} b }}}} c",
    "clean_quotes": lambda t: f'{t} and "{t}"',
    "clean_tags": lambda t: f"AB{t}goneC\xa0D",
    "clean_formulas": lambda t: "formula_1 formula_2, x....",
    "compact_sections": lambda t: f"=={t}==\n===B===\ntext\n ind",
    "expand_templates": lambda t: f"<{t}-d> {t.upper()} 7 ",
    "strip_markup": lambda t: f"{t} b\ncap.",
    "zh_sentences": lambda t: f"{t}。|{t}！|丙",
}


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("titles"))
    rows = [(str(i), t, datetime(2024, 1, 1)) for i, t in enumerate(TITLES)]
    rows += [("0", TITLES[0], datetime(2024, 2, 1)), ("99", None, datetime(2024, 1, 1))]
    spark.createDataFrame(rows, "id string, title string, loaded_at timestamp").write.parquet(f"{at}/page.parquet")
    return at


@pytest.mark.parametrize("name", sorted(WANTED))
def test_made_markup(spark, pages, name):
    got = {r.id: r.text for r in encyclopedia.queries()[name](spark, pages).collect()}
    assert got == {str(i): WANTED[name](t) for i, t in enumerate(TITLES)}
