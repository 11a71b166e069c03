from datetime import datetime

from quillon.plans import encyclopedia

TITLES = ("Plain Title", "ébène 12", "茶园钟楼", "мост (река)", "A/B-c, d.e", "สะพาน 7", "C++", "\"Q\" & R", "𐐨x", "बाग!", "a:b")


def _pages(spark, at):
    rows = [(str(i), t, datetime(2024, 1, 1)) for i, t in enumerate(TITLES)] + [("99", None, datetime(2024, 1, 1))]
    spark.createDataFrame(rows, "id string, title string, loaded_at timestamp").write.parquet(f"{at}/page.parquet")
    return str(at)


def _upper(t):
    return t[:1].upper() + t[1:]


def test_parsed_articles(spark, tmp_path):
    got = {r.id: r for r in encyclopedia.parsed_articles(spark, _pages(spark, tmp_path)).collect()}
    assert set(got) == {str(i) for i in range(len(TITLES))}
    for i, t in enumerate(TITLES):
        r = got[str(i)]
        assert r.article == f"{t} is a thing of Site. \n==Part==\nBody bold & end." and r.fine and r.n_links == 1
        # Offsets count characters, also those outside the basic plane.
        assert r.article[r.link_start :].startswith("thing") and r.article[r.url_start :].startswith("Site")
        assert r.link_title == _upper(t.lower()) and r.categories == t


def test_namespace_titles(spark, tmp_path):
    got = {r.title: r.full for r in encyclopedia.namespace_titles(spark, _pages(spark, tmp_path)).collect()}
    assert got == {t: "Talk:" + _upper(t.lower()) for t in TITLES}
