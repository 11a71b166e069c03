import bz2
import gzip
import json

from pyspark.sql import functions as F

from quillon.operators import graph, kb, langlinks, mentions, pages
from quillon.operators.skew import lookup_join
from quillon.sources import dumps, sinks

PAGE = '  <page>\n    <title>{t}</title>\n    <ns>{ns}</ns>\n    <id>{i}</id>\n{r}    <revision><text xml:space="preserve">{x}</text></revision>\n  </page>\n'


def mini(tmp_path):
    made = [
        ("A", 0, 1, "", "'''A''' links [[B]] and [[A#x]] and [[Missing|m]].\n[[Category:K]]"), ("B", 0, 2, "A", "#REDIRECT [[A]]"), ("C", 0, 3, "Missing", ""),
        ("D", 0, 4, "", "{{disambiguation}}"), ("E", 0, 5, "B", ""), ("T", 10, 6, "", "template"), ("A", 0, 7, "", "second 𝔸 中文 {{x"),
    ]
    text = [PAGE.format(t=t, ns=ns, i=i, r=f'    <redirect title="{r}" />\n' if r else "", x=x) for t, ns, i, r, x in made]
    parts = [b"<mediawiki>\n", *("".join(text[k : k + 2]).encode() for k in range(0, len(text), 2)), b"</mediawiki>"]
    blob, offsets = b"", []
    for p in parts:
        offsets.append(len(blob))
        blob += bz2.compress(p)
    (tmp_path / "pages.xml.bz2").write_bytes(blob)
    index = "".join(f"{offsets[1 + k // 2]}:{made[k][2]}:{made[k][0]}\n" for k in range(len(made)))
    (tmp_path / "index.txt.bz2").write_bytes(bz2.compress(index.encode()))
    return str(tmp_path / "pages.xml.bz2"), str(tmp_path / "index.txt.bz2")


def test_page_dump(spark, tmp_path):
    path, index = mini(tmp_path)
    plan = [(r.beg, r.end) for r in dumps.plan_chunks(dumps.read_index(spark, index), 2).orderBy("beg").collect()]
    assert len(plan) == 2 and plan[-1][1] == -1 and plan[0][1] == plan[1][0]
    by_range = dumps.read_multistream(spark, path, plan)
    whole = dumps.read_pages_xml(spark, path)
    cols = ["id", "title", "ns", "redirect", "markup"]
    assert {tuple(r) for r in by_range.select(cols).collect()} == {tuple(r) for r in whole.select(cols).collect()} and by_range.count() == 7
    parsed = dumps.parse_pages(pages.main_namespace(by_range)).cache()
    a = parsed.where("id = '1'").first()
    assert a.article == "A links B and A#x and m." and [(k.title, a.article[k.start_pos : k.end_pos]) for k in a.links] == [("B", "B"), ("A#x", "A#x"), ("Missing", "m")]
    assert parsed.where("error is not null").count() == 0 and parsed.where("disambiguation").select("id").first().id == "4"
    titles = pages.title_table(parsed)
    valid = pages.redirects(titles).cache()
    assert {tuple(r) for r in valid.collect()} == {("B", "A"), ("E", "B")}
    assert {tuple(r) for r in pages.id_to_title(titles, valid).collect()} == {("1", "1", "A"), ("2", "1", "A"), ("3", "3", "C"), ("4", "4", "D"), ("5", "2", "B")}
    assert {tuple(r) for r in pages.articles(titles, valid).collect()} == {("1", "A"), ("3", "C")}
    assert [r.title for r in pages.disambiguations(titles).collect()] == ["D"]
    assert {tuple(r) for r in pages.dangling_redirects(titles).collect()} == {("C", "Missing")}
    assert {(r.title, r.target, r.hops) for r in pages.follow_redirects(valid, 3).collect()} == {("B", "A", 1), ("E", "A", 2)}
    links = pages.page_links(parsed.withColumn("links", F.transform("links", lambda x: x.withField("id", F.lit(None).cast("string")))))
    got = {(r.title, r.id) for r in pages.resolve_links(links.where("page_id = '1'"), titles, valid).collect()}
    assert got == {("A", "1"), ("A#x", None), ("Missing", None)}


def test_chunks_of():
    assert dumps.chunks_of("30:10:20") == [(10, 20), (20, 30)]


def test_entities_and_langlinks(spark, tmp_path):
    body = "[\n" + json.dumps({"id": "Q1", "claims": {"P31": []}, "labels": []}) + ",\n" + json.dumps({"id": "P5"}) + "\n{broken\n]\n"
    (tmp_path / "e.json.bz2").write_bytes(bz2.compress(body.encode()))
    e = dumps.read_entities(spark, str(tmp_path / "e.json.bz2"))
    assert {(r.id, tuple(r.properties)) for r in e.collect()} == {("Q1", ("P31",)), ("P5", ())}
    sql = "-- dump\nCREATE TABLE x;\nINSERT INTO `langlinks` VALUES (1,'de','Foo_\\'bar'),(2,'fr','Q'),(3,'es','');\nINSERT INTO `langlinks` VALUES (1,'it','Z');\n"
    with gzip.open(tmp_path / "l.sql.gz", "wt") as f:
        f.write(sql)
    raw = dumps.read_langlinks(spark, str(tmp_path / "l.sql.gz"))
    assert {tuple(r) for r in raw.collect()} == {("1", "de", "Foo_\\'bar"), ("2", "fr", "Q"), ("1", "it", "Z")}
    known = spark.createDataFrame([("1", "9", "X_Y")], "id string, target_id string, target_title string")
    assert {tuple(r) for r in langlinks.attach(raw, known, "de").collect()} == {("de", "Foo 'bar", "X Y", "9")}
    assert {tuple(r) for r in langlinks.rejects(raw, known).collect()} == {("2", "fr", "Q")}


def test_maps_and_sinks(spark, tmp_path):
    pairs = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, v string")
    sinks.write_json_object(pairs, str(tmp_path / "m"))
    assert {tuple(r) for r in dumps.read_json_map(spark, str(tmp_path / "m")).collect()} == {("a", "x"), ("b", "y")}
    sinks.write_table(pairs, str(tmp_path / "t"), by=["k"], sort=["v"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    sinks.write_rejects(pairs, str(tmp_path / "r"))
    assert "a\tx" in "".join(p.read_text() for p in (tmp_path / "r").glob("*.csv"))
    urls = dumps.dump_urls(spark.createDataFrame([("xwiki",)], "site string"), "https://d.example/", "20200101").collect()
    assert len(urls) == 7 and urls[0].url.startswith("https://d.example/xwiki/latest/xwiki-latest") and "20200101" in urls[0].file
    sinks.write_annotated(spark.createDataFrame([("1", []), ("2", ["s"])], "id string, sentences array<string>"), str(tmp_path / "j"))
    assert dumps.read_blocks(spark, str(tmp_path / "j"), "id string, sentences array<string>").count() == 1


def test_mentions(spark):
    counts = spark.createDataFrame([("m1", "A", 3), ("m1", "B", 1), ("m2", "A", 4)], "mention string, title string, n long")
    assert {(r.mention, r.title, r.p) for r in mentions.score(counts, "mention").collect()} == {("m1", "A", 0.75), ("m1", "B", 0.25), ("m2", "A", 1.0)}
    assert {(r.mention, r.title): r.p for r in mentions.score(counts, "title").collect()}[("m1", "A")] == 3 / 7
    assert {tuple(r) for r in mentions.entity_prior(counts).collect()} == {("A", 7 / 8), ("B", 1 / 8)}
    links = spark.createDataFrame([("the U.S.", "US", "1"), ("x", "File:y", "2"), ("x", None, "3"), (None, "US", "4"), ("q", "US", None), ("z", "US", "")], "text string, title string, id string")
    assert {tuple(r) for r in mentions.mention_counts(mentions.valid_links(links)).collect()} == {("the u.s.", "US", 1), ("the us", "US", 1), ("u.s.", "US", 1)}
    assert mentions.mention_counts(mentions.valid_links(links), threshold=1).count() == 0
    assert mentions.valid_links(links, spark.createDataFrame([("4",)], "id string")).count() == 1


def test_graph(spark):
    links = spark.createDataFrame([("A", "B", "2"), ("A", "B", "2"), ("A", "C", None), ("B", "A", "1")], "page_title string, title string, id string")
    e = graph.edges(links)
    assert {tuple(r) for r in e.collect()} == {("A", "B"), ("B", "A")}
    assert graph.link_counters(links).first().num_of_invalid_title == 1
    assert {tuple(r) for r in graph.degrees(e).collect()} == {("A", 1, 1), ("B", 1, 1)}


def test_inversion_and_taxonomy(spark):
    pairs = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "k string, v string")
    assert {tuple(r) for r in kb.invert_list(pairs).collect()} == {("x", "a", 2), ("x", "b", 2), ("y", "a", 1)}
    assert {tuple(r) for r in kb.invert_unique(pairs).collect()} == {("x", "b", 2), ("y", "a", 1)}
    named = spark.createDataFrame([("rc",), ("car",), ("vt",)], "id string")
    p279 = spark.createDataFrame([("rc", "car")], "k string, v string")
    none = p279.where("false")
    assert {tuple(r) for r in kb.taxonomy(p279, none, named).collect()} == {("car", "rc"), ("rc", None)}
    p31 = spark.createDataFrame([("rc", "vt")], "k string, v string")
    assert {tuple(r) for r in kb.taxonomy(p279, p31, named).collect()} == {("car", "vt"), ("vt", None)}
    assert kb.taxonomy(p279, p31, named, prune_instance_leaves=True).count() == 0


def test_hot_keys_split(spark):
    left = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) as k", "id").unionByName(spark.createDataFrame([(None, 1)], "k string, id long"))
    right = spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = sorted(map(str, left.join(right, "k", how).collect()))
        assert sorted(map(str, lookup_join(left, right, "k", how, rows=100).collect())) == plain
