import json

from test_sources import mini

from quillon.cli import main
from quillon.streaming.ingest import running_link_counts, stream_entities, stream_pages


def test_pages_to_mentions(spark, tmp_path):
    dump, index = mini(tmp_path)
    out = str(tmp_path / "out")
    main(["pages", dump, index, out], spark)
    assert spark.read.parquet(out + "/pages").count() == 6
    assert {(r.title, r.id) for r in spark.read.parquet(out + "/links").where("page_id = '1'").collect()} == {("A", "1"), ("A#x", None), ("Missing", None)}
    main(["mentions", out + "/links", out + "/m"], spark)
    assert spark.read.parquet(out + "/m/by_mention").where("title = 'A'").count() >= 1
    main(["graph", out + "/links", out + "/g"], spark)
    assert spark.read.parquet(out + "/g/edges").count() >= 1
    main(["annotate", out + "/pages", out + "/a"], spark)
    assert spark.read.json(out + "/a").count() >= 1


def test_entities(spark, tmp_path):
    e = {"id": "Q1", "labels": {"en": {"language": "en", "value": "a"}}, "claims": {"P31": [{"mainsnak": {"snaktype": "value", "datatype": "wikibase-item", "datavalue": {"value": {"id": "Q2"}, "type": "x"}}}]}}
    (tmp_path / "e.json").write_text("[\n" + json.dumps(e) + "\n]\n")
    main(["entities", str(tmp_path / "e.json"), str(tmp_path / "kb")], spark)
    assert [(r.s, r.o) for r in spark.read.parquet(str(tmp_path / "kb/triples")).collect()] == [("Q1", "Q2")]
    assert [r.id for r in spark.read.parquet(str(tmp_path / "kb/by_P31")).where("v = 'Q2'").collect()] == ["Q1"]


def test_streams(spark, sf, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.parquet").symlink_to(sf + "/page.parquet")
    q = running_link_counts(stream_pages(spark, str(tmp_path / "in"))).writeStream.outputMode("complete").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    p = spark.read.parquet(sf + "/page.parquet").dropDuplicates(["id"]).selectExpr("inline(links)").where("title is not null")
    assert spark.table("counts").groupBy().sum("n").first()[0] == p.count()
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text('[\n{"id":"Q1"},\n{"id":"Q2"\n]\n')
    q = stream_entities(spark, str(tmp_path / "lines")).writeStream.format("memory").queryName("ents").start()
    q.processAllAvailable()
    q.stop()
    assert [r.id for r in spark.table("ents").collect()] == ["Q1"]
