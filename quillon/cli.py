"""Command line: ``python -m quillon.cli COMMAND …`` reads dumps and writes Parquet tables."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quillon.operators import graph, kb, langlinks, mentions, pages, sentences
from quillon.sources import dumps, sinks


def _pages(spark, a):
    ranges = dumps.chunks_of(a.index_range) if a.index_range else [(r.beg, r.end) for r in dumps.plan_chunks(dumps.read_index(spark, a.index)).orderBy("beg").collect()]
    parsed = dumps.parse_pages(pages.main_namespace(dumps.read_multistream(spark, a.dump, ranges)))
    sinks.write_table(parsed, a.out + "/pages")
    stored = spark.read.parquet(a.out + "/pages")
    titles = pages.title_table(stored)
    sinks.write_table(titles, a.out + "/titles", sort=["title"])
    titles = spark.read.parquet(a.out + "/titles")
    valid = pages.redirects(titles)
    for name, df in (("redirects", valid), ("id2title", pages.id_to_title(titles, valid)), ("articles", pages.articles(titles, valid)), ("disambiguations", pages.disambiguations(titles))):
        sinks.write_table(df, f"{a.out}/{name}")
    for name, df in pages.page_tables(stored).items():
        sinks.write_table(df, f"{a.out}/by_{name}", sort=["v"])
    plain = stored.withColumn("links", F.transform("links", lambda x: x.withField("id", F.lit(None).cast("string"))))
    sinks.write_table(pages.resolve_links(pages.page_links(plain), titles, valid), a.out + "/links", sort=["title"])


def _entities(spark, a):
    sinks.write_table(dumps.read_entities(spark, a.dump), a.out + "/entities", sort=["id"])
    e = spark.read.parquet(a.out + "/entities")
    kb.assert_unique(e, "id")
    sinks.write_table(kb.triples(kb.claims_long(e)), a.out + "/triples", by=["p"], sort=["s", "o"])
    for name, df in kb.key_tables(e).items():
        sinks.write_table(df, f"{a.out}/by_{name}", sort=["v"])


def _mentions(spark, a):
    links = spark.read.parquet(a.links)
    allowed = dumps.read_json_map(spark, a.allow).select(F.col("k").alias("id")) if a.allow else None
    counts = mentions.mention_counts(mentions.valid_links(links, allowed), not a.no_expand, threshold=a.threshold)
    sinks.write_table(counts, a.out + "/counts", sort=["mention"])
    counts = spark.read.parquet(a.out + "/counts")
    for name, df in (("by_mention", mentions.score(counts, "mention")), ("by_title", mentions.score(counts, "title")), ("prior", mentions.entity_prior(counts))):
        sinks.write_table(df, f"{a.out}/{name}")


def _graph(spark, a):
    e = graph.edges(spark.read.parquet(a.links))
    sinks.write_table(e, a.out + "/edges", sort=["src", "dst"])
    sinks.write_table(graph.inlinks(e), a.out + "/inlinks", sort=["title", "source"])


def _langlinks(spark, a):
    raw, known = dumps.read_langlinks(spark, a.dump), spark.read.parquet(a.id2title)
    sinks.write_table(langlinks.attach(raw, known, a.lang), a.out + "/langlinks", by=["lang"])
    sinks.write_rejects(langlinks.rejects(raw, known), a.out + "/rejects")


def _annotate(spark, a):
    sinks.write_annotated(sentences.annotate_pages(spark.read.parquet(a.pages).withColumn("lang", F.lit(a.lang))), a.out)


def _sentences(spark, a):
    p, s = spark.read.parquet(a.pages), spark.read.parquet(a.annotated)
    known = spark.read.parquet(a.langlinks).select("title", "id_ll", "title_ll").groupBy("title").agg(F.min_by(F.struct("id_ll", "title_ll"), "id_ll").alias("l")).select("title", "l.*")
    sinks.write_table(sentences.full_rows(p, s, known), a.out + "/sentences", sort=["title", "start_pos", "end_pos"])
    rows = spark.read.parquet(a.out + "/sentences")
    for name, df in sentences.sentence_tables(rows).items():
        sinks.write_table(df, f"{a.out}/by_{name}", sort=df.columns[:-1])


COMMANDS = {
    "pages": (_pages, ["dump", "index", "out"], {"--index-range": None}), "entities": (_entities, ["dump", "out"], {}),
    "mentions": (_mentions, ["links", "out"], {"--allow": None, "--threshold": 0, "--no-expand": False}), "graph": (_graph, ["links", "out"], {}),
    "langlinks": (_langlinks, ["dump", "id2title", "out"], {"--lang": "all"}), "sentences": (_sentences, ["pages", "annotated", "langlinks", "out"], {}), "annotate": (_annotate, ["pages", "out"], {"--lang": "en"}),
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)
    for name, (_, places, options) in COMMANDS.items():
        p = sub.add_parser(name)
        for x in places:
            p.add_argument(x)
        for x, default in options.items():
            p.add_argument(x, **({"action": "store_true"} if default is False else {"default": default, "type": type(default) if default is not None else str}))
    a = parser.parse_args(argv)
    COMMANDS[a.command][0](spark or SparkSession.builder.getOrCreate(), a)


if __name__ == "__main__":
    main()
