"""Queries of the page family: titles, redirects, links, mentions, graph, markup, sentences."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions import text as T
from quillon.functions import wikitext
from quillon.operators import graph, langlinks, mentions, pages, sentences
from quillon.storage import Scratch


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _pages(spark, sf, *cols) -> DataFrame:
    """Each page once, only the columns asked for."""
    return pages.latest(_table(spark, sf, "page").select("id", *cols, "loaded_at")).drop("loaded_at")


def _titles(spark, sf) -> DataFrame:
    return pages.title_table(_pages(spark, sf, "title", "redirect", "disambiguation"))


def _links(spark, sf, *fields) -> DataFrame:
    """Links of each page once; only the fields asked for are read and shuffled."""
    fields = fields or ("text", "start_pos", "end_pos", "title", "id")
    p = _table(spark, sf, "page").select("id", "title", F.arrays_zip(*[f"links.{f}" for f in fields]).alias("links"), "loaded_at")
    return pages.page_links(pages.latest(p))


def _kept(spark, name: str, df: DataFrame) -> DataFrame:
    """A table that several joins read, written once."""
    return Scratch(spark, name).put(df, name)


def titles_dedup(spark, sf):
    return _titles(spark, sf)


def redirects_valid(spark, sf):
    return pages.redirects(_kept(spark, "titles", _titles(spark, sf)))


def redirects_dangling(spark, sf):
    return pages.dangling_redirects(_kept(spark, "titles", _titles(spark, sf)))


def redirects_two_hops(spark, sf):
    return pages.follow_redirects(_kept(spark, "valid", pages.redirects(_kept(spark, "titles", _titles(spark, sf)))), 2)


def id2title(spark, sf):
    titles = _kept(spark, "titles", _titles(spark, sf))
    return pages.id_to_title(titles, _kept(spark, "valid", pages.redirects(titles)))


def articles(spark, sf):
    titles = _kept(spark, "titles", _titles(spark, sf))
    return pages.articles(titles, pages.redirects(titles))


def disambiguations(spark, sf):
    return pages.disambiguations(_titles(spark, sf))


def links_resolved(spark, sf):
    titles = _kept(spark, "titles", _titles(spark, sf))
    links = _kept(spark, "links", _links(spark, sf, "title", "id").drop("page_title"))
    return pages.resolve_links(links, titles, pages.redirects(titles))


def links_regrouped(spark, sf):
    """Resolved links back in their pages: how many, and their titles in order."""
    titles = _kept(spark, "titles", _titles(spark, sf))
    links = _kept(spark, "links", _links(spark, sf).drop("page_title"))
    out = pages.regroup_links(pages.resolve_links(links, titles, pages.redirects(titles)))
    return out.select("page_id", F.size("links").cast("bigint").alias("n"), F.array_join(F.transform("links", lambda x: F.coalesce(x["title"], F.lit(""))), "|").alias("titles"))


def page_links(spark, sf):
    return _links(spark, sf).select("page_id", "pos", "text", "start_pos", "end_pos", "title", "id")


def page_sections(spark, sf):
    return pages.side_tables(_pages(spark, sf, "title", "sections", "links", "categories"))["page_sections"]


def link_counters(spark, sf):
    return graph.link_counters(_links(spark, sf, "id"))


def outlinks(spark, sf):
    return graph.outlinks(graph.edges(_links(spark, sf, "title", "id")))


def inlinks(spark, sf):
    return graph.inlinks(graph.edges(_links(spark, sf, "title", "id")))


def edge_degrees(spark, sf):
    return graph.degrees(_table(spark, sf, "edge").where("src is not null and dst is not null").select("src", "dst").distinct())


def page_categories(spark, sf):
    return graph.page_categories(_pages(spark, sf, "title", "categories"))


def mention_counts(spark, sf):
    return mentions.mention_counts(mentions.valid_links(_links(spark, sf, "text", "title", "id")))


def mention_counts_raw(spark, sf):
    return mentions.mention_counts(mentions.valid_links(_links(spark, sf, "text", "title", "id")), expand=False)


def mention_threshold(spark, sf):
    return mentions.mention_counts(mentions.valid_links(_links(spark, sf, "text", "title", "id")), threshold=2)


def mention_allow_list(spark, sf):
    allowed = _table(spark, sf, "article")
    return mentions.mention_counts(mentions.valid_links(_kept(spark, "links", _links(spark, sf, "text", "title", "id")), allowed))


def _scores(spark, sf, given):
    counts = _kept(spark, "counts", mention_counts(spark, sf))
    return mentions.score(counts, given).withColumn("p", F.round("p", 9))


def mention_to_entity(spark, sf):
    return _scores(spark, sf, "mention")


def entity_to_mention(spark, sf):
    return _scores(spark, sf, "title")


def entity_prior(spark, sf):
    return mentions.entity_prior(_kept(spark, "counts", mention_counts(spark, sf))).withColumn("p", F.round("p", 9))


def mention_nysiis(spark, sf):
    from quillon.functions.phonetic import nysiis

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(nysiis)

    return mentions.mention_counts(mentions.valid_links(_links(spark, sf, "text", "title", "id")), encode=lambda c: F.pandas_udf(run, "string")(c))


def titles_normalized(spark, sf):
    t = _table(spark, sf, "page").where("title is not null").select("title").distinct()
    return t.select("title", T.normalize_title(F.concat(F.lit(" _"), F.translate(T.lower_first("title"), " ", "_"), F.lit("_ "))).alias("normal"), T.langlink_title(F.concat("title", F.lit("_\\'x"))).alias("langlink"), T.page_url(F.lit("http://wiki.example/"), F.length("title").cast("string")).alias("url"), T.upper_first("title").alias("upper"), T.lower_first("title").alias("lower"))


def namespace_titles(spark, sf):
    t = _table(spark, sf, "page").where("title is not null").select("title").distinct()
    return t.select("title", T.namespace_title(F.concat(F.lit("talk:_ "), F.lower("title"))).alias("full"))


def category_markup(spark, sf):
    """Categories read back from markup made of the page's own categories."""
    p = _pages(spark, sf, "categories").where("size(categories) > 0")
    markup = F.array_join(F.transform("categories", lambda c: F.concat(F.lit("[[Category: "), c, F.lit("|key]] x "))), "")
    return p.select("id", F.array_join(T.category_names(markup), "|").alias("names"))


def section_marks(spark, sf):
    p = _pages(spark, sf, "title").where("title is not null")
    return p.select("id", F.array_join(T.section_marks(F.concat(F.lit("==A== "), F.lit("=== "), "title", F.lit(" ==="))), "|").alias("marks"))


def disambiguation_flag(spark, sf):
    p = _pages(spark, sf, "title", "redirect").where("title is not null")
    kind = F.pmod(F.length("title"), F.lit(4))
    markup = F.when(kind == 0, "{{Disambiguation|geo}}").when(kind == 1, "{{Place name disambiguation}}").when(kind == 2, "a {{hndis|x}}").otherwise("{{geodis}}")
    return p.select("id", T.is_disambiguation(markup, "redirect").alias("flag"))


def main_namespace(spark, sf):
    p = _pages(spark, sf, "title").withColumn("ns", F.when(F.length("title") % 3 == 0, "0").otherwise("14"))
    return pages.main_namespace(p).select("id")


def _parsed(spark, sf, markup):
    """Pages whose markup is made of their title, parsed."""
    from quillon.sources.dumps import parse_pages

    raw = _pages(spark, sf, "title").where("title is not null").select("id", "title", F.lit("0").alias("ns"), F.lit(None).cast("string").alias("redirect"), markup.alias("markup"))
    return parse_pages(raw)


_PAGE_MARKUP = ("'''", "''' is a [[", "|thing]] of [http://x.example/a Site]. {{x|{{y}}}}<ref>n</ref>\n== Empty ==\n== Part ==\nBody <b>bold</b> &amp; {| t |}end.\n[[Category:", "]]\n{{Infobox a|{{b}}}}")


def parsed_articles(spark, sf):
    a, b, c, d = _PAGE_MARKUP
    out = _parsed(spark, sf, F.concat(F.lit(a), "title", F.lit(b), F.lower("title"), F.lit(c), "title", F.lit(d)))
    link, outer, sec = F.col("links")[0], F.col("external_links")[0], F.col("sections")[0]
    return out.select("id", "article", "infobox", F.size("links").cast("bigint").alias("n_links"), link["text"].alias("link_text"), link["start_pos"].alias("link_start"), link["title"].alias("link_title"),
                      outer["url"].alias("url"), outer["start_pos"].alias("url_start"), sec["title"].alias("section"), sec["level"].alias("level"), F.array_join("categories", "|").alias("categories"), F.col("error").isNull().alias("fine"))


def _cleaned(spark, sf, make, clean):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(clean)

    p = _pages(spark, sf, "title").where("title is not null")
    return p.select("id", F.pandas_udf(run, "string")(make).alias("text"))


def clean_templates(spark, sf):
    return _cleaned(spark, sf, F.concat(F.lit("a {{b {{"), "title", F.lit("}} d}} "), "title", F.lit(" b }} c")), wikitext.clean)


def clean_quotes(spark, sf):
    return _cleaned(spark, sf, F.concat(F.lit("'''"), "title", F.lit("''' and ''"), "title", F.lit("''")), wikitext.clean)


def clean_tags(spark, sf):
    return _cleaned(spark, sf, F.concat(F.lit("A<ref name=\"x\">q</ref>B<!-- c --><b>"), "title", F.lit("</b><br /><div class=\"n\">gone</div>C&nbsp;D")), wikitext.clean)


def clean_formulas(spark, sf):
    return _cleaned(spark, sf, F.concat(F.lit("<math>"), "title", F.lit("</math> <math>b</math>,, x.....,.")), wikitext.clean)


def compact_sections(spark, sf):
    make = F.concat(F.lit("== A ==\n== "), "title", F.lit(" ==\n=== B ===\n(note)\n| cell\ntext\n: ind\n== C =="))
    return _cleaned(spark, sf, make, lambda t: "\n".join(wikitext.compact(t, True)))


def expand_templates(spark, sf):
    def run(t):
        return wikitext.expand_templates(t, {"T": "<{{{1}}}-{{{k|d}}}>"})

    return _cleaned(spark, sf, F.concat(F.lit("{{T|"), "title", F.lit("}} {{#if:x|{{uc:"), "title", F.lit("}}|n}} {{#expr:1+2*3}} {{none}}")), run)


def strip_markup(spark, sf):
    return _cleaned(spark, sf, F.concat(F.lit("[[File:a.jpg|thumb|cap]]'''"), "title", F.lit("''' {{t}}[[A|b]] ( )<ref>r</ref>")), wikitext.strip_markup)


def articles_cleaned(spark, sf):
    """The left-over markup of every article put through the cleaner."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda t: wikitext.parse_page(t)["article"])

    return _pages(spark, sf, "article").select("id", F.pandas_udf(run, "string")("article").alias("article"))


def annotated_sentences(spark, sf):
    """Sentences of every page that is no redirect, by the reference rule."""
    out = sentences.annotate_pages(_pages(spark, sf, "title", "lang", "redirect", "article", "links"))
    return out.select("id", F.explode("sentences").alias("s")).select("id", "s.start", "s.end", "s.paragraph_index", F.size("s.tokens").cast("bigint").alias("n_tokens"))


def title_tokens(spark, sf):
    t = _table(spark, sf, "page").where("title is not null").select("title").distinct()
    tokens = sentences.token_column("title")
    return t.select("title", F.array_join(F.transform(tokens, lambda x: x["text"]), "|").alias("tokens"))


def zh_sentences(spark, sf):
    from quillon.functions.annotate import split_chinese

    return _cleaned(spark, sf, F.concat("title", F.lit("。"), "title", F.lit("！丙")), lambda t: "|".join(split_chinese(t)))


def _sentence_rows(spark, sf):
    a = pages.latest(_table(spark, sf, "annotated").select("id", "sentences", "loaded_at"))
    return sentences.sentence_rows(sentences.sentence_links(_pages(spark, sf, "links"), a))


def sentence_rows(spark, sf):
    r = _sentence_rows(spark, sf)
    return r.select("_id", "id", "len_char", "len_links", F.array_join(F.transform("links", lambda x: F.concat_ws(":", F.coalesce(x["text_lower"], F.lit("")), x["start_pos"].cast("string"))), "|").alias("links"))


def _raw_langlinks(spark, sf):
    """Language links as a dump lists them: page id, language, title with ``_`` and an escaped quote."""
    p = _pages(spark, sf, "title", "lang").where("title is not null and lang is not null")
    return p.select(F.col("id").alias("ll_from"), F.col("lang").alias("ll_lang"), F.concat(F.replace("title", F.lit(" "), F.lit("_")), F.lit("\\'")).alias("ll_title"))


def langlinks_attached(spark, sf):
    raw = _kept(spark, "raw", _raw_langlinks(spark, sf))
    return langlinks.attach(raw, _kept(spark, "id2title", id2title(spark, sf)))


def langlinks_rejected(spark, sf):
    raw = _kept(spark, "raw", _raw_langlinks(spark, sf))
    return langlinks.rejects(raw, _kept(spark, "id2title", id2title(spark, sf))).select("ll_lang", "ll_title")


def langlinks_dedup(spark, sf):
    return langlinks.first_by_title(langlinks_attached(spark, sf))


def sentence_langlinks(spark, sf):
    a = pages.latest(_table(spark, sf, "annotated").select("id", "sentences", "loaded_at"))
    rows = _kept(spark, "rows", sentences.sentence_links(_pages(spark, sf, "links"), a))
    by_title = _titles(spark, sf).select("title", F.col("id").alias("id_ll"))
    return sentences.enrich(rows.select("id", "n", "links"), by_title)


def sentence_full_rows(spark, sf):
    """Sentence rows with the language links of page and links; every title's upper-case form stands for its language link."""
    a = pages.latest(_table(spark, sf, "annotated").select("id", "sentences", "loaded_at"))
    known = _kept(spark, "known", _titles(spark, sf).select("title", F.col("id").alias("id_ll"), F.upper("title").alias("title_ll")))
    r = sentences.full_rows(_pages(spark, sf, "title", "article", "links"), a, known)
    links = F.array_join(F.transform("links", lambda x: F.concat_ws(":", F.coalesce(x["text_lower"], F.lit("")), F.coalesce(x["id_ll"], F.lit("-")))), "|")
    return r.select("_id", "id", "title", "id_ll", "len_char", "len_links", "len_links_ll", links.alias("links"))


def links_unmatched(spark, sf):
    """Links no sentence contains whole, by their spans."""
    a = pages.latest(_table(spark, sf, "annotated").select("id", "sentences", "loaded_at"))
    out = sentences.unmatched_links(_pages(spark, sf, "links"), a)
    return out.select("id", F.explode("links").alias("l")).select("id", "l.start_pos", "l.end_pos")


def chunk_plan(spark, sf):
    """Byte ranges over an index whose offsets grow with the titles' lengths."""
    from quillon.sources.dumps import plan_chunks

    index = _table(spark, sf, "page").where("title is not null").select((F.length("title") * 7 + F.ascii("title") * 1000).cast("bigint").alias("offset"))
    return plan_chunks(index, 100)


_NAMES = (
    titles_dedup, redirects_valid, redirects_dangling, redirects_two_hops, id2title, articles, disambiguations, links_resolved, links_regrouped,
    page_links, page_sections, link_counters, outlinks, inlinks, edge_degrees, page_categories, mention_counts, mention_counts_raw,
    mention_threshold, mention_allow_list, mention_to_entity, entity_to_mention, entity_prior, mention_nysiis, titles_normalized,
    namespace_titles, category_markup, section_marks, disambiguation_flag, main_namespace, parsed_articles, clean_templates, clean_quotes,
    clean_tags, clean_formulas, compact_sections, expand_templates, strip_markup, articles_cleaned, annotated_sentences, title_tokens,
    zh_sentences, sentence_rows, langlinks_attached, langlinks_rejected, langlinks_dedup, sentence_langlinks, sentence_full_rows, links_unmatched, chunk_plan,
)


def queries():
    return {f.__name__: f for f in _NAMES}


def oracle_sql() -> dict[str, str]:
    from quillon.plans import encyclopedia_sql

    return encyclopedia_sql.oracle_sql()
