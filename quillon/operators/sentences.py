"""Sentence rows: links within their sentence, lengths, language links."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions.annotate import annotate, tokenize
from quillon.operators.skew import lookup_join
from quillon.storage import Scratch

TOKENS = "array<struct<text:string,start:int,end:int>>"


def annotate_pages(pages: DataFrame) -> DataFrame:
    """``(id, title, sentences)`` of the pages that are no redirects and have a sentence.

    Links that cross a boundary join its sentences; null articles and links count as empty.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, t, lang, text, links in zip(pdf["id"], pdf["title"], pdf["lang"], pdf["article"], pdf["spans"]):
                spans = [(a["start_pos"], a["end_pos"]) for a in (links if links is not None else []) if a is not None and a["start_pos"] is not None and a["end_pos"] is not None]
                found = annotate(text or "", spans, lang)
                if found:
                    out.append((i, t, found))
            yield pd.DataFrame(out, columns=["id", "title", "sentences"])

    rows = pages.where("redirect is null or redirect = ''").select("id", "title", "lang", "article", F.transform("links", lambda x: F.struct(x["start_pos"], x["end_pos"])).alias("spans"))
    return rows.mapInPandas(run, f"id string, title string, sentences array<struct<start:int,end:int,paragraph_index:int,tokens:{TOKENS}>>")


def sentence_links(pages: DataFrame, sentences: DataFrame) -> DataFrame:
    """One row a sentence ``(id, n, start_pos, end_pos, paragraph_index, links)`` with the links it contains, rebased.

    The sentences of a page and its links meet on the page id; each link is kept by
    the sentences that contain it whole.
    """
    s = sentences.select("id", F.posexplode("sentences").alias("n", "s")).select("id", "n", "s.*")
    inside = F.filter("links", lambda x: (x["start_pos"] >= F.col("start_pos")) & (x["end_pos"] <= F.col("end_pos")))
    rebased = F.transform(inside, lambda x: F.struct(x["text"].alias("text"), (x["start_pos"] - F.col("start_pos")).alias("start_pos"), (x["end_pos"] - F.col("start_pos")).alias("end_pos"), x["title"].alias("title"), x["id"].alias("id"), F.lower(x["text"]).alias("text_lower")))
    return s.join(pages.select("id", "links"), "id").select("id", "n", "start_pos", "end_pos", "paragraph_index", F.coalesce(rebased, F.array().cast(_LINKS)).alias("links"))


_LINKS = "array<struct<text:string,start_pos:int,end_pos:int,title:string,id:string,text_lower:string>>"


def sentence_rows(rows: DataFrame, source: str = "all") -> DataFrame:
    """With the derived ids and lengths: ``_id, _chunk_id, len_char, len_links``."""
    return rows.select(
        F.concat_ws("_", "id", F.col("n").cast("string")).alias("_id"), F.lit(source).alias("_chunk_id"), "id", "start_pos", "end_pos", "paragraph_index",
        (F.col("end_pos") - F.col("start_pos")).alias("len_char"), F.size("links").alias("len_links"), "links",
    )


def enrich(rows: DataFrame, langlinks: DataFrame) -> DataFrame:
    """``(id, n, len_links, len_links_ll)``: how many of a sentence's links have a language link.

    ``langlinks`` has one row a title.
    """
    flat = rows.select("id", "n", F.explode_outer("links").alias("l")).select("id", "n", F.col("l.title").alias("title"), F.col("l").isNotNull().alias("real"))
    joined = lookup_join(flat, langlinks.select("title", "id_ll"), "title", "left")
    return joined.groupBy("id", "n").agg(F.count_if("real").alias("len_links"), F.count("id_ll").alias("len_links_ll"))


def full_rows(pages: DataFrame, sentences: DataFrame, langlinks: DataFrame, source: str = "all") -> DataFrame:
    """Sentence rows as a store keeps them: ids, title, lengths, and language links of the page and of every link.

    ``pages`` has ``id, title, article, links``, ``langlinks`` one row a title (``title, id_ll,
    title_ll``).  Columns: ``_id, _chunk_id, id, title, id_ll, title_ll, start_pos, end_pos,
    paragraph_index, len_char, len_tokens, len_links, len_links_ll, links``; each link also
    carries ``text_lower, id_ll, title_ll``.  A null article gives null ``len_tokens``; links keep their order.
    """
    tmp = Scratch(pages.sparkSession, "sentences")
    rows = tmp.put(sentence_links(pages, sentences), "rows")
    flat = tmp.put(rows.select("id", "n", F.posexplode("links").alias("pos", "l")).select("id", "n", "pos", "l.title", "l"), "links")
    found = lookup_join(flat, langlinks.select("title", "id_ll", "title_ll"), "title", "left")
    item = F.struct("pos", F.col("l").withField("id_ll", F.col("id_ll")).withField("title_ll", F.col("title_ll")).alias("l"))
    links = found.groupBy("id", "n").agg(
        F.transform(F.array_sort(F.collect_list(item)), lambda x: x["l"]).alias("links"), F.count("*").cast("int").alias("len_links"), F.count("id_ll").cast("int").alias("len_links_ll"),
    )
    own = langlinks.select("title", F.col("id_ll").alias("own_id"), F.col("title_ll").alias("own_title"))
    heads = tmp.put(pages.select("id", "title", "article"), "heads")
    texts = rows.drop("links").join(heads, "id").withColumn("len_tokens", F.size(token_column(F.expr("substring(article, start_pos + 1, end_pos - start_pos)")))).drop("article")
    texts = texts.withColumn("len_tokens", F.when(F.col("len_tokens") >= 0, F.col("len_tokens")))
    return (
        texts.join(links, ["id", "n"], "left").join(own, "title", "left")
        .select(
            F.concat_ws("_", "id", F.col("n").cast("string")).alias("_id"), F.lit(source).alias("_chunk_id"), "id", "title", F.col("own_id").alias("id_ll"), F.col("own_title").alias("title_ll"),
            "start_pos", "end_pos", "paragraph_index", (F.col("end_pos") - F.col("start_pos")).alias("len_char"), "len_tokens",
            F.coalesce("len_links", F.lit(0)).alias("len_links"), F.coalesce("len_links_ll", F.lit(0)).alias("len_links_ll"), F.coalesce("links", F.array().cast(links.schema["links"].dataType)).alias("links"),
        )
    )


def sentence_tables(rows: DataFrame) -> dict[str, DataFrame]:
    """Covering tables in place of the indexes of sentence rows: one a key, one row a sentence (or a link of it).

    Write each clustered and sorted by its first columns; the row itself is found by ``_id``.
    """
    plain = {k: rows.select(F.col(k).alias("v"), "_id") for k in ("_chunk_id", "id", "title", "id_ll", "title_ll", "len_links", "len_tokens", "len_char", "len_links_ll")}
    flat = rows.select("_id", F.explode("links").alias("l"))
    linked = {f"links_{k}": flat.select(F.col(f"l.{k}").alias("v"), "_id") for k in ("id", "title", "text", "text_lower")}
    spans = {"title_start": ["title", "start_pos"], "title_end": ["title", "end_pos"], "title_start_end": ["title", "start_pos", "end_pos"]}
    tables = {**plain, **linked, **{name: rows.select(*cols, "_id") for name, cols in spans.items()}}
    return {name: df.where(F.col(df.columns[0]).isNotNull()) for name, df in tables.items()}


def unmatched_links(pages: DataFrame, sentences: DataFrame) -> DataFrame:
    """``(id, links)``: spans of a page's links that no sentence contains whole; pages where all are contained give no row."""
    span = lambda x: F.struct(x["start_pos"].alias("start_pos"), x["end_pos"].alias("end_pos"))
    both = pages.select("id", "links").join(sentences.select("id", "sentences"), "id")
    real = F.filter("links", lambda x: x["start_pos"].isNotNull() & x["end_pos"].isNotNull())
    within = F.filter(real, lambda x: F.exists("sentences", lambda s: (x["start_pos"] >= s["start_pos"]) & (x["end_pos"] <= s["end_pos"])))
    left = F.array_except(F.transform(real, span), F.transform(within, span))
    return both.select("id", left.alias("links")).where(F.size("links") > 0)


def token_column(text):
    """Tokens of a text column with offsets."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: None if t is None else [{"text": a, "start": b, "end": e} for a, b, e in tokenize(t)])

    return F.pandas_udf(run, TOKENS)(F.col(text) if isinstance(text, str) else text)
