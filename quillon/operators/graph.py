"""Link graph and page categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def edges(links: DataFrame) -> DataFrame:
    """Distinct ``(src, dst)`` titles of the links whose target has an id."""
    return links.where("id is not null and id <> '' and title is not null and page_title is not null").select(F.col("page_title").alias("src"), F.col("title").alias("dst")).distinct()


def outlinks(e: DataFrame) -> DataFrame:
    """``(title, target)``: one row a distinct link; a hub's targets never meet in one list."""
    return e.select(F.col("src").alias("title"), F.col("dst").alias("target"))


def inlinks(e: DataFrame) -> DataFrame:
    """``(title, source)``: the edges turned round."""
    return e.select(F.col("dst").alias("title"), F.col("src").alias("source"))


def degrees(e: DataFrame) -> DataFrame:
    """``(title, n_out, n_in)`` over distinct edges, summed map-side before any shuffle by title."""
    both = e.select(F.col("src").alias("title"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(e.select(F.col("dst").alias("title"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    return both.groupBy("title").agg(F.sum("o").alias("n_out"), F.sum("i").alias("n_in"))


def page_categories(pages: DataFrame) -> DataFrame:
    """Distinct ``(title, category)``; pages without categories do not appear."""
    return pages.where("title is not null").select("title", F.explode(F.array_distinct("categories")).alias("category")).where("category is not null").distinct()


def link_counters(links: DataFrame) -> DataFrame:
    """``(num_of_links, num_of_invalid_title)``: all links, and those without an id."""
    return links.agg(F.count("*").alias("num_of_links"), F.count_if(F.col("id").isNull() | (F.col("id") == "")).alias("num_of_invalid_title"))
