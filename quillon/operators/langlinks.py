"""Language links: attach to pages, reject, dedupe, enrich."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions.text import langlink_title
from quillon.operators.skew import lookup_join


def attach(raw: DataFrame, id2title: DataFrame, lang: str = "all") -> DataFrame:
    """``(lang, title, title_ll, id_ll)`` of raw links ``(ll_from, ll_lang, ll_title)`` whose page is known."""
    chosen = raw if lang == "all" else raw.where(F.col("ll_lang") == lang)
    known = id2title.select(F.col("id").alias("ll_from"), "target_id", "target_title")
    return lookup_join(chosen, known, "ll_from").select(
        F.col("ll_lang").alias("lang"), langlink_title("ll_title").alias("title"), langlink_title("target_title").alias("title_ll"), F.col("target_id").alias("id_ll")
    )


def rejects(raw: DataFrame, id2title: DataFrame) -> DataFrame:
    return lookup_join(raw, id2title.select(F.col("id").alias("ll_from")), "ll_from", "left_anti").select("ll_from", "ll_lang", "ll_title")


def first_by_title(links: DataFrame) -> DataFrame:
    """``(lang, title, title_ll, id_ll, n)``: one link a language and title – the smallest id –, ``n`` how many there were."""
    return links.groupBy("lang", "title").agg(F.min(F.struct("id_ll", "title_ll")).alias("r"), F.count("*").alias("n")).select("lang", "title", "r.title_ll", "r.id_ll", "n")
