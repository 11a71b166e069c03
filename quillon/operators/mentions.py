"""Mention–entity statistics: counts, conditional scores, priors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions.text import mention_set
from quillon.operators.skew import lookup_join


def valid_links(links: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """Links to an entity: with an id (on the allow-list if given), a title, and no file or image."""
    kept = links.where("id is not null and id <> '' and title is not null and title <> '' and not title rlike '^(File|Image):'")
    return kept if allowed is None else lookup_join(kept, allowed.select("id").distinct(), "id", "left_semi")


def mention_counts(links: DataFrame, expand: bool = True, encode=None, threshold: int = 0) -> DataFrame:
    """``(mention, title, n)``: in how many links a form of the text leads to the title.

    A link counts once for each distinct form.  ``encode`` maps the forms (a phonetic
    key, say).  With a positive ``threshold`` only pairs above it stay.
    """
    forms = links.where("text is not null").select("title", F.explode(mention_set("text", expand)).alias("mention"))
    if encode is not None:
        forms = forms.withColumn("mention", encode("mention"))
    out = forms.groupBy("mention", "title").agg(F.count("*").alias("n"))
    return out.where(F.col("n") > threshold) if threshold > 0 else out


def score(counts: DataFrame, given: str) -> DataFrame:
    """Counts with ``p``: the share of the row in its ``given`` (mention or title)."""
    totals = counts.groupBy(given).agg(F.sum("n").alias("all"))
    # The totals are one row a key; hot keys are split off instead of sorting a window partition.
    return lookup_join(counts, totals, given).select("mention", "title", "n", (F.col("n") / F.col("all")).alias("p"))


def entity_prior(counts: DataFrame) -> DataFrame:
    """``(title, p)``: the title's share of all counts."""
    whole = F.broadcast(counts.agg(F.sum("n").alias("all")))
    return counts.groupBy("title").agg(F.sum("n").alias("n")).join(whole).select("title", (F.col("n") / F.col("all")).alias("p"))
