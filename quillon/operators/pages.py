"""Title tables of a page dump: redirects, ids, articles, resolved links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.operators.skew import lookup_join


def latest(df: DataFrame, key: str = "id", at: str = "loaded_at", keep: str = "min") -> DataFrame:
    """One row a key: rows delivered again differ in ``at`` only, so the first delivery is kept.

    Ties are settled by taking any of the equal rows; rows with a null key are kept together as one.
    """
    first = F.min_by if keep == "min" else F.max_by
    rest = [c for c in df.columns if c != key]
    # Keys hardly repeat, so combining before the shuffle would only sort everything twice.
    return df.repartition(key).groupBy(key).agg(first(F.struct(*rest), at).alias("r")).select(key, "r.*")


def main_namespace(raw: DataFrame) -> DataFrame:
    return raw.where("ns = '0'")


def title_table(pages: DataFrame) -> DataFrame:
    """``(title, id, redirect, disambiguation)``: one row a title, the numerically lowest id wins.

    Later pages of the same title are skipped whole.  Null titles give no row.
    """
    number = F.struct(F.col("id").cast("decimal(38,0)").alias("n"), F.col("id").alias("i"))
    rest = F.struct("id", F.nullif("redirect", F.lit("")).alias("redirect"), F.coalesce("disambiguation", F.lit(False)).alias("disambiguation"))
    return pages.where("title is not null and id is not null").groupBy("title").agg(F.min_by(rest, number).alias("r")).select("title", "r.*")


def redirects(titles: DataFrame) -> DataFrame:
    """``(title, target)`` of the redirects whose target is a title."""
    known = titles.select(F.col("title").alias("target"))
    return lookup_join(titles.where("redirect is not null").select("title", F.col("redirect").alias("target")), known, "target", "left_semi").select("title", "target")


def dangling_redirects(titles: DataFrame) -> DataFrame:
    known = titles.select(F.col("title").alias("target"))
    return lookup_join(titles.where("redirect is not null").select("title", F.col("redirect").alias("target")), known, "target", "left_anti").select("title", "target")


def follow_redirects(valid: DataFrame, max_hops: int = 1) -> DataFrame:
    """``(title, target, hops)`` after up to ``max_hops`` steps; loops stop where the steps run out."""
    out = valid.select("title", "target", F.lit(1).alias("hops"))
    for hop in range(2, max_hops + 1):
        step = valid.select(F.col("title").alias("target"), F.col("target").alias("next"))
        out = lookup_join(out, step, "target", "left").select("title", F.coalesce("next", "target").alias("target"), F.when(F.col("next").isNotNull(), F.lit(hop)).otherwise(F.col("hops")).alias("hops"))
    return out


def id_to_title(titles: DataFrame, valid: DataFrame) -> DataFrame:
    """``(id, target_id, target_title)``: every title's id with the id and title one redirect further."""
    at = lookup_join(titles.select("id", "title"), valid, "title", "left").select("id", F.col("title").alias("own"), F.col("target").alias("title"))
    ids = titles.select("title", F.col("id").alias("target_id"))
    own = titles.select("id", F.col("id").alias("own_id"))
    return lookup_join(at, ids, "title", "left").join(own, "id").select(
        "id", F.coalesce("target_id", "own_id").alias("target_id"), F.coalesce("title", "own").alias("target_title")
    )


def articles(titles: DataFrame, valid: DataFrame) -> DataFrame:
    """``(id, title)`` of the titles that are neither valid redirects nor disambiguations."""
    return titles.where("not disambiguation").join(valid.select("title"), "title", "left_anti").select("id", "title")


def disambiguations(titles: DataFrame) -> DataFrame:
    return titles.where("disambiguation").select("title").orderBy("title")


def page_links(pages: DataFrame, kind: str = "links") -> DataFrame:
    """One row a link: ``(page_id, page_title, pos, …)``; null links arrays give none, null elements one of nulls."""
    return pages.select(F.col("id").alias("page_id"), F.col("title").alias("page_title"), F.posexplode(kind).alias("pos", "link")).select("page_id", "page_title", "pos", "link.*")


def resolve_links(links: DataFrame, titles: DataFrame, valid: DataFrame) -> DataFrame:
    """``links`` with ``title`` one redirect further and ``id`` looked up by it (null if no page has it)."""
    step = valid.select("title", "target")
    moved = lookup_join(links.drop("id"), step, "title", "left").withColumn("title", F.coalesce("target", "title")).drop("target")
    return lookup_join(moved, titles.select("title", "id"), "title", "left").select(*[c for c in links.columns if c != "id"], "id")


def regroup_links(links: DataFrame) -> DataFrame:
    """Links back to one array a page, in their order."""
    item = F.struct("pos", F.struct("text", "start_pos", "end_pos", "title", "id").alias("link"))
    return links.groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["link"]).alias("links"))


def side_tables(pages: DataFrame) -> dict[str, DataFrame]:
    """Exploded look-up tables in place of multi-key indexes, each clustered by its key."""
    return {
        "page_links": page_links(pages),
        "page_sections": pages.select(F.col("id").alias("page_id"), F.posexplode("sections").alias("pos", "s")).select("page_id", "pos", "s.*"),
        "page_categories": pages.select(F.col("id").alias("page_id"), F.explode("categories").alias("category")),
    }


def page_tables(pages: DataFrame, source: str = "all") -> dict[str, DataFrame]:
    """Covering tables in place of the indexes of pages: ``(v, id)`` by each key, ``links_title`` with both titles.

    Write each clustered and sorted by ``v``; null keys give no row.  Links as parsed have no id yet, so no ``links_id``.
    """
    out = {k: pages.select(F.col(k).alias("v"), "id") for k in ("id", "title", "redirect", "disambiguation")}
    out["_chunk_id"] = pages.select(F.lit(source).alias("v"), "id")
    out["categories"] = pages.select(F.explode("categories").alias("v"), "id")
    sections, links = pages.select("id", F.explode("sections").alias("s")), pages.select("id", "title", F.explode("links").alias("l"))
    out |= {f"sections_{k}": sections.select(F.col(f"s.{k}").alias("v"), "id") for k in ("text", "title", "level")}
    out |= {f"links_{k}": links.select(F.col(f"l.{k}").alias("v"), "id", "title") for k in links.select("l.*").columns if k in ("id", "title", "text")}
    return {name: df.where("v is not null") for name, df in out.items()}
