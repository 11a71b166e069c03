"""Queries of the training-data problems on texts, and the SQL of those SQL can express."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.text import normalize_title
from quillon.llm.abuse import THRESHOLD, score_documents, source_rates
from quillon.llm.clean_text import clean_pages
from quillon.llm.components import page_groups
from quillon.llm.heavy import heavy_hitters
from quillon.llm.markup import markup_units
from quillon.llm.mixing import mix, shares
from quillon.llm.packing import fill_report, pack
from quillon.llm.sentence_units import sentence_units
from quillon.llm.tokens import token_count
from quillon.llm.visual_form import look_alikes
from quillon.storage import Scratch


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return page_groups(_table(spark, sf, "page"), normalize_title("title"), normalize_title("redirect"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    titles = look_alikes(_table(spark, sf, "page"), "id", "title")
    values = (
        _table(spark, sf, "entity").select("id", F.explode(F.map_values("aliases")).alias("a"))
        .select("id", F.explode("a.value").alias("alias"))
    )
    return titles.select(F.lit("title").alias("field"), "key_a", "key_b").unionByName(
        look_alikes(values, "id", "alias").select(F.lit("alias").alias("field"), "key_a", "key_b")
    )


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    links = _table(spark, sf, "page").select("id", F.col("links.title").alias("titles")).where("links is not null")
    titles = links.repartition("id").dropDuplicates(["id"]).select(F.explode("titles").alias("title"))
    return heavy_hitters(Scratch(spark, "links").put(titles, "titles"), "title", 0.005).select(F.col("value").alias("title"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return markup_units(_table(spark, sf, "page"), "id", "article")


def p5_clean_text(spark: SparkSession, sf: str) -> DataFrame:
    """Every page's article as clean text, units kept in a marked form."""
    return clean_pages(_table(spark, sf, "page"), "id", "article")


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    wanted = _table(spark, sf, "annotated").select("id").distinct()
    docs = _table(spark, sf, "page").select("id", "article", "lang").where("article is not null").join(wanted, "id", "left_semi").dropDuplicates(["id"])
    # Read twice, to learn and to split.
    return sentence_units(Scratch(spark, "articles").put(docs, "docs"), "id", "article", "lang")


def _sizes(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Documents measured once: ``doc_id, source, tokens``."""
    docs = _table(spark, sf, "documents").select("doc_id", "source", token_count("text").alias("tokens"))
    return Scratch(spark, name).put(docs, "sizes")


def _packed(spark: SparkSession, sf: str) -> list[tuple[str, int, DataFrame]]:
    items = _sizes(spark, sf, "p8").select(F.col("doc_id").alias("item"), F.col("tokens").alias("size"))
    # A handful of container kinds.
    kinds = _table(spark, sf, "container").where("capacity_tokens > 0").distinct().orderBy("name").collect()
    # Their supersteps are many small jobs each, so the kinds are packed side by side.
    with ThreadPoolExecutor(max(1, min(4, len(kinds)))) as pool:
        packed = list(pool.map(lambda r: pack(items, r.capacity_tokens), kinds))
    return [(r.name, r.capacity_tokens, p) for r, p in zip(kinds, packed)]


def p8_packed(spark: SparkSession, sf: str) -> DataFrame:
    parts = [p.select(F.lit(name).alias("container"), "bin", F.col("item").alias("doc_id"), "piece", F.col("size").alias("tokens")) for name, _, p in _packed(spark, sf)]
    return reduce(DataFrame.unionByName, parts)


def p8_fill(spark: SparkSession, sf: str) -> DataFrame:
    parts = [fill_report(p, c).select(F.lit(name).alias("container"), "bins", "used", "capacity", "fill") for name, c, p in _packed(spark, sf)]
    return reduce(DataFrame.unionByName, parts)


def p9_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mix(_sizes(spark, sf, "p9"), _table(spark, sf, "mix_target"))


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    targets = _table(spark, sf, "mix_target")
    return shares(mix(_sizes(spark, sf, "p9"), targets), targets)


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    scores = score_documents(_table(spark, sf, "documents"), _table(spark, sf, "abuse_label"), evidence=False)
    return scores.where(F.col("score") >= THRESHOLD).select("doc_id")


def p10_source_rates(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return source_rates(docs, score_documents(docs, _table(spark, sf, "abuse_label"), evidence=False))


def p10_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Score, label, likeliest passage and nearest unwanted example of every document."""
    return score_documents(_table(spark, sf, "documents"), _table(spark, sf, "abuse_label"))


def p8_check(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of every packing, a row a container kind: documents placed, and violations."""
    sizes = _table(spark, sf, "documents").select(F.col("doc_id").alias("item"), (F.length("text") > 0).alias("real"))
    rows = []
    for name, capacity, packed in _packed(spark, sf):
        loads = packed.groupBy("bin").agg(F.sum("size").alias("load"), F.max("size").alias("most"))
        over = loads.agg(F.count_if(F.col("load") > capacity).alias("overfull"), (F.sum("load") * 100 >= F.count("*") * capacity * 95).alias("well_filled"))
        docs = packed.groupBy("item").agg(F.count("*").alias("pieces"), F.count_distinct("piece").alias("kinds"), F.sum("size").alias("size"))
        whole = sizes.where("real").join(docs, "item", "left").agg(
            F.count("pieces").alias("placed"), F.count_if(F.col("pieces").isNull()).alias("missing"),
            F.count_if(F.col("pieces") != F.col("kinds")).alias("placed_twice"), F.count_if(F.col("pieces") != F.ceil(F.col("size") / capacity)).alias("split_needlessly"),
        )
        rows.append(over.crossJoin(whole).select(F.lit(name).alias("container"), "placed", "missing", "placed_twice", "split_needlessly", "overfull", "well_filled"))  # one row each
    return reduce(DataFrame.unionByName, rows)


def p9_check(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of the mix, a row a source: tokens within two documents a source of the target, repeats within the limit, copies evenly used."""
    targets = _table(spark, sf, "mix_target")
    mixed = Scratch(spark, "mixed").put(mix(_sizes(spark, sf, "p9"), targets), "mix")
    used = shares(mixed, targets)
    spread = mixed.groupBy("source", "doc_id").agg(F.count("*").alias("n")).groupBy("source").agg((F.max("n") - F.min("n") <= 1).alias("even"))
    # Every source adds its own deviation to the total.
    largest = mixed.groupBy("source").agg(F.max("tokens").alias("most")).agg(F.max("most").alias("most"), F.count("*").alias("sources"))
    whole = mixed.agg(F.sum("tokens").alias("whole"))
    limits = targets.groupBy("source").agg(F.max("max_repeat").alias("max_repeat"))
    return used.join(limits, "source").join(spread, "source", "left").join(F.broadcast(largest)).join(F.broadcast(whole)).select(
        "source", (F.abs(F.col("tokens") - F.col("target_share") * F.col("whole")) <= 2 * F.col("most") * F.col("sources")).alias("on_target"),
        (F.col("most_used") <= F.col("max_repeat")).alias("within_repeat"), F.coalesce("even", F.lit(True)).alias("even"),
    )


def queries():
    return {f.__name__: f for f in (p1_found, p2_found, p3_found, p5_found, p5_clean_text, p7_found, p8_packed, p8_fill, p9_mix, p9_shares, p10_found, p10_scores, p10_source_rates, p8_check, p9_check)}


_NORM = "upper(left(trim(replace({0}, '_', ' '), chr(32)||chr(9)||chr(10)||chr(13)||chr(160)||chr(12288)), 1)) || substr(trim(replace({0}, '_', ' '), chr(32)||chr(9)||chr(10)||chr(13)||chr(160)||chr(12288)), 2)"


def oracle_sql() -> dict[str, str]:
    p1 = f"""
      WITH RECURSIVE pages AS (SELECT DISTINCT id, nullif({_NORM.format('title')}, '') AS t, nullif({_NORM.format('redirect')}, '') AS r FROM page),
      ties AS (
        SELECT a.id AS a, b.id AS b FROM pages a JOIN pages b ON a.t = b.t
        UNION SELECT a.id, b.id FROM pages a JOIN pages b ON a.r = b.t
        UNION SELECT b.id, a.id FROM pages a JOIN pages b ON a.r = b.t),
      walk AS (SELECT a AS id, a AS other FROM ties UNION SELECT w.id, t.b FROM walk w JOIN ties t ON t.a = w.other)
      SELECT id, min(other) AS group_id FROM walk GROUP BY id HAVING count(DISTINCT other) > 1
    """
    p3 = """
      WITH links AS (SELECT unnest(titles) AS title FROM (SELECT id, any_value([x.title for x in links]) AS titles FROM page GROUP BY id))
      SELECT title FROM links GROUP BY title HAVING title IS NOT NULL AND count(*) >= 0.005 * (SELECT count(*) FROM links)
    """
    p8 = """
      SELECT name AS container, (SELECT count(*) FROM documents WHERE length(text) > 0) AS placed, 0 AS missing, 0 AS placed_twice,
        0 AS split_needlessly, 0 AS overfull, true AS well_filled
      FROM (SELECT DISTINCT name, capacity_tokens FROM container WHERE capacity_tokens > 0)
    """
    p9 = """
      SELECT source, true AS on_target, true AS within_repeat, true AS even FROM mix_target
    """
    return {"p1_found": p1, "p3_found": p3, "p8_check": p8, "p9_check": p9}
