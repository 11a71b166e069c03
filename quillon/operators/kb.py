"""Knowledge-base entities: look-ups, property mappings, triples, taxonomy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.operators.skew import lookup_join


def item_id(raw: Column) -> Column:
    """The item of a statement's value: ``id`` of the JSON object, or the plain string."""
    return F.coalesce(F.get_json_object(raw, "$.id"), F.when(~F.ltrim(raw).startswith("{"), raw))


def with_properties(entity: DataFrame) -> DataFrame:
    return entity.withColumn("properties", F.coalesce(F.map_keys("claims"), F.array().cast("array<string>")))


def claims_long(entity: DataFrame) -> DataFrame:
    """``(s, property, pos, snaktype, datatype, value_raw, value_id)``: one row a statement."""
    return entity.select(F.col("id").alias("s"), F.explode("claims").alias("property", "statements")).select("s", "property", F.posexplode("statements").alias("pos", "st")).select(
        "s", "property", "pos", "st.mainsnak.snaktype", "st.mainsnak.datatype",
        F.col("st.mainsnak.datavalue.value").alias("value_raw"), item_id(F.col("st.mainsnak.datavalue.value")).alias("value_id"),
    )


def triples(claims: DataFrame) -> DataFrame:
    """``(s, p, o)`` of the statements whose value is an item; duplicates stay."""
    return claims.where("datatype = 'wikibase-item' and snaktype = 'value' and value_id is not null").select("s", F.col("property").alias("p"), F.col("value_id").alias("o"))


def property_list(entity: DataFrame, prop: str, items: bool = True) -> DataFrame:
    """``(k, pos, v)``: values of a property in statement order, those without a value skipped."""
    value = lambda s: item_id(s["mainsnak"]["datavalue"]["value"]) if items else s["mainsnak"]["datavalue"]["value"]
    values = F.filter(F.transform(F.col("claims")[prop], value), lambda v: v.isNotNull())
    return entity.where(F.array_contains("properties", prop)).select(F.col("id").alias("k"), F.posexplode(values).alias("pos", "v"))


def property_last(entity: DataFrame, prop: str, items: bool = False) -> DataFrame:
    """``(k, v)``: the last value of a property."""
    return property_list(entity, prop, items).groupBy("k").agg(F.max_by("v", "pos").alias("v"))


def language_map(entity: DataFrame, field: str, key: str, part: str = "value") -> DataFrame:
    """``(k, v)``: non-empty text of ``field[key]`` (labels, descriptions: value; sitelinks: title)."""
    v = F.col(field)[key][part]
    return entity.select(F.col("id").alias("k"), v.alias("v")).where(F.col("v").rlike(".+"))


def property_names(entity: DataFrame, lang: str = "en") -> DataFrame:
    """Labels of the properties (ids ``P`` and digits); those without a label are left out."""
    return language_map(entity.where(F.col("id").startswith("P") & F.col("id").rlike(r"^P\d+$")), "labels", lang)


def properties_unnamed(entity: DataFrame, lang: str = "en") -> DataFrame:
    """``(id)`` of the properties without a label in that language."""
    label = F.coalesce(F.col("labels")[lang]["value"], F.lit(""))
    return entity.where(F.col("id").rlike(r"^P\d+$") & (label == "")).select("id")


def attach_labels(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(parent, parent_label, child, child_label)``: taxonomy pairs with the label of each node, null where it has none.

    ``labels`` has ``id`` and ``label``; of several labels of an id the smallest is taken.
    """
    named = labels.where("id is not null").groupBy("id").agg(F.min("label").alias("label"))
    for end in ("parent", "child"):
        pairs = lookup_join(pairs, named.select(F.col("id").alias(end), F.col("label").alias(f"{end}_label")), end, "left")
    return pairs.select("parent", "parent_label", "child", "child_label")


def invert_list(pairs: DataFrame) -> DataFrame:
    """``(v, k, n)``: 1:n inversion with one row for each of the ``n`` keys of a value, repeated keys kept.

    A frequent value's keys stay spread over all tasks; ``n`` is looked up.
    """
    sizes = pairs.groupBy("v").agg(F.count("*").alias("n"))
    return lookup_join(pairs.select("v", "k"), sizes, "v")


def invert_unique(pairs: DataFrame) -> DataFrame:
    """``(v, k, n)``: 1:1 inversion, the last key in order wins; ``n`` > 1 warns of duplicates."""
    return pairs.groupBy("v").agg(F.max("k").alias("k"), F.count("*").alias("n"))


def instances_of(entity: DataFrame, item: str) -> DataFrame:
    """``(id)`` of the entities with any P31 statement of that item."""
    return entity.where(F.exists(F.coalesce(F.col("claims")["P31"], F.array().cast(entity.schema["claims"].dataType.valueType)), lambda s: item_id(s["mainsnak"]["datavalue"]["value"]) == item)).select("id")


def by_site_title(entity: DataFrame, site: str = "enwiki") -> DataFrame:
    """``(title, id)``: the smallest id of every title of a site."""
    return entity.select(F.col("sitelinks")[site]["title"].alias("title"), "id").where("title is not null and title <> ''").groupBy("title").agg(F.min("id").alias("id"))


def lookup_title(entity: DataFrame, title: str, site: str = "enwiki") -> DataFrame:
    return entity.where(F.col("sitelinks")[site]["title"] == F.translate(F.lit(title), "_", " ")).agg(F.min("id").alias("id")).where("id is not null")


def taxonomy(parents: DataFrame, classes: DataFrame, labels: DataFrame, prune_instance_leaves: bool = False) -> DataFrame:
    """``(parent, child)`` between labelled nodes; a node is replaced by its classes if it has any.

    ``parents`` are P279 pairs ``(k, v)``, ``classes`` P31 pairs, ``labels`` has ``id``.
    Every child appears as a parent too, with a null child if it has none of its own.
    ``prune_instance_leaves`` keeps the raw nodes instead and drops leaves that have classes.
    """
    known = labels.select(F.col("id").alias("n")).where("n is not null").distinct()
    e = parents.select(F.col("k").alias("child"), F.col("v").alias("parent")).distinct()
    for end in ("child", "parent"):
        e = lookup_join(e, known.withColumnRenamed("n", end), end, "left_semi")
    if prune_instance_leaves:
        leaf = e.select("child").distinct().join(e.select(F.col("parent").alias("child")), "child", "left_anti")
        drop = leaf.join(classes.select(F.col("k").alias("child")), "child", "left_semi")
        e = e.join(drop, "child", "left_anti").select("parent", "child")
    else:
        swap = lookup_join(classes.select(F.col("k"), F.col("v").alias("n")), known.withColumn("ok", F.lit(True)), "n", "left")
        # Whether a node has classes counts, even if none of them is labelled.
        for end in ("child", "parent"):
            e = e.join(swap.select(F.col("k").alias(end), F.col("n").alias("as"), "ok"), end, "left").where("as is null or ok").withColumn(end, F.coalesce("as", end)).drop("as", "ok")
        e = e.select("parent", "child").distinct()
    nodes = e.select("parent").unionByName(e.select(F.col("child").alias("parent"))).distinct()
    return nodes.join(e, "parent", "left").select("parent", "child")


def assert_unique(df: DataFrame, key: str) -> None:
    """Raise if a key repeats."""
    bad = df.groupBy(key).count().where("count > 1").limit(5).collect()
    if bad:
        raise ValueError(f"{key} is not unique: {[r[0] for r in bad]}")


def key_tables(entity: DataFrame) -> dict[str, DataFrame]:
    """Covering tables in place of the secondary indexes: partial ones are filtered, composite ones two columns."""
    langs = {"label_en": ("labels", "en", "value"), "enwiki": ("sitelinks", "enwiki", "title"), "zhwiki": ("sitelinks", "zhwiki", "title")}
    out = {name: language_map(entity, *where).select("v", F.col("k").alias("id")) for name, where in langs.items()}
    out["alias_en"] = entity.select(F.explode(F.col("aliases")["en"]).alias("a"), "id").select(F.col("a.value").alias("v"), "id").where("v is not null")
    for p in ("P31", "P279", "P646"):
        out[p] = property_list(entity, p, p != "P646").select("v", F.col("k").alias("id"))
    out["properties"] = entity.select(F.explode("properties").alias("v"), "id")
    return out
