"""Queries of the knowledge-base family, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.operators import kb
from quillon.operators.nested import flat_tables, parse_entity_lines
from quillon.operators.pages import latest
from quillon.storage import Scratch


def _entities(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    """Each entity once, only the columns asked for."""
    return latest(spark.read.parquet(f"{sf}/entity.parquet").select("id", *cols, "loaded_at")).drop("loaded_at")


def _one(spark: SparkSession, sf: str, field: str, key: str) -> DataFrame:
    """Each entity that has ``key`` in the map ``field``, with that entry only: the other entries never leave the scan."""
    e = spark.read.parquet(f"{sf}/entity.parquet").where(F.map_contains_key(field, key))
    return latest(e.select("id", F.map_filter(field, lambda k, _: k == key).alias(field), "loaded_at")).drop("loaded_at")


def _statements(spark: SparkSession, sf: str, prop: str) -> DataFrame:
    return _one(spark, sf, "claims", prop).withColumn("properties", F.array(F.lit(prop)))


def _kept(spark, df: DataFrame) -> DataFrame:
    return Scratch(spark, "kb").put(df, "kb")


def entity_properties(spark, sf):
    e = kb.with_properties(_entities(spark, sf, "claims"))
    return e.select("id", F.array_join(F.array_sort("properties"), "|").alias("properties"))


def claims_long(spark, sf):
    return kb.claims_long(_entities(spark, sf, "claims")).select("s", "property", "pos", "snaktype", "datatype", "value_id")


def triples(spark, sf):
    return kb.triples(kb.claims_long(_entities(spark, sf, "claims")))


def property_counts(spark, sf):
    return kb.claims_long(_entities(spark, sf, "claims")).groupBy("property", "snaktype").agg(F.count("*").alias("n"))


def _list(spark, sf, prop, items=True):
    return kb.property_list(_statements(spark, sf, prop), prop, items)


def p31_list(spark, sf):
    return _list(spark, sf, "P31")


def p279_list(spark, sf):
    return _list(spark, sf, "P279")


def p18_list(spark, sf):
    return _list(spark, sf, "P18", False)


def p646_last(spark, sf):
    return kb.property_last(_statements(spark, sf, "P646"), "P646")


def labels_en(spark, sf):
    return kb.language_map(_one(spark, sf, "labels", "en"), "labels", "en")


def descriptions_en(spark, sf):
    return kb.language_map(_one(spark, sf, "descriptions", "en"), "descriptions", "en")


def sitelinks_en(spark, sf):
    return kb.language_map(_one(spark, sf, "sitelinks", "enwiki"), "sitelinks", "enwiki", "title")


def property_names(spark, sf):
    return kb.property_names(_entities(spark, sf, "labels"), "ar")


def properties_unnamed(spark, sf):
    """Properties without an Arabic label."""
    return kb.properties_unnamed(_entities(spark, sf, "labels"), "ar")


def invert_p31(spark, sf):
    return kb.invert_list(_kept(spark, _list(spark, sf, "P31")))


def invert_p646(spark, sf):
    return kb.invert_unique(kb.property_last(_statements(spark, sf, "P646"), "P646"))


def instances_of_commonest(spark, sf):
    """Instances of the most frequent class, looked up one statement at a time."""
    e = _kept(spark, _entities(spark, sf, "claims", "properties"))
    top = kb.property_list(e, "P31").groupBy("v").count().orderBy(F.desc("count"), "v").first()
    return kb.instances_of(e, top.v if top else "")


def ids_by_site_title(spark, sf):
    return kb.by_site_title(_entities(spark, sf, "sitelinks"))


def aliases_en(spark, sf):
    t = flat_tables(_entities(spark, sf, "aliases"))["aliases"]
    return t.where("key = 'en'").select("entity_id", "pos", "value")


def labels_long(spark, sf):
    return flat_tables(_entities(spark, sf, "labels"))["labels"].select("entity_id", "key", "language", "value")


def line_entities(spark, sf):
    """Entities of the raw dump lines: how many labels, sitelinks and properties each has."""
    e = parse_entity_lines(spark.read.parquet(f"{sf}/entity_line.parquet").dropDuplicates(["line"]))
    n = lambda c: F.coalesce(F.size(F.map_keys(c)), F.lit(0)).cast("bigint")
    return e.select("id", "type", F.greatest(n("labels"), F.lit(0)).alias("n_labels"), F.greatest(n("sitelinks"), F.lit(0)).alias("n_sitelinks"), F.greatest(n("claims"), F.lit(0)).alias("n_properties")).distinct()


def _taxonomy(spark, sf, prune):
    e = _kept(spark, _entities(spark, sf, "claims", "properties", "labels"))
    named = kb.language_map(e, "labels", "en").select(F.col("k").alias("id")).unionByName(spark.read.parquet(f"{sf}/taxonomy_labels.parquet").select("id"))
    return kb.taxonomy(kb.property_list(e, "P279"), kb.property_list(e, "P31"), named, prune)


def taxonomy(spark, sf):
    return _taxonomy(spark, sf, False)


def taxonomy_labelled(spark, sf):
    """The taxonomy with the English label, or the taxonomy's own, of each node."""
    e = _entities(spark, sf, "labels").select("id", F.col("labels")["en"]["value"].alias("label")).where("label <> ''")
    own = spark.read.parquet(f"{sf}/taxonomy_labels.parquet").select("id", "label")
    return kb.attach_labels(_kept(spark, _taxonomy(spark, sf, False)), own.unionByName(e))


def taxonomy_pruned(spark, sf):
    return _taxonomy(spark, sf, True)


_NAMES = (
    entity_properties, claims_long, triples, property_counts, p31_list, p279_list, p18_list, p646_last, labels_en, descriptions_en, sitelinks_en,
    property_names, properties_unnamed, taxonomy_labelled, invert_p31, invert_p646, instances_of_commonest, ids_by_site_title, aliases_en, labels_long, line_entities, taxonomy, taxonomy_pruned,
)


def queries():
    return {f.__name__: f for f in _NAMES}


_EN = "en AS (SELECT * FROM entity QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at) = 1)"
_ITEM = "CASE WHEN starts_with(ltrim({0}), '{{') THEN json_extract_string({0}, '$.id') ELSE {0} END"
_CLAIMS = f"""{_EN},
  st AS (
    SELECT s, property, CAST(pos - 1 AS INT) AS pos, x.mainsnak.snaktype AS snaktype, x.mainsnak.datatype AS datatype, x.mainsnak.datavalue.value AS value_raw FROM (
      SELECT s, property, unnest(xs) AS x, generate_subscripts(xs, 1) AS pos FROM (
        SELECT id AS s, k AS property, claims[k] AS xs FROM (SELECT id, claims, unnest(map_keys(claims)) AS k FROM en)))),
  claims AS (SELECT s, property, pos, snaktype, datatype, value_raw, {_ITEM.format('value_raw')} AS value_id FROM st)"""


def _listed(prop: str, column: str = "value_id") -> str:
    return f"{_CLAIMS}, l AS (SELECT s AS k, CAST(row_number() OVER (PARTITION BY s ORDER BY pos) - 1 AS INT) AS pos, {column} AS v FROM claims WHERE property = '{prop}' AND {column} IS NOT NULL AND s IN (SELECT id FROM en WHERE list_contains(properties, '{prop}')))"


def _language(field: str, key: str, part: str = "value") -> str:
    return f"WITH {_EN} SELECT id AS k, {field}['{key}'].{part} AS v FROM en WHERE regexp_matches({field}['{key}'].{part}, '.+')"


def oracle_sql() -> dict[str, str]:
    two = _listed("P31").replace(" l AS (", " p31 AS (") + ", " + _listed("P279")[len(_CLAIMS) + 1 :].replace(" l AS (", " p279 AS (")
    edges = f"""{two},
      named AS (SELECT id FROM en WHERE regexp_matches(labels['en'].value, '.+') UNION SELECT id FROM taxonomy_labels),
      e AS (SELECT DISTINCT v AS parent, k AS child FROM p279 WHERE v IN (SELECT id FROM named) AND k IN (SELECT id FROM named))"""
    nodes = " nodes AS (SELECT parent AS n FROM f UNION SELECT child FROM f) SELECT n AS parent, f.child FROM nodes LEFT JOIN f ON f.parent = nodes.n"
    return {
        "entity_properties": f"WITH {_EN} SELECT id, array_to_string(list_sort(coalesce(map_keys(claims), [])), '|') AS properties FROM en",
        "claims_long": f"WITH {_CLAIMS} SELECT s, property, pos, snaktype, datatype, value_id FROM claims",
        "triples": f"WITH {_CLAIMS} SELECT s, property AS p, value_id AS o FROM claims WHERE datatype = 'wikibase-item' AND snaktype = 'value' AND value_id IS NOT NULL",
        "property_counts": f"WITH {_CLAIMS} SELECT property, snaktype, count(*) AS n FROM claims GROUP BY 1, 2",
        "p31_list": f"WITH {_listed('P31')} SELECT * FROM l",
        "p279_list": f"WITH {_listed('P279')} SELECT * FROM l",
        "p18_list": f"WITH {_listed('P18', 'value_raw')} SELECT * FROM l",
        "p646_last": f"WITH {_listed('P646', 'value_raw')} SELECT k, max_by(v, pos) AS v FROM l GROUP BY k",
        "labels_en": _language("labels", "en"),
        "descriptions_en": _language("descriptions", "en"),
        "sitelinks_en": _language("sitelinks", "enwiki", "title"),
        "property_names": _language("labels", "ar") + " AND regexp_matches(id, '^P\\d+$')",
        "properties_unnamed": f"WITH {_EN} SELECT id FROM en WHERE regexp_matches(id, '^P\\d+$') AND coalesce(labels['ar'].value, '') = ''",
        "invert_p31": f"WITH {_listed('P31')} SELECT v, k, count(*) OVER (PARTITION BY v) AS n FROM l",
        "invert_p646": f"WITH {_listed('P646', 'value_raw')}, u AS (SELECT k, max_by(v, pos) AS v FROM l GROUP BY k) SELECT v, max(k) AS k, count(*) AS n FROM u GROUP BY v",
        "instances_of_commonest": f"WITH {_listed('P31')} SELECT DISTINCT s AS id FROM claims WHERE property = 'P31' AND value_id = (SELECT v FROM l GROUP BY v ORDER BY count(*) DESC, v LIMIT 1)",
        "ids_by_site_title": f"WITH {_EN} SELECT sitelinks['enwiki'].title AS title, min(id) AS id FROM en WHERE sitelinks['enwiki'].title <> '' GROUP BY 1",
        "aliases_en": f"WITH {_EN} SELECT id AS entity_id, CAST(i - 1 AS INT) AS pos, a.value AS value FROM (SELECT id, unnest(aliases['en']) AS a, generate_subscripts(aliases['en'], 1) AS i FROM en)",
        "labels_long": f"WITH {_EN} SELECT id AS entity_id, e.key AS key, e.value.language AS language, e.value.value AS value FROM (SELECT id, unnest(map_entries(labels)) AS e FROM en)",
        "line_entities": """WITH b AS (SELECT DISTINCT regexp_replace(line, '^\\s+|[\\s,]+$', '', 'g') AS b FROM entity_line),
            j AS (SELECT CASE WHEN json_valid(b) THEN b::JSON END AS j FROM b)
            SELECT DISTINCT json_extract_string(j, '$.id') AS id, json_extract_string(j, '$.type') AS type,
              CAST(CASE WHEN json_type(j, '$.labels') = 'OBJECT' THEN len(json_keys(j, '$.labels')) ELSE 0 END AS BIGINT) AS n_labels,
              CAST(CASE WHEN json_type(j, '$.sitelinks') = 'OBJECT' THEN len(json_keys(j, '$.sitelinks')) ELSE 0 END AS BIGINT) AS n_sitelinks,
              CAST(CASE WHEN json_type(j, '$.claims') = 'OBJECT' THEN len(json_keys(j, '$.claims')) ELSE 0 END AS BIGINT) AS n_properties
            FROM j WHERE json_type(j) = 'OBJECT' AND json_extract_string(j, '$.id') IS NOT NULL""",
        "taxonomy": f"""WITH {edges},
            x AS (SELECT k, v, v IN (SELECT id FROM named) AS ok FROM p31),
            c AS (SELECT DISTINCT e.parent, coalesce(x.v, e.child) AS child FROM e LEFT JOIN x ON x.k = e.child WHERE x.k IS NULL OR x.ok),
            f AS (SELECT DISTINCT coalesce(x.v, c.parent) AS parent, c.child FROM c LEFT JOIN x ON x.k = c.parent WHERE x.k IS NULL OR x.ok),{nodes}""",
        "taxonomy_labelled": f"""WITH {edges},
            x AS (SELECT k, v, v IN (SELECT id FROM named) AS ok FROM p31),
            c AS (SELECT DISTINCT e.parent, coalesce(x.v, e.child) AS child FROM e LEFT JOIN x ON x.k = e.child WHERE x.k IS NULL OR x.ok),
            f AS (SELECT DISTINCT coalesce(x.v, c.parent) AS parent, c.child FROM c LEFT JOIN x ON x.k = c.parent WHERE x.k IS NULL OR x.ok),
            lab AS (SELECT id, min(label) AS label FROM (SELECT id, label FROM taxonomy_labels UNION ALL SELECT id, labels['en'].value FROM en WHERE labels['en'].value <> '') WHERE id IS NOT NULL GROUP BY id),
            nodes AS (SELECT parent AS n FROM f UNION SELECT child FROM f), pair AS (SELECT n AS parent, f.child FROM nodes LEFT JOIN f ON f.parent = nodes.n)
            SELECT pair.parent, a.label AS parent_label, pair.child, b.label AS child_label FROM pair LEFT JOIN lab a ON a.id = pair.parent LEFT JOIN lab b ON b.id = pair.child""",
        "taxonomy_pruned": f"""WITH {edges},
            f AS (SELECT * FROM e WHERE child IN (SELECT parent FROM e) OR child NOT IN (SELECT k FROM p31)),{nodes}""",
    }
