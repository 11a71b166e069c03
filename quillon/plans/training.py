"""Queries of the general training-data problems (nested records, hierarchies)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.operators.hierarchy import descendant_counts, descendants, hierarchy, parent_statements
from quillon.operators.nested import entity_paths, flat_tables, parse_entity_lines
from quillon.storage import Scratch


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _parsed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines parsed once into a typed table, so that each flat table reads its columns only."""
    return Scratch(spark, "lines").put(parse_entity_lines(_table(spark, sf, "entity_line")), "entities")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return entity_paths(_table(spark, sf, "entity"), _parsed_lines(spark, sf))


def p4_statement_values(spark: SparkSession, sf: str) -> DataFrame:
    """The flat table of statements of ``entity``."""
    cols = ["entity_id", "path", "property", "pos", "snaktype", "value"]
    return flat_tables(_table(spark, sf, "entity"))["statements"].select(cols).distinct()


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return hierarchy(parent_statements(_table(spark, sf, "entity")), "child", "parent")


def p6_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Root, depth and path from the root down to each entity; below a loop the path runs once round it, on a loop it is null."""
    return hierarchy(parent_statements(_table(spark, sf, "entity")), "child", "parent", with_paths=True, loop_paths=True)


def p6_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """The descendants of each class themselves, a row a pair; only pairs within a loop are left out."""
    return descendants(p6_paths(spark, sf))


def p6_descendants(spark: SparkSession, sf: str) -> DataFrame:
    """How many entities lie below each class, and how far the lowest; only pairs within a loop are left out."""
    return descendant_counts(parent_statements(_table(spark, sf, "entity")), "child", "parent")


def queries():
    return {f.__name__: f for f in (p4_found, p4_statement_values, p6_found, p6_paths, p6_pairs, p6_descendants)}


_EDGES = """
  edges AS (
    SELECT id AS child, min(parent) AS parent FROM (
      SELECT id, CASE WHEN starts_with(ltrim(v), '{') THEN json_extract_string(v, '$.id') ELSE v END AS parent FROM (
        SELECT id, s.mainsnak.datavalue.value AS v FROM (SELECT id, unnest(claims['P279']) AS s FROM entity)))
    WHERE parent IS NOT NULL AND parent <> '' AND id IS NOT NULL GROUP BY id)
"""


def oracle_sql() -> dict[str, str]:
    paths = """
      SELECT entity_id, path FROM (
        SELECT id AS entity_id, 'labels/' || k AS path FROM (SELECT id, unnest(map_keys(labels)) AS k FROM entity)
        UNION ALL SELECT id, 'sitelinks/' || k FROM (SELECT id, unnest(map_keys(sitelinks)) AS k FROM entity)
        UNION ALL SELECT id, 'claims/' || k || '/' || i FROM (
          SELECT id, k, unnest(range(len(claims[k]))) AS i FROM (SELECT id, claims, unnest(map_keys(claims)) AS k FROM entity))
        UNION ALL SELECT id, 'labels/' || k FROM (SELECT id, unnest(json_keys(j, '$.labels')) AS k FROM lines WHERE json_type(j, '$.labels') = 'OBJECT')
        UNION ALL SELECT id, 'sitelinks/' || k FROM (SELECT id, unnest(json_keys(j, '$.sitelinks')) AS k FROM lines WHERE json_type(j, '$.sitelinks') = 'OBJECT')
        UNION ALL SELECT id, p FROM stm
        UNION ALL SELECT id, p || '/qualifiers/' || k || '/' || i FROM (
          SELECT id, p, k, unnest(range(CAST(json_array_length(json_extract(s, '$.qualifiers.' || k)) AS BIGINT))) AS i FROM (
            SELECT id, p, s, unnest(json_keys(s, '$.qualifiers')) AS k FROM stm WHERE json_type(s, '$.qualifiers') = 'OBJECT'))
        UNION ALL SELECT id, p || '/references/' || n || '/snaks/' || k || '/' || i FROM (
          SELECT id, p, n, k, unnest(range(CAST(json_array_length(json_extract(r, '$.snaks.' || k)) AS BIGINT))) AS i FROM (
            SELECT id, p, n, r, unnest(json_keys(r, '$.snaks')) AS k FROM (
              SELECT id, p, n, json_extract(s, '$.references[' || n || ']') AS r FROM (
                SELECT id, p, s, unnest(range(CAST(json_array_length(s, '$.references') AS BIGINT))) AS n FROM stm WHERE json_type(s, '$.references') = 'ARRAY'))
            WHERE json_type(r, '$.snaks') = 'OBJECT')))
    """
    p4 = f"""
      WITH lines AS (
        SELECT json_extract_string(j, '$.id') AS id, j FROM (
          SELECT CASE WHEN json_valid(b) THEN b::JSON END AS j FROM (SELECT regexp_replace(line, '^\\s+|[\\s,]+$', '', 'g') AS b FROM entity_line))
        WHERE json_type(j) = 'OBJECT' AND json_extract_string(j, '$.id') IS NOT NULL),
      prop AS (SELECT id, j, unnest(json_keys(j, '$.claims')) AS k FROM lines WHERE json_type(j, '$.claims') = 'OBJECT'),
      stm AS (
        SELECT id, 'claims/' || k || '/' || i AS p, json_extract(j, '$.claims.' || k || '[' || i || ']') AS s FROM (
          SELECT id, j, k, unnest(range(CAST(json_array_length(json_extract(j, '$.claims.' || k)) AS BIGINT))) AS i FROM prop))
      SELECT DISTINCT entity_id, path FROM ({paths})
    """
    values = """
      SELECT DISTINCT id AS entity_id, 'claims/' || k || '/' || (i - 1) AS path, k AS property, CAST(i - 1 AS INT) AS pos,
        s.mainsnak.snaktype AS snaktype, s.mainsnak.datavalue.value AS value
      FROM (SELECT id, k, unnest(claims[k]) AS s, generate_subscripts(claims[k], 1) AS i
            FROM (SELECT id, claims, unnest(map_keys(claims)) AS k FROM entity))
    """
    walk = f"""
      WITH RECURSIVE {_EDGES},
      up AS (
        SELECT child AS id, parent AS top, 1 AS depth, [child] AS seen, child = parent AS loop FROM edges
        UNION ALL
        SELECT up.id, e.parent, up.depth + 1, list_append(up.seen, up.top), list_contains(up.seen, e.parent) OR e.parent = up.top
        FROM up JOIN edges e ON e.child = up.top WHERE NOT up.loop)
    """
    p6 = walk + """
      SELECT id, CASE WHEN loop THEN 'cycle' ELSE top END AS root_id, CAST(CASE WHEN loop THEN -1 ELSE depth END AS INT) AS depth
      FROM up WHERE loop OR NOT EXISTS (SELECT 1 FROM edges e WHERE e.child = up.top)
    """
    route = walk + """
      SELECT id, CASE WHEN loop THEN 'cycle' ELSE top END AS root_id, CAST(CASE WHEN loop THEN -1 ELSE depth END AS INT) AS depth,
        CASE WHEN NOT loop THEN list_reverse(list_append(seen, top)) WHEN top <> id THEN list_reverse(seen) END AS path
      FROM up WHERE loop OR NOT EXISTS (SELECT 1 FROM edges e WHERE e.child = up.top)
    """
    pairs = walk + """
      SELECT top AS ancestor_id, id, CAST(depth AS INT) AS distance
      FROM up WHERE NOT loop AND id NOT IN (SELECT id FROM up WHERE loop AND top = id)
    """
    below = walk + """
      SELECT top AS ancestor_id, count(*) AS n_below, CAST(max(depth) AS INT) AS height
      FROM up WHERE NOT loop AND id NOT IN (SELECT id FROM up WHERE loop AND top = id) GROUP BY top
    """
    return {"p4_found": p4, "p4_statement_values": values, "p6_found": p6, "p6_paths": route, "p6_pairs": pairs, "p6_descendants": below}
