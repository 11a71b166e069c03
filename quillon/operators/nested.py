"""Deeply nested entity records as related flat tables.

Every table is one higher-order projection: nested ``transform`` calls carry the
ancestor keys and positions down, ``flatten`` joins the inner arrays, and a single
``inline`` emits the rows.  No shuffle, no Python, and a table reads only the
columns it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SNAK = "struct<snaktype:string,property:string,datatype:string,datavalue:struct<value:string,type:string>>"
STATEMENT = (
    f"struct<mainsnak:{SNAK},type:string,id:string,rank:string,qualifiers:map<string,array<{SNAK}>>,"
    f"references:array<struct<hash:string,snaks:map<string,array<{SNAK}>>>>>"
)
ENTITY = (
    "struct<id:string,type:string,labels:map<string,struct<language:string,value:string>>,"
    "descriptions:map<string,struct<language:string,value:string>>,"
    "aliases:map<string,array<struct<language:string,value:string>>>,"
    f"claims:map<string,array<{STATEMENT}>>,sitelinks:map<string,struct<site:string,title:string>>>"
)


def parse_entity_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Typed entities of raw dump lines (``id, type, labels, …, sitelinks``).

    Outer blanks and any run of trailing commas go; what is then no complete JSON
    object – null, blank, a bracket, a truncated or glued line – gives no row, nor
    does an object without ``id``.  Absent fields and maps written as ``[]`` are null.
    Repeated lines give repeated rows.
    """
    body = F.regexp_replace(F.col(line), r"^[\s﻿]+|[\s,]+$", "")
    return (
        lines.select(body.alias("body"))
        .where("startswith(body, '{') and endswith(body, '}')")
        # As an array of one, text after the object is an error instead of being ignored.
        .select(F.from_json(F.concat(F.lit("["), "body", F.lit("]")), f"array<{ENTITY}>").alias("e"))
        .where("size(e) = 1 and e[0].id is not null")
        .select(F.inline("e"))
    )


#: Target tables: the columns they read and the array of rows each entity turns into.
#: ``flatten`` yields null if an inner array is null, hence the coalesce calls.
_TABLES = {
    "entities": ("type", "array(named_struct('path', '', 'parent_path', cast(null as string), 'type', type))"),
    "labels": ("labels", "transform(map_entries(labels), m -> named_struct('path', concat('labels/', m.key), 'parent_path', '', 'key', m.key, 'language', m.value.language, 'value', m.value.value))"),
    "descriptions": ("descriptions", "transform(map_entries(descriptions), m -> named_struct('path', concat('descriptions/', m.key), 'parent_path', '', 'key', m.key, 'language', m.value.language, 'value', m.value.value))"),
    "sitelinks": ("sitelinks", "transform(map_entries(sitelinks), m -> named_struct('path', concat('sitelinks/', m.key), 'parent_path', '', 'key', m.key, 'site', m.value.site, 'title', m.value.title))"),
    "aliases": (
        "aliases",
        """flatten(transform(map_entries(aliases), m -> coalesce(transform(m.value, (x, i) -> named_struct(
             'path', concat_ws('/', 'aliases', m.key, cast(i as string)), 'parent_path', '', 'key', m.key, 'pos', i,
             'language', x.language, 'value', x.value)), array())))""",
    ),
    "statements": (
        "claims",
        """flatten(transform(map_entries(claims), m -> coalesce(transform(m.value, (x, i) -> named_struct(
             'path', concat_ws('/', 'claims', m.key, cast(i as string)), 'parent_path', '', 'property', m.key, 'pos', i,
             'id', {x.id}, 'type', {x.type}, 'rank', {x.rank}, 'snaktype', x.mainsnak.snaktype, 'datatype', x.mainsnak.datatype,
             'value_type', x.mainsnak.datavalue.type, 'value', x.mainsnak.datavalue.value)), array())))""",
    ),
    "qualifiers": (
        "claims",
        """flatten(flatten(transform(map_entries(claims), m -> coalesce(transform(m.value, (s, i) ->
             coalesce(flatten(transform(map_entries(s.qualifiers), q -> coalesce(transform(q.value, (x, j) -> named_struct(
               'path', concat_ws('/', 'claims', m.key, cast(i as string), 'qualifiers', q.key, cast(j as string)),
               'parent_path', concat_ws('/', 'claims', m.key, cast(i as string)), 'property', q.key, 'pos', j,
               'snaktype', x.snaktype, 'datatype', {q.datatype}, 'value_type', x.datavalue.type, 'value', x.datavalue.value)), array()))), array())),
             array()))))""",
    ),
    "references": (
        "claims",
        """flatten(flatten(transform(map_entries(claims), m -> coalesce(transform(m.value, (s, i) ->
             coalesce(flatten(transform(s.references, (r, k) ->
               coalesce(flatten(transform(map_entries(r.snaks), q -> coalesce(transform(q.value, (x, j) -> named_struct(
                 'path', concat_ws('/', 'claims', m.key, cast(i as string), 'references', cast(k as string), 'snaks', q.key, cast(j as string)),
                 'parent_path', concat_ws('/', 'claims', m.key, cast(i as string)), 'reference', k, 'property', q.key, 'pos', j,
                 'snaktype', x.snaktype, 'datatype', {r.datatype}, 'value_type', x.datavalue.type, 'value', x.datavalue.value)), array()))), array()))), array())),
             array()))))""",
    ),
    "reference_records": (
        "claims",
        """flatten(flatten(transform(map_entries(claims), m -> coalesce(transform(m.value, (s, i) -> coalesce(transform(s.references, (r, k) -> named_struct(
             'path', concat_ws('/', 'claims', m.key, cast(i as string), 'references', cast(k as string)),
             'parent_path', concat_ws('/', 'claims', m.key, cast(i as string)), 'pos', k, 'hash', {h.hash})), array())), array()))))""",
    ),
}


def _optional(statement: StructType) -> dict[str, str]:
    """What the placeholders of ``_TABLES`` stand for: fields that the input's type lacks are null."""
    heads = statement["references"].dataType.elementType if "references" in statement.names else StructType()
    qualifiers = statement["qualifiers"].dataType.valueType.elementType if "qualifiers" in statement.names else StructType()
    snaks = heads["snaks"].dataType.valueType.elementType if "snaks" in heads.names else StructType()
    fields = {"x.id": statement, "x.type": statement, "x.rank": statement, "q.datatype": qualifiers, "r.datatype": snaks, "h.hash": heads}
    columns = {"h.hash": "r.hash", "q.datatype": "x.datatype", "r.datatype": "x.datatype"}
    return {f"{{{f}}}": columns.get(f, f) if f[2:] in kind.names else "cast(null as string)" for f, kind in fields.items()}


def flat_tables(entities: DataFrame) -> dict[str, DataFrame]:
    """The flat tables of ``entities`` by name, each with ``entity_id, path, parent_path``.

    ``entities`` has one row an entity (``path`` is empty, ``parent_path`` null).
    ``labels, descriptions, sitelinks, aliases, statements`` hang on the entity
    (``parent_path`` is empty), ``qualifiers``, ``references`` (one row a snak) and
    ``reference_records`` (one row a reference, also without snaks) on their statement.
    Fields that the type of the input lacks are null.  ``path`` joins map keys and zero-based positions by ``/`` and is
    unique within an entity.  Null or empty maps and arrays give no rows; a null
    element still counts and gives a row of nulls; columns that the input lacks (and
    statements without qualifiers or references in their type) give no table.
    Entities given twice give their rows twice; other columns are ignored.
    """
    found = {}
    statement, optional = StructType(), {}
    if "claims" in entities.columns:
        statement = entities.schema["claims"].dataType.valueType.elementType
        optional = _optional(statement)
    for name, (column, rows) in _TABLES.items():
        if name == "entities":
            kind = F.col(column) if column in entities.columns else F.lit(None).cast("string").alias(column)
            found[name] = entities.select(F.col("id").alias("entity_id"), kind).selectExpr("entity_id", f"inline({rows})")
            continue
        needed = {"qualifiers": "qualifiers", "references": "references", "reference_records": "references"}.get(name)
        if column not in entities.columns or needed and needed not in statement.names:
            continue
        for mark, value in optional.items():
            rows = rows.replace(mark, value)
        found[name] = entities.select(F.col("id").alias("entity_id"), column).where(f"{column} is not null").selectExpr("entity_id", f"inline({rows})")
    return found


def entity_paths(*sources: DataFrame, tables=("labels", "sitelinks", "statements", "qualifiers", "references")) -> DataFrame:
    """Distinct ``(entity_id, path)`` of the named flat tables of all ``sources``."""
    parts = [t.select("entity_id", "path") for s in sources for n, t in flat_tables(s).items() if n in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()
