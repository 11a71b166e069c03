import json

from quillon.operators.nested import flat_tables, parse_entity_lines


def test_no_parsed_field_is_lost(spark):
    snak = {"snaktype": "value", "property": "P2", "datatype": "string", "datavalue": {"value": "v", "type": "string"}}
    item = {"id": "Q1", "type": "item", "claims": {"P1": [{"id": "Q1$a", "type": "statement", "rank": "preferred", "mainsnak": snak, "qualifiers": {"P2": [snak]},
            "references": [{"hash": "h0", "snaks": {"P2": [snak]}}, {"hash": "h1", "snaks": []}, {}]}]}}
    bare = {"id": "Q2", "type": "property", "labels": {}, "claims": {}}
    t = flat_tables(parse_entity_lines(spark.createDataFrame([(json.dumps(x),) for x in (item, bare)], "line string")))
    assert {(r.entity_id, r.path, r.parent_path, r.type) for r in t["entities"].collect()} == {("Q1", "", None, "item"), ("Q2", "", None, "property")}
    assert [(r.id, r.type, r.rank, r.datatype) for r in t["statements"].collect()] == [("Q1$a", "statement", "preferred", "string")]
    assert [r.datatype for r in t["qualifiers"].collect()] == ["string"] and [r.datatype for r in t["references"].collect()] == ["string"]
    assert {(r.path, r.parent_path, r.pos, r.hash) for r in t["reference_records"].collect()} == {(f"claims/P1/0/references/{k}", "claims/P1/0", k, h) for k, h in enumerate(("h0", "h1", None))}


def test_fields_the_type_lacks(spark):
    kind = "id string, claims map<string,array<struct<mainsnak:struct<snaktype:string,datatype:string,datavalue:struct<value:string,type:string>>>>>"
    t = flat_tables(spark.createDataFrame([("Q1", {"P1": [None]}), ("Q2", None)], kind))
    assert {(r.entity_id, r.type) for r in t["entities"].collect()} == {("Q1", None), ("Q2", None)} and "reference_records" not in t
    assert [(r.path, r.rank, r.id) for r in t["statements"].collect()] == [("claims/P1/0", None, None)]
