import json

from quillon.operators.nested import entity_paths, flat_tables, parse_entity_lines

ITEM = {
    "id": "Q1", "type": "item", "labels": {"en": {"language": "en", "value": "a"}, "de": {"language": "de", "value": None}}, "sitelinks": [],
    "claims": {
        "P1": [
            {"mainsnak": {"snaktype": "value", "property": "P1", "datavalue": {"value": {"id": "Q2"}, "type": "x"}}, "qualifiers": {"P2": [{"snaktype": "novalue"}, {"snaktype": "value"}]},
             "references": [{"snaks": {"P3": [{"snaktype": "value"}]}}, {"snaks": []}, {}]},
            {"mainsnak": {"snaktype": "somevalue"}},
        ],
        "P9": [],
    },
}


def brute(o):
    out = {f"labels/{k}" for k in o["labels"]} if isinstance(o["labels"], dict) else set()
    out |= {f"sitelinks/{k}" for k in o["sitelinks"]} if isinstance(o["sitelinks"], dict) else set()
    for p, ss in o["claims"].items():
        for i, s in enumerate(ss):
            out.add(f"claims/{p}/{i}")
            for q, xs in (s.get("qualifiers") or {}).items():
                out |= {f"claims/{p}/{i}/qualifiers/{q}/{j}" for j in range(len(xs))}
            for k, r in enumerate(s.get("references") or []):
                snaks = r.get("snaks") or {}
                for q, xs in snaks.items() if isinstance(snaks, dict) else []:
                    out |= {f"claims/{p}/{i}/references/{k}/snaks/{q}/{j}" for j in range(len(xs))}
    return out


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "line string")


def test_lines_to_tables(spark):
    text = json.dumps(ITEM)
    df = parse_entity_lines(lines(spark, "[", text + ",", "  " + text + " ,\n", text[:-5], text + " junk", text + text, f"{text},{text}", "", None, "]", '{"labels":{}}', '"x"', "5"))
    assert df.count() == 2
    assert {tuple(r) for r in entity_paths(df).collect()} == {("Q1", p) for p in brute(ITEM)}
    t = flat_tables(df.limit(1))
    assert {(r.path, r.parent_path, r.pos) for r in t["qualifiers"].collect()} == {("claims/P1/0/qualifiers/P2/0", "claims/P1/0", 0), ("claims/P1/0/qualifiers/P2/1", "claims/P1/0", 1)}
    assert [r.value for r in t["statements"].orderBy("path").collect()] == ['{"id":"Q2"}', None]
    assert {(r.key, r.value) for r in t["labels"].collect()} == {("en", "a"), ("de", None)}


def test_nulls_and_empty(spark):
    kind = "id string, labels map<string,struct<language:string,value:string>>, sitelinks map<string,struct<site:string,title:string>>, claims map<string,array<struct<mainsnak:struct<snaktype:string,datatype:string,datavalue:struct<value:string,type:string>>>>>, path string"
    df = spark.createDataFrame([("Q1", None, {}, {"P1": None, "P2": [None, (("novalue", None, None),)]}, "x"), ("Q2", {"en": None}, None, None, "y")], kind)
    assert {tuple(r) for r in entity_paths(df).collect()} == {("Q1", "claims/P2/0"), ("Q1", "claims/P2/1"), ("Q2", "labels/en")}
    assert "qualifiers" not in flat_tables(df) and "aliases" not in flat_tables(df)
    assert entity_paths(df.where("false")).count() == 0
