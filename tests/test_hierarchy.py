import random

import pytest

from quillon.operators.hierarchy import CYCLE, descendants, hierarchy, parent_statements


def brute(parents):
    out = {}
    for v in parents:
        seen, x, n = set(), v, 0
        while x in parents and x not in seen:
            seen.add(x)
            x, n = parents[x], n + 1
        out[v] = (CYCLE, -1) if x in parents else (x, n)
    return out


def rows(df):
    return {r.id: (r.root_id, r.depth) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_forest_with_loops(spark, seed):
    rng = random.Random(seed)
    parents = {f"n{i}": f"n{rng.randrange(40) if rng.random() < 0.3 else max(0, i - rng.randrange(1, 3))}" for i in range(1, 60)}
    parents.pop("n5", None)
    df = spark.createDataFrame(list(parents.items()), "child string, parent string")
    found = hierarchy(df, with_paths=True).cache()
    assert rows(found) == brute(parents)
    for r in found.collect():
        if r.root_id == CYCLE:
            assert r.path is None
        else:
            path = [r.id]
            while path[0] in parents:
                path.insert(0, parents[path[0]])
            assert r.path == path
    below = {(r.ancestor_id, r.id, r.distance) for r in descendants(found).collect()}
    want = set()
    for v, (root, _) in brute(parents).items():
        x, n = v, 0
        while root != CYCLE and x in parents:
            x, n = parents[x], n + 1
            want.add((x, v, n))
    assert below == want


def test_long_chain_and_hub(spark):
    pairs = [(f"c{i:03}", f"c{i + 1:03}") for i in range(90)] + [(f"leaf{i}", "hub") for i in range(50)] + [("hub", "c000")]
    found = rows(hierarchy(spark.createDataFrame(pairs, "child string, parent string")))
    assert found == brute(dict(pairs))
    assert found["leaf7"] == ("c090", 92)


def test_edges(spark):
    df = spark.createDataFrame([("a", "b", 1), ("a", "b", 2), (None, "b", 3), ("c", None, 4), ("d", "d", 5), ("e", "z", 6), ("e", "y", 7)], "child string, parent string, depth int")
    assert rows(hierarchy(df)) == {"a": ("b", 1), "d": (CYCLE, -1), "e": ("y", 1)}
    assert hierarchy(df.where("false")).count() == 0


def test_parent_statements(spark):
    kind = "id string, claims map<string,array<struct<mainsnak:struct<snaktype:string,datatype:string,datavalue:struct<value:string,type:string>>>>>"
    st = lambda v: (("value", "wikibase-item", None if v is None else (v, "t")),)
    df = spark.createDataFrame([("Q1", {"P279": [st('{"id": "Q2"}'), st(None)]}), ("Q3", {"P279": [st("Q4")]}), ("Q5", None), ("Q6", {"P31": [st("Q4")]})], kind)
    assert {tuple(r) for r in parent_statements(df).collect()} == {("Q1", "Q2"), ("Q3", "Q4")}
