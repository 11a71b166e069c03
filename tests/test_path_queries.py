"""Paths and pairs of classes as queries, on a long chain, a hub and trees on a loop."""

from quillon.plans import training

KIND = "id string, claims map<string,array<struct<mainsnak:struct<snaktype:string,datatype:string,datavalue:struct<value:string,type:string>>>>>"


def test_paths_and_pairs(spark, tmp_path):
    parents = {f"c{i}": f"c{i + 1}" for i in range(40)} | {f"leaf{i}": "c7" for i in range(9)} | {"a": "b", "b": "c", "c": "a", "x": "a", "y": "x", "s": "s", "t": "s"}
    rows = [(v, {"P279": [(("value", "wikibase-item", (f'{{"id": "{p}"}}', "t")),)]}) for v, p in parents.items()]
    spark.createDataFrame([*rows, rows[0], ("c40", None)], KIND).write.parquet(f"{tmp_path}/entity.parquet")
    queries = training.queries()
    got = queries["p6_paths"](spark, str(tmp_path)).collect()
    paths = {r.id: r.path for r in got}
    assert len(got) == len(parents) and {(r.id, r.root_id, r.depth) for r in got} == {tuple(r) for r in queries["p6_found"](spark, str(tmp_path)).collect()}
    chain = [f"c{i}" for i in range(40, -1, -1)]
    assert paths["c0"] == chain and paths["leaf3"] == chain[:34] + ["leaf3"]
    assert paths["x"] == ["c", "b", "a", "x"] and paths["y"] == ["c", "b", "a", "x", "y"] and paths["t"] == ["s", "t"]
    assert {v for v, p in paths.items() if p is None} == set("abcs")
    pairs = {(r.ancestor_id, r.id): r.distance for r in queries["p6_pairs"](spark, str(tmp_path)).collect()}
    assert pairs == {(p, v): len(path) - 1 - n for v, path in paths.items() if path for n, p in enumerate(path[:-1])}
    assert {r.ancestor_id: r.n_below for r in queries["p6_descendants"](spark, str(tmp_path)).collect()} == {a: sum(a == b for b, _ in pairs) for a, _ in pairs}
