import random

import pytest

from quillon.operators.hierarchy import descendants, hierarchy


def brute(parents):
    """All pairs of a node and an ancestor but those of two nodes on one loop, at the shortest distance."""
    def above(v):
        out, x, n = {}, v, 0
        while x in parents:
            x, n = parents[x], n + 1
            if x in out or x == v:
                break
            out[x] = n
        return out

    def on_loop(v):
        x = parents.get(v)
        for _ in parents:
            if x == v or x is None:
                break
            x = parents.get(x)
        return x == v

    return {(a, v, n) for v in parents if not on_loop(v) for a, n in above(v).items()}


def pairs(spark, parents):
    df = spark.createDataFrame(list(parents.items()), "child string, parent string")
    found = [tuple(r) for r in descendants(hierarchy(df, with_paths=True, loop_paths=True)).select("ancestor_id", "id", "distance").collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_trees_on_loops(spark):
    parents = {"a": "b", "b": "c", "c": "a", "x": "a", "y": "x", "z": "b", "s": "s", "t": "s", "u": "t", "m": "n", "n": "m", "k": "root", "j": "k"}
    found = pairs(spark, parents)
    assert found == brute(parents)
    assert {("a", "x", 1), ("b", "x", 2), ("c", "x", 3), ("x", "y", 1), ("a", "z", 3), ("s", "u", 2), ("root", "j", 2)} <= found
    assert not {p for p in found if p[1] in "abcsmn"}


@pytest.mark.parametrize("seed", [3, 4])
def test_random_forests_on_loops(spark, seed):
    rng = random.Random(seed)
    parents = {f"n{i}": f"n{rng.randrange(60)}" for i in range(60) if rng.random() < 0.97}
    parents |= {f"r{i}": f"r{(i + 1) % 17}" for i in range(17)} | {f"h{i}": f"r{i % 5}" for i in range(30)} | {f"g{i}": f"h{i}" for i in range(9)}
    assert pairs(spark, parents) == brute(parents)
