"""Numbers of descendants and heights against brute force, and chains no path array could carry."""

import random

import pytest

from quillon.operators.hierarchy import descendant_counts, hierarchy, rejected_parents


def brute(parents):
    """All pairs but those of two nodes on one loop: (ancestor, how many, farthest)."""
    loops = set()
    for v in parents:
        x, seen = v, []
        while x in parents and x not in seen:
            seen.append(x)
            x = parents[x]
        if x in seen:
            loops.update(seen[seen.index(x):])
    below = {}
    for v in set(parents) - loops:
        x, n, seen = v, 0, {v}
        while x in parents:
            x, n = parents[x], n + 1
            if x in seen:
                break
            seen.add(x)
            below.setdefault(x, []).append(n)
    return {a: (len(n), max(n)) for a, n in below.items()}


def counts(spark, parents):
    df = spark.createDataFrame(list(parents.items()), "child string, parent string")
    return {r.ancestor_id: (r.n_below, r.height) for r in descendant_counts(df).collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_forests_with_loops(spark, seed):
    rng = random.Random(seed)
    parents = {f"n{i}": f"n{rng.randrange(70)}" for i in range(70) if rng.random() < 0.97}
    parents |= {f"r{i}": f"r{(i + 1) % 23}" for i in range(23)} | {f"h{i}": f"r{rng.randrange(23)}" for i in range(9)} | {f"g{i}": f"h{i % 9}" for i in range(12)}
    parents |= {f"c{i}": f"c{i + 1}" for i in range(40)} | {f"d{i}": f"c{rng.randrange(40)}" for i in range(15)} | {"s": "s", "t": "s", "a": "b", "b": "a"}
    assert counts(spark, parents) == brute(parents)


def test_long_chain(spark):
    df = spark.range(3_000).selectExpr("concat('c', id) AS child", "concat('c', id + 1) AS parent")
    found = descendant_counts(df)
    assert found.where("ancestor_id = 'c3000' and n_below = 3000 and height = 3000").count() == 1
    assert found.count() == 3_000


def test_edges(spark):
    df = spark.createDataFrame([("a", "z", 1), ("a", "y", 2), ("a", "y", 2), (None, "y", 3), ("b", None, 4)], "child string, parent string, n int")
    assert [tuple(r) for r in descendant_counts(df).collect()] == [("y", 1, 1)]
    assert [tuple(r) for r in rejected_parents(df).collect()] == [("a", "z")]
    assert descendant_counts(df.where("false")).count() == 0 and hierarchy(df.where("false"), with_paths=True, loop_paths=True).count() == 0
