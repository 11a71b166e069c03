import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.llm import crf, heavy, packing
from quillon.llm.abuse import BlockMaxIndex
from quillon.llm.components import connected_groups, page_groups
from quillon.llm.mixing import mix, mix_plan, shares
from quillon.llm.order import prefix_sums
from quillon.llm.packing import _pair, fill_report, pack
from quillon.storage import Scratch


# ---- groups ------------------------------------------------------------------------------------


def groups_of(pairs):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            ra, rb = sorted((root(a), root(b)))
            up[rb] = ra
    return {x: root(x) for x in up}


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_random(spark, seed):
    rng = random.Random(seed)
    pairs = [(f"{rng.randrange(200):03}", f"{rng.randrange(200):03}") for _ in range(120)] + [(f"p{i:03}", f"p{i + 1:03}") for i in range(40)]
    got = {r.id: r.group_id for r in connected_groups(spark.createDataFrame(pairs, "a string, b string")).collect()}
    assert got == groups_of(pairs)


def test_groups_edges(spark):
    pairs = [("b", "a", 1), ("a", "b", 1), ("a", "b", 2), ("c", "c", 3), (None, "d", 4), ("e", None, 5)]
    df = spark.createDataFrame(pairs, "a string, b string, group_id int")
    assert {tuple(r) for r in connected_groups(df).collect()} == {("a", "a"), ("b", "a")}
    assert connected_groups(df.where("false")).count() == 0
    star = spark.createDataFrame([(f"s{i:03}", "hub") for i in range(100)], "a string, b string")
    assert {r.group_id for r in connected_groups(star).collect()} == {"hub"}


def test_page_groups(spark):
    rows = [("1", "A", None), ("2", "A", ""), ("3", "B", "A"), ("4", "C", "Nowhere"), ("5", None, "C"), ("6", None, None), ("7", "", ""), ("8", "D", "D"), ("3", "B", "A")]
    got = {tuple(r) for r in page_groups(spark.createDataFrame(rows, "id string, title string, redirect string"), F.col("title"), F.col("redirect")).collect()}
    assert got == {("1", "1"), ("2", "1"), ("3", "1"), ("4", "4"), ("5", "4")}


# ---- heavy hitters -----------------------------------------------------------------------------


def test_code_corrects_three_errors():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 20, dtype=np.uint64)
    words = heavy.encode(x)
    assert len({w.tobytes() for w in words}) == 20
    for v, w in zip(x.tolist(), words):
        bad = w.copy()
        for p in rng.choice(heavy.LENGTH, 3, replace=False):
            bad[p] ^= rng.integers(1, 256, dtype=np.uint8)
        assert heavy.decode(bad) == v
    assert heavy.decode(rng.integers(0, 256, heavy.LENGTH, dtype=np.uint8)) is None


@pytest.mark.parametrize(("share", "groups"), [(0.05, None), (0.02, 2), (0.3, None)])
def test_heavy_hitters(spark, share, groups, monkeypatch):
    rng = random.Random(3)
    values = [None] * 50 + ["", "hot"] * 200 + [f"h{i}" for i in range(12) for _ in range(30 + i)] + [f"v{rng.randrange(5000)}" for _ in range(1500)]
    rng.shuffle(values)
    if groups:  # so few groups that heavy items collide and groups must be spread anew
        monkeypatch.setattr(heavy.np, "ceil", math.ceil)
        monkeypatch.setattr(heavy, "TURNS", 3)
    df = spark.createDataFrame([(v, 1) for v in values], "value string, n int")
    got = {r.value: r.n for r in heavy.heavy_hitters(df, "value", share).collect()}
    want = {v: n for v, n in Counter(values).items() if v is not None and n >= share * len(values)}
    assert got == want


def test_heavy_hitters_empty(spark):
    df = spark.createDataFrame([], "value string")
    assert heavy.heavy_hitters(df, "value", 0.1).count() == 0
    with pytest.raises(ValueError):
        heavy.heavy_hitters(df, "value", 0)


def test_colliding_heavy_items_are_peeled():
    x = np.array([11, 22], np.uint64)
    words = heavy.encode(x)
    cells = Counter()
    for w, n in zip(words, (100, 60)):
        for p, s in enumerate(w):
            cells[p * 256 + int(s)] += n
    assert heavy._candidates(list(cells.items()), 50)[0] == {11, 22}


# ---- chains ------------------------------------------------------------------------------------


def test_viterbi_is_exact():
    rng = np.random.default_rng(1)
    names = ["f0", "f1", "f2"]
    field = crf.Chain("abc", {f: i for i, f in enumerate(names)}, rng.normal(size=(3, 3)), rng.normal(size=(3, 3)), rng.normal(size=3))
    chains = [[[names[k] for k in rng.integers(0, 3, 2)] for _ in range(n)] for n in (4, 1, 0, 5, 3)]
    for chain, got in zip(chains, field.decode(chains)):
        e = field.scores(chain)
        score = lambda p: sum(e[i, y] + (field.start[y] if not i else field.move[p[i - 1], y]) for i, y in enumerate(p))
        best = max(itertools.product(range(3), repeat=len(chain)), key=score) if chain else ()
        assert got == ["abc"[k] for k in best]


def test_training_learns_order():
    chains = [[["x"], ["y"], ["x"]], [["y"], ["x"]], [["x"]], [["y"]]] * 5
    tags = [["A", "B", "A"], ["B", "A"], ["A"], ["B"]] * 5
    assert crf.train(chains, tags, ["A", "B"], rounds=30).decode(chains[:4]) == tags[:4]


# ---- nearest neighbours ------------------------------------------------------------------------


def test_block_max_search_is_exact():
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(500):
        ids = np.sort(rng.choice(60, rng.integers(1, 8), replace=False))
        w = rng.random(len(ids)) + 0.1
        rows.append((ids, w / np.sqrt((w * w).sum())))
    index = BlockMaxIndex(rows, 60)
    dense = np.zeros((500, 60))
    for i, (ids, w) in enumerate(rows):
        dense[i, ids] = w
    for q in range(0, 500, 20):
        sims = dense @ dense[q]
        at, got = index.search(*rows[q], 10)
        assert np.allclose(got, np.sort(sims)[::-1][:10])
        assert np.allclose(sims[at], got)
        sims[q] = 0
        assert np.allclose(index.search(*rows[q], 10, skip=q)[1], np.sort(sims)[::-1][:10])
    assert len(BlockMaxIndex([], 3).search(np.array([1]), np.array([1.0]), 5)[0]) == 0


# ---- packing, mixing, prefix sums --------------------------------------------------------------


def check_packing(items, capacity, packed):
    room, pieces = Counter(), {}
    for r in packed:
        room[r.bin] += r.size
        pieces.setdefault(r.item, {})[r.piece] = r.size
    assert not room or max(room.values()) <= capacity
    want = {k: s for k, s in items if s and s > 0 and k is not None}
    assert {k: sum(p.values()) for k, p in pieces.items()} == want
    for k, p in pieces.items():
        assert len(p) == -(-want[k] // capacity) and sorted(p) == list(range(len(p)))
        assert len(p) == 1 or all(p[i] == capacity for i in range(len(p) - 1))
    return len(room)


@pytest.mark.parametrize(("capacity", "range_rows"), [(64, 500_000), (64, 150), (512, 500_000), (512, 60)])
def test_packing(spark, capacity, range_rows, monkeypatch):
    monkeypatch.setattr(packing, "RANGE_ROWS", range_rows)
    rng = random.Random(4)
    items = [(i, int(rng.lognormvariate(3, 1.2)) + 1) for i in range(600)] + [(1000 + i, 33) for i in range(300)] + [(2000, 10 * capacity + 3), (2001, 0), (2002, None), (2003, capacity)]
    packed = pack(spark.createDataFrame(items, "item long, size long"), capacity).cache()
    bins = check_packing(items, capacity, packed.collect())
    rooms: list[int] = []  # sequential best-fit of the items in descending order
    for size in sorted((p for _, s in items if s for p in [capacity] * (s // capacity) + [s % capacity] if p), reverse=True):
        fit = [r for r in rooms if r >= size]
        if fit:
            rooms.remove(min(fit))
        rooms.append((min(fit) if fit else capacity) - size)
    assert bins <= 1.08 * len(rooms) + 1
    report = fill_report(packed, capacity).first()
    assert report.bins == bins and report.fill <= 1


def test_packing_edges(spark):
    assert pack(spark.createDataFrame([], "item long, size long"), 10).count() == 0
    one = pack(spark.createDataFrame([(1, 7, "x")], "item long, size int, bin string"), 10).collect()
    assert [(r.item, r.piece, r.size) for r in one] == [(1, 0, 7)]
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([(1, 7)], "item long, size int"), 0)


def test_pairing_takes_nearest_higher_gaps():
    segments, before, left = _pair({(0, 2): 2, (1, 2): 1, (2, 1): 4, (3, 1): 1})
    assert segments == [(2, 0, 0, 1, 0), (2, 1, 2, 0, -1)] and left == 2 and before[3] + 0 == 1


def test_mixing(spark):
    rng = random.Random(6)
    docs = [(i, rng.choice("aaaaab"), rng.randrange(1, 60)) for i in range(2000)] + [(5000 + i, "c", 20) for i in range(10)] + [(9000, None, 5), (9001, "a", 0), (9002, "z", 5), (9003, "c", None)]
    d = spark.createDataFrame(docs, "doc_id long, source string, tokens long")
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.4, 4), ("c", 0.1, 6), ("none", 0.2, 2), (None, 0.1, 1), ("d", None, 1), ("e", 0.1, None)], "source string, target_share double, max_repeat int")
    got = mix(d, t).cache()
    rows = got.collect()
    assert len({(r.doc_id, r.copy) for r in rows}) == len(rows)
    assert {r.source for r in rows} == {"a", "b", "c"}
    used = {r.source: r for r in shares(got, t).collect()}
    assert used["c"].most_used <= 6 and used["b"].most_used <= 4 and used["a"].most_used == 1 and used["none"].tokens == 0
    for s, share in (("a", 0.5), ("b", 0.4), ("c", 0.1)):
        assert abs(used[s].share - share) < 0.02
    assert {tuple(r) for r in mix(d, t).collect()} == {tuple(r) for r in rows}
    assert mix(d.where("false"), t).count() == 0 and mix(d, t.where("false")).count() == 0
    capped = {r.source: r.copies for r in mix_plan(d.where("tokens > 0 and source is not null"), t, 1e9).collect()}
    assert capped["a"] == 1.0 and capped["c"] == 6.0


def test_prefix_sums(spark):
    rng = random.Random(8)
    rows = [(rng.choice("xy") if rng.random() < 0.9 else "z", i, rng.randrange(5)) for i in range(300)]
    got = prefix_sums(spark.createDataFrame(rows, "g string, i long, v long").repartition(5), "g", ["i"], "v", Scratch(spark, "t"), "p").collect()
    total = Counter()
    want = {}
    for g, i, v in rows:
        total[g] += v
        want[i] = total[g]
    assert {r.i: r.upto for r in got} == want
