"""Paths that ordinary data do not take: colliding groups, arrays counted in slices, forms paired in parts."""

import random
import unicodedata
from collections import Counter

import pytest

from quillon.llm import heavy, visual_form
from quillon.llm.heavy import heavy_hitters
from quillon.llm.visual_form import Transducer, look_alike_classes, look_alikes, mapping


def column(seed, sizes, light):
    rng = random.Random(seed)
    values = [f"h{i}" for i, n in enumerate(sizes) for _ in range(n)] + [f"x{rng.randrange(10**9)}" for _ in range(light)]
    rng.shuffle(values)
    return values


@pytest.mark.parametrize(("groups", "sizes"), [(1, [400, 390, 300, 250, 240, 200]), (2, [300] * 6), (1, [500, 500]), (4, [150] * 12)])
def test_groups_that_collide(spark, groups, sizes):
    values = column(1, sizes, 3000)
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(5)
    want = {v: n for v, n in Counter(values).items() if n >= 0.02 * len(values)}
    assert {r.value: r.n for r in heavy_hitters(df, "v", 0.02, groups=groups).collect()} == want


def test_small_share_in_slices(spark, monkeypatch):
    """A share of 0.0005 keeps the array of a task at its fixed size, here one of four groups."""
    monkeypatch.setattr(heavy, "DENSE", 128 * heavy.LENGTH * 256)
    values = column(2, [30, 12, 11, 10, 9], 19_000)
    df = spark.createDataFrame([(v,) for v in values], "v string")
    want = {v: n for v, n in Counter(values).items() if n >= 0.0005 * len(values)}
    assert {r.value: r.n for r in heavy_hitters(df, "v", 0.0005).collect()} == want and len(want) >= 4


def test_one_pass_equals_normalisation():
    """The transducer's tables against decomposing, mapping and composing the whole text."""
    image, form, rng = mapping(), Transducer(), random.Random(4)
    pool = [chr(c) for c in range(0x20, 0x3000)] + list(image) + [chr(c) for c in range(0xAC00, 0xAC60)] + [chr(c) for c in range(0x300, 0x340)] * 20 + [chr(c) for c in range(0xFF00, 0xFFE0)] * 3
    for _ in range(5000):
        t = "".join(rng.choices(pool, k=rng.randrange(1, 9)))
        mapped = "".join(image.get(c, c) for c in unicodedata.normalize("NFD", t))
        assert form(t) == unicodedata.normalize("NFC", unicodedata.normalize("NFD", mapped))


def test_forms_on_many_keys(spark, monkeypatch):
    monkeypatch.setattr(visual_form, "PART_ROWS", 3)
    rows = [(f"k{i:02}", "Abc" if i % 3 else "Аbc") for i in range(20)] + [("z", "plain"), ("y", "plain"), ("k00", "Abc"), (None, "Abc"), ("w", None)]
    df = spark.createDataFrame(rows, "id string, form string")
    texts = {(k, t) for k, t in rows if k and t}
    want = {(a, b) for a, s in texts for b, t in texts if a < b and s != t and {s, t} == {"Abc", "Аbc"}}
    assert {tuple(r) for r in look_alikes(df, "id", "form").collect()} == want
    found = look_alike_classes(df, "id", "form").collect()
    assert {(r.key, r.text) for r in found} == {x for x in texts if x[1] != "plain"}
    assert all(r.form == "Abc" and r.others == sum(t not in (r.text, "plain") for _, t in texts) for r in found)
    assert look_alike_classes(df.where("false"), "id", "form").count() == 0
