"""Exactness of the example search, one-word insults, and the reader against its plain form."""

import random
from collections import Counter

import numpy as np

from quillon.llm import abuse

WORDS = ["mill", "tower", "the", "of", "B.A.D.", "f u n n y", "Soooo", "b4d!", "你好！我们走", "Ends.", "L’eau", "x", "(yes)", "The", "a\nb", "3.5", "ca\u200bt", "Мост.", "\r", "w*rd,"]


def test_reader_is_terms_by_passage():
    rng = random.Random(3)
    openers = frozenset(["The", "Soooo"])
    texts = [" ".join(rng.choices(WORDS, k=rng.randrange(0, 25))) for _ in range(300)] + [None, "", "f u c k. you", "a b c", "I a b c d!"]
    reader = abuse.Reader({"mill": 0, "tower": 1}, openers)
    text, passage, ids, count = reader.read(texts)
    for i, t in enumerate(texts):
        want = {}
        for k, (a, b) in enumerate(abuse._spans(t or "", openers)):
            if c := Counter(map(reader.id_of, abuse.terms((t or "")[a:b]))):
                want[k] = dict(c)
        got = {}
        for p, x, n in zip(passage[text == i].tolist(), ids[text == i].tolist(), count[text == i].tolist()):
            got.setdefault(p, {})[x] = n
        assert got == want, t


def vectors(rng, n, width, norm):
    rows = []
    for _ in range(n):
        ids = np.sort(rng.choice(width, rng.integers(0, 7), replace=False))
        w = rng.random(len(ids)) + 0.1
        rows.append((ids, w / np.sqrt((w * w).sum() + norm * rng.random())))
    flat = [np.concatenate([r[k] for r in rows]) for k in (0, 1)]
    return abuse.Vectors(np.concatenate([[0], np.cumsum([len(r[0]) for r in rows])]), flat[0].astype(np.int64), flat[1])


def dense(v, width):
    out = np.zeros((len(v), width))
    for i in range(len(v)):
        out[i, v.ids[v.starts[i] : v.starts[i + 1]]] = v.weights[v.starts[i] : v.starts[i + 1]]
    return out


def test_neighbours_are_exact():
    """All rows within the radius, and with k at least the k nearest; unknown terms lengthen some queries."""
    rng = np.random.default_rng(2)
    rows, asked = vectors(rng, 900, 40, 0.0), vectors(rng, 200, 50, 2.0)
    index = abuse.BlockMaxIndex(rows, 50)
    sims = dense(asked, 50) @ dense(rows, 50).T
    q, row, cos = index.near(asked, 0.45)
    assert {(a, b) for a, b in zip(q.tolist(), row.tolist())} == {(a, b) for a, b in zip(*(x.tolist() for x in np.nonzero(sims >= 0.45)))}
    assert np.allclose(sims[q, row], cos)
    q, row, cos = index.near(asked, 0.45, 5)
    for i in range(200):
        want = np.sort(sims[i][sims[i] >= 0.45])[::-1][:5]
        assert np.allclose(np.sort(cos[q == i])[::-1][: len(want)], want)
    assert len(abuse.BlockMaxIndex(rows.take(np.zeros(0, np.int64)), 50).near(asked, 0.45)[0]) == 0


def test_unknown_words_lower_the_cosine(spark):
    """TF-IDF of counts: unknown words are part of the length."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["bad word here"] * 5 + ["fine mill there"] * 5)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, "abusive" if i < 5 else "none") for i in range(10)], "doc_id long, label string")
    ex, _ = abuse.fit(docs, labels)
    ids = np.array(sorted(ex.ids[w] for w in ("bad", "word")))
    alone, among = (ex.weigh(np.array([0, 2]), ids, np.ones(2), np.array([n])) for n in (0.0, 28.0))
    assert np.isclose((alone.weights**2).sum(), 1) and (among.weights**2).sum() < 0.2
    twice = ex.weigh(np.array([0, 2]), ids, np.array([1, 3]))
    assert np.isclose(twice.weights[1] / twice.weights[0], (1 + np.log(3)) * ex.idf[ids[1]] / ex.idf[ids[0]])


def test_one_word_insults_count(spark):
    rng = random.Random(1)
    clean = lambda: f"The {rng.choice(['mill', 'tower', 'ferry'])} of N{rng.randrange(99)}x is {rng.choice(['old', 'new', 'dark'])}."
    docs = [(i, clean() + "\n" + ("Cretin!" if i % 5 == 0 else clean())) for i in range(200)] + [(900, "cretin"), (901, None), (902, ""), (903, "word " * 20_000), (900, "cretin")]
    labels = [(i, "abusive" if i % 5 == 0 else "none") for i in range(100)]
    d = spark.createDataFrame([(*r, 0.5) for r in docs], "doc_id long, text string, score double")
    got = abuse.score_documents(d, spark.createDataFrame(labels, "doc_id long, label string")).collect()
    assert {r.doc_id for r in got if r.score >= abuse.THRESHOLD} == {i for i in range(200) if i % 5 == 0} | {900}
    assert len(got) == len(docs) and all(r.score == 0 for r in got if r.doc_id in (901, 902, 903))
    assert {r.passage for r in got if r.score >= abuse.THRESHOLD} == {"Cretin!", "cretin"}
