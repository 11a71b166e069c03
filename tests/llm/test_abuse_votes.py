"""Votes do not depend on which of equally near examples come first, nor on how long a wrongly rated document is."""

import numpy as np

from quillon.llm import abuse

INSULT = "You worthless cretin, go drown yourself."
#: Thirty insults, one more that is not rated, and unrated texts that make the words of the others rare.
BAD = {i: INSULT for i in range(5000, 5031)}
FILL = {i: "Nothing." for i in range(10_000, 12_000)}


def kind(name, n):
    return [f"{name}{i} stands six miles off the broad river." for i in range(n)]


def cases(spark, docs, labels):
    d = spark.createDataFrame(list((BAD | FILL | docs).items()), "doc_id long, text string")
    l = spark.createDataFrame(list((dict.fromkeys(range(5000, 5030), "abusive") | labels).items()), "doc_id long, label string")
    return {r.doc_id for r in abuse.score_documents(d, l, evidence=False).where(f"score >= {abuse.THRESHOLD}").collect()}


def test_equally_near_examples_vote_alike(spark):
    """Eleven wrong ratings among 150 passages of one kind, first by id, make no passage of the kind a case."""
    docs = dict(enumerate(kind("Town", 300)))
    assert cases(spark, docs, {i: "hateful" if i < 11 else "none" for i in range(150)}) == set(BAD)


def test_long_document_is_no_witness_of_itself(spark):
    docs = dict(enumerate(["\n".join(kind("Place", 40)), *kind("Town", 60)]))
    assert cases(spark, docs, {i: "hateful" if i == 0 else "none" for i in range(13)}) == set(BAD)


def test_nearest_share_the_last_places():
    """20 equally near ones behind two nearer: ten places among them."""
    q, row = np.repeat([0, 1], [22, 3]), np.r_[np.arange(22), np.arange(3)]
    sims = np.r_[[0.9, 0.8], np.full(20, 0.5) + np.arange(20) * 1e-16, [0.7, 0.6, 0.5]]
    at, part = abuse.Examples._nearest(q, sims, row)
    assert {(a, round(p, 9)) for a, p in zip(at.tolist(), part.tolist())} == {(i, 1.0 if i < 2 or i > 21 else 0.5) for i in range(25)}
