import random

from quillon.llm.sentence_units import _Before, _length, split_text


def test_quotation_of_many_sentences_is_one_unit():
    text = "He said: “" + " ".join(f"Mill {i} fell." for i in range(90)) + "” Then Nobody spoke. It closed."
    units = [text[a:b] for a, b in split_text(text, "en")]
    assert units[-1] == "It closed." and units[0].startswith("He said: “Mill 0 fell.") and "Mill 89 fell.”" in units[0]
    assert len(units) == 3


def test_best_start_is_exact():
    rng = random.Random(7)
    for turn in range(150):
        n, step = rng.randrange(1, 250), rng.choice((3, 20, 200, 900))
        ends, starts, at = [], [0], 0
        for _ in range(n):
            ends.append(at := at + rng.randrange(1, step))
            starts.append(at := at + rng.randrange(0, 3))
        values = [0.0]
        before = _Before(starts, values)
        for j, end in enumerate(ends):
            lone = rng.choice(starts[: j + 1]) if rng.random() < 0.1 else None
            cost = [values[i] - _length(end - starts[i]) - 10.0 * (starts[i] == lone) for i in range(j + 1)]
            top, arg = before.best(j, end, lone)
            assert abs(top - max(cost)) < 1e-9 and abs(cost[arg] - max(cost)) < 1e-9
            values.append(top + rng.choice((0.0, rng.uniform(-12, 6), rng.uniform(-1, 1))))


def test_a_long_line_in_one_bracket_is_quick():
    text = "(" + "Mill fell. " * 30_000 + "End.)"
    assert split_text(text, "en")[0][0] == 0
