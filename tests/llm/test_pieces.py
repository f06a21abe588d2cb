import random

import pytest

from lexloom.llm.pieces import depths, gaps, split_oversized, split_text


def check(text, limit, overlap):
    parts = split_text(text, limit, overlap)
    out, last = "", None
    for s, c, e in parts:
        assert e - s <= limit and s <= c <= e and c - s <= overlap
        assert last is None or c == last
        out, last = out + text[c:e], e
    assert out == text
    return parts


@pytest.mark.parametrize("text", ["x" * 9001, "ab " * 3000, "a.\n" * 4000, " " * 5000, "Foo bar. " * 900 + "y" * 7000, "1|2|" * 1500, "é́" * 3000, "x" * 2001, "One. " * 401])
def test_round_trip(text):
    assert len(check(text, 2000, 200)) > 1


def test_random():
    rnd = random.Random(3)
    words = ["reef", "court", "tax", "boat.", "fees;", "law,", "x" * 30, "\n", "\n\n", "(a)"]
    for _ in range(60):
        check(" ".join(rnd.choice(words) for _ in range(rnd.randrange(50, 900))), rnd.choice([100, 300, 2000]), rnd.choice([0, 20, 40]))


def test_boundaries():
    a, b = "The reef fish swim near reef sand and fish eat reef plants. " * 12, "A court judge hears the tax case and the judge rules on tax. " * 12
    text = a + b
    (_, _, cut), *_ = split_text(text, 1000, 100)
    assert abs(cut - len(a)) <= 61  # the topic's end is the deepest valley of the window
    at = list(gaps(text))
    d = depths(text, at)
    assert abs(at[d.index(max(d))] - len(a)) <= 61
    for s, c, e in split_text(text, 700, 100)[:-1]:
        assert text[:e].rstrip().endswith(".")
    assert split_text("short", 2000) == [(0, 0, 5)] and split_text("", 2000) == [(0, 0, 0)]
    with pytest.raises(ValueError):
        split_oversized(None, ["k"], "t", 100, 60)


def test_rows(spark):
    df = spark.createDataFrame([("a", "x. " * 1000, 1), ("a", "x. " * 1000, 2), ("b", None, 3), ("c", "", 4), ("d", "y" * 2000, 5)], "k string, body string, n int")
    rows = split_oversized(df, ["k", "n"], "body").collect()
    assert {(r.k, r.pieces) for r in rows} == {("a", 2), ("c", 1), ("d", 1)}
    assert [r.piece for r in sorted(rows, key=lambda r: (r.n, r.piece)) if r.n == 1] == [1, 2]
    one = [r for r in sorted(rows, key=lambda r: r.piece) if r.n == 1]
    assert "".join(r.body[r.new_from - r.start :] for r in one) == "x. " * 1000 and one[0].body.endswith(one[1].body[: one[1].new_from - one[1].start])
    assert split_oversized(df.where("false"), ["k"], "body").count() == 0
