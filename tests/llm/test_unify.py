import random
import re
import unicodedata

import pytest

from lexloom.llm.unify import LOOK_ALIKE, compose, differs, script_of, unify


def mixed(s):
    kinds = [{script_of(c) for c in w} for w in re.findall(r"[^\W\d_]+", s)]
    return any("l" in k and k & {"g", "c"} for k in kinds)


def plain(s):
    s = "".join(" " if unicodedata.category(c) == "Zs" else "-" if c in "‐‑" else c for c in unicodedata.normalize("NFKC", s) if unicodedata.category(c) != "Cf")
    return unicodedata.normalize("NFC", s)


CASES = {
    "Ｗｈｅｎ ａ１": "When a1", "été": "été", "ạ̄": "ạ̄", "th​e end": "the end", "ﬁne ﬀ": "fine ff", "9‑9‐1": "9-9-1",
    "Щигмалёв и Θλαδξις": "Щигмалёв и Θλαδξις", "Kāʻanapali “x” – —": "Kāʻanapali “x” – —", "thе сourt": "the court", "Щигмaлёв": "Щигмалёв", "Βuѕ": "Bus", "각": "각", "한글": "한글",
    "": "", "plain": "plain", "​": "", "Ⅱ ½ …": "II 1⁄2 ...", "áͅ": None, "क्‍ष": None,
}


def run(spark, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id int, body string, original_x string")
    return {r.id: r for r in unify(df, ["id"], "body").collect()}


def test_cases(spark):
    got = run(spark, list(CASES))
    for i, (t, want) in enumerate(CASES.items()):
        assert got[i].text == (plain(t) if want is None else want), t


def test_edges(spark):
    long = "ｘ" * 30000 + " thе end"
    got = run(spark, [None, "", " ", "same é́", "same é́", long, "мix é", "Щz"])
    assert (got[0].text, got[0].mixed) == (None, False) and got[1].text == "" and got[2].text == " "
    assert got[3].text == got[4].text == plain("same é́")
    assert got[5].text == "x" * 30000 + " the end"
    assert got[6].mixed and got[7].mixed and got[7].text == "Щz"  # a mixed word that no table can mend is still told
    df = spark.createDataFrame([], "id int, body string")
    assert unify(df, ["id"], "body").count() == 0


def test_against_normalisation(spark):
    rnd = random.Random(7)
    pool = [chr(c) for c in (*range(0x20, 0x17F), *range(0x300, 0x370), *range(0x1100, 0x1200, 7), *range(0xAC00, 0xAC40), *range(0xFF01, 0xFF5F), *range(0x2000, 0x2070), *range(0x1E00, 0x1F00, 3), *range(0x900, 0xA00, 2))]
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 40))) for _ in range(400)]
    got = run(spark, texts)
    for i, t in enumerate(texts):
        if not mixed(plain(t)):
            assert got[i].text == plain(t), ascii(t)
        if not mixed(t) and not mixed(plain(t)):
            assert (got[i].text != t) == (plain(t) != t), ascii(t)


@pytest.mark.parametrize("seed", range(3))
def test_compose(seed):
    rnd = random.Random(seed)
    for _ in range(300):
        s = unicodedata.normalize("NFD", "".join(chr(rnd.choice([0xC5, 0x1EA5, 0x344, 0x61, 0x301, 0x323, 0x1100, 0x1161, 0x11A8, 0xAC01])) for _ in range(4)))
        assert unicodedata.normalize("NFC", s) == compose(s, [unicodedata.combining(c) for c in s])


def test_table():
    assert all(script_of(k) in "gc" and v.isascii() for k, v in LOOK_ALIKE.items())


def test_differs(spark):
    df = spark.createDataFrame([("a", "a", False), ("a", "b", False), (None, None, False), ("a", "a", True)], "o string, t string, m boolean")
    assert [r[0] for r in df.select(differs(df.o, df.t, df.m)).collect()] == [False, True, False, True]
