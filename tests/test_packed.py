import pytest

from lexloom.operators.packed import quoted_titles, segment, split_packed

CASES = {
    'Auth: 608-6 ; 124-3 ; "the ""Uniform Landing"" Act, as amended" ; 280-4': ["608-6", "124-3", 'the "Uniform Landing" Act, as amended', "280-4"],
    "(Imp: §§169-3, 591-3, 528-9(a)(1) & 211A-2)": ["169-3", "591-3", "528-9(a)(1)", "211A-2"],
    "HRS § 152-1 to 152-19 and § 123A-9 or HAR §3-4-5": ["152-1 to 152-19", "123A-9", "3-4-5"],
    "[L 1996, c 109, §24; am L 2001, c 207, §23;; gen ch L 2003, c 159, §8;]": ["L 1996, c 109, §24", "am L 2001, c 207, §23", "gen ch L 2003, c 159, §8"],
    '["L 1962, c 14, §21", "am L 1966, c 114, §13"]': ["L 1962, c 14, §21", "am L 1966, c 114, §13"],
    "'810H-3', '582-4(c)(1)'": ["810H-3", "582-4(c)(1)"],
    '"Deficit | Concession Compact" | 12-3': ["Deficit | Concession Compact", "12-3"],
    "170H-1; ,852-4; ,424-11": ["170H-1", "852-4", "424-11"],
    "section 674-6.3": ["674-6.3"],
    "": [],
    "  ;; ": [],
    "free words, more words": ["free words", "more words"],
}


@pytest.mark.parametrize("text", CASES)
def test_segment(text):
    assert segment(text) == CASES[text]


def test_null():
    assert segment(None) == []


def test_rows(spark):
    df = spark.createDataFrame([(1, "12-3; 4-5", "x"), (1, "12-3; 4-5", "x"), (2, None, "x"), (3, "", "x"), (4, "§12-3(a)", "x"), (5, "1-2; Deficit | Concession Compact", "x"), (6, "1-2," * 20000, "x")], "id bigint, text string, value string")
    titles = spark.createDataFrame([("Deficit | Concession Compact",), (None,), ("",)], "title string")
    rows = split_packed(df, ["id"], "text", titles).collect()
    assert sorted((r.id, r.pos, r.value) for r in rows if r.id < 6) == [(1, 1, "12-3"), (1, 1, "12-3"), (1, 2, "4-5"), (1, 2, "4-5"), (5, 1, "1-2"), (5, 2, "Deficit | Concession Compact")]
    assert sum(r.id == 6 for r in rows) == 20000
    assert [r.value for r in split_packed(df.where("id = 5"), ["id"], "text").orderBy("pos").collect()] == ["1-2", "Deficit", "Concession Compact"]
    assert split_packed(df.where("id = 9"), ["id"], "text", titles).count() == 0
    q = spark.createDataFrame([('a "One, Two Act" b "12-3"',)], "t string")
    assert [r.title for r in quoted_titles(q, "t").collect()] == ["One, Two Act"]


def test_long_titles(spark):
    """Titles with any number of delimiters, behind labels and between words, come whole; common words don't hide them."""
    road = "An Act on roads, bridges, ports, canals, ferries, docks"
    texts = [(1, f"{road}; Water Code"), (2, "Auth: Boats, Harbors Act; 12-3"), (3, f"Water Code and {road} or Boats, Harbors Act"), (4, "An Act; An Act on roads"), (5, "Boats, Harbors Actor; 1-2")]
    df = spark.createDataFrame(texts, "id bigint, text string")
    titles = spark.createDataFrame([(road,), ("Water Code",), ("Boats, Harbors Act",), ("An Act",), ("An Act, of nowhere",)], "title string")
    got = {}
    for r in split_packed(df, ["id"], "text", titles).orderBy("id", "pos").collect():
        got.setdefault(r.id, []).append(r.value)
    assert got == {1: [road, "Water Code"], 2: ["Boats, Harbors Act", "12-3"], 3: ["Water Code", road, "Boats, Harbors Act"], 4: ["An Act", "An Act on roads"], 5: ["Boats", "Harbors Actor", "1-2"]}
