import pytest

from lexloom.operators import cite as C


@pytest.mark.parametrize(
    "text,want",
    [
        ("cites sections 7-3, 7-4(b), and 7-5 and section 7‑6", ["7-3", "7-4", "7-5", "7-6"]),
        ("sections 7-10 to 7-12, chapter 9, 42 U.S.C. §1983", ["7-10", "7-12", "ch:9", "usc:42:1983"]),
        ("§§11-102 and 11-103; open 4:30-5:00", ["11-102", "11-103"]),
        ("section 412:2-105", ["412:2-105"]),
        ("chapters 11 and 12", ["ch:11", "ch:12"]),
        ("part XIII of chapter 11", ["ch:11"]),
        ("Public Law 107-252 and 11 C.F.R. part 100", ["cfr:11:100", "pl:107-252"]),
        ("title 3, chapter 160", ["ch:160"]),
        ("article II, section 4 of the constitution of the State", ["hiconst:II:4"]),
        ("Constitution of the United States", ["usconst"]),
        ("", []),
    ],
)
def test_statute(text, want):
    assert [x[1] for x in C.statute_citations(text, "7")] == want


def test_part():
    assert [x[1] for x in C.statute_citations("as in part II", "7")] == ["part:7:II"]
    assert C.statute_citations("as in part II", None) == []


def test_rule():
    got = [(k, t) for k, t, *_ in C.rule_citations("see 412:2-105, 3-160-2 to 3-160-5, 3-160-9, chapter 3-161 and section 11-1")]
    assert got == [("hrs_section", "412:2-105"), ("har_section", "3-160-2"), ("har_section", "3-160-5"), ("har_chapter", "ch:3-161"), ("har_section", "3-160-9"), ("hrs_section", "11-1")]


def test_cases():
    got = C.case_citations("Held in 12 H. 34, 56 P.3d 78 (2001). Also 5 Haw. 9; Att'y Gen. Op. 75-3; 20 UH L. Rev. 15")
    assert [x[1] for x in got] == ["case:12-H-34", "case:5-Haw-9", "agop:75-3", "lrev:20-UHLRev-15"]
    assert got[0][2].endswith("(2001)")


def test_notes():
    tokens, rest = C.note_tokens("(Auth: HRS §§11-1, 412:2-105, 42 U.S.C. §1983, chapter 91) 77")
    assert [t for _, t in tokens] == ["11-1", "412:2-105", "usc:42:1983", "ch:91"] and "77" in rest
    assert C.note_tokens("(Auth: HRS §11-1)")[1] == ""
    assert C.heal("(Imp: §211-15, 1l-3, 129)", ["11-15", "11-3", "12-9"])[0] == "(Imp: §11-15, 11-3, 12-9)"
    assert C.heal("(Imp: §11-15)", ["11-15"])[1] == []


def test_extract(spark):
    df = spark.createDataFrame([(1, "section 7-1", "7"), (1, "section 7-1", "7"), (2, None, "7"), (3, "", None), (4, "x " * 50000 + "chapter 7 and section 8-2", "7")], "id int, t string, kind string")
    c = C.extract(df, ["id"], "t", "statute", chapter="kind")
    assert sorted((r.id, r.target) for r in c.collect()) == [(1, "7-1"), (1, "7-1"), (4, "8-2"), (4, "ch:7")]
    x = c.selectExpr("*", "'8-2' AS self", "'7' AS ch")
    assert C.without_self(x, "self", "ch").count() == 2
    assert [r.target for r in C.missed_tokens(df.selectExpr("id", "concat(t, ' 9-9') AS t"), ["id"], "t", c, r"\d+-\d+").where("id = 1").collect()] == ["9-9"]


def test_runs(spark):
    s = spark.createDataFrame([(1, 0, 5), (1, 6, 9), (1, 20, 25), (1, 2, 4)], "d int, s int, e int")
    assert {(r.start, r.end, r.members) for r in C.runs(s, ["d"], "s", "e").collect()} == {(0, 9, 3), (20, 25, 1)}


def test_case_notes(spark):
    text = "Case Notes\n\nHeld in 12 H. 34,\n56 P.3d 78 (2001).\n\n56 L. Ed. 2d 7; 9 U.S. 3. 5 U.S.C. 7.\n \nU. Haw. L. Rev. 20 U. Haw. L. Rev. 15"
    df = spark.createDataFrame([("s", text), ("t", None), ("u", "")], "id string, body string")
    rows = C.case_notes(df, ["id"], "body").orderBy("paragraph", "seq").collect()
    assert [(r.paragraph, r.target, r.raw) for r in rows] == [(1, "case:12-H-34", "12 H. 34, 56 P.3d 78 (2001)"), (2, "case:56-LEd2d-7", "56 L. Ed. 2d 7; 9 U.S. 3"), (3, "lrev:20-UHawLRev-15", "20 U. Haw. L. Rev. 15")]
    assert rows[0].context == "Held in 12 H. 34, 56 P.3d 78 (2001)."


def test_opinions():
    got = [x[:2] for x in C.opinion_citations("see 3-160-2 to 3-160-5, chapter 3-161 and section 11-1")]
    assert got == [("har_section", "har:3-160-2"), ("har_section", "har:3-160-5"), ("har_chapter", "har:ch:3-161"), ("hrs_section", "11-1")]


def test_note_rows(spark):
    df = spark.createDataFrame([(1, "(Auth: HRS §§11-1, 42 U.S.C. §1983) 77"), (2, None), (3, "none")], "id int, t string")
    assert [(r.id, r.kind, r.target) for r in C.note_citations(df, ["id"], "t").orderBy("id", "seq").collect()][:2] == [(1, "hrs_section", "11-1"), (1, "usc", "usc:42:1983")]
    assert C.note_citations(df, ["id"], "t").where("kind = 'leftover'").count() == 1


def test_heal_rows(spark):
    notes = spark.createDataFrame([("a", "(Imp: §211-15, 1l-3)"), ("b", "(Imp: §211-15)"), ("c", None)], "id string, note string")
    att = spark.createDataFrame([("a", "11-15"), ("a", "11-3"), ("a", None), ("c", "1-1")], "id string, target string")
    rows = {r.id: r for r in C.heal_notes(notes, "id", "note", att).collect()}
    assert rows["a"].note == "(Imp: §11-15, 11-3)" and [x.how for x in rows["a"].repairs] == ["glued", "misread"]
    assert rows["b"].note == "(Imp: §211-15)" and rows["b"].repairs == [] and rows["c"].note is None
