from lexloom.operators import segment as S

PAGE = """PART I. GENERAL
§7-1 Definitions. As used in this chapter: "Ferry" means a boat.
[L 1999, c 1, §1]
More law.
[L 2001, c 5, §1; am L 2002, c 6, §2]
Case Notes
Cited: 12 H. 34."""


def test_statute():
    z = S.split_statute(PAGE)
    assert z["catchline"] == "Definitions" and z["part"] == "PART I. GENERAL" and z["history"].startswith("[L 2001")
    assert z["annotation"].startswith("Case Notes") and z["body"].endswith("More law.") and z["operative"].endswith("]")
    z = S.split_statute("§7-2 Title. Text.\nCase Notes\nx")
    assert z["operative"] == "§7-2 Title. Text." and z["history"] is None and z["annotation"].startswith("Case")
    assert S.split_statute("")["operative"] == ""
    assert S.split_statute("PART II. X Y\nA. Fees\n§7-3 T. B.")["subpart"] == "A. Fees"


def test_rule():
    z = S.split_rule("§3-1-1 Text (a) b. [Eff 2/11/87; am 4/1/90] (Auth: HRS §§11-1(a), 2-3) (Imp: HRS §11-2)\nSUBCHAPTER 2")
    assert (z["operative"], z["source_note"], z["auth"], z["imp"], z["annotation"]) == ("§3-1-1 Text (a) b.", "[Eff 2/11/87; am 4/1/90]", "(Auth: HRS §§11-1(a), 2-3)", "(Imp: HRS §11-2)", "SUBCHAPTER 2")
    z = S.split_rule("Text. [Eff 1] (Auth: HRS §11-1 (Imp: HRS §11-2)")
    assert z["auth"] == "(Auth: HRS §11-1" and z["imp"] == "(Imp: HRS §11-2)"
    assert S.split_rule("bare")["operative"] == "bare"


def test_zones(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, "")], "id int, t string")
    rows = S.as_rows(S.statute_zones(df, "id", "t"), "id", ["preamble", "operative", "history", "annotation"]).collect()
    assert {(r.id, r.zone) for r in rows} == {(1, z) for z in ("preamble", "operative", "history", "annotation")}
    assert S.rule_zones(df, "id", "t").count() == 2


def test_pages():
    assert S.strip_page("HAWAII RULES\ntext here\nmore\n\n12-3\n", "hawaii rules") == "text here\nmore"
    assert S.strip_page("text cites section\n12-3") == "text cites section\n12-3"


def test_sections(spark):
    df = spark.createDataFrame([("d", "intro\n§1-1-1 A\nx\n§1-1-2 B\ny\n§1-1-1 A again\nlonger text here")], "doc string, t string")
    s = S.sections_of(df, "doc", "t", r"^§(\d+-\d+-\d+)")
    assert [(r.pos, r.id) for r in s.orderBy("pos").collect()] == [(1, "1-1-1"), (2, "1-1-2"), (3, "1-1-1")]
    assert {(r.id, r.pos) for r in S.longest_of_each(s, "doc").collect()} == {("1-1-1", 3), ("1-1-2", 2)}
    heads = spark.createDataFrame([("d", 2, "SUBCHAPTER 1")], "doc string, pos int, heading string").selectExpr("doc", "cast(pos as bigint) pos", "heading")
    assert [r.heading_as_of for r in S.heading_of(s.select("doc", "pos"), heads, "doc").orderBy("pos").collect()] == [None, None, "SUBCHAPTER 1"]
    fixed, log = S.repair(df, "doc", "t", [("misprint", r"§1-1-2", "§1-1-3")])
    assert [(r.rule, r.before, r.after) for r in log.collect()] == [("misprint", "§1-1-2", "§1-1-3")] and "§1-1-3" in fixed.first().t
    toc = spark.createDataFrame([("d", "1-1-1"), ("d", "1-1-4")], "doc string, id string")
    lines = spark.createDataFrame([("d", 7, "§ 1 - 1 – 4 Found")], "doc string, line int, t string")
    assert [tuple(r) for r in S.toc_repair(s, toc, lines, "doc").collect()] == [("d", "1-1-4", 7)]


def test_constitution(spark):
    df = spark.createDataFrame([("c", "ARTICLE I\nRIGHTS OF THE PEOPLE\nSection 1. All power. [Am 1978]\nDUE PROCESS\nSection 2. No person.\ncontinued\nARTICLE II\nSection 1. Vote.")], "doc string, t string")
    rows = sorted((r.article, r.section, r.catchline, r.body, r.history) for r in S.constitution(df, "doc", "t").collect())
    assert rows[0] == ("I", "1", "RIGHTS OF THE PEOPLE", "Section 1. All power. [Am 1978]", "[Am 1978]")
    assert rows[1] == ("I", "2", "DUE PROCESS", "Section 2. No person. continued", None) and rows[2][:3] == ("II", "1", None)


def test_geometry(spark):
    w = [(1, 10.0, 40.0, 100.0, 10.0, "Chapter"), (1, 45.0, 60.0, 101.0, 10.0, "1"), (1, 60.0, 63.0, 98.0, 6.0, "2"), (1, 10.0, 30.0, 112.0, 10.0, "Next"), (1, 190.0, 320.0, 100.0, 10.0, "right")]
    df = spark.createDataFrame(w, "page int, x0 double, x1 double, top double, size double, text string")
    assert [(r.side, r.text) for r in S.word_lines(df, "page", 200.0).orderBy("side", "line").collect()] == [(0, "Chapter 1"), (0, "Next"), (1, "right")]


def test_tables(spark):
    lines = ["TITLE 3 AUDITOR", "Subtitle 1 X", "10 Audits of", "public funds", "PART II Y", "11 Rules", "TITLE 4 B", "12 Next"]
    df = spark.createDataFrame([("d", i, t) for i, t in enumerate(lines)], "doc string, i int, text string")
    got = sorted((r.chapter, r.title, r.subtitle, r.part, r.catchline) for r in S.directory_rows(df, ["i"], ["doc"]).collect())
    assert got == [("10", "3", "1", None, "Audits of public funds"), ("11", "3", "1", "II", "Rules"), ("12", "4", None, None, "Next")]
    rows = spark.createDataFrame([("d", 1, 1, "11-1", "3-1-1,"), ("d", 1, 2, "", "2"), ("d", 2, 1, "", "to 5"), ("d", 2, 2, "11-2", "4-1-1")], "doc string, page int, row int, key string, val string")
    assert {(r.key, r.list) for r in S.keyed_lists(rows, ["page", "row"], ["doc"]).collect()} == {("11-1", "3-1-1, 2 to 5"), ("11-2", "4-1-1")}
    laws = spark.createDataFrame([("d", 1, "1999"), ("d", 2, "Act 5"), ("e", 1, "Act 7")], "doc string, i int, key string")
    assert {(r.doc, r.year, r.act) for r in S.session_laws(laws, ["i"], ["doc"]).collect()} == {("d", "1999", "5"), ("e", None, "7")}
    c = spark.createDataFrame([("d", "1", "10"), ("d", None, "11")], "doc string, mark string, chapter string")
    n = spark.createDataFrame([("d", "1", "note"), ("d", "2", "lost")], "doc string, mark string, note string")
    with_note, lost = S.footnotes(c, n, ["doc"])
    assert with_note.where("note is not null").count() == 1 and lost.first().note == "lost"


def test_fallbacks():
    z = S.split_rule("§3-1-1 Text. Eff 2/11/87; am 4/1/90 (Auth: HRS §11-1) (Imp: HRS §11-2) SUBCHAPTER 2 FEES AND COSTS")
    assert (z["operative"], z["source_note"], z["annotation"]) == ("§3-1-1 Text.", "Eff 2/11/87; am 4/1/90", None)
    assert S.split_rule("Text. [Eff 2/11/87 (Auth: HRS §11-1)")["source_note"] == "[Eff 2/11/87"
    assert S.balanced("a (b (c) d) e", 2) == 11 and S.balanced("(a (b)", 0) == -1


def test_reparse(spark):
    df = spark.createDataFrame([("d", "§1-1-1 A\nx\nS1-l-2 Bees\ny\n§1-1-40 Other\n5 1-1-3 \"C\"\nz")], "doc string, t string")
    toc = spark.createDataFrame([("d", x) for x in ("1-1-1", "1-1-2", "1-1-3", "1-1-4")], "doc string, id string")
    s, log = S.reparse(df, "doc", "t", r"^§(\d+-\d+-\d+)", toc)
    assert [(r.id, r.body.split("\n")[-1]) for r in s.orderBy("pos").collect()] == [("1-1-1", "x"), ("1-1-2", "y"), ("1-1-40", "§1-1-40 Other"), ("1-1-3", "z")]
    assert {(r.id, r.before) for r in log.collect()} == {("1-1-2", "S1-l-2 Bees"), ("1-1-3", '5 1-1-3 "C"')}


def test_pages_as_rows(spark):
    df = spark.createDataFrame([("d", 1, "RULES\nbody\n12-3"), ("d", 2, None)], "doc string, page int, t string")
    assert [r.t for r in S.strip_pages(df.withColumn("head", S.F.lit("rules")), ["doc", "page"], "t", "head").orderBy("page").collect()] == ["body", None]
