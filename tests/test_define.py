from pyspark.sql import functions as F

from lexloom.operators import define as D
from lexloom.plans import text as P

TEXT = 'For the purposes of this section: "Ferry" means a boat. In this chapter, "Port" includes a harbor, as defined in section 7-9; "ferry" means another.'


def test_definitions():
    got = D.definitions(TEXT, False)
    assert [(t, v, s, i) for t, v, s, _, i in got] == [("Ferry", "means", "section", None), ("Port", "includes", "chapter", "7-9")]
    assert [t for t, *_ in D.definitions('"Ballot", the paper; "Office", an elective one', True)] == ["Ballot", "Office"]
    assert D.definitions('"Ballot", the paper', False) == [] and D.definitions("", True) == []
    assert [(t, s) for t, _, s, _, _ in D.definitions("As used in this chapter, the emergency review means any classroom", False)] == [("emergency review", "chapter")]


def test_near_declarations():
    assert [k for _, k in D.declarations("in this part and in this chapter")] == ["part", "chapter"]
    assert [k for _, k in D.declarations("in this part, in this chapter")] == ["part", "chapter"]


def test_extract(spark):
    df = spark.createDataFrame([("s1", TEXT, "x"), ("s2", None, None), ("s3", "", "Definitions")], "id string, t string, c string")
    assert {(r.section, r.term_norm, r.scope) for r in D.extract_definitions(df, "id", "t", "c").collect()} == {("s1", "ferry", "section"), ("s1", "port", "chapter")}


def test_resolve(spark):
    places = spark.createDataFrame([("7-2", "7", "PART I.", "", "1"), ("9-1", "9", "", "", "2")], "section string, chapter string, part string, subpart string, title string")
    keys = ["sec:7-2", "ch:7:PART I.", "ch:7", "title:1", "ch:8"]
    defs = spark.createDataFrame([("ferry", k, i) for i, k in enumerate(reversed(keys))] + [(None, "ch:7", 9)], "term_norm string, scope_key string, seq int")
    rows = D.resolve(places, defs).collect()
    assert [r.scope_key for r in rows if r.controls] == ["sec:7-2"]
    assert sorted((r.rank, r.scope_key) for r in rows if r.section == "7-2") == [(1, "sec:7-2"), (2, "ch:7:PART I."), (3, "ch:7"), (4, "title:1")]
    assert not [r for r in rows if r.section == "9-1"]
    assert D.collisions(defs.where("term_norm is not null")).first().scopes == 5
    assert [r.term_norm for r in D.suggest(defs.where("term_norm is not null"), "FER").collect()] == ["ferry"]


def test_scope_key(spark):
    df = spark.createDataFrame([("part", "7-1", "7", "", "", "1"), ("subpart", "7-1", "7", "I", "A", "1"), ("unstated", "7-1", "7", "", "", "1")], "k string, s string, c string, p string, u string, t string")
    assert [r[0] for r in df.select(D.scope_key(*[F.col(x) for x in "kscput"])).collect()] == [None, "ch:7:I:A", None]


def test_undeclared_scopes(spark, tmp_path):
    df = spark.createDataFrame([("s1", '"Ferry" means a boat.', "x"), ("s2", '"Ferry" means a boat.', "Definitions")], "id string, t string, c string")
    assert {(r.section, r.scope) for r in D.extract_definitions(df, "id", "t", "c").collect()} == {("s1", "section"), ("s2", "chapter")}
    docs = [(1, '"Ferry" means a boat.', "7"), (2, 'In this chapter, the ferry means a ship.', "7"), (3, '"Port" means a harbor.', "7")]
    spark.createDataFrame(docs, "doc_id long, text string, unit_id string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {(r.term_norm, r.places, r.shadowed) for r in P.definition_at(spark, str(tmp_path)).collect()} == {("ferry", 2, 1), ("port", 1, 0)}
    assert {(r.term_norm, r.scopes) for r in P.definition_collisions(spark, str(tmp_path)).collect()} == {("ferry", 2)}


def test_declared_scopes():
    """A mention of the section declares nothing; what is used in it or defined for its purposes does."""
    text = 'In this chapter: "Board" means x. Nothing in this section applies here. "Fish" means y. As used in this section: "Port" means z.'
    assert [(t, s) for t, _, s, _, _ in D.definitions(text, False)] == [("Board", "chapter"), ("Fish", "chapter"), ("Port", "section")]
    leads = ["in this subpart", "in this part", "for purposes of this title", "for the purpose of this chapter", "for this purpose", "for the purposes of this section", "in this section"]
    assert [[k for _, k in D.declarations(x)] for x in leads] == [["subpart"], ["part"], ["title"], ["chapter"], ["section"], ["section"], []]
    got = D.definitions('"Port," means a harbor; "Ferry" has the same meaning as in section 7-9', False)
    assert [(D.norm(t), i) for t, _, _, _, i in got] == [("port", None), ("ferry", "7-9")]


def test_listings(spark):
    defs = spark.createDataFrame([("7-2", "ferry", "chapter"), ("7-1", "ferry", "section"), ("7-1", "boat", "title"), ("7-3", "ferry", "section")], "section string, term_norm string, scope string")
    assert [r.term_norm for r in D.terms_of(defs, "7-1").collect()] == ["boat", "ferry"]
    assert [(r.section, r.scope_rank) for r in D.scopes_of(defs, " Ferry.").collect()] == [("7-1", 0), ("7-3", 0), ("7-2", 3)]
