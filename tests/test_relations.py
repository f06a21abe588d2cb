import pytest
from pyspark.sql import functions as F

from lexloom.operators import relations as R


def test_compare(spark):
    s = "src string, dst string, relation string, id int"
    a = spark.createDataFrame([("r1", "x", "i", 1), ("r1", "x", "a", 2), ("r2", "y", "i", 3), ("r3", "z", "i", 4), (None, "z", "i", 5)], s)
    b = spark.createDataFrame([("r1", "x", "i", 1), ("r2", "w", "i", 2), ("r4", "z", "i", 3)], s)
    assert {(r.src, r.outcome) for r in R.compare_sets(a, b, "src", "dst").collect()} == {("r1", "agree"), ("r2", "differ"), ("r3", "right_unread"), ("r4", "left_unread")}
    got = {(r.src, r.dst, r.finding) for r in R.compare_pairs(a.where("src is not null"), b, ["src", "dst"], "relation", "id").collect()}
    assert got == {("r1", "x", "conflict"), ("r2", "y", "only_left"), ("r2", "w", "only_right"), ("r3", "z", "only_left"), ("r4", "z", "only_right")}


@pytest.mark.parametrize(
    "text,want",
    [
        ("13-275-1, 2, 5 to 8", ["13-275-1", "13-275-2", "13-275-5", "13-275-6", "13-275-7", "13-275-8"]),
        ("3-181.1, 4", ["3-181.1", "3-181.1-4"]),
        ("18-231-9.9-07", ["18-231-9.9-07"]),
        ("13-275-1.5 to 13-275-2.5", ["13-275-1.5", "13-275-2.5"]),
    ],
)
def test_expand(spark, text, want):
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "k int, t string")
    rows = R.expand_lists(df, "k", "t").orderBy("pos").collect()
    assert [r.member for r in rows] == want and all(r.parsed for r in rows)


def test_expand_leftover(spark):
    rows = R.expand_lists(spark.createDataFrame([(1, "5 to 6")], "k int, t string"), "k", "t").collect()
    assert [(r.member, r.parsed) for r in rows] == [("5 to 6", False)]


def test_upsert_and_precedence(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], "k string, n int, v string")
    new = spark.createDataFrame([("a", 1, "y"), ("a", 2, "z"), ("c", 1, "w")], "k string, n int, v string")
    assert {(r.k, r.v) for r in R.upsert(old, new, ["k"], "n").collect()} == {("a", "z"), ("b", "x"), ("c", "w")}
    assert {(r.k, r.v) for r in R.by_precedence(new, ["k"], F.when(F.col("v") == "y", 0).otherwise(1), "n").collect()} == {("a", "y"), ("c", "w")}


def test_quarantine_and_search(spark):
    df = spark.createDataFrame([("a", i, i < 4) for i in range(6)] + [(None, i, False) for i in range(3)], "g string, i int, bad boolean")
    assert {(r.g, r.quarantined) for r in R.quarantine(df, ["g"], F.col("bad"), 0.3).collect()} == {("a", True), (None, False)}
    t = spark.createDataFrame([(1, "The Reef, and shore"), (2, "reef only"), (3, None), (4, "")], "id int, t string")
    assert [r.id for r in R.search(t, ["id"], "t", "shore REEF").collect()] == [1]
    assert {(r.token, r.n) for r in R.token_index(t, ["id"], "t").where("id = 2").collect()} == {("reef", 1), ("only", 1)}


def test_expand_packed(spark):
    """Quotes, pin cites, layer names, other separators and ranges of two-part numbers."""
    get = lambda t: [(r.member, r.parsed) for r in R.expand_lists(spark.createDataFrame([(1, t)], "k int, t string"), "k", "t").orderBy("pos").collect()]
    assert get('"13-275-1(a)"; HAR §13-275-2 & sec. 8-1-1.5(d)(2)/\'9-2-3\'|10-1-1\n11-1-1') == [(x, True) for x in ("13-275-1", "13-275-2", "8-1-1.5", "9-2-3", "10-1-1", "11-1-1")]
    assert get("sections 549-2 to 549-4, 259K-2(c)(1), and 6-57-5 to 7") == [(x, True) for x in ("549-2", "549-3", "549-4", "259K-2", "6-57-5", "6-57-6", "6-57-7")]
    assert get('"1-1-1","the ""Uniform Tank"" Act, as amended",733:6-33') == [("1-1-1", True), ('the "Uniform Tank" Act, as amended', False), ("733:6-33", True)]
    assert get("13-275-1 to 13-276-5") == [("13-275-1", True), ("13-276-5", True)]


def test_list_members_whole(spark, sf):
    """Every citation of a rule with a text has members, and ranges are expanded."""
    from lexloom.plans.relations import list_members
    from lexloom.sources.tables import table

    rows = table(spark, sf, "edge").where("kind = 'har_section' and raw rlike '[0-9]'")
    assert list_members(spark, sf).select("edge_id").distinct().count() == rows.select("edge_id").distinct().count()
