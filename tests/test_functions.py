import datetime
import re

from pyspark.sql import functions as F

from lexloom.functions import ids as I
from lexloom.functions import text as X


def values(spark, xs, f, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], f"i int, x {kind}")
    return [r.y for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_proper_section(spark):
    xs = [" § 9–1‑2(a)", "HRS: 9h-4", "har:1-2-3.4", "412:2-105", "12-3", "1­2-​3", None, "", "section 5-6(b)(1)", "９-１"]
    assert values(spark, xs, I.proper_section) == ["har:9-1-2", "hrs:9H-4", "har:1-2-3.4", "hrs:412:2-105", "hrs:12-3", "hrs:12-3", None, "hrs:", "hrs:5-6", "hrs:9-1"]


def test_proper_target(spark):
    assert values(spark, ["HRS:CH:9a ", " usc:42:1983", "hrs:9-9(b)", "9-9-9", None], I.proper_target) == ["hrs:ch:9A", "usc:42:1983", "hrs:9-9", "har:9-9-9", None]


def test_natural_order(spark):
    df = spark.createDataFrame([(x,) for x in ["11-2", "2-10", "2-9.5", "2A-1", "2-9", "x"]], "x string")
    assert [r.x for r in df.orderBy(I.statute_key(F.col("x"))).collect()] == ["2-9", "2-9.5", "2-10", "2A-1", "11-2", "x"]
    df = spark.createDataFrame([(x,) for x in ["3-10-2", "3-9-2", "3-9-2.5", "3-9-10", "bad"]], "x string")
    assert [r.x for r in df.orderBy(I.rule_key(F.col("x"))).collect()] == ["3-9-2", "3-9-2.5", "3-9-10", "3-10-2", "bad"]


def test_identifiers(spark):
    assert values(spark, ["11-2(b)", "412:2-105", "x", " 7a-1 "], I.valid_section) == ["11-2", "412:2-105", None, "7A-1"]
    assert values(spark, ["HRS_0011-0102_.htm", "HRS_0412-0002-0105.htm", "HRS_0001-0003_0005.htm", "[OLD]HRS_0011-0102.htm", "x"], I.file_section) == ["11-102", "412:2-105", "1-3.5", None, None]
    got = values(spark, ["chapter 91", "ch. 11, part II", "11A5 [R]", "42 U.S.C. §1983", "412:2-1", "1-2-3", "see above", "", None], I.classify_key)
    assert [(g.kind, g.value, g.repealed) for g in got] == [("hrs_chapter", "91", False), ("hrs_chapter_part", "11:II", False), ("hrs_section", "11A-5", True), ("usc", "usc:42:1983", False), ("hrs_section_colon", "412:2-1", False), ("har_section", "1-2-3", False), ("prose", "see above", False), ("skip", None, False), ("skip", None, False)]
    df = spark.createDataFrame([("hi_const", "Art. I §1"), ("har_section", "3-4-5"), ("hrs_chapter", "ch:9"), ("usc", "usc:1:2")], "k string, t string")
    assert [r[0] for r in df.select(I.namespaced(F.col("k"), F.col("t"))).collect()] == ["hiconst:I:1", "har:3-4-5", "hrs:ch:9", "usc:1:2"]
    assert spark.range(1).select(I.session_law_id(F.lit(2021), F.lit(213), F.lit(True))).first()[0] == "slh:2021:213:ss"
    assert spark.range(1).select(I.chapter_id(F.lit("3"), F.lit("160")), I.chapter_id(F.lit("3"), F.lit("4-1"))).first()[:] == ("3-160", "4-1")


def test_html(spark):
    html = "<html><style>p{x:'</p>'}</style><p>One&nbsp;&amp; two</p><table><tr><td>a</td><td>b</td></tr></table><script>1<2</script>end<br/><br/><br/><br>x"
    assert values(spark, [html, None, ""], X.strip_html) == ["One & two\na b\nend\n\nx", None, ""]
    assert values(spark, ["<b>a</b>\n<i>b</i>"], X.strip_tags) == ["a b"]
    assert values(spark, ["section 11-\n  102  x"], X.dewrap) == ["section 11-102 x"]


def test_dates(spark):
    d = datetime.date
    assert values(spark, ["2/11/87", "4/10/2003", "7/1/12", "13/1/99", "", None, "x"], X.printed_date) == [d(1987, 2, 11), d(2003, 4, 10), d(2012, 7, 1), None, None, None, None]
    assert values(spark, ["[Eff 2/11/87; am and comp 4/10/2003]", "none"], X.last_date) == [d(2003, 4, 10), None]
    assert values(spark, ["on March 5, 1994 and", "no"], X.long_date) == [d(1994, 3, 5), None]
    assert values(spark, ["0CT - 5 l998", "XXX 5 1998"], X.stamp_date) == [d(1998, 10, 5), None]


def test_text(spark):
    assert values(spark, ["ABc1", "", "12", None], X.caps_ratio) == [2 / 3, 0.0, 0.0, None]
    assert values(spark, ["a‑b­c"], lambda c: X.normalize_dashes(c, True)) == ["a-bc"]
    assert values(spark, ["S ubchap ter 2", "Part II"], X.rejoin_keyword) == ["Subchapter 2", "Part II"]
    got = values(spark, [r"see [[a|b]] and [[c]] and [[d\|e]]"], X.wikilinks)[0]
    assert [(x.page, x.alias) for x in got] == [("a", "b"), ("c", None), ("d", "e")]
    assert values(spark, ["42 U.S.C. §1983 and 7-1"], X.mask_federal)[0].split() == ["and", "7-1"]
    pattern = values(spark, ["11-15"], X.fuzzy_pattern)[0]
    assert re.search(pattern, "see 1l – I5 here") and not re.search(pattern, "see 12-15")
    df = spark.createDataFrame([("Repealed.", None), ("x", "§§1 REPEALED"), ("(Reserved)", ""), ("x", None), (None, None)], "c string, b string")
    assert [r[0] for r in df.select(X.is_repealed(F.col("c"), F.col("b"))).collect()] == [True, True, True, False, False]


def test_hints(spark):
    df = spark.createDataFrame([("Chapter 3-160", "https://x.gov/a.pdf"), ("Rules", "https://x.gov/d/HAR_3-161.pdf"), ("Chapter 12", "https://x.gov/z.pdf"), (None, "https://x.gov/ch7.pdf"), (None, None)], "l string, u string")
    assert [r[0] for r in df.select(X.chapter_hint(F.col("l"), F.col("u"))).collect()] == ["3-160", "3-161", "12", "7", None]
    df = spark.createDataFrame([("to 22 REPEALED.", "7-20"), ("to 7-22. REPEALED", "7-20"), ("Fees", "7-1"), (None, "7-1")], "c string, n string")
    assert [r[0] for r in df.select(X.repealed_range(F.col("c"), F.col("n"))).collect()] == ["REPEALED (§§7-20 to 7-22)", "REPEALED (§§7-20 to 7-22)", "Fees", None]
    df = spark.createDataFrame([("PART II. X", "7", True), (None, "8", False)], "p string, c string, r boolean")
    assert [r[0] for r in df.select(X.page_tags(F.col("p"), F.col("c"), F.col("r"))).collect()] == [["chapter/7", "part/ii", "repealed"], ["chapter/8"]]


def test_entities(spark):
    import html

    texts = ["Hawai&#8217;i &rsquo; &eacute;", "&#x41;&#66; &lt;a&gt; &amp;amp; &nosuch; & &", "&copy 2001 &sect;5", "&#0;&#xD800;&#150;", "no entity", "a &#8217 b", "&Aacute;&hellip;&nbsp;x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "i int, t string")
    got = {r.i: r.x for r in df.select("i", X.unescape(F.col("t")).alias("x")).collect()}
    assert got[99] is None and [got[i] for i in range(len(texts))] == [html.unescape(t) for t in texts]
    assert df.select(X.clean(F.lit("a<br/>b<b>c</b> &amp;  d"))).first()[0] == "a bc & d"


def test_stamps(spark):
    rows = [("[Eff 2/11/87; comp DEC 0 9 2016]", "2016-12-09"), ("[Eff nEC O9 2 0 1 6; am 1/2/17]", "2017-01-02"), ("[Eff 3/4/90 xyz 12 1999]", "1990-03-04"), (None, None), ("none", None)]
    df = spark.createDataFrame([(a,) for a, _ in rows], "t string")
    assert [str(r[0]) if r[0] else None for r in df.select(X.last_date(F.col("t"))).collect()] == [w for _, w in rows]
    assert spark.range(1).select(X.mask_federal(F.lit("Public Law 107-252, P.L. No. 9-1, 5 U.S.C. 7-8, 11-15"))).first()[0].split() == [",", ",", ",", "11-15"]


def test_more_names(spark):
    rows = [("hi_const", "Preamble"), ("hi_const", "Art. I §1"), ("hi_const", "Art. XIV"), ("hrs_part", "part:11:II"), ("har", "har:3:160")]
    df = spark.createDataFrame(rows, "k string, t string")
    assert [r[0] for r in df.select(I.namespaced(F.col("k"), F.col("t"))).collect()] == ["hiconst:preamble", "hiconst:I:1", "hiconst:art:XIV", "hrs:part:11:II", "har:3:160"]
    assert df.select(I.display(F.col("k"), F.col("t"))).collect()[3][0] == "HRS chapter 11, part II"
    assert spark.range(1).select(I.classify_key(F.lit("Hawaii Constitution"))["kind"]).first()[0] == "group"
