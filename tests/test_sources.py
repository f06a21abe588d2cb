import json

from pyspark.sql import functions as F

from lexloom.sources import documents as D
from lexloom.sources import sinks as K
from lexloom.operators import quality as Q


def test_raw(spark, tmp_path):
    (tmp_path / "a.txt").write_text("﻿---\ntitle: \"One: two\"\nurl: https://x.invalid/1\n---\n<!-- c -->\nBody\n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("no header", encoding="utf-8")
    rows = {r.path[-5:]: r for r in D.read_raw(spark, f"{tmp_path}/*.txt").collect()}
    assert rows["a.txt"].meta == {"title": "One: two", "url": "https://x.invalid/1"} and rows["a.txt"].body == "Body\n"
    assert rows["b.txt"].meta == {} and rows["b.txt"].body == "no header"


def test_json(spark, tmp_path):
    (tmp_path / "a.json").write_text("﻿" + json.dumps({"sections": [{"section": "1-1", "file": "f"}]}), encoding="utf-8")
    (tmp_path / "b.json").write_text('noise {"sections": []} tail')
    (tmp_path / "c.json").write_text("{broken")
    ok, bad = D.read_json(spark, f"{tmp_path}/*.json", "sections array<struct<section: string, file: string>>")
    assert ok.count() == 2 and [r.path[-6:] for r in bad.collect()] == ["c.json"]
    assert [tuple(r) for r in D.read_manifest(spark, f"{tmp_path}/a.json", "section: string, file: string").collect()] == [("1-1", "f")]


def test_pages_and_links(spark):
    df = spark.createDataFrame([("d", "one\fINDEX two\fthree")], "doc string, t string")
    p = D.pages(df, "doc", "t")
    assert [r.page for r in D.pages_from(p, "doc", "INDEX").orderBy("page").collect()] == [2, 3]
    assert [r["mode"] for r in D.pages_by_mode(p, "doc", {"idx": "INDEX"}).orderBy("page").collect()] == [None, "idx", "idx"]
    html = spark.createDataFrame([("v1", '<A HREF="Ch01/">x</A><a href="Ch02/">y <b>z</b></a><a href="../">up</a>'), ("v2", None)], "v string, h string")
    assert [(r.href, r.label) for r in D.hrefs(html.where("h is not null"), "v", "h").orderBy("seq").collect()] == [("Ch01/", "x"), ("Ch02/", "y z"), ("../", "up")]
    assert {(r.v, r.expected) for r in D.universe(html, "v", "h", r'(?i)href="(Ch\d+)/"').collect()} == {("v1", 1), ("v2", -1)}


def test_discovery(spark):
    seeds = spark.createDataFrame([("https://a.example.gov/x",)], "url string")
    links = spark.createDataFrame([("https://a.example.gov/x", i, h) for i, h in enumerate(["https://a.example.gov/rules", "https://b.example.gov/admin", "https://c.com/rules", "https://a.example.gov/rules.zip", "https://a.example.gov/about"])], "page string, seq int, href string")
    assert {(r.url, r.depth) for r in D.discover(seeds, links).collect()} == {("https://a.example.gov/x", 0), ("https://a.example.gov/rules", 1), ("https://b.example.gov/admin", 1)}
    assert D.discover(seeds, links, most=1).count() == 2


def test_lists(spark):
    idx = spark.createDataFrame([("m", "TITLE 1 GENERAL\n\n1\n\nCommon law\n\n2\n\n3\n\nTITLE 2\n\n4.\n\nElections\n\n1\n\nAgain")], "doc string, t string")
    assert {(r.title, r.num, r.name) for r in D.chapter_index(idx, "doc", "t").collect()} == {("1", "1", "Common law"), ("1", "2", "3"), ("2", "4", "Elections")}
    a = spark.createDataFrame([("u1", 1, "a"), ("u2", 2, "a")], "url string, seq int, w string")
    b = spark.createDataFrame([("u2", 1, "b"), ("u3", 1, "b"), ("u3", 2, "c")], "url string, seq int, w string")
    assert {(r.url, r.w) for r in D.work_list(a, b).collect()} == {("u1", "a"), ("u2", "a"), ("u3", "b")}
    assert {(r.url, r.status) for r in D.with_archived(a, b.dropDuplicates(["url"]), "url").collect()} == {("u1", "ok"), ("u2", "ok"), ("u3", "ok_archived")}
    assert {r.url for r in D.first_listed(b, "url", F.col("seq")).collect()} == {"u2", "u3"}
    work = spark.createDataFrame([("k1", "x"), ("k2", "y")], "k string, sha256 string")
    done = spark.createDataFrame([("k1", "x"), ("k2", "old")], "k string, sha256 string")
    assert [r.k for r in D.still_to_do(work, done, "k").collect()] == ["k2"]
    docs = spark.createDataFrame([(bytearray(b"%PDF-" + b"x" * 300), "t" * 600), (bytearray(b"%PDF-" + b"x" * 300), "t"), (bytearray(b"<html>" + b"x" * 300), ""), (bytearray(b"x"), ""), (None, None)], "c binary, t string")
    assert [r.state for r in D.document_state(docs, "c", "t").collect()] == ["ok", "scan", "not_a_pdf", "too_small", "fetch_failed"]


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "w" / "t")
    df = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, n int, v string")
    K.write_table(df, path, key=["k"])
    K.upsert_table(spark, path, spark.createDataFrame([("b", 2, "z"), ("c", 1, "w")], df.schema), ["k"], "n")
    read = lambda: {(r.k, r.v) for r in spark.read.parquet(path).collect()}
    assert read() == {("a", "x"), ("b", "z"), ("c", "w")}
    try:
        K.write_table(df.unionByName(df), path, key=["k"])
        raise AssertionError("a repeated key has to fail")
    except ValueError:
        assert read() == {("a", "x"), ("b", "z"), ("c", "w")}
    for _ in range(2):  # a rebuild keeps hand-written rows, once
        K.write_table(K.keep_handwritten(spark, path, df, ["k"]), path)
        assert read() == {("a", "x"), ("b", "z"), ("c", "w")}
    assert K.keep_handwritten(spark, str(tmp_path / "none"), df, ["k"]).count() == 2

    def validate(root):
        spark.read.parquet(f"{root}/t").createOrReplaceTempView("built")
        return Q.run_checks(spark, [("rows", "SELECT count(*) FROM built", "=", 2), ("least", "SELECT count(*) FROM built", ">=", 1), ("fails", "SELECT count(*) FROM built", "=", 5), ("null", "SELECT max(n) FROM built WHERE false", "=", 0)])

    report = K.build(spark, {"t": df}, str(tmp_path / "b"), validate, check_only=True)
    assert {r.name: r.passed for r in report.collect()} == {"rows": True, "least": True, "fails": False, "null": False}
    assert not (tmp_path / "b.check").exists()
    m = K.snapshot(df, str(tmp_path / "s"), "2025-01-01").first()
    assert m.rows == 2 and len(m.sha256) == 64
    K.dump_json(df, str(tmp_path / "j"), ["k"])
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def test_reports(spark):
    s = spark.createDataFrame([("hrs:1-1", "T", "Body."), ("hrs:1-2", None, "B2")], "id string, catchline string, body string")
    c = spark.createDataFrame([("hrs:1-1", "hrs:1-2"), ("hrs:1-1", "hrs:1-2")], "id string, other string")
    notes = spark.createDataFrame([("hrs:1-1", "mine"), ("hrs:9-9", "lost")], "id string, note string")
    kept, missing = K.inject_notes(notes, s)
    pages = K.section_pages(s, c, c.where("false"), kept)
    page = {r.path: r.content for r in pages.collect()}["hrs-1-1.md"]
    assert "# hrs:1-1 T" in page and page.count("[[hrs:1-2]]") == 1 and missing.first().note == "lost"
    assert [tuple(r) for r in K.curated_blocks(pages).collect()] == [("hrs-1-1.md", "mine")]
    q = spark.createDataFrame([("a", "x", 2), ("a", "y", 5), ("b", "z", 1)], "grp string, item string, n int")
    assert K.queue_page(q, "Queue").first().content == "# Queue\n\n## a\n- y (5)\n- x (2)\n\n## b\n- z (1)"


def test_quality(spark):
    df = spark.createDataFrame([(i,) for i in range(5)], "id int")
    assert Q.conservation(df, df.where("id < 3"), df.where("id >= 3")).first().conserved
    assert not Q.conservation(df, df.where("id < 3"), df.where("id > 3")).first().conserved
    assert Q.regression(df, df).count() == 0
    assert {(r.id, r.side) for r in Q.regression(df, df.where("id > 0")).collect()} == {(0, "old")}
    t = spark.createDataFrame([("c", "1"), ("c", "2")], "c string, id string")
    assert {(r.id, r.problem) for r in Q.toc_against_body(t, t.where("id = '1'").unionByName(spark.createDataFrame([("c", "3")], t.schema)), ["c"]).collect()} == {("2", "not_in_body"), ("3", "not_in_toc")}
    assert Q.problem(t, "toc", "toc_absent", "c").count() == 2
    items = spark.createDataFrame([("d", "3-1")] * 9 + [("d", "8-1")] * 2, "doc string, ch string")
    assert [(r.ch, r.n) for r in Q.stray_groups(items, "ch", "doc", spark.createDataFrame([("3-1",)], "ch string")).collect()] == [("8-1", 2)]
    assert Q.handwritten_kept(df, df.where("id <> 2"), ["id"]).first().id == 2
