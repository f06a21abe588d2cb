import duckdb
from pyspark.sql import functions as F

from lexloom.operators import graph as G
from lexloom.plans import graph as P


def corpus(spark, folder, edges, sections):
    """Tables of a few rows: edges (src, kind, target, zone), sections (id, repealed)."""
    spark.createDataFrame([(i, s, k, t, z, f"raw {t}") for i, (s, k, t, z) in enumerate(edges)], "edge_id long, src string, kind string, target string, zone string, raw string").write.parquet(f"{folder}/edge.parquet")
    rows = [(x, x[:3], x[4:].rpartition("-")[0], r) for x, r in sections]
    spark.createDataFrame(rows, "id string, layer string, chapter string, repealed int").withColumn("deleted_at", F.lit(None).cast("timestamp")).write.parquet(f"{folder}/sections.parquet")
    return str(folder)


def edges(spark):
    rows = [("A", "B", "operative"), ("B", "C", "operative"), ("C", "A", "operative"), ("A", "usc:42:1983", "operative"), ("A", "D", "annotation"), ("D", "Z", "operative"), (None, "B", "operative"), ("A", None, "operative"), ("A", "B", "operative")]
    return spark.createDataFrame([(s, d, z, "k", f"raw {d}", i) for i, (s, d, z) in enumerate(rows)], "src string, dst string, zone string, kind string, raw string, seq int")


def test_reach(spark):
    e = edges(spark).where("zone = 'operative'")
    seeds = spark.createDataFrame([("A",), ("A",), (None,)], "seed string")
    out = {(r.node, r.depth, r.on_cycle) for r in G.reach(e, seeds, 3).collect()}
    assert out == {("B", 1, False), ("usc:42:1983", 1, False), ("C", 2, False), ("A", 3, True)}
    assert {(r.node, r.depth) for r in G.reach(e, seeds, 1, reverse=True).collect()} == {("C", 1)}
    assert G.reach(e.where("false"), seeds, 3).count() == 0 and G.reach(e, seeds.where("false"), 2).count() == 0


def test_hubs_orphans_queue(spark):
    e = edges(spark)
    assert [tuple(r) for r in G.hubs(e, 2).collect()] == [("A", 1), ("B", 1)]
    nodes = spark.createDataFrame([(x,) for x in "ABCDE"], "id string")
    assert {r.id for r in G.orphans(nodes, e.where("zone = 'operative'")).collect()} == {"E"}
    q = {r.dst: r for r in G.unresolved(e, nodes).collect()}
    assert set(q) == {"usc:42:1983", "Z"} and q["Z"].examples == "D" and q["Z"].first_raw == "raw Z"


def test_as_of(spark):
    left = spark.createDataFrame([(1, "u", 5), (2, "u", 10), (3, "u", 1), (4, "v", 5)], "id int, k string, t int")
    right = spark.createDataFrame([("u", 5, "a"), ("u", 7, "b"), ("u", 5, "c")], "k string, t int, v string")
    get = lambda **kw: {r.id: r.v_as_of for r in G.as_of(left, right, ["k"], "t", "v", **kw).collect()}
    assert get() == {1: "c", 2: "b", 3: None, 4: None}
    assert get(inclusive=False) == {1: None, 2: "b", 3: None, 4: None}


def test_windows(spark):
    df = spark.createDataFrame([("c", 1, "I", None), ("c", 2, None, "A"), ("c", 3, None, None), ("c", 4, "II", None), ("c", 5, None, None)], "c string, i int, part string, sub string")
    f = [(r.part_filled, r.sub_filled) for r in G.forward_fill(df, ["c"], ["i"], "part", "sub").orderBy("i").collect()]
    assert f == [("I", None), ("I", "A"), ("I", "A"), ("II", None), ("II", None)]
    n = spark.createDataFrame([("a", v) for v in (4, 1, 3, 2)] + [("b", 7), ("b", None)], "k string, v int")
    assert {(r.k, r.median, r.n) for r in G.upper_median(n, ["k"], "v").collect()} == {("a", 3, 4), ("b", 7, 1)}
    s = spark.createDataFrame([("d", i, x) for i, x in enumerate("abcabc")] + [("e", 0, "a")], "d string, i int, x string")
    assert {(r.d, r.split, r.difference) for r in G.best_split(s, ["d"], "i", "x").collect()} == {("d", 3, 0)}
    e = spark.createDataFrame([("u", t) for t in (1, 2, 9, 10, 30)], "u string, t int")
    assert [r.island for r in G.islands(e, ["u"], "t", F.col("t") - F.col("prev") > 5).orderBy("t").collect()] == [1, 1, 2, 2, 3]
    assert [r.t for r in G.keep_one(e, ["u"], [F.desc("t")]).collect()] == [30]


def test_queue_of_all_kinds(spark, tmp_path):
    kinds = [("hrs_section", "7-1"), ("hrs_section", "7-9"), ("har_section", "3-7-1"), ("hrs_chapter", "ch:7"), ("hrs_chapter", "ch:8A"), ("har_chapter", "ch:3-7"), ("har_chapter", "ch:3-8"), ("hrs_part", "ch:7:II")]
    kinds += [("usc", "usc:5:552"), ("cfr", "cfr:5:2"), ("case", "case:1-H-2"), ("session_law", "slh:1999:1"), ("hi_const", "hiconst:I:1"), ("usc", None)]
    d = corpus(spark, tmp_path, [("7-1", *k, "operative") for k in kinds] + [("7-1", "usc", "usc:9:9", "annotation")], [("hrs:7-1", 0), ("har:3-7-1", 0)])
    assert {r.dst for r in P.graph_queue(spark, d).collect()} == {"hrs:7-9", "hrs:ch:8A", "har:ch:3-8", "usc:5:552", "cfr:5:2", "case:1-H-2", "slh:1999:1", "hiconst:I:1"}


def test_queue_as_in_sql(spark, sf):
    """The same targets of all kinds, counts and examples."""
    con = duckdb.connect()
    for t in ("edge", "sections"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = sorted(con.execute(f"SELECT kind, dst, citations, sources, examples, first_raw FROM ({P.SQL['graph_queue']})").fetchall(), key=str)
    rows = P.graph_queue(spark, sf).select("kind", "dst", "citations", "sources", "examples", "first_raw").collect()
    assert sorted((tuple(r) for r in rows), key=str) == want and {r.kind for r in rows} > set(P.SECTIONS)


def test_other_kinds_count(spark, tmp_path):
    edges = [("7-1", "hrs_section", "7-2", "operative"), ("7-2", "usc", "usc:5:552", "operative"), ("7-2", "hrs_chapter", "ch:8", "operative"), ("7-3", "case", "case:1-H-2", "operative"), ("7-4", "usc", "usc:9:9", "annotation")]
    d = corpus(spark, tmp_path, edges, [("hrs:7-1", 1), ("hrs:7-2", 0), ("hrs:7-3", 0), ("hrs:7-4", 0)])
    assert [r.id for r in P.graph_orphans(spark, d).collect()] == ["hrs:7-4"]
    leaves = {("hrs:7-2", 1), ("usc:5:552", 2), ("hrs:ch:8", 2)}
    assert {(r.node, r.depth) for r in P.graph_out(spark, d).collect()} == leaves
    assert {(r.node, r.depth) for r in P.graph_both(spark, d).where("direction = 'out'").collect()} == leaves
    assert {(r.node, r.refs_out, r.refs_in) for r in P.graph_degrees(spark, d).collect()} == {("hrs:7-1", 1, 0), ("hrs:7-2", 2, 1), ("hrs:7-3", 1, 0), ("hrs:7-4", 1, 0)}


def test_renumbering_to_the_end(spark, tmp_path):
    chain = [(f"hrs:7-{i + 1}", f"HRS 7-{i}" if i % 2 else f"hrs:7-{i}", "renumbered_from") for i in range(1, 8)]
    spark.createDataFrame([*chain, ("hrs:9-1", "hrs:9-2", "renumbered_from"), ("hrs:9-2", "hrs:9-1", "renumbered_from")], "src string, dst string, relation string").write.parquet(f"{tmp_path}/edges.parquet")
    rows = P.renumbering(spark, str(tmp_path)).collect()
    assert {(r.node, r.depth) for r in rows if r.seed == "hrs:7-1"} == {(f"hrs:7-{i}", i - 1) for i in range(2, 9)}
    assert len(rows) == 28 + 4


def test_contents_and_cycles(spark):
    s = spark.createDataFrame([("d", i, x) for i, x in enumerate("abcabc")] + [("e", i, x) for i, x in enumerate("abcd")] + [("f", i, x) for i, x in enumerate("abcdea")], "d string, i int, x string")
    assert {(r.d, r.split, r.accepted) for r in G.contents_split(s, ["d"], "i", "x").collect()} == {("d", 3, True), ("e", 0, False), ("f", 0, False)}
    e = spark.createDataFrame([("A", "B"), ("B", "C"), ("C", "B"), ("C", "D"), ("D", "D")], "src string, dst string")
    seeds = spark.createDataFrame([("A",)], "seed string")
    assert {tuple(r) for r in G.cycles(e, seeds, 4).collect()} == {("A", "C", "B", 3), ("A", "D", "D", 4)}


def test_examples_in_order(spark):
    e = spark.createDataFrame([("k", f"11-{i}", "Z", "r", i) for i in (10, 9, 2, 100)] + [("k", None, "Z", "r", 0)], "kind string, src string, dst string, raw string, seq int")
    from lexloom.functions.ids import statute_key

    nodes = spark.createDataFrame([("A",)], "id string")
    row = G.unresolved(e, nodes, 3, statute_key).first()
    assert (row.examples, row.citations, row.sources) == ("11-2, 11-9, 11-10", 5, 4)
