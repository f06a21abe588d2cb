"""Queries on the citation graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.functions.ids import bare, namespaced, proper_section, proper_target, squeeze, statute_key
from lexloom.operators import graph as G
from lexloom.plans.sqlparts import GRAPH, GRAPH_ALL, LIVE, natural_sql, proper_target_sql
from lexloom.sources.tables import table


SECTIONS = ("hrs_section", "har_section")


def citation_edges(spark: SparkSession, d: str) -> DataFrame:
    """Citations of all kinds, each target in its own name space: `hrs:1-2`, `hrs:ch:1A`, `usc:5:552`."""
    layer = F.substring("kind", 1, 3)
    chapter = F.concat(layer, F.lit(":ch:"), bare(F.regexp_replace(squeeze(F.col("target")), r"(?i)^(?:(?:hrs|har):?)?(?:ch:)?", "")))
    dst = F.when(F.col("kind").isin(*SECTIONS), proper_section(F.col("target"), layer)).when(F.col("kind").isin("hrs_chapter", "har_chapter"), chapter).otherwise(namespaced(F.col("kind"), F.col("target")))
    return table(spark, d, "edge").select("edge_id", "kind", "zone", "raw", proper_section(F.col("src")).alias("src"), dst.alias("dst"), F.col("edge_id").alias("seq"))


def section_edges(spark: SparkSession, d: str) -> DataFrame:
    return citation_edges(spark, d).where(F.col("kind").isin(*SECTIONS))


def live_sections(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sections").where("deleted_at is null and repealed = 0").select("id").distinct()


def graph_hubs(spark, d):
    return G.hubs(section_edges(spark, d).where("zone = 'operative'"))


def graph_hub_labels(spark, d):
    """Labels for edge ends, also for those that the corpus lacks."""
    e = section_edges(spark, d).where("zone = 'operative' and dst is not null")
    hubs = e.groupBy(F.col("dst").alias("node")).agg(F.count_distinct("src").alias("sources"))
    names = table(spark, d, "sections").groupBy(F.col("id").alias("node")).agg(F.min("catchline").alias("name"), F.lit(True).alias("there"))
    return hubs.join(names, "node", "left").select("node", "sources", F.when(F.col("there"), F.coalesce("name", F.lit(""))).otherwise("[not in corpus]").alias("label"))


def graph_orphans(spark, d):
    return G.orphans(live_sections(spark, d), citation_edges(spark, d).where("zone = 'operative'"))


def graph_queue(spark, d):
    """Operative targets of all kinds that the corpus lacks: sections without a row, chapters without a section, everything outside; parts are no targets of their own."""
    s = table(spark, d, "sections")
    known = s.select("id").union(s.select(F.concat_ws(":ch:", "layer", "chapter")))
    e = citation_edges(spark, d).where("zone = 'operative' and kind not in ('hrs_part', 'har_part', 'hrs_chapter_part')")
    return G.unresolved(e, known, order=lambda c: F.struct(F.substring_index(c, ":", 1).alias("layer"), statute_key(F.substring_index(c, ":", -1)).alias("num")))


def graph_queue_groups(spark, d):
    """The queue as a report of five groups: chapters, sections by their chapter, federal law, constitutions and other rules, and repealed sections that are still cited; each item with citations, sources and zones."""
    s = table(spark, d, "sections")
    known = s.select("id").union(s.select(F.concat_ws(":ch:", "layer", "chapter"))).distinct()
    e = citation_edges(spark, d).where("dst is not null")
    group = (
        F.when(F.col("kind").isin("hrs_chapter", "har_chapter"), "1 chapters").when(F.col("kind").isin(*SECTIONS), "2 sections")
        .when(F.col("kind").isin("usc", "cfr", "public_law"), "3 federal").otherwise("4 other")
    )
    lost = e.join(known.select(F.col("id").alias("dst")), "dst", "left_anti").withColumn("grp", group)
    repealed = s.groupBy(F.col("id").alias("dst")).agg(F.max("repealed").alias("r")).where("r = 1").select("dst")
    rows = lost.unionByName(e.where(F.col("kind").isin(*SECTIONS)).join(repealed, "dst", "left_semi").withColumn("grp", F.lit("5 repealed")))
    item = F.when(F.col("grp") == "2 sections", F.regexp_replace("dst", r"-[^-]*$", "")).otherwise(F.col("dst"))
    per = rows.groupBy("grp", item.alias("item"))
    return per.agg(F.count(F.lit(1)).alias("citations"), F.count_distinct("src").alias("sources"), F.coalesce(F.array_join(F.array_sort(F.collect_set("zone")), "/"), F.lit("")).alias("zones"))


def unresolved_top(spark, d):
    """The 12 targets that most citations of all zones miss."""
    return graph_queue(spark, d).select("kind", "dst", "citations").orderBy(F.desc("citations"), "kind", "dst").limit(12)


def out_in_order(spark, d):
    """What each repealed section cites, statutes and rules first in natural order, then the others by kind and name, numbered."""
    e = citation_edges(spark, d).where("zone = 'operative' and src is not null and dst is not null").join(_seeds(spark, d).distinct(), F.col("src") == F.col("seed"), "left_semi").select("src", "kind", "dst").distinct()
    w = Window.partitionBy("src").orderBy(~F.col("kind").isin(*SECTIONS), F.when(F.col("kind").isin(*SECTIONS), F.lit("")).otherwise(F.col("kind")), statute_key(F.when(F.col("kind").isin(*SECTIONS), F.substring_index("dst", ":", -1)).otherwise(F.lit(""))), "kind", "dst")
    return e.select("src", F.row_number().over(w).alias("pos"), "kind", "dst")


def back_references(spark, d):
    """Citations that lead back to a section which a walk of three steps from a repealed one came through."""
    return G.cycles(section_edges(spark, d).where("zone = 'operative'"), _seeds(spark, d), 3)


def _seeds(spark, d):
    return table(spark, d, "sections").where("repealed = 1").select(F.col("id").alias("seed"))


def graph_out(spark, d):
    """What repealed sections reach; targets of other kinds are leaves, as only sections have edges of their own."""
    return G.reach(citation_edges(spark, d).where("zone = 'operative'"), _seeds(spark, d), 3)


def graph_in(spark, d):
    return G.reach(section_edges(spark, d).where("zone = 'operative'"), _seeds(spark, d), 3, reverse=True)


def graph_both(spark, d):
    e = citation_edges(spark, d).where("zone in ('operative', 'annotation')")
    between = e.where(F.col("kind").isin(*SECTIONS))
    return G.reach(e, _seeds(spark, d), 2).withColumn("direction", F.lit("out")).unionByName(G.reach(between, _seeds(spark, d), 2, reverse=True).withColumn("direction", F.lit("in")))


def graph_degrees(spark, d):
    """Different targets of all kinds that a node cites, and different sources that cite a section."""
    e = citation_edges(spark, d).where("src is not null and dst is not null")
    out = e.groupBy(F.col("src").alias("node")).agg(F.count_distinct("kind", "dst").alias("refs_out"))
    in_ = e.where(F.col("kind").isin(*SECTIONS)).groupBy(F.col("dst").alias("node")).agg(F.count_distinct("src").alias("refs_in"))
    return out.join(in_, "node", "full").select("node", F.coalesce("refs_out", F.lit(0)).alias("refs_out"), F.coalesce("refs_in", F.lit(0)).alias("refs_in"))


def graph_queue_chapters(spark, d):
    """Unresolved targets by chapter: citations, targets, zones seen; chapters that the corpus has no section of are marked."""
    e = section_edges(spark, d).where("dst is not null").join(table(spark, d, "sections").select(F.col("id").alias("dst")).distinct(), "dst", "left_anti")
    e = e.withColumn("chapter", F.regexp_extract("dst", r"^(.*)-[^-]*$", 1))
    have = table(spark, d, "sections").select(F.concat_ws(":", "layer", "chapter").alias("chapter")).distinct().withColumn("known", F.lit(True))
    per = e.groupBy("chapter").agg(F.count(F.lit(1)).alias("citations"), F.count_distinct("dst").alias("targets"), F.array_join(F.array_sort(F.collect_set("zone")), "+").alias("zones"))
    return per.join(have, "chapter", "left").select("chapter", "citations", "targets", "zones", F.coalesce("known", F.lit(False)).alias("chapter_known"))


def frontier_size(spark, d):
    """Whole-chapter citations beside pinpoint citations, by chapter."""
    e = table(spark, d, "edge")
    whole = e.where("kind = 'hrs_chapter' and target is not null").groupBy(F.regexp_replace("target", "^ch:", "").alias("chapter")).agg(F.count(F.lit(1)).alias("whole"))
    pin = section_edges(spark, d).where("kind = 'hrs_section' and dst is not null").groupBy(F.regexp_extract("dst", r"^hrs:([0-9A-Z:]+)-", 1).alias("chapter")).agg(F.count(F.lit(1)).alias("pinpoint"))
    return whole.join(pin, "chapter", "full").select("chapter", F.coalesce("whole", F.lit(0)).alias("whole"), F.coalesce("pinpoint", F.lit(0)).alias("pinpoint"))


def link_lint(spark, d):
    """Dead links (targets without a section) with their number and least example, and sections that nothing links to."""
    e = section_edges(spark, d)
    ids = table(spark, d, "sections").select("id").distinct()
    dead = e.where("dst is not null").join(ids, F.col("dst") == F.col("id"), "left_anti").groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("links"), F.min("src").alias("example"))
    alone = ids.join(e.select(F.col("dst").alias("id")), "id", "left_anti").select("id", F.lit(0).cast("bigint").alias("links"), F.lit(None).cast("string").alias("example"))
    return dead.withColumn("problem", F.lit("dead")).unionByName(alone.withColumn("problem", F.lit("unlinked")))


def rules_by_statute(spark, d):
    """Rules that a statute authorises: most different sources first."""
    e = table(spark, d, "edges").where("relation = 'authorized_by' and dst is not null")
    return e.groupBy("dst").agg(F.count_distinct("src").alias("rules")).orderBy(F.desc("rules"), "dst").limit(10)


def renumbering(spark, d):
    """Old numbers to new ones, followed to the end of each chain, in proper form."""
    e = table(spark, d, "edges").where("relation = 'renumbered_from' and src is not null and dst is not null").select(proper_target(F.col("dst")).alias("src"), proper_target(F.col("src")).alias("dst"))
    return G.reach(e, e.select(F.col("src").alias("seed")), None).select("seed", "node", "depth")


_OUT = """WITH RECURSIVE {graph}, e AS (SELECT DISTINCT {a} AS a, {b} AS b FROM {g} WHERE {where} AND src IS NOT NULL AND dst IS NOT NULL),
r(seed, node, depth) AS (SELECT DISTINCT id, b, 1 FROM sections JOIN e ON e.a = id WHERE repealed = 1
 UNION SELECT seed, b, depth + 1 FROM r JOIN e ON e.a = r.node WHERE depth < {depth})
SELECT seed, node, min(depth) AS depth, seed = node AS on_cycle{extra} FROM r GROUP BY seed, node"""
_OP = "zone = 'operative'"

SQL = {
    "graph_hubs": f"WITH {GRAPH} SELECT dst AS node, count(DISTINCT src) AS sources FROM g WHERE zone = 'operative' AND dst IS NOT NULL AND src IS NOT NULL GROUP BY dst ORDER BY sources DESC, node LIMIT 25",
    "graph_hub_labels": f"""WITH {GRAPH}, h AS (SELECT dst AS node, count(DISTINCT src) AS sources FROM g WHERE zone = 'operative' AND dst IS NOT NULL GROUP BY dst),
 n AS (SELECT id, min(catchline) AS name FROM sections GROUP BY id)
 SELECT node, sources, CASE WHEN id IS NULL THEN '[not in corpus]' ELSE coalesce(name, '') END AS label FROM h LEFT JOIN n ON id = node""",
    "graph_orphans": f"WITH {GRAPH}, {GRAPH_ALL}, {LIVE} SELECT id FROM live WHERE NOT EXISTS (SELECT 1 FROM ga WHERE zone = 'operative' AND ga.src = id) AND NOT EXISTS (SELECT 1 FROM g WHERE zone = 'operative' AND g.dst = id)",
    "graph_queue": f"""WITH {GRAPH_ALL}, k AS (SELECT id FROM sections UNION SELECT layer || ':ch:' || chapter FROM sections),
 m AS (SELECT * FROM ga WHERE zone = 'operative' AND dst IS NOT NULL AND NOT EXISTS (SELECT 1 FROM k WHERE k.id = ga.dst)),
 n AS (SELECT DISTINCT kind, dst, src, split_part(src, ':', 1) AS layer, split_part(src, ':', -1) AS num FROM m WHERE src IS NOT NULL),
 r AS (SELECT kind, dst, src, row_number() OVER (PARTITION BY kind, dst ORDER BY layer, {natural_sql("num")}, src) AS r FROM n),
 x AS (SELECT kind, dst, string_agg(src, ', ' ORDER BY r) AS examples FROM r WHERE r <= 6 GROUP BY kind, dst)
 SELECT m.kind, m.dst, count(*) AS citations, count(DISTINCT src) AS sources, coalesce(any_value(examples), '') AS examples, arg_min(raw, edge_id) FILTER (raw IS NOT NULL OR TRUE) AS first_raw FROM m LEFT JOIN x ON x.kind = m.kind AND x.dst = m.dst GROUP BY m.kind, m.dst""",
    "graph_queue_groups": f"""WITH {GRAPH_ALL}, k AS (SELECT id FROM sections UNION SELECT layer || ':ch:' || chapter FROM sections), p AS (SELECT id FROM sections GROUP BY id HAVING max(repealed) = 1),
 e AS (SELECT * FROM ga WHERE dst IS NOT NULL),
 m AS (SELECT CASE WHEN kind IN ('hrs_chapter', 'har_chapter') THEN '1 chapters' WHEN kind IN ('hrs_section', 'har_section') THEN '2 sections' WHEN kind IN ('usc', 'cfr', 'public_law') THEN '3 federal' ELSE '4 other' END AS grp, * FROM e WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.id = e.dst)
  UNION ALL SELECT '5 repealed', * FROM e WHERE kind IN ('hrs_section', 'har_section') AND dst IN (SELECT id FROM p))
 SELECT grp, CASE WHEN grp = '2 sections' THEN regexp_replace(dst, '-[^-]*$', '') ELSE dst END AS item, count(*) AS citations, count(DISTINCT src) AS sources, coalesce(array_to_string(list_sort(list(DISTINCT zone) FILTER (zone IS NOT NULL)), '/'), '') AS zones FROM m GROUP BY ALL""",
    "unresolved_top": f"""WITH {GRAPH_ALL}, k AS (SELECT id FROM sections UNION SELECT layer || ':ch:' || chapter FROM sections)
 SELECT kind, dst, count(*) AS citations FROM ga WHERE zone = 'operative' AND dst IS NOT NULL AND NOT EXISTS (SELECT 1 FROM k WHERE k.id = ga.dst) GROUP BY kind, dst ORDER BY citations DESC, kind, dst LIMIT 12""",
    "out_in_order": f"""WITH {GRAPH_ALL}, e AS (SELECT DISTINCT src, kind, dst, kind IN ('hrs_section', 'har_section') AS s, split_part(dst, ':', -1) AS num FROM ga WHERE zone = 'operative' AND dst IS NOT NULL AND src IN (SELECT id FROM sections WHERE repealed = 1))
 SELECT src, row_number() OVER (PARTITION BY src ORDER BY NOT s, CASE WHEN s THEN '' ELSE kind END, CASE WHEN s THEN struct_pack(x := {natural_sql("num").replace("), regexp_extract(", "), y := regexp_extract(").replace(", list_transform(", ", z := list_transform(")}) END, kind, dst) AS pos, kind, dst FROM e""",
    "back_references": f"""WITH RECURSIVE {GRAPH}, e AS (SELECT DISTINCT src AS a, dst AS b FROM g WHERE zone = 'operative' AND src IS NOT NULL AND dst IS NOT NULL),
 w(seed, cur, prior, path, back, depth) AS (SELECT DISTINCT id, e.b, e.a, [id, e.b], e.b = id, 1 FROM sections JOIN e ON e.a = id WHERE repealed = 1
  UNION ALL SELECT seed, e.b, e.a, list_append(path, e.b), list_contains(path, e.b), depth + 1 FROM w JOIN e ON e.a = w.cur WHERE NOT back AND depth < 3)
 SELECT seed, prior AS src, cur AS dst, min(depth) AS depth FROM w WHERE back GROUP BY seed, prior, cur""",
    "graph_out": _OUT.format(graph=GRAPH_ALL, a="src", b="dst", g="ga", where=_OP, depth=3, extra=""),
    "graph_in": _OUT.format(graph=GRAPH, a="dst", b="src", g="g", where=_OP, depth=3, extra=""),
    "graph_both": "SELECT * FROM (" + _OUT.format(graph=GRAPH_ALL, a="src", b="dst", g="ga", where="zone IN ('operative', 'annotation')", depth=2, extra=", 'out' AS direction") + ") UNION ALL SELECT * FROM (" + _OUT.format(graph=GRAPH, a="dst", b="src", g="g", where="zone IN ('operative', 'annotation')", depth=2, extra=", 'in' AS direction") + ")",
    "graph_degrees": f"""WITH {GRAPH}, {GRAPH_ALL}, o AS (SELECT src AS node, count(DISTINCT (kind, dst)) AS n FROM ga WHERE src IS NOT NULL AND dst IS NOT NULL GROUP BY src),
 i AS (SELECT dst AS node, count(DISTINCT src) AS n FROM g WHERE src IS NOT NULL AND dst IS NOT NULL GROUP BY dst)
 SELECT coalesce(o.node, i.node) AS node, coalesce(o.n, 0) AS refs_out, coalesce(i.n, 0) AS refs_in FROM o FULL JOIN i ON o.node = i.node""",
    "graph_queue_chapters": f"""WITH {GRAPH}, m AS (SELECT *, regexp_extract(dst, '^(.*)-[^-]*$', 1) AS chapter FROM g WHERE dst IS NOT NULL AND dst NOT IN (SELECT id FROM sections))
 SELECT chapter, count(*) AS citations, count(DISTINCT dst) AS targets, coalesce(array_to_string(list_sort(list(DISTINCT zone) FILTER (zone IS NOT NULL)), '+'), '') AS zones,
 chapter IN (SELECT layer || ':' || chapter FROM sections) AS chapter_known FROM m GROUP BY chapter""",
    "frontier_size": f"""WITH {GRAPH}, w AS (SELECT regexp_replace(target, '^ch:', '') AS chapter, count(*) AS n FROM edge WHERE kind = 'hrs_chapter' AND target IS NOT NULL GROUP BY 1),
 p AS (SELECT regexp_extract(dst, '^hrs:([0-9A-Z:]+)-', 1) AS chapter, count(*) AS n FROM g WHERE kind = 'hrs_section' AND dst IS NOT NULL GROUP BY 1)
 SELECT coalesce(w.chapter, p.chapter) AS chapter, coalesce(w.n, 0) AS whole, coalesce(p.n, 0) AS pinpoint FROM w FULL JOIN p ON w.chapter = p.chapter""",
    "link_lint": f"""WITH {GRAPH} SELECT dst AS id, count(*) AS links, min(src) AS example, 'dead' AS problem FROM g WHERE dst IS NOT NULL AND dst NOT IN (SELECT id FROM sections) GROUP BY dst
 UNION ALL SELECT DISTINCT id, 0, NULL, 'unlinked' FROM sections WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.dst = sections.id)""",
    "rules_by_statute": "SELECT dst, count(DISTINCT src) AS rules FROM edges WHERE relation = 'authorized_by' AND dst IS NOT NULL GROUP BY dst ORDER BY rules DESC, dst LIMIT 10",
    "renumbering": f"""WITH RECURSIVE n AS (SELECT {proper_target_sql("dst")} AS a, {proper_target_sql("src")} AS b FROM edges WHERE relation = 'renumbered_from' AND src IS NOT NULL AND dst IS NOT NULL),
 e AS (SELECT DISTINCT a, b FROM n), r(seed, node, depth) AS (SELECT a, b, 1 FROM e UNION SELECT seed, b, depth + 1 FROM r JOIN e ON e.a = r.node WHERE depth < 100)
 SELECT seed, node, min(depth) AS depth FROM r GROUP BY seed, node""",
}
QUERIES = {k: globals()[k] for k in SQL}
