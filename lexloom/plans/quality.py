"""Validation as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexloom.functions import ids as I
from lexloom.operators import cite as C
from lexloom.operators import quality as Q
from lexloom.operators import relations as R
from lexloom.operators.segment import rule_zones
from lexloom.plans.graph import section_edges
from lexloom.plans.sqlparts import GRAPH, LAYER, NUM
from lexloom.sources import sinks as K
from lexloom.sources.tables import table

CHECKS = [
    ("layers", "SELECT count(DISTINCT layer) FROM v_sections", "=", 2),
    ("sections", "SELECT count(*) FROM v_sections", ">=", 100),
    ("sections_without_id", "SELECT count(*) FROM v_sections WHERE id IS NULL OR id = ''", "=", 0),
    ("zones_without_section", "SELECT count(*) FROM v_zones z WHERE NOT EXISTS (SELECT 1 FROM v_sections s WHERE s.id = z.section_id)", "=", 0),
    ("known_zones", "SELECT count(DISTINCT zone) FROM v_zones", "=", 7),
    ("repeated_zones", "SELECT count(*) FROM (SELECT section_id, zone FROM v_zones GROUP BY section_id, zone HAVING count(*) > 1)", "=", 0),
    ("edges_without_source", "SELECT count(*) FROM v_edge WHERE src IS NULL", "=", 0),
    ("repealed", "SELECT count(*) FROM v_sections WHERE repealed = 1", ">=", 1),
    ("statutes", "SELECT count(*) FROM v_sections WHERE layer = 'hrs'", ">=", 50),
    ("rules", "SELECT count(*) FROM v_sections WHERE layer = 'har'", ">=", 50),
    ("rule_titles", "SELECT count(DISTINCT id) FROM v_units WHERE layer = 'har' AND kind = 'title'", ">=", 20),
    ("statute_chapters", "SELECT count(DISTINCT id) FROM v_units WHERE layer = 'hrs' AND kind = 'chapter'", ">=", 100),
    ("units_of_one_kind", "SELECT count(*) FROM (SELECT id FROM v_units GROUP BY id HAVING count(DISTINCT kind) > 1)", "=", 0),
    ("repeated_edges", "SELECT count(*) FROM (SELECT edge_id FROM v_edge GROUP BY edge_id HAVING count(*) > 1)", "=", 0),
    ("rule_text_edges", "SELECT count(*) FROM v_edges WHERE attestation = 'rule_text'", ">=", 100),
    ("table_edges", "SELECT count(*) FROM v_edges WHERE attestation = 'lrb2025'", ">=", 100),
    ("statute_text_edges", "SELECT count(*) FROM v_edges WHERE attestation = 'hrs_text'", ">=", 100),
    ("acts", "SELECT count(DISTINCT target) FROM v_edge WHERE kind = 'session_law'", ">=", 10),
    ("rules_by_one_statute", "SELECT max(n) FROM (SELECT dst, count(DISTINCT src) AS n FROM v_edges WHERE relation = 'authorized_by' GROUP BY dst)", ">=", 2),
    ("found_by_word", "SELECT count(*) FROM v_zones WHERE body LIKE '%section%'", ">=", 1),
]


def checks(spark, d):
    for t in ("sections", "zones", "edge", "edges", "units"):
        table(spark, d, t).createOrReplaceTempView(f"v_{t}")
    return Q.run_checks(spark, CHECKS)


def kept_and_problems(spark, d):
    """Every document is either kept or a problem."""
    x = table(spark, d, "documents").select("doc_id", "text")
    bad = F.col("text").isNull() | (F.trim("text") == "")
    return Q.conservation(x, x.where(~bad), Q.problem(x.where(bad), "documents", "unread_document", "doc_id"))


def contents_against_body(spark, d):
    """Chapters that the units name and the sections lack, and the other way round."""
    toc = table(spark, d, "units").where("kind = 'chapter'").select("layer", F.col("num").alias("id"))
    return Q.toc_against_body(toc, table(spark, d, "sections").select("layer", F.col("chapter").alias("id")), ["layer"])


def rebuild_regression(spark, d):
    """Federal citations read again from their raw text by the extractor: per kind the rows stored and read again, and those that differ on either side."""
    e = table(spark, d, "edge").where("kind in ('usc', 'cfr') and raw is not null and target is not null").select("edge_id", "kind", "raw", F.trim("target").alias("target"))
    old = e.select("edge_id", "kind", "target")
    new = C.extract(e.select("edge_id", "raw"), ["edge_id"], "raw", "statute").where("kind in ('usc', 'cfr')").select("edge_id", "kind", "target")
    count = lambda x, name: x.groupBy("kind").agg(F.count(F.lit(1)).alias(name))
    differ = Q.regression(old, new)
    sides = [count(old, "stored"), count(new, "read"), count(differ.where("side = 'old'"), "only_stored"), count(differ.where("side = 'new'"), "only_read")]
    out = sides[0]
    for x in sides[1:]:
        out = out.join(x, "kind", "full")
    return out.na.fill(0)


def upsert_units(spark, d):
    """Chapters inserted or replaced by key: the last of each stays."""
    u = table(spark, d, "units").select("id", "title", "url").distinct()
    new = u.where("url is null").select("id", F.lit("retitled").alias("title"), F.lit("none").alias("url"))
    return R.upsert(u, new, ["id"], "title")


def missing_notes(spark, d):
    """Rules without an authority or an implementation note."""
    z = table(spark, d, "zones").select("section_id", "zone").distinct()
    s = table(spark, d, "sections").where("layer = 'har' and repealed = 0").select(F.col("id").alias("section_id")).distinct()
    out = None
    for zone in ("auth", "imp"):
        x = Q.problem(s.join(z.where(F.col("zone") == zone), "section_id", "left_anti"), "zones", f"missing_{zone}", "section_id")
        out = x if out is None else out.unionByName(x)
    return out.groupBy("origin", "kind").agg(F.count(F.lit(1)).alias("n"))


def rule_text_round_trip(spark, d):
    """Rules put together from the zones they have and split again: sections of which a zone comes out otherwise, missing ones included.

    Notes that are kept without their parentheses or label get them back, as they are printed."""
    names = ["operative", "source_note", "auth", "imp"]
    z = table(spark, d, "zones").where(F.col("zone").isin(*names)).where("section_id like 'har:%' and trim(body) <> ''")
    trim = lambda c: F.nullif(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""), F.lit(""))
    printed = lambda c, label: F.when(c.rlike(r"^\(\s*[A-Za-z1][A-Za-z1\s]{1,6}:"), c).when(c.rlike(rf"(?i)^{label}\s*:"), F.concat(F.lit("("), c, F.lit(")"))).otherwise(F.concat(F.lit(f"({label}: "), c, F.lit(")")))
    p = z.groupBy("section_id").pivot("zone", names).agg(F.max(trim(F.col("body"))))
    p = p.withColumns({"auth": printed(F.col("auth"), "Auth"), "imp": printed(F.col("imp"), "Imp")})
    again = rule_zones(p.select("section_id", F.concat_ws(" ", *names).alias("text")), "section_id", "text")
    j = p.join(again.select("section_id", *[trim(F.col(c)).alias(f"n_{c}") for c in names]), "section_id")
    return j.where(" or ".join(f"not ({c} <=> n_{c})" for c in names)).select("section_id")


def citation_pages(spark, d):
    """A page per section with what it cites and what cites it: paths and lengths of the contents."""
    s = table(spark, d, "sections").groupBy("id").agg(F.max("catchline").alias("catchline"))
    b = table(spark, d, "zones").where("zone = 'operative'").groupBy(F.col("section_id").alias("id")).agg(F.max("body").alias("body"))
    e = table(spark, d, "edge").where("src is not null and target is not null").select(I.proper_section(F.col("src")).alias("id"), F.col("target").alias("other"))
    back = section_edges(spark, d).where("src is not null and dst is not null").select(F.col("dst").alias("id"), F.col("src").alias("other"))
    return K.section_pages(s.join(b, "id", "left"), e, back).select("path", F.length("content").alias("chars"))


_CK = " UNION ALL ".join(f"SELECT '{n}' AS name, CAST(({q}) AS BIGINT) AS value, '{op}' AS op, CAST({e} AS BIGINT) AS expected, coalesce(CAST(({q}) AS BIGINT) {op} {e}, false) AS passed" for n, q, op, e in CHECKS).replace("v_", "")
SQL = {
    "checks": _CK,
    "kept_and_problems": "SELECT count(*) AS rows_in, count(*) FILTER (text IS NOT NULL AND trim(text) <> '') AS rows_out, count(*) FILTER (text IS NULL OR trim(text) = '') AS problems, true AS conserved FROM documents",
    "contents_against_body": "WITH u AS (SELECT DISTINCT layer, num AS id FROM units WHERE kind = 'chapter'), s AS (SELECT DISTINCT layer, chapter AS id FROM sections) SELECT layer, id, 'not_in_body' AS problem FROM (FROM u EXCEPT FROM s) UNION ALL SELECT layer, id, 'not_in_toc' FROM (FROM s EXCEPT FROM u)",
    "rebuild_regression": """WITH e AS (SELECT kind, trim(target, ' ') AS target, regexp_extract(raw, '([0-9]+)\\s+[UC]\\.[SF]\\.[CR]\\.\\s*(§+|parts?|sections?)?\\s*([0-9]+)', 1) AS a, regexp_extract(raw, '([0-9]+)\\s+[UC]\\.[SF]\\.[CR]\\.\\s*(§+|parts?|sections?)?\\s*([0-9]+)', 3) AS b FROM edge WHERE kind IN ('usc', 'cfr') AND raw IS NOT NULL AND target IS NOT NULL),
 x AS (SELECT *, CASE WHEN a <> '' THEN kind || ':' || a || ':' || b END AS again FROM e)
 SELECT kind, count(*) AS stored, count(again) AS read, count(*) FILTER (again IS NULL OR again <> target) AS only_stored, count(*) FILTER (again <> target) AS only_read FROM x GROUP BY kind""",
    "upsert_units": "WITH u AS (SELECT DISTINCT id, title, url FROM units), a AS (SELECT id, title, url, 0 AS n FROM u UNION ALL SELECT id, 'retitled', 'none', 1 FROM u WHERE url IS NULL) SELECT id, title, url FROM a QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, title DESC NULLS LAST) = 1",
    "missing_notes": "WITH s AS (SELECT DISTINCT id FROM sections WHERE layer = 'har' AND repealed = 0) SELECT 'zones' AS origin, 'missing_' || k AS kind, count(*) AS n FROM s CROSS JOIN (VALUES ('auth'), ('imp')) v(k) WHERE NOT EXISTS (SELECT 1 FROM zones z WHERE z.section_id = s.id AND z.zone = k) GROUP BY k",
    "rule_text_round_trip": None,
    "citation_pages": f"""WITH {GRAPH}, s AS (SELECT id, max(catchline) AS catchline FROM sections GROUP BY id), b AS (SELECT section_id, max(body) AS body FROM zones WHERE zone = 'operative' GROUP BY 1),
 n AS (SELECT src, target, {NUM.format(c="src")} AS num FROM edge WHERE src IS NOT NULL AND target IS NOT NULL),
 o AS (SELECT id, sum(length(other) + 6) + count(*) - 1 + 9 AS chars FROM (SELECT DISTINCT {LAYER.format(c="src", n="num")} || ':' || num AS id, target AS other FROM n) GROUP BY id),
 i AS (SELECT dst AS id, sum(length(src) + 6) + count(*) - 1 + 12 AS chars FROM (SELECT DISTINCT dst, src FROM g WHERE src IS NOT NULL AND dst IS NOT NULL) GROUP BY dst)
 SELECT regexp_replace(lower(s.id), '[^0-9a-z.-]', '-', 'g') || '.md' AS path, CAST(length(s.id) + length(coalesce(catchline, '')) + 3 + 2 + length('<!-- curated -->') + 2 + length('<!-- /curated -->') + coalesce(length(body) + 2, 0) + coalesce(o.chars + 2, 0) + coalesce(i.chars + 2, 0) AS BIGINT) AS chars
 FROM s LEFT JOIN b ON b.section_id = s.id LEFT JOIN o ON o.id = s.id LEFT JOIN i ON i.id = s.id""",
}
QUERIES = {k: globals()[k] for k in SQL}
SQL = {k: v for k, v in SQL.items() if v}
