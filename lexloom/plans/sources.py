"""Readers, segmentation and pages as queries: documents put together from the tables are read again."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexloom.functions.ids import statute_key
from lexloom.operators import segment as S
from lexloom.plans.graph import graph_queue_groups
from lexloom.plans.graph import SQL as GRAPH_SQL
from lexloom.sources import documents as R
from lexloom.sources import sinks as K
from lexloom.sources.tables import table


def raw_documents(spark, d):
    """Documents behind a header of provenance and a comment."""
    t = table(spark, d, "documents").where("text is not null")
    value = F.concat(F.lit("---\nunit: '"), F.coalesce("unit_id", F.lit("")), F.lit("'\nsource: a: b\nnone\n---\n<!-- kept\nout -->\n"), F.col("text"))
    x = R.parse_raw(t.select(F.col("doc_id").cast("string").alias("path"), value.alias("value")))
    return x.select(F.col("path").cast("bigint").alias("doc_id"), F.col("meta")["unit"].alias("unit"), F.col("meta")["source"].alias("source"), F.size("meta").alias("keys"), F.md5("body").alias("print"))


def manifest_files(spark, d):
    """File records out of manifests, one manifest per unit."""
    u = table(spark, d, "documents").where("unit_id is not null").groupBy("unit_id").agg(F.collect_list(F.struct(F.col("doc_id").cast("string").alias("file"), F.col("unit_id").alias("chapter"))).alias("sections"))
    return R.parse_manifest(u.select(F.concat(F.lit("\ufeff"), F.to_json(F.struct("sections"))).alias("value")), "file string, chapter string")


def tolerant_json(spark, d):
    """JSON with a byte order mark and words around it: what was read, and what couldn't be."""
    u = table(spark, d, "units").where("extra is not null").groupBy("id").agg(F.max("extra").alias("extra"))
    good, bad = R.parse_json(u.select(F.col("id").alias("path"), F.concat(F.lit("\ufeffsee: "), F.col("extra"), F.lit(" (end)")).alias("value")), "sections int, volume int")
    return good.select("path", F.col("r.sections").alias("sections"), F.lit(True).alias("read")).unionByName(bad.select("path", F.lit(None).cast("int").alias("sections"), F.lit(False).alias("read")))


def form_feed_pages(spark, d):
    """Zones of a section as pages of one file."""
    z = table(spark, d, "zones").where("body <> ''").select("section_id", "body").distinct()
    g = z.groupBy("section_id").agg(F.array_join(F.array_sort(F.collect_list("body")), "\f").alias("t"))
    return R.pages(g, "section_id", "t").select("section_id", "page", F.length("text").alias("chars"))


def listed_sections(spark, d):
    """How many sections a directory listing names per chapter; a chapter without a listing gives -1."""
    s = table(spark, d, "sections").where("layer = 'hrs'").select("chapter", "num").distinct()
    line = F.concat(F.lit('<a href="HRS_'), F.col("num"), F.lit('.htm">x</a>'))
    g = s.groupBy("chapter").agg(F.concat(F.lit('<A HREF="HRS_contents.htm">all</A>'), F.array_join(F.collect_list(line), "<br>")).alias("html"))
    u = table(spark, d, "units").where("layer = 'hrs' and kind = 'chapter'").select(F.col("num").alias("chapter")).distinct()
    return R.universe(u.join(g, "chapter", "left"), "chapter", "html", r'(?i)href="(HRS_[^"]+)"')


def discovered_pages(spark, d):
    """One hop from the pages of titles to those of their chapters, at most 40 a title, pictures left out."""
    u = table(spark, d, "units").select("id", "kind", "num", "parent").distinct()
    home = F.concat(F.lit("https://law.example.invalid/"), F.col("parent"))
    links = u.where("kind = 'chapter' and parent is not null").select(home.alias("page"), F.concat(home, F.lit("/chapter-"), F.col("num")).alias("href"), F.regexp_extract("num", r"(\d+)", 1).cast("int").alias("seq"))
    links = links.unionByName(links.select("page", F.concat("page", F.lit("/chapter.jpg")).alias("href"), F.lit(0).alias("seq")))
    seeds = u.where("kind = 'title'").select(F.concat(F.lit("https://law.example.invalid/"), F.col("id")).alias("url"))
    return R.discover(seeds, links)


def master_index(spark, d):
    """A printed index of chapters, in titles by their first digit: each number with its title and the name in the block behind it."""
    u = table(spark, d, "units").where("layer = 'hrs' and kind = 'chapter'").select("num").distinct()
    u = u.where(F.col("num").rlike(r"^\d+[A-Z]?$")).select("num", F.substring("num", 1, 1).alias("title"))
    block = F.concat(F.lit("TITLE "), F.col("title"), F.lit("\n\n"), F.col("num"), F.lit(".\n\nName of\n "), F.col("num"))
    text = u.agg(F.array_join(F.array_sort(F.collect_list(block)), "\n \n").alias("t")).select(F.lit("index").alias("doc"), "t")
    return R.chapter_index(text, "doc", "t").select("title", "num", "name")


def trusted_links(spark, d):
    """Work list of addresses from two sources: each once, from the more trusted."""
    u = table(spark, d, "units").where("url is not null").select("url", "layer", F.col("id").alias("seq")).distinct()
    return R.work_list(u.where("layer = 'har'"), u).select("url", "trust", "seq")


def archived_texts(spark, d):
    """Documents without a text, from an archive, and told apart from the others."""
    x = table(spark, d, "documents").select("doc_id", "text")
    return R.with_archived(x.where("text is not null"), x.select("doc_id", F.lit("archived").alias("text")), "doc_id").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def pages_behind_heading(spark, d):
    """Pages of a section from the first one that bears a heading on, and the table each belongs to."""
    z = table(spark, d, "zones").where("body is not null").select("section_id", "zone", "body").distinct()
    w = Window.partitionBy("section_id").orderBy("zone", "body")
    p = z.select("section_id", F.row_number().over(w).alias("page"), F.col("body").alias("text"))
    kept = R.pages_from(p, "section_id", "(?i)section")
    return R.pages_by_mode(kept, "section_id", {"notes": "Case Notes", "law": "(?i)section"}).select("section_id", "page", "mode")


def statute_pages(spark, d):
    """Pages put together from numbers and catchlines, taken apart again: preamble, catchline, history, notes."""
    s = table(spark, d, "sections").where("layer = 'hrs'").groupBy("num").agg(F.max(F.regexp_replace("catchline", "[^A-Za-z ]", "")).alias("c")).where(F.col("c").rlike("^[A-Za-z]+ [A-Za-z]")).where(F.col("num").rlike(r"^[0-9A-Z]+(?::[0-9A-Z]+)?-[0-9.]+$"))
    page = F.concat(F.lit("PART II. FEES\n[§"), F.col("num"), F.lit("] "), F.trim("c"), F.lit(". The port is open.\n[L 1999, c 1, §1]\nIt stays so.\n[L 2001, c 5, §1; am L 2002, c 6, §2]\nCase Notes\nCited.")).alias("page")
    return S.statute_zones(s.select("num", page), "num", "page").select("num", "part", "catchline", "history", "annotation", F.length("body").alias("chars"))


def sections_cut(spark, d):
    """Chapters as one text, cut at header lines; of a number that comes twice the longer text."""
    s = table(spark, d, "sections").where("layer = 'har'").select("chapter", "num", F.coalesce("catchline", F.lit("")).alias("c")).distinct().withColumn("c", F.regexp_replace("c", r"[\n§]", " "))
    line = F.concat(F.lit("§"), F.col("num"), F.lit(" Head\n"), F.col("c"))
    text = s.groupBy("chapter").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("t"))
    cut = S.longest_of_each(S.sections_of(text, "chapter", "t", r"^§(\S+) Head"), "chapter")
    return cut.select("chapter", "id", F.length("body").alias("chars"))


def directory(spark, d):
    """A printed directory with wrapped names, in titles by the chapters' first digit: title, chapter and name of each line."""
    u = table(spark, d, "units").where("layer = 'hrs' and kind = 'chapter'").select("num").distinct().where(F.col("num").rlike(r"^\d+[A-Z]?$"))
    u = u.select("num", F.substring("num", 1, 1).alias("title"))
    key = F.struct(F.col("title").cast("int").alias("t"), statute_key(F.col("num")).alias("n"))
    lines = F.array(F.concat(F.lit("TITLE "), F.col("title"), F.lit(" LAWS")), F.concat(F.col("num"), F.lit(" Name of")), F.concat(F.lit("chapter "), F.col("num")))
    x = u.select(F.lit("d").alias("doc"), key.alias("k"), F.posexplode(lines).alias("i", "text"))
    return S.directory_rows(x, ["k", "i"], ["doc"]).select("title", "chapter", "catchline")


def keyed_rows(spark, d):
    """Rows of a table whose key is printed once: the list of each key."""
    e = table(spark, d, "edges").where("attestation = 'lrb2025' and src is not null and dst is not null and trim(dst) <> ''").select("src", "dst", "id")
    w = Window.partitionBy("src").orderBy("id")
    rows = e.select(F.substring("src", 1, 6).alias("doc"), "src", "id", F.when(F.row_number().over(w) == 1, F.col("src")).otherwise(F.lit("")).alias("key"), F.col("dst").alias("val"))
    return S.keyed_lists(rows, ["src", "id"], ["doc"]).select(F.col("key").alias("src"), F.md5("list").alias("print"))


def curated_notes(spark, d):
    """Hand-written blocks put on pages and taken off again."""
    s = table(spark, d, "sections").groupBy("id").agg(F.max("catchline").alias("catchline"), F.max("repealed").alias("repealed")).withColumn("body", F.lit(None).cast("string"))
    notes = s.where("repealed = 1").select("id", F.concat(F.lit("keep\n"), "id").alias("note"))
    none = s.where("false").select("id", F.lit("").alias("other"))
    return K.curated_blocks(K.section_pages(s.drop("repealed"), none, none, notes))


def noted_sections(spark, d):
    """Notes on cited sections: those whose section is there, and those whose section is missing."""
    notes = table(spark, d, "edges").where("dst like 'hrs:%'").select(F.col("dst").alias("id"), F.lit("n").alias("note")).distinct()
    found, missing = K.inject_notes(notes, table(spark, d, "sections"))
    return found.select("id", F.lit(True).alias("there")).unionByName(missing.select("id", F.lit(False).alias("there")))


def queue_report(spark, d):
    """The queue as one page, the five largest items of each group: its fingerprint."""
    q = graph_queue_groups(spark, d).select("grp", "item", F.col("citations").alias("n"))
    return K.queue_page(q, "Queue", 5).select(F.md5("content").alias("print"), F.length("content").alias("chars"))


_HOME = "'https://law.example.invalid/'"
SQL = {
    "raw_documents": "SELECT doc_id, coalesce(unit_id, '') AS unit, 'a: b' AS source, 2 AS keys, md5(regexp_replace(text, '^[ \\t\\n\\v\\f\\r]+', '')) AS print FROM documents WHERE text IS NOT NULL",
    "manifest_files": "SELECT CAST(doc_id AS VARCHAR) AS file, unit_id AS chapter FROM documents WHERE unit_id IS NOT NULL",
    "tolerant_json": "WITH u AS (SELECT id AS path, max(extra) AS e FROM units WHERE extra IS NOT NULL GROUP BY id) SELECT path, TRY_CAST(json_extract_string(TRY_CAST(nullif(e, '') AS JSON), '$.sections') AS INT) AS sections, contains(e, '{') AS read FROM u",
    "form_feed_pages": "SELECT section_id, row_number() OVER (PARTITION BY section_id ORDER BY body) AS page, length(body) AS chars FROM (SELECT DISTINCT section_id, body FROM zones WHERE body <> '')",
    "listed_sections": "SELECT u.num AS chapter, CASE WHEN n IS NULL THEN -1 ELSE n END AS expected FROM (SELECT DISTINCT num FROM units WHERE layer = 'hrs' AND kind = 'chapter') u LEFT JOIN (SELECT chapter, count(DISTINCT num) AS n FROM sections WHERE layer = 'hrs' GROUP BY chapter) s ON s.chapter = u.num",
    "discovered_pages": f"""WITH u AS (SELECT DISTINCT id, kind, num, parent FROM units), t AS (SELECT DISTINCT id FROM u WHERE kind = 'title'),
 l AS (SELECT parent, {_HOME} || parent || '/chapter-' || num AS href, min(TRY_CAST(regexp_extract(num, '([0-9]+)', 1) AS INT)) AS seq FROM u WHERE kind = 'chapter' AND parent IN (SELECT id FROM t) GROUP BY 1, 2)
 SELECT {_HOME} || id AS url, 0 AS depth FROM t UNION ALL SELECT DISTINCT href, 1 FROM (SELECT href FROM l QUALIFY row_number() OVER (PARTITION BY parent ORDER BY seq, href) <= 40)""",
    "master_index": "SELECT DISTINCT left(num, 1) AS title, num, 'Name of ' || num AS name FROM units WHERE layer = 'hrs' AND kind = 'chapter' AND regexp_matches(num, '^[0-9]+[A-Z]?$')",
    "trusted_links": "WITH u AS (SELECT DISTINCT url, layer, id AS seq FROM units WHERE url IS NOT NULL), w AS (SELECT url, 0 AS trust, seq FROM u WHERE layer = 'har' UNION ALL SELECT url, 1, seq FROM u) SELECT url, trust, seq FROM w QUALIFY row_number() OVER (PARTITION BY url ORDER BY trust, seq) = 1",
    "archived_texts": "SELECT CASE WHEN text IS NULL THEN 'ok_archived' ELSE 'ok' END AS status, count(*) AS n FROM documents GROUP BY 1",
    "pages_behind_heading": """WITH z AS (SELECT DISTINCT section_id, zone, body FROM zones WHERE body IS NOT NULL), p AS (SELECT section_id, row_number() OVER (PARTITION BY section_id ORDER BY zone NULLS FIRST, body) AS page, body FROM z),
 o AS (SELECT *, max(regexp_matches(body, '(?i)section')::INT) OVER (PARTITION BY section_id ORDER BY page) AS o, CASE WHEN contains(body, 'Case Notes') THEN 'notes' WHEN regexp_matches(body, '(?i)section') THEN 'law' END AS m FROM p)
 SELECT section_id, page, last_value(m IGNORE NULLS) OVER (PARTITION BY section_id ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mode FROM o WHERE o = 1""",
    "statute_pages": """WITH s AS (SELECT num, max(regexp_replace(catchline, '[^A-Za-z ]', '', 'g')) AS c FROM sections WHERE layer = 'hrs' GROUP BY num) SELECT num, 'PART II. FEES' AS part, left(regexp_replace(trim(c, ' '), ' +', ' ', 'g'), 250) AS catchline, '[L 2001, c 5, §1; am L 2002, c 6, §2]' AS history,
 'Case Notes' || chr(10) || 'Cited.' AS annotation, length('[§' || num || '] ' || trim(c, ' ') || '. The port is open.' || chr(10) || '[L 1999, c 1, §1]' || chr(10) || 'It stays so.') AS chars FROM s WHERE regexp_matches(c, '^[A-Za-z]+ [A-Za-z]') AND regexp_matches(num, '^[0-9A-Z]+(:[0-9A-Z]+)?-[0-9.]+$')""",
    "sections_cut": "SELECT chapter, num AS id, max(length('§' || num || ' Head') + 1 + length(coalesce(catchline, ''))) AS chars FROM sections WHERE layer = 'har' GROUP BY 1, 2",
    "directory": "SELECT DISTINCT left(num, 1) AS title, num AS chapter, 'Name of chapter ' || num AS catchline FROM units WHERE layer = 'hrs' AND kind = 'chapter' AND regexp_matches(num, '^[0-9]+[A-Z]?$')",
    "keyed_rows": "SELECT trim(src, ' ') AS src, md5(string_agg(trim(dst, ' '), ' ' ORDER BY id)) AS print FROM edges WHERE attestation = 'lrb2025' AND dst IS NOT NULL AND trim(dst, ' ') <> '' AND src IS NOT NULL GROUP BY src",
    "curated_notes": "SELECT regexp_replace(lower(id), '[^0-9a-z.-]', '-', 'g') || '.md' AS path, 'keep' || chr(10) || id AS note FROM sections GROUP BY id HAVING max(repealed) = 1",
    "noted_sections": "SELECT DISTINCT dst AS id, EXISTS (SELECT 1 FROM sections s WHERE s.id = dst) AS there FROM edges WHERE dst LIKE 'hrs:%'",
    "queue_report": f"""WITH q AS ({GRAPH_SQL["graph_queue_groups"]}), r AS (SELECT grp, item, citations AS n, row_number() OVER (PARTITION BY grp ORDER BY citations DESC, item) AS r FROM q),
 g AS (SELECT grp, string_agg('- ' || item || ' (' || n || ')', chr(10) ORDER BY r) AS t FROM r WHERE r <= 5 GROUP BY grp), p AS (SELECT '# Queue' || chr(10) || chr(10) || string_agg('## ' || grp || chr(10) || t, chr(10) || chr(10) ORDER BY grp) AS c FROM g)
 SELECT md5(c) AS print, length(c) AS chars FROM p""",
}
QUERIES = {k: globals()[k] for k in SQL}
