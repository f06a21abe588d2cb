"""Text functions, citations and definitions as queries."""

from __future__ import annotations

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from lexloom.functions import ids as I
from lexloom.functions import text as X
from lexloom.operators import cite as C
from lexloom.operators import define as D
from lexloom.plans.graph import section_edges
from lexloom.plans.sqlparts import GRAPH, LAYER, NUM
from lexloom.sources.tables import table


def text_forms(spark, d):
    """Titles through the text functions."""
    t = F.col("title")
    return table(spark, d, "units").distinct().select(
        "id", X.flatten(t).alias("flat"), X.normalize_dashes(t).alias("dashes"), X.normalize_dashes(t, True).alias("no_soft"), F.round(X.caps_ratio(t), 4).alias("caps"), X.slug(F.col("layer"), F.col("num")).alias("slug"), X.reporter_slug(t).alias("letters"),
    )


def effective_dates(spark, d):
    """The last date of each source note."""
    z = table(spark, d, "zones").where("zone = 'source_note' and body is not null").select("section_id", "body").distinct()
    return z.select("section_id", X.last_date(F.col("body")).alias("effective"))


def printed_dates(spark, d):
    return table(spark, d, "sections").select("id", X.printed_date(F.col("effective")).alias("effective")).distinct()


def repealed_flags(spark, d):
    s = table(spark, d, "sections").select("id", "catchline").distinct()
    z = table(spark, d, "zones").where("zone = 'operative'").select(F.col("section_id").alias("id"), "body").distinct()
    return s.join(z, "id", "left").select("id", X.is_repealed(F.col("catchline"), F.col("body")).alias("repealed")).groupBy("repealed").agg(F.count_distinct("id").alias("n"))


def display_names(spark, d):
    return table(spark, d, "edge").where("target is not null").select("kind", "target", I.display(F.col("kind"), F.col("target")).alias("name")).distinct()


def key_kinds(spark, d):
    """Raw citations classified like keys of a printed table."""
    e = table(spark, d, "edge").select(F.regexp_replace("raw", r"^(?i)(HRS|HAR|§|section|sec\.|\s)+", "").alias("k"))
    return e.groupBy(I.classify_key(F.col("k"))["kind"].alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def name_spaces(spark, d):
    e = table(spark, d, "edge").where("target is not null")
    return e.groupBy("kind", F.regexp_extract(I.namespaced(F.col("kind"), I.squeeze(F.col("target"))), r"^([a-z]+(:ch)?):", 1).alias("space")).agg(F.count(F.lit(1)).alias("n"))


def pin_cites(spark, d):
    return table(spark, d, "edge").where("kind in ('hrs_section', 'har_section')").select("edge_id", I.pin_cite(F.col("raw")).alias("pin")).where("pin is not null")


def _operative(spark: SparkSession, d: str):
    return table(spark, d, "zones").where("zone = 'operative'").select("section_id", "body").distinct()


def citations(spark, d):
    """Citations extracted from operative texts, per target."""
    c = C.extract(_operative(spark, d), ["section_id"], "body", "statute")
    return c.where("kind = 'hrs_section'").groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("section_id").alias("sections"))


def citation_kinds(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    both = C.extract(docs, ["doc_id"], "text", "statute").unionByName(C.extract(docs, ["doc_id"], "text", "case"))
    return both.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def case_runs(spark, d):
    c = C.extract(table(spark, d, "edge").where("kind = 'case' and raw is not null").select("edge_id", "raw"), ["edge_id"], "raw", "case")
    return c.where("kind = 'case'").select("edge_id", "target")


def citation_sweep(spark, d):
    """Tokens of section citations in operative texts, found by a pattern of their own, that the edge table has no citation of that section for."""
    z = _operative(spark, d).select("section_id", F.regexp_replace("body", r"(?i)(?<![A-Za-z])section\s+(?=\d)", "section ").alias("body"))
    have = section_edges(spark, d).select(F.col("src").alias("section_id"), F.concat(F.lit("section "), F.regexp_extract("dst", r"^hrs:(.*)$", 1)).alias("target"))
    return C.missed_tokens(z, ["section_id"], "body", have, r"section \d+[A-Z]?-\d+(?:\.\d+)?")


def raw_citations(spark, d):
    """Chapters and federal citations as printed, read by the extractor: per target."""
    e = table(spark, d, "edge").where("kind in ('hrs_chapter', 'usc', 'cfr')").select("edge_id", "raw")
    return C.extract(e, ["edge_id"], "raw", "statute").groupBy("kind", "target").agg(F.count(F.lit(1)).alias("n"))


def rule_citations(spark, d):
    """Rules cited as printed, in lists and ranges (their ends), read as rule text: per rule."""
    e = table(spark, d, "edge").where("kind = 'har_section'").select("edge_id", "raw")
    return C.extract(e, ["edge_id"], "raw", "rule").where("kind = 'har_section'").groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("edge_id").alias("edges"))


def opinion_citations(spark, d):
    """Rules and chapters of rules cited in opinions, planted behind the raw citations, in the name space of rules."""
    e = table(spark, d, "edge").where("kind = 'har_section'").select("edge_id", F.concat("raw", F.lit("; chapter 3-160 and section 11-1")).alias("raw"))
    return C.extract(e, ["edge_id"], "raw", "opinion").where("kind in ('har_section', 'har_chapter')").groupBy("kind", "target").agg(F.count(F.lit(1)).alias("n"))


def authority_notes(spark, d):
    """What the authority notes cite, and how many of them leave a digit unread."""
    z = table(spark, d, "zones").where("zone in ('auth', 'imp')").select("section_id", "zone", "body").distinct()
    return C.note_citations(z, ["section_id", "zone"], "body").groupBy("zone", "kind").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.when(F.col("kind") != "leftover", F.col("target"))).alias("targets"))


def case_paragraphs(spark, d):
    """Cases held about sections, read from editorial notes: planted citations at the end of each note, a run of parallel ones and one of another paragraph."""
    z = table(spark, d, "zones").where("zone = 'annotation' and body is not null").select("section_id", F.concat("body", F.lit("\n\nHeld in 12 H. 34,\n56 P.3d 78 (2001).\n\n9 L. Ed. 2d 7"))).toDF("section_id", "body").distinct()
    return C.case_notes(z, ["section_id"], "body").where("target in ('case:12-H-34', 'case:9-LEd2d-7')").select("section_id", "target", "raw", "context")


def healed_notes(spark, d):
    """Authority notes with misread digits, planted, mended where the table attests the citation: how many of each kind of repair."""
    z = table(spark, d, "zones").where("zone = 'auth'").where(F.col("body").rlike(r"^\d*1\d*-\d+$")).select("section_id", "body").distinct()
    notes = z.select("section_id", F.concat(F.lit("(Auth: HRS §"), F.regexp_replace("body", r"^(\d*?)1", "$1l"), F.lit(")")).alias("note"))
    return C.heal_notes(notes, "section_id", "note", z.withColumnRenamed("body", "target")).select("section_id", "note", F.size("repairs").alias("repairs"))


def _defined(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("section"), "text", F.lit("").alias("catchline"), F.coalesce("unit_id", F.lit("")).alias("unit"))
    defs = D.extract_definitions(docs, "section", "text", "catchline")
    return docs.select("section", "unit"), defs


def definition_scopes(spark, d):
    return _defined(spark, d)[1].groupBy("scope").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("term_norm").alias("terms"))


def _keyed(docs, defs):
    """Definitions with the place where they count; documents have no part, subpart or title."""
    none = F.lit(None).cast("string")
    return defs.join(docs, "section").select("term_norm", "scope", "section", D.scope_key(F.col("scope"), F.col("section"), F.col("unit"), none, none, none).alias("scope_key"), F.col("section").cast("bigint").alias("seq"))


def definition_collisions(spark, d):
    docs, defs = _defined(spark, d)
    return D.collisions(_keyed(docs, defs))


def definition_at(spark, d):
    """Definitions that govern in each unit: counts of controlling and shadowed ones per term. Documents of a unit see the same scopes, so each unit is resolved once,
    and a document besides for the terms that it defines for itself alone."""
    docs, defs = _defined(spark, d)
    defs = _keyed(docs, defs)
    own = defs.where("scope = 'section'").select("section", "term_norm").distinct()
    rest = [F.lit("").alias("part"), F.lit("").alias("subpart"), F.lit(None).cast("string").alias("title")]
    units = docs.where("unit <> ''").select(F.concat(F.lit("unit:"), "unit").alias("section"), F.col("unit").alias("chapter"), *rest)
    alone = docs.join(own.select("section").distinct(), "section", "left_semi").select("section", F.nullif("unit", F.lit("")).alias("chapter"), *rest)
    defs = defs.select("term_norm", "scope_key", "seq")
    r = D.resolve(units, defs).unionByName(D.resolve(alone, defs).join(own, ["section", "term_norm"], "left_semi"))
    return r.groupBy("term_norm").agg(F.count_if("controls").alias("places"), F.count_if(~F.col("controls")).alias("shadowed"))


def definition_levels(spark, d):
    """Which definitions govern at each section, over all five scopes: every section defines the first word of its catchline, with a scope by the length of its id."""
    s = table(spark, d, "sections").groupBy("id").agg(F.max("layer").alias("layer"), F.max("chapter").alias("num"), F.max("unit_path").alias("path"), F.max("catchline").alias("catchline"))
    titles = table(spark, d, "units").where("kind = 'chapter'").groupBy("layer", "num").agg(F.max("parent").alias("title"))
    part, sub = F.regexp_extract("path", r"^(Part [IVXL]+)", 1), F.regexp_extract("path", r"› ([A-Z]\. .*)$", 1)
    x = s.join(titles, ["layer", "num"], "left").select(F.col("id").alias("section"), F.concat_ws(":", "layer", "num").alias("chapter"), part.alias("part"), sub.alias("subpart"), "title", "catchline")
    scope = F.element_at(F.array(*[F.lit(k) for k in D.SCOPES[:5]]), F.length("section") % 5 + 1)
    place = [F.col(c) for c in ("section", "chapter", "part", "subpart", "title")]
    defs = x.select(F.nullif(F.lower(F.regexp_extract("catchline", r"^([A-Za-z]+)", 1)), F.lit("")).alias("term_norm"), D.scope_key(scope, *place).alias("scope_key"), F.col("section").alias("seq")).where("scope_key is not null")
    return D.resolve(x, defs).groupBy("section").agg(F.count_if("controls").alias("controls"), F.count_if(~F.col("controls")).alias("shadowed"), F.min(F.when(F.col("controls"), F.col("seq"))).alias("first"))


def definition_listing(spark, d):
    """Terms that several documents define, with their definitions in order: the narrowest scope first, then by document."""
    defs = _defined(spark, d)[1]
    many = defs.groupBy("term_norm").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rank = F.array_position(F.array(*[F.lit(k) for k in D.SCOPES]), F.col("scope"))
    w = Window.partitionBy("term_norm").orderBy(rank, "section")
    return defs.join(many, "term_norm").select("term_norm", F.row_number().over(w).alias("pos"), "section")


def html_text(spark, d):
    """Documents wrapped in markup, with their marks as entities, as text again: a fingerprint of each."""
    mark = lambda c, a, b: F.replace(c, F.lit(a), F.lit(b))
    body = mark(mark(mark(mark(F.col("text"), "&", "&amp;"), "<", "&lt;"), "§", "&sect;"), "’", "&#8217;")
    page = F.concat(F.lit("<html><style>p{a:'</p>'}</style><script>x<y</script><body><p>"), body, F.lit("</p><td>a</td>b<br/>c</body></html>"))
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.md5(X.strip_html(page)).alias("print"))


def duplicate_texts(spark, d):
    """Documents with a text seen before: the first one of each text is kept. Copies meet in a partial aggregate alone."""
    x = table(spark, d, "documents").where("text is not null").select("doc_id", F.md5("text").alias("m"))
    first = x.groupBy("m").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("m", "first")
    return x.join(first, "m").where("doc_id <> first").select("doc_id")


def page_tag_counts(spark, d):
    s = table(spark, d, "sections").groupBy("id").agg(F.max("unit_path").alias("path"), F.max("chapter").alias("chapter"), F.max("repealed").alias("repealed"))
    return s.select(F.explode(X.page_tags(F.col("path"), F.col("chapter"), F.col("repealed") == 1)).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def acts_on_sections(spark, d):
    """Which acts touched a section, by its citations of session laws."""
    e = table(spark, d, "edge").where("kind = 'session_law' and target is not null and src is not null")
    return e.groupBy(I.proper_section(F.col("src")).alias("section_id")).agg(F.count_distinct("target").alias("acts"), F.max(F.regexp_extract("target", r"^slh:(\d+):", 1)).alias("last_year"))


def cases_on_sections(spark, d):
    """What was held about a section: its reported cases."""
    e = table(spark, d, "edge").where("kind = 'case' and target is not null and src is not null")
    return e.groupBy(I.proper_section(F.col("src")).alias("section_id")).agg(F.count_distinct("target").alias("cases"), F.min("target").alias("first_case"))


def citers_by_kind(spark, d):
    """Sources per kind and zone of citation, with the totals of each kind."""
    e = table(spark, d, "edge").select("kind", "zone", "src")
    return e.groupBy("kind").agg(F.count(F.lit(1)).alias("citations"), F.count_distinct("src").alias("sources"), F.count_if(F.col("zone") == "operative").alias("operative"), F.count_if(F.col("zone").isNull()).alias("no_zone"))


_DEF = "regexp_extract_all(text, '(?i)\\bin\\s+this\\s+chapter,\\s+the\\s+([a-z][a-z \\-]{2,60}?)\\s+(?:means)\\b', 1)"
_FLAT = "trim(regexp_replace({c}, '[\\s\\p{{Z}}]+', ' ', 'g'))"
_PDATE = "TRY_CAST(lpad(CAST(CASE WHEN y >= 100 THEN y WHEN y <= 30 THEN y + 2000 ELSE y + 1900 END AS VARCHAR), 4, '0') || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-' || lpad(CAST(dd AS VARCHAR), 2, '0') AS DATE)"
_PARTS = "TRY_CAST(string_split({c}, '/')[1] AS INT) AS m, TRY_CAST(string_split({c}, '/')[2] AS INT) AS dd, TRY_CAST(string_split({c}, '/')[3] AS INT) AS y"
SQL = {
    "text_forms": f"""SELECT id, {_FLAT.format(c="title")} AS flat, translate(title, '‐‑‒–—―−', '-------') AS dashes, replace(translate(title, '‐‑‒–—―−', '-------'), chr(173), '') AS no_soft,
 round(CASE WHEN title IS NULL THEN NULL WHEN length(regexp_replace(title, '[^\\p{{L}}]', '', 'g')) = 0 THEN 0.0 ELSE length(regexp_replace(title, '[^\\p{{Lu}}]', '', 'g')) / length(regexp_replace(title, '[^\\p{{L}}]', '', 'g')) END, 4) AS caps,
 lower(layer) || '-' || lower(regexp_replace(num, '[^0-9A-Za-z.\\-]', '-', 'g')) AS slug, regexp_replace(title, '[^A-Za-z0-9]', '', 'g') AS letters FROM (SELECT DISTINCT * FROM units)""",
    "effective_dates": f"WITH z AS (SELECT DISTINCT section_id, body FROM zones WHERE zone = 'source_note' AND body IS NOT NULL), l AS (SELECT section_id, regexp_extract_all(body, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2,4}}')[-1] AS x FROM z), p AS (SELECT section_id, {_PARTS.format(c='x')} FROM l) SELECT section_id, {_PDATE} AS effective FROM p",
    "printed_dates": f"WITH p AS (SELECT DISTINCT id, effective AS x, {_PARTS.format(c='effective')} FROM sections) SELECT DISTINCT id, {_PDATE} AS effective FROM p",
    "repealed_flags": "WITH z AS (SELECT DISTINCT section_id, body FROM zones WHERE zone = 'operative'), s AS (SELECT DISTINCT id, catchline FROM sections) SELECT coalesce(regexp_matches(catchline, '(?i)^\\s*\\(?(repealed|reserved)\\b'), false) OR coalesce(contains(substr(body, 1, 180), 'REPEALED'), false) AS repealed, count(DISTINCT id) AS n FROM s LEFT JOIN z ON z.section_id = s.id GROUP BY 1",
    "display_names": """SELECT DISTINCT kind, target, CASE kind WHEN 'hrs_section' THEN 'HRS §' || regexp_replace(target, '^hrs:', '') WHEN 'har_section' THEN 'HAR §' || regexp_replace(target, '^har:', '')
 WHEN 'hrs_chapter' THEN 'HRS chapter ' || regexp_replace(target, '^(hrs:)?ch:', '') WHEN 'usc' THEN regexp_replace(target, '^usc:([0-9]+):(.*)$', '\\1 U.S.C. §\\2', 's') WHEN 'cfr' THEN regexp_replace(target, '^cfr:([0-9]+):(.*)$', '\\1 C.F.R. §\\2', 's')
 WHEN 'session_law' THEN regexp_replace(target, '^slh:([0-9]+):([0-9]+).*$', 'Act \\2, Session Laws \\1', 's') WHEN 'hi_const' THEN regexp_replace(target, '^hiconst:([IVXL]+):(.*)$', 'Haw. Const. art. \\1, §\\2', 's') ELSE target END AS name FROM edge WHERE target IS NOT NULL""",
    "page_tag_counts": "WITH s AS (SELECT id, max(unit_path) AS path, max(chapter) AS chapter, max(repealed) AS repealed FROM sections GROUP BY id), t AS (SELECT 'chapter/' || chapter AS tag FROM s UNION ALL SELECT 'part/' || lower(regexp_extract(path, '(?i)part\\s+([IVXLC]+)', 1)) FROM s WHERE path <> '' UNION ALL SELECT 'repealed' FROM s WHERE repealed = 1) SELECT tag, count(*) AS n FROM t GROUP BY tag",
    "acts_on_sections": f"WITH n AS (SELECT *, {NUM.format(c='src')} AS num FROM edge WHERE kind = 'session_law' AND target IS NOT NULL AND src IS NOT NULL) SELECT {LAYER.format(c='src', n='num')} || ':' || num AS section_id, count(DISTINCT target) AS acts, max(regexp_extract(target, '^slh:([0-9]+):', 1)) AS last_year FROM n GROUP BY 1",
    "cases_on_sections": f"WITH n AS (SELECT *, {NUM.format(c='src')} AS num FROM edge WHERE kind = 'case' AND target IS NOT NULL AND src IS NOT NULL) SELECT {LAYER.format(c='src', n='num')} || ':' || num AS section_id, count(DISTINCT target) AS cases, min(target) AS first_case FROM n GROUP BY 1",
    "citers_by_kind": "SELECT kind, count(*) AS citations, count(DISTINCT src) AS sources, count(*) FILTER (zone = 'operative') AS operative, count(*) FILTER (zone IS NULL) AS no_zone FROM edge GROUP BY kind",
    "key_kinds": """WITH k AS (SELECT trim(regexp_replace(raw, '^(?i)(HRS|HAR|§|section|sec\\.|[ \\t\\n\\r\\f\\v])+', ''), ' ') AS k FROM edge), v AS (SELECT k, trim(regexp_replace(k, '\\[R\\]', '', 'g'), ' ') AS v FROM k),
 b AS (SELECT k, v, upper(regexp_replace(v, '\\(.*$', '')) AS b FROM v), n AS (SELECT k, v, CASE WHEN regexp_matches(b, '^[0-9]{1,3}[A-Z][0-9]+(\\.[0-9]+)?$') THEN regexp_replace(b, '^([0-9]{1,3}[A-Z])([0-9])', '\\1-\\2') ELSE b END AS n FROM b)
 SELECT CASE WHEN k IS NULL OR k = '' THEN 'skip' WHEN regexp_matches(v, '(?i)^(ch\\.?|chapter)\\s+([0-9]+[A-Z]?),?\\s+(pt\\.?|part)\\s+([IVXL]+)$') THEN 'hrs_chapter_part' WHEN regexp_matches(v, '(?i)^(ch\\.?|chapter)\\s+([0-9]+[A-Z]?)$') THEN 'hrs_chapter'
 WHEN regexp_matches(v, '(?i)^[0-9]+\\s+U\\.?S\\.?C\\.?\\s*§*\\s*[0-9]') THEN 'usc' WHEN regexp_matches(n, '^[0-9]+[A-Z]?:[0-9]+[A-Z]?-[0-9]+(\\.[0-9]+)?$') THEN 'hrs_section_colon' WHEN regexp_matches(n, '^[0-9]+[A-Z]?-[0-9]+(\\.[0-9]+)?$') THEN 'hrs_section'
 WHEN regexp_matches(n, '^[0-9]+-[0-9]+[A-Z]?-[0-9]+(\\.[0-9]+)?$') THEN 'har_section' ELSE 'prose' END AS kind, count(*) AS n FROM n GROUP BY 1""",
    "name_spaces": "SELECT kind, CASE kind WHEN 'hrs_section' THEN 'hrs' WHEN 'har_section' THEN 'har' WHEN 'hrs_chapter' THEN 'hrs:ch' ELSE regexp_extract(regexp_replace(target, '[\\p{Cf}\\p{Z}\\s§]+', '', 'g'), '^([a-z]+(:ch)?):', 1) END AS space, count(*) AS n FROM edge WHERE target IS NOT NULL GROUP BY 1, 2",
    "pin_cites": "SELECT edge_id, regexp_extract(raw, '(\\(.*\\))\\s*$', 1) AS pin FROM edge WHERE kind IN ('hrs_section', 'har_section') AND regexp_extract(raw, '(\\(.*\\))\\s*$', 1) <> ''",
    "citations": "WITH z AS (SELECT DISTINCT section_id, translate(body, '‐‑‒–—―−', '-------') AS body FROM zones WHERE zone = 'operative'), t AS (SELECT section_id, unnest(regexp_extract_all(body, '(?i)(?:\\bsections?\\s+|§)(\\p{Nd}+[A-Z]?-\\p{Nd}+(?:\\.\\p{Nd}+)?)', 1)) AS t FROM z) SELECT upper(t) AS target, count(*) AS n, count(DISTINCT section_id) AS sections FROM t GROUP BY 1",
    "citation_kinds": """WITH t AS (SELECT translate(text, '‐‑‒–—―−', '-------') AS t, text FROM documents),
 c AS (SELECT 'hrs_section' AS kind, sum(len(regexp_extract_all(t, '(?i)(?:\\bsections?[\\s\\p{Z}]+|§[\\s\\p{Z}]*)(?:\\p{Nd}{3}[A-Z]?:)?(\\p{Nd}+[A-Z]?-\\p{Nd}+(?:\\.\\p{Nd}+)?)'))) AS n FROM t UNION ALL SELECT 'case', sum(len(regexp_extract_all(text, '\\b[0-9]{1,4}\\s+H\\.\\s+[0-9]{1,5}'))) FROM t)
 SELECT kind, CAST(n AS BIGINT) AS n FROM c WHERE n > 0""",
    "raw_citations": """WITH t AS (SELECT translate(raw, '‐‑‒–—―−', '-------') AS t FROM edge WHERE kind IN ('hrs_chapter', 'usc', 'cfr')),
 c AS (SELECT 'hrs_chapter' AS kind, 'ch:' || upper(regexp_extract(t, '(?i)\\bchapters?\\s+([0-9]+[A-Z]?)\\b', 1)) AS target FROM t WHERE regexp_matches(t, '(?i)\\bchapters?\\s+[0-9]+[A-Z]?\\b')
 UNION ALL SELECT CASE WHEN regexp_matches(t, 'U\\.S') THEN 'usc' ELSE 'cfr' END, CASE WHEN regexp_matches(t, 'U\\.S') THEN 'usc:' ELSE 'cfr:' END || regexp_extract(t, '([0-9]+)\\s+[UC]\\.[SF]\\.[CR]\\.\\s*(§+|parts?|sections?)?\\s*([0-9][\\w-]*)', 1) || ':' || regexp_extract(t, '([0-9]+)\\s+[UC]\\.[SF]\\.[CR]\\.\\s*(§+|parts?|sections?)?\\s*([0-9][\\w-]*)', 3) FROM t WHERE regexp_matches(t, '[0-9]+\\s+[UC]\\.[SF]\\.[CR]\\.'))
 SELECT kind, target, count(*) AS n FROM c GROUP BY 1, 2""",
    "rule_citations": "WITH t AS (SELECT edge_id, unnest(regexp_extract_all(translate(raw, '‐‑‒–—―−', '-------'), '\\b[0-9]+-[0-9]+[A-Z]?-[0-9]+(?:\\.[0-9]+)?\\b')) AS target FROM edge WHERE kind = 'har_section') SELECT target, count(*) AS n, count(DISTINCT edge_id) AS edges FROM t GROUP BY target",
    "opinion_citations": "WITH t AS (SELECT 'har_section' AS kind, 'har:' || unnest(regexp_extract_all(translate(raw, '‐‑‒–—―−', '-------'), '\\b[0-9]+-[0-9]+[A-Z]?-[0-9]+(?:\\.[0-9]+)?\\b')) AS target FROM edge WHERE kind = 'har_section' UNION ALL SELECT 'har_chapter', 'har:ch:3-160' FROM edge WHERE kind = 'har_section' AND raw IS NOT NULL) SELECT kind, target, count(*) AS n FROM t GROUP BY 1, 2",
    "authority_notes": """WITH z AS (SELECT DISTINCT section_id, zone, translate(body, '‐‑‒–—―−', '-------') AS t FROM zones WHERE zone IN ('auth', 'imp')),
 p AS (SELECT '(?i)[0-9]+\\s+U\\.?\\s?S\\.?\\s?C\\.?\\s*§*\\s*[0-9][\\w-]*|[0-9]+\\s+C\\.?\\s?F\\.?\\s?R\\.?\\s*(?:part|§)*\\s*[0-9][\\w-]*|P(?:ub)?\\.\\s?L\\.\\s*(?:No\\.\\s*)?[0-9]+-[0-9]+|\\b[0-9]+-[0-9]+[A-Z]?-[0-9]+(?:\\.[0-9]+)?|[0-9]{3}[A-Z]?:[0-9]+[A-Z]?-[0-9]+(?:\\.[0-9]+)?|[0-9]+[A-Z]?-[0-9]+(?:\\.[0-9]+)?|(?:chapters?|ch\\.)\\s*[0-9]+[A-Z]?' AS p),
 u AS (SELECT zone, unnest(regexp_extract_all(t, p)) AS v FROM z, p),
 k AS (SELECT zone, CASE WHEN regexp_matches(v, '(?i)U\\.?\\s?S') THEN 'usc' WHEN regexp_matches(v, '(?i)C\\.?\\s?F') THEN 'cfr' WHEN regexp_matches(v, '(?i)^P') THEN 'public_law' WHEN regexp_matches(v, '(?i)^[0-9]+-[0-9]+[A-Z]?-[0-9]') THEN 'har_section' WHEN regexp_matches(v, '(?i)^ch') THEN 'hrs_chapter' ELSE 'hrs_section' END AS kind, upper(v) AS target FROM u
 UNION ALL SELECT zone, 'leftover', NULL FROM z, p WHERE regexp_matches(regexp_replace(regexp_replace(t, p, ' ', 'g'), '\\([a-z0-9]{1,4}\\)', '', 'g'), '[0-9]'))
 SELECT zone, kind, count(*) AS n, count(DISTINCT target) AS targets FROM k GROUP BY 1, 2""",
    "case_paragraphs": """WITH z AS (SELECT DISTINCT section_id FROM zones WHERE zone = 'annotation' AND body IS NOT NULL), n AS (SELECT section_id, count(DISTINCT body) AS n FROM zones WHERE zone = 'annotation' AND body IS NOT NULL GROUP BY 1)
 SELECT section_id, v.target, v.raw, v.context FROM n, generate_series(1, n) g, (VALUES ('case:12-H-34', '12 H. 34, 56 P.3d 78 (2001)', 'Held in 12 H. 34, 56 P.3d 78 (2001).'), ('case:9-LEd2d-7', '9 L. Ed. 2d 7', '9 L. Ed. 2d 7')) v(target, raw, context)""",
    "healed_notes": "SELECT DISTINCT section_id, '(Auth: HRS §' || body || ')' AS note, 1 AS repairs FROM zones WHERE zone = 'auth' AND regexp_matches(body, '^[0-9]*1[0-9]*-[0-9]+$')",
    "case_runs": "SELECT edge_id, 'case:' || regexp_extract(raw, '([0-9]+) H\\. ([0-9]+)', 1) || '-H-' || regexp_extract(raw, '([0-9]+) H\\. ([0-9]+)', 2) AS target FROM edge WHERE kind = 'case' AND regexp_matches(raw, '[0-9]+ H\\. [0-9]+')",
    "citation_sweep": f"""WITH {GRAPH}, z AS (SELECT DISTINCT section_id, translate(body, '‐‑‒–—―−', '-------') AS body FROM zones WHERE zone = 'operative'), t AS (SELECT DISTINCT section_id, 'section ' || unnest(regexp_extract_all(body, '(?:^|[^A-Za-z])(?i:section)\\s+([0-9]+[A-Z]?-[0-9]+(?:\\.[0-9]+)?)', 1)) AS target FROM z)
 SELECT section_id, target FROM t WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.src = t.section_id AND 'section ' || regexp_extract(g.dst, '^hrs:(.*)$', 1) = t.target)""",
    "definition_scopes": f"WITH t AS (SELECT DISTINCT doc_id, lower(unnest({_DEF})) AS term FROM documents) SELECT 'chapter' AS scope, count(*) AS n, count(DISTINCT term) AS terms FROM t",
    "definition_listing": f"WITH t AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS section, lower(unnest({_DEF})) AS term_norm FROM documents) SELECT term_norm, row_number() OVER (PARTITION BY term_norm ORDER BY section) AS pos, section FROM t QUALIFY count(*) OVER (PARTITION BY term_norm) > 1",
    "definition_levels": """WITH s AS (SELECT id, max(layer) AS layer, max(chapter) AS num, max(unit_path) AS path, max(catchline) AS catchline FROM sections GROUP BY id), u AS (SELECT layer, num, max(parent) AS title FROM units WHERE kind = 'chapter' GROUP BY 1, 2),
 x AS (SELECT s.id, s.layer || ':' || s.num AS chapter, nullif(regexp_extract(path, '^(Part [IVXL]+)', 1), '') AS part, nullif(regexp_extract(path, '› ([A-Z]\\. .*)$', 1), '') AS sub, title, nullif(lower(regexp_extract(catchline, '^([A-Za-z]+)', 1)), '') AS term, length(s.id) % 5 AS level FROM s LEFT JOIN u ON u.layer = s.layer AND u.num = s.num),
 k AS (SELECT *, 'sec:' || id AS k0, 'ch:' || chapter || ':' || part || ':' || sub AS k1, 'ch:' || chapter || ':' || part AS k2, 'ch:' || chapter AS k3, 'title:' || title AS k4 FROM x),
 d AS (SELECT id AS seq, term, CASE level WHEN 0 THEN k0 WHEN 1 THEN k1 WHEN 2 THEN k2 WHEN 3 THEN k3 ELSE k4 END AS key FROM k WHERE term IS NOT NULL),
 c AS (SELECT id, 0 AS depth, k0 AS key FROM k UNION ALL SELECT id, 1, k1 FROM k UNION ALL SELECT id, 2, k2 FROM k UNION ALL SELECT id, 3, k3 FROM k UNION ALL SELECT id, 4, k4 FROM k),
 r AS (SELECT c.id, d.seq, row_number() OVER (PARTITION BY c.id, d.term ORDER BY c.depth, d.seq) AS r FROM c JOIN d ON d.key = c.key)
 SELECT id AS section, count(*) FILTER (r = 1) AS controls, count(*) FILTER (r > 1) AS shadowed, min(seq) FILTER (r = 1) AS first FROM r GROUP BY id""",
    "definition_collisions": f"WITH t AS (SELECT DISTINCT doc_id, unit_id, unnest({_DEF}) AS term FROM documents) SELECT lower(term) AS term_norm, count(DISTINCT 'ch:' || coalesce(unit_id, '')) AS scopes FROM t GROUP BY 1 HAVING count(DISTINCT 'ch:' || coalesce(unit_id, '')) > 1",
    "definition_at": f"""WITH t AS (SELECT DISTINCT doc_id, coalesce(unit_id, '') AS unit, lower(unnest({_DEF})) AS term FROM documents), p AS (SELECT DISTINCT unit_id FROM documents WHERE unit_id <> ''),
 j AS (SELECT t.term, row_number() OVER (PARTITION BY p.unit_id, t.term ORDER BY t.doc_id) AS r FROM p JOIN t ON t.unit = p.unit_id)
 SELECT term AS term_norm, count(*) FILTER (r = 1) AS places, count(*) FILTER (r > 1) AS shadowed FROM j GROUP BY term""",
    "html_text": """WITH a AS (SELECT doc_id, regexp_replace(translate(text || chr(10) || 'a b' || chr(10) || 'c', chr(160) || chr(65279), ' '), '[ \\t]+', ' ', 'g') AS t FROM documents WHERE text IS NOT NULL)
 SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(t, '(?m)^ +| +$', '', 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), '^[ \\t\\n\\v\\f\\r]+|[ \\t\\n\\v\\f\\r]+$', '', 'g')) AS print FROM a""",
    "duplicate_texts": "SELECT doc_id FROM documents WHERE text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1",
}
QUERIES = {k: globals()[k] for k in SQL}
SQL = {k: v for k, v in SQL.items() if v}
