"""Joins, aggregates, orderings and set operations as queries."""

from __future__ import annotations

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from lexloom.functions import ids as I
from lexloom.functions import text as X
from lexloom.operators import graph as G
from lexloom.operators import relations as R
from lexloom.plans.graph import section_edges
from lexloom.plans.sqlparts import GRAPH, LAYER, NUM
from lexloom.sources.tables import table


def _attested(spark: SparkSession, d: str, a: str):
    e = table(spark, d, "edges").where(F.col("attestation") == a)
    return e.select("id", I.proper_section(F.col("src")).alias("src"), I.proper_target(F.col("dst")).alias("dst"), "relation", "dst_kind")


def attested_sets(spark, d):
    return R.compare_sets(_attested(spark, d, "rule_text"), _attested(spark, d, "lrb2025"), "src", "dst")


def attested_pairs(spark, d):
    return R.compare_pairs(_attested(spark, d, "rule_text"), _attested(spark, d, "lrb2025"), ["src", "dst"], "relation", "id").groupBy("finding").agg(F.count(F.lit(1)).alias("n"))


def join_rate(spark, d):
    """Per attestation how many targets the corpus holds."""
    have = table(spark, d, "sections").select("id").distinct().withColumn("known", F.lit(1))
    e = table(spark, d, "edges").select("attestation", I.proper_target(F.col("dst")).alias("id"))
    return e.join(have, "id", "left").groupBy("attestation").agg(F.count(F.lit(1)).alias("edges"), F.count("known").alias("joined"), F.round(F.count("known") * 100 / F.count(F.lit(1)), 1).alias("pct"))


def coverage(spark, d):
    u = table(spark, d, "units").distinct()
    n = table(spark, d, "sections").groupBy("layer").agg(F.count_distinct("chapter").alias("chapters_read"))
    c = u.groupBy("layer", "kind").agg(F.count(F.lit(1)).alias("units"), F.count_if(F.expr("repealed = 1")).alias("repealed"), F.count_if(F.expr("reserved = 1")).alias("reserved"))
    return c.join(n, "layer", "left").select("layer", "kind", "units", "repealed", "reserved", F.coalesce("chapters_read", F.lit(0)).alias("chapters_read"))


def coverage_by_kind(spark, d):
    """Chapters read counted per kind of unit, for chapters alone."""
    u = table(spark, d, "units").where("kind = 'chapter'").select("layer", F.col("num").alias("chapter")).distinct()
    s = table(spark, d, "sections").select("layer", "chapter").distinct().withColumn("read", F.lit(1))
    return u.join(s, ["layer", "chapter"], "left").groupBy("layer").agg(F.count(F.lit(1)).alias("chapters"), F.count("read").alias("read"))


def zone_totals(spark, d):
    z = table(spark, d, "zones").distinct()
    return z.groupBy("zone").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("body").isNull() | (F.col("body") == "")).alias("empty"), F.sum(F.length("body")).alias("chars"), F.count_distinct("section_id").alias("sections"))


def size_histogram(spark, d):
    b = F.length("body")
    bucket = F.when(b < 100, "1: under 100").when(b < 250, "2: 100 to 249").when(b < 500, "3: 250 to 499").when(b < 1000, "4: 500 to 999").when(b < 2000, "5: 1000 to 1999").when(b < 5000, "6: 2000 to 4999").otherwise("7: 5000 and more")
    return table(spark, d, "zones").distinct().where("body is not null").groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.sum(b).alias("chars"))


def largest_sections(spark, d):
    return table(spark, d, "zones").distinct().groupBy("section_id").agg(F.sum(F.length("body")).alias("chars")).where("chars is not null").orderBy(F.desc("chars"), "section_id").limit(12)


def upper_medians(spark, d):
    z = table(spark, d, "zones").distinct().select("zone", F.length("body").alias("chars"))
    return G.upper_median(z, ["zone"], "chars")


def projected_size(spark, d):
    """Characters per layer projected to all its chapters: the measured ones plus the upper median for each unread one."""
    z = table(spark, d, "zones").distinct().join(table(spark, d, "sections").select(F.col("id").alias("section_id"), "layer", "chapter").distinct(), "section_id")
    per = z.groupBy("layer", "chapter").agg(F.sum(F.coalesce(F.length("body"), F.lit(0))).alias("chars"))
    m = G.upper_median(per, ["layer"], "chars").join(per.groupBy("layer").agg(F.sum("chars").alias("measured")), "layer")
    total = table(spark, d, "units").where("kind = 'chapter'").select("layer", "num").distinct().groupBy("layer").agg(F.count(F.lit(1)).alias("chapters"))
    return m.join(total, "layer").select("layer", "chapters", "n", "measured", (F.col("measured") + F.col("median") * F.greatest(F.col("chapters") - F.col("n"), F.lit(0))).alias("projected"))


def acts_and_statutes(spark, d):
    e = table(spark, d, "edge").where("kind = 'session_law' and target is not null and src is not null")
    return e.agg(F.count_distinct("target").alias("acts"), F.count_distinct("src").alias("sections"), F.count(F.lit(1)).alias("edges"))


def act_history(spark, d):
    """Acts cited in edges beside acts in history notes, per section and act: both, edge_only, history_only."""
    e = table(spark, d, "edge").where("kind = 'session_law'").select(I.proper_section(F.col("src")).alias("section_id"), F.regexp_extract("target", r"^slh:(\d+):(\d+)", 1).alias("year"), F.regexp_extract("target", r"^slh:(\d+):(\d+)", 2).alias("act")).where("section_id is not null and year <> ''").distinct()
    z = table(spark, d, "zones").where("zone = 'history'").select("section_id", F.explode(F.regexp_extract_all("body", F.lit(r"L \d{4}, c \d+"), F.lit(0))).alias("l"))
    z = z.select("section_id", F.regexp_extract("l", r"L (\d{4}), c (\d+)", 1).alias("year"), F.regexp_extract("l", r"L (\d{4}), c (\d+)", 2).alias("act")).distinct()
    k = ["section_id", "year", "act"]
    j = e.withColumn("a", F.lit(1)).join(z.withColumn("b", F.lit(1)), k, "full")
    return j.groupBy(F.when(F.col("b").isNull(), "edge_only").when(F.col("a").isNull(), "history_only").otherwise("both").alias("found_in")).agg(F.count(F.lit(1)).alias("n"))


def act_join(spark, d):
    """Inner join on a key and an expression: documents and their unit, where a document without a unit meets the empty id."""
    docs = table(spark, d, "documents").select("doc_id", F.coalesce("unit_id", F.lit("")).alias("unit"))
    u = table(spark, d, "units").select("id", "layer", "kind").distinct().select(F.coalesce("id", F.lit("")).alias("unit"), "layer", "kind")
    return docs.join(u, "unit").groupBy("layer", "kind").agg(F.count(F.lit(1)).alias("documents"))


def dedup_edges(spark, d):
    """Per (src, dst, relation, attestation) the first edge."""
    w = Window.partitionBy("src", "dst", "relation", "attestation").orderBy("id")
    return table(spark, d, "edges").withColumn("r", F.row_number().over(w)).where("r = 1").select("id", "src", "dst", "relation", "attestation")


def keep_longest(spark, d):
    """Per unit and kind of document the longest text; ties take the least id."""
    x = table(spark, d, "documents").where("text is not null").select("unit_id", "doc_kind", "doc_id", F.length("text").alias("chars"))
    return G.keep_one(x, ["unit_id", "doc_kind"], [F.desc("chars"), "doc_id"])


def contested(spark, d):
    """Sections that came more than once: every row, numbered, with the number of rows."""
    s = table(spark, d, "sections").select("id", "catchline", "loaded_at").distinct()
    w = Window.partitionBy("id")
    return s.withColumn("n", F.count(F.lit(1)).over(w)).withColumn("listing", F.row_number().over(w.orderBy("loaded_at", F.col("catchline").asc_nulls_first())) - 1).where("n > 1")


def listings(spark, d):
    """All loadings of a section as one nested list, for those with several."""
    s = table(spark, d, "sections").select("id", "loaded_at", "deleted_at").distinct()
    return s.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("loaded_at", "deleted_at"))), lambda x: F.date_format(x["loaded_at"], "yyyy-MM-dd")), ",").alias("loaded")).where("n > 1")


def trusted_title(spark, d):
    """One title per unit: the url that isn't null first, then the least title; units whose titles disagree are marked."""
    u = table(spark, d, "units").select("id", "title", "url").distinct()
    w = Window.partitionBy("id")
    u = u.withColumn("lo", F.min("title").over(w)).withColumn("hi", F.max("title").over(w)).withColumn("seq", F.coalesce("title", F.lit("~")))
    best = R.by_precedence(u, ["id"], F.col("url").isNull().cast("int"), "seq")
    return best.select("id", "title", (~F.col("lo").eqNullSafe(F.col("hi"))).alias("disagree"))


def natural_order(spark, d):
    """Sections of each statute chapter in natural order of their numbers."""
    s = table(spark, d, "sections").where("layer = 'hrs'").select("num", "chapter").distinct()
    w = Window.partitionBy("chapter").orderBy(I.statute_key(F.col("num")))
    return s.select("chapter", "num", F.row_number().over(w).alias("pos"))


def rule_order(spark, d):
    s = table(spark, d, "sections").where("layer = 'har'").select("num", "chapter").distinct()
    w = Window.partitionBy("chapter").orderBy(I.rule_key(F.col("num")))
    return s.select("chapter", "num", F.row_number().over(w).alias("pos"))


def part_fill(spark, d):
    """Part and subpart carried forward over the sections of a statute chapter; a new part resets the subpart."""
    s = table(spark, d, "sections").where("layer = 'hrs'").groupBy("chapter", "num").agg(F.max("unit_path").alias("path"))
    part = F.nullif(F.regexp_extract("path", r"^(Part [IVXL]+)", 1), F.lit(""))
    sub = F.nullif(F.regexp_extract("path", r"› ([A-Z]\. .*)$", 1), F.lit(""))
    x = s.select("chapter", "num", part.alias("part"), sub.alias("subpart"))
    f = G.forward_fill(x, ["chapter"], [I.statute_key(F.col("num"))], "part", "subpart")
    return f.select("chapter", "num", "part_filled", "subpart_filled")


def sessions(spark, d):
    """Islands in the events of a user: a gap of over an hour begins a new one."""
    e = table(spark, d, "events").select("event_id", "user_id", "ts")
    w = ["ts", "event_id"]
    x = G.islands(e, ["user_id"], w, F.col("ts") > F.col("prev") + F.expr("INTERVAL 1 HOUR"))
    return x.groupBy("user_id", "island").agg(F.count(F.lit(1)).alias("events"), F.min("event_id").alias("first_event"))


def last_error(spark, d):
    """As-of join: each event with the last error event of its user before it."""
    e = table(spark, d, "events").select("event_id", "user_id", "ts")
    r = table(spark, d, "events").where("event_type = 'error'").select("user_id", "ts", F.col("event_id").alias("error_id"))
    return G.as_of(e, r, ["user_id"], "ts", "error_id", inclusive=False).select("event_id", "error_id_as_of")


def last_signup(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts")
    r = table(spark, d, "events").where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("purchase_id"))
    return G.as_of(e, r, ["user_id"], "ts", "purchase_id").select("event_id", "purchase_id_as_of")


def toc_split(spark, d):
    """The cut of each user's events into two halves with nearly the same kinds of events by hour."""
    e = table(spark, d, "events").select("user_id", "event_id", F.concat_ws(":", "event_type", F.hour("ts")).alias("item"))
    return G.best_split(e, ["user_id"], "event_id", "item")


def list_members(spark, d):
    """Targets of each rule as a compressed list, expanded again."""
    return R.expand_lists(table(spark, d, "edge").where("kind = 'har_section'"), "edge_id", "raw")


def range_repeals(spark, d):
    """Catchlines of ranges repealed as a whole, planted on the repealed statutes (`to 12 REPEALED.` at 7-9): the catchline in full and the numbers covered that have no section of their own."""
    s = table(spark, d, "sections").where("layer = 'hrs'").select("num", "repealed").distinct().withColumn("n", F.regexp_extract("num", r"-(\d+)$", 1).try_cast("int")).where("n is not null")
    r = s.where("repealed = 1").select("num", "n", F.concat(F.lit("to "), (F.col("n") + 3).cast("string"), F.lit(" REPEALED.")).alias("catchline"))
    r = r.select("num", X.repealed_range(F.col("catchline"), F.col("num")).alias("catchline"))
    return R.covered(r, "num", "catchline").join(s.select(F.col("num").alias("member")), "member", "left_anti").select("num", "catchline", "member")


def crosswalk_totals(spark, d):
    """Per attestation its edges, and the different sources, targets and acts."""
    e = table(spark, d, "edges")
    return e.groupBy("attestation").agg(F.count(F.lit(1)).alias("edges"), F.count_distinct("src").alias("sources"), F.count_distinct("dst").alias("targets"), F.count_distinct(F.when((F.col("dst_kind") == "session_law") | F.col("dst").startswith("slh:"), F.col("dst"))).alias("acts"))


def subpart_sizes(spark, d):
    """Sections by part and subpart, of the parts whose name begins alike."""
    return table(spark, d, "sections").where(F.col("unit_path").like("Part I%")).groupBy("unit_path").agg(F.count_distinct("id").alias("sections"))


def find_words(spark, d):
    return R.search(table(spark, d, "zones"), ["section_id", "zone"], "body", "reasonable pasture")


def token_counts(spark, d):
    t = R.token_index(table(spark, d, "zones").distinct(), ["section_id", "zone"], "body")
    return t.groupBy("token").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n")).where("texts > 20")


def short_documents(spark, d):
    """Documents of sources of which over 30 % are short are set aside; counts per source and flag add up to the input."""
    x = table(spark, d, "documents").select("doc_id", "source", F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    q = R.quarantine(x, ["source"], F.col("chars") < 700, 0.30, 2)
    return q.groupBy("source", "quarantined").agg(F.count(F.lit(1)).alias("n"))


def implemented_by(spark, d):
    """Statutes with the rules that implement or rest on them."""
    e = table(spark, d, "edges").where("relation in ('implements', 'authorized_by')").select(I.proper_target(F.col("dst")).alias("statute"), I.proper_section(F.col("src")).alias("rule"), "relation")
    return e.groupBy("statute").agg(F.count_distinct(F.when(F.col("relation") == "implements", F.col("rule"))).alias("implementing"), F.count_distinct(F.when(F.col("relation") == "authorized_by", F.col("rule"))).alias("authorized"))


def double_amendments(spark, d):
    """Sections amended by several acts of one year, by their history notes and by the acts that they cite."""
    z = table(spark, d, "zones").where("zone = 'history'").select("section_id", F.explode(F.regexp_extract_all("body", F.lit(r"L \d{4}, c \d+"), F.lit(0))).alias("l"))
    z = z.select("section_id", F.substring("l", 3, 4).alias("year"), F.regexp_extract("l", r"c (\d+)", 1).alias("act"))
    law = r"^slh:(\d{4}):(\d+)"
    e = table(spark, d, "edge").where("kind = 'session_law' and src is not null").where(F.col("target").rlike(law))
    e = e.select(I.proper_section(F.col("src")).alias("section_id"), F.regexp_extract("target", law, 1).alias("year"), F.regexp_extract("target", law, 2).alias("act"))
    return z.unionByName(e).distinct().groupBy("section_id", "year").agg(F.count(F.lit(1)).alias("acts")).where("acts > 1")


def repealed_targets(spark, d):
    """Live citations of sections that are repealed."""
    s = table(spark, d, "sections").groupBy("id").agg(F.max("repealed").alias("repealed")).where("repealed = 1")
    e = section_edges(spark, d).where("zone = 'operative'").join(s.select(F.col("id").alias("dst")), "dst", "left_semi")
    return e.groupBy("dst").agg(F.count(F.lit(1)).alias("citations"), F.count_distinct("src").alias("sources"))


def unit_children(spark, d):
    """Titles and their chapters, with those that have none."""
    u = table(spark, d, "units").select("id", "kind", "parent").distinct()
    kids = u.groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("children"))
    return u.where("kind = 'title'").join(kids, "id", "left").select("id", F.coalesce("children", F.lit(0)).alias("children"))


def drift(spark, d):
    """Chapters whose printed number of sections differs from the sections held."""
    u = table(spark, d, "units").where("kind = 'chapter'").select("layer", "num", F.get_json_object("extra", "$.sections").cast("int").alias("printed")).distinct().where("printed is not null")
    s = table(spark, d, "sections").groupBy("layer", F.col("chapter").alias("num")).agg(F.count_distinct("id").alias("held"))
    return u.join(s, ["layer", "num"]).where("printed <> held").select("layer", "num", "printed", "held")


_SQL_ATT = """n AS (SELECT id, relation, dst_kind, attestation, src, dst, {sn} AS sn, {dn} AS dn, {sq} AS q FROM edges WHERE src IS NOT NULL),
e AS (SELECT id, relation, dst_kind, attestation, {sl} || ':' || sn AS src,
 CASE WHEN regexp_matches(lower(q), '^(hrs|har):?ch:') THEN regexp_extract(lower(q), '^(hrs|har)', 1) || ':ch:' || upper(regexp_replace(regexp_replace(q, '^(?i)(hrs|har):?ch:', ''), '\\(.*$', ''))
 WHEN regexp_matches(lower(q), '^usc:') THEN 'usc:' || upper(regexp_replace(substr(q, 5), '\\(.*$', ''))
 ELSE {dl} || ':' || dn END AS dst FROM n)"""


def _att() -> str:
    from lexloom.plans.p6 import _SQ
    from lexloom.plans.sqlparts import LAYER, NUM

    return _SQL_ATT.format(sn=NUM.format(c="src"), dn=NUM.format(c="dst"), sq=_SQ, sl=LAYER.format(c="src", n="sn"), dl=LAYER.format(c="dst", n="dn"))


ATT = _att()
_NUM_SRC, _LAYER_SRC = NUM.format(c="src"), LAYER.format(c="src", n="num")
_KEYNUM = "CAST(regexp_extract(num, '^([0-9]+)', 1) AS BIGINT), regexp_extract(num, '^[0-9]+([A-Za-z]*)', 1), list_transform(regexp_extract_all(regexp_replace(num, '^[0-9]+[A-Za-z]*', ''), '[0-9]+'), lambda x: CAST(x AS BIGINT))"
_SETS = "a AS (SELECT DISTINCT src, dst FROM e WHERE attestation = 'rule_text'), b AS (SELECT DISTINCT src, dst FROM e WHERE attestation = 'lrb2025')"
SQL = {
    "attested_sets": f"""WITH {ATT}, {_SETS},
 j AS (SELECT coalesce(a.src, b.src) AS src, a.src AS x, b.src AS y FROM a FULL JOIN b ON a.src = b.src AND a.dst = b.dst),
 c AS (SELECT src, count(*) FILTER (y IS NULL) AS only_left, count(*) FILTER (x IS NULL) AS only_right, count(*) FILTER (x IS NOT NULL AND y IS NOT NULL) AS shared, count(x) AS na, count(y) AS nb FROM j GROUP BY src)
 SELECT src, CASE WHEN nb = 0 THEN 'right_unread' WHEN na = 0 THEN 'left_unread' WHEN only_left = 0 AND only_right = 0 THEN 'agree' ELSE 'differ' END AS outcome, only_left, only_right, shared FROM c""",
    "attested_pairs": f"""WITH {ATT}, l AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY attestation, src, dst ORDER BY id DESC) = 1),
 j AS (SELECT a.id AS x, b.id AS y, a.relation AS r, b.relation AS s FROM (SELECT * FROM l WHERE attestation = 'rule_text') a FULL JOIN (SELECT * FROM l WHERE attestation = 'lrb2025') b ON a.src = b.src AND a.dst = b.dst)
 SELECT CASE WHEN y IS NULL THEN 'only_left' WHEN x IS NULL THEN 'only_right' WHEN r IS DISTINCT FROM s THEN 'conflict' ELSE 'equal' END AS finding, count(*) AS n FROM j GROUP BY 1""",
    "join_rate": f"WITH {ATT}, k AS (SELECT attestation, dst IN (SELECT id FROM sections) AS known FROM e) SELECT attestation, count(*) AS edges, count(*) FILTER (known) AS joined, round(count(*) FILTER (known) * 100.0 / count(*), 1) AS pct FROM k GROUP BY attestation",
    "coverage": "SELECT layer, kind, count(*) AS units, count(*) FILTER (repealed = 1) AS repealed, count(*) FILTER (reserved = 1) AS reserved, (SELECT count(DISTINCT s.chapter) FROM sections s WHERE s.layer = u.layer) AS chapters_read FROM (SELECT DISTINCT * FROM units) u GROUP BY layer, kind",
    "coverage_by_kind": "WITH u AS (SELECT DISTINCT layer, num FROM units WHERE kind = 'chapter'), s AS (SELECT DISTINCT layer, chapter FROM sections) SELECT u.layer, count(*) AS chapters, count(s.chapter) AS read FROM u LEFT JOIN s ON s.layer = u.layer AND s.chapter = u.num GROUP BY u.layer",
    "zone_totals": "SELECT zone, count(*) AS rows, count(*) FILTER (body IS NULL OR body = '') AS empty, CAST(sum(length(body)) AS BIGINT) AS chars, count(DISTINCT section_id) AS sections FROM (SELECT DISTINCT * FROM zones) GROUP BY zone",
    "size_histogram": "SELECT CASE WHEN b < 100 THEN '1: under 100' WHEN b < 250 THEN '2: 100 to 249' WHEN b < 500 THEN '3: 250 to 499' WHEN b < 1000 THEN '4: 500 to 999' WHEN b < 2000 THEN '5: 1000 to 1999' WHEN b < 5000 THEN '6: 2000 to 4999' ELSE '7: 5000 and more' END AS bucket, count(*) AS n, CAST(sum(b) AS BIGINT) AS chars FROM (SELECT length(body) AS b FROM (SELECT DISTINCT * FROM zones) WHERE body IS NOT NULL) GROUP BY 1",
    "largest_sections": "SELECT section_id, CAST(sum(length(body)) AS BIGINT) AS chars FROM (SELECT DISTINCT * FROM zones) GROUP BY section_id HAVING sum(length(body)) IS NOT NULL ORDER BY chars DESC, section_id LIMIT 12",
    "upper_medians": "SELECT zone, list_sort(list(b))[(count(*) // 2) + 1] AS median, count(*) AS n, min(b) AS least, max(b) AS greatest FROM (SELECT zone, length(body) AS b FROM (SELECT DISTINCT * FROM zones) WHERE body IS NOT NULL) GROUP BY zone",
    "projected_size": """WITH p AS (SELECT s.layer, s.chapter, CAST(sum(coalesce(length(body), 0)) AS BIGINT) AS chars FROM (SELECT DISTINCT * FROM zones) z JOIN (SELECT DISTINCT id, layer, chapter FROM sections) s ON s.id = z.section_id GROUP BY 1, 2),
 m AS (SELECT layer, list_sort(list(chars))[(count(*) // 2) + 1] AS median, count(*) AS n, CAST(sum(chars) AS BIGINT) AS measured FROM p GROUP BY layer),
 t AS (SELECT layer, count(DISTINCT num) AS chapters FROM units WHERE kind = 'chapter' GROUP BY layer)
 SELECT layer, chapters, n, measured, measured + median * greatest(chapters - n, 0) AS projected FROM m JOIN t USING (layer)""",
    "acts_and_statutes": "SELECT count(DISTINCT target) AS acts, count(DISTINCT src) AS sections, count(*) AS edges FROM edge WHERE kind = 'session_law' AND target IS NOT NULL AND src IS NOT NULL",
    "act_history": f"""WITH n AS (SELECT src, target, {_NUM_SRC} AS num FROM edge WHERE kind = 'session_law' AND src IS NOT NULL),
 e AS (SELECT DISTINCT {_LAYER_SRC} || ':' || num AS section_id, regexp_extract(target, '^slh:([0-9]+):([0-9]+)', 1) AS year, regexp_extract(target, '^slh:([0-9]+):([0-9]+)', 2) AS act FROM n WHERE target IS NOT NULL),
 h AS (SELECT section_id, unnest(regexp_extract_all(body, 'L [0-9]{{4}}, c [0-9]+')) AS l FROM zones WHERE zone = 'history'),
 z AS (SELECT DISTINCT section_id, regexp_extract(l, 'L ([0-9]{{4}}), c ([0-9]+)', 1) AS year, regexp_extract(l, 'L ([0-9]{{4}}), c ([0-9]+)', 2) AS act FROM h),
 j AS (SELECT e.section_id AS a, z.section_id AS b FROM (SELECT * FROM e WHERE year <> '') e FULL JOIN z ON e.section_id = z.section_id AND e.year = z.year AND e.act = z.act)
 SELECT CASE WHEN b IS NULL THEN 'edge_only' WHEN a IS NULL THEN 'history_only' ELSE 'both' END AS found_in, count(*) AS n FROM j GROUP BY 1""",
    "act_join": "SELECT layer, kind, count(*) AS documents FROM documents d JOIN (SELECT DISTINCT id, layer, kind FROM units) u ON coalesce(d.unit_id, '') = coalesce(u.id, '') GROUP BY layer, kind",
    "dedup_edges": "SELECT id, src, dst, relation, attestation FROM edges QUALIFY row_number() OVER (PARTITION BY src, dst, relation, attestation ORDER BY id) = 1",
    "keep_longest": "SELECT unit_id, doc_kind, doc_id, length(text) AS chars FROM documents WHERE text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY unit_id, doc_kind ORDER BY length(text) DESC, doc_id) = 1",
    "contested": "SELECT id, catchline, loaded_at, count(*) OVER (PARTITION BY id) AS n, row_number() OVER (PARTITION BY id ORDER BY loaded_at, catchline NULLS FIRST) - 1 AS listing FROM (SELECT DISTINCT id, catchline, loaded_at FROM sections) QUALIFY n > 1",
    "listings": "SELECT id, count(*) AS n, array_to_string(list_transform(list_sort(list(loaded_at)), lambda x: strftime(x, '%Y-%m-%d')), ',') AS loaded FROM (SELECT DISTINCT id, loaded_at, deleted_at FROM sections) GROUP BY id HAVING count(*) > 1",
    "trusted_title": "WITH u AS (SELECT DISTINCT id, title, url FROM units) SELECT id, title, min(title) OVER (PARTITION BY id) IS DISTINCT FROM max(title) OVER (PARTITION BY id) AS disagree FROM u QUALIFY row_number() OVER (PARTITION BY id ORDER BY (url IS NULL)::INT, coalesce(title, '~')) = 1",
    "natural_order": f"SELECT chapter, num, row_number() OVER (PARTITION BY chapter ORDER BY {_KEYNUM}) AS pos FROM (SELECT DISTINCT chapter, num FROM sections WHERE layer = 'hrs')",
    "rule_order": "SELECT chapter, num, row_number() OVER (PARTITION BY chapter ORDER BY list_transform(string_split(num, '-'), lambda x: {'n': CAST(regexp_extract(x, '^([0-9]+)', 1) AS BIGINT), 'd': coalesce(TRY_CAST(regexp_extract(x, '^[0-9]+[A-Za-z]*\\.([0-9]+)', 1) AS BIGINT), -1), 's': regexp_extract(x, '([A-Za-z]*)$', 1)})) AS pos FROM (SELECT DISTINCT chapter, num FROM sections WHERE layer = 'har')",
    "part_fill": f"""WITH s AS (SELECT chapter, num, max(unit_path) AS path FROM sections WHERE layer = 'hrs' GROUP BY 1, 2),
 x AS (SELECT chapter, num, nullif(regexp_extract(path, '^(Part [IVXL]+)', 1), '') AS part, nullif(regexp_extract(path, '› ([A-Z]\\. .*)$', 1), '') AS sub, row_number() OVER (PARTITION BY chapter ORDER BY {_KEYNUM}) AS i FROM s),
 f AS (SELECT *, count(part) OVER (PARTITION BY chapter ORDER BY i) AS g, last_value(part IGNORE NULLS) OVER (PARTITION BY chapter ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS part_filled FROM x)
 SELECT chapter, num, part_filled, last_value(sub IGNORE NULLS) OVER (PARTITION BY chapter, g ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS subpart_filled FROM f""",
    "sessions": "WITH x AS (SELECT event_id, user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events), y AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts > prev + INTERVAL 1 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM x) SELECT user_id, CAST(island AS BIGINT) AS island, count(*) AS events, min(event_id) AS first_event FROM y GROUP BY user_id, island",
    "last_error": "SELECT e.event_id, (SELECT max_by(r.event_id, (r.ts, r.event_id)) FROM events r WHERE r.event_type = 'error' AND r.user_id = e.user_id AND r.ts < e.ts) AS error_id_as_of FROM events e",
    "last_signup": "SELECT e.event_id, (SELECT max_by(r.event_id, (r.ts, r.event_id)) FROM events r WHERE r.event_type = 'purchase' AND r.user_id = e.user_id AND r.ts <= e.ts) AS purchase_id_as_of FROM events e",
    "toc_split": """WITH x AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i, event_type || ':' || hour(ts) AS item FROM events),
 k AS (SELECT user_id, item, min(i) AS f, max(i) AS l FROM x GROUP BY 1, 2), n AS (SELECT user_id, max(i) AS n FROM x GROUP BY 1),
 d AS (SELECT x.user_id, x.i, (SELECT count(*) FROM k WHERE k.user_id = x.user_id AND (l <= x.i OR f > x.i)) AS difference FROM x JOIN n ON n.user_id = x.user_id WHERE x.i < n.n)
 SELECT user_id, arg_min(i, (difference, i)) AS split, min(difference) AS difference FROM d GROUP BY user_id""",
    "list_members": None,
    "find_words": "SELECT DISTINCT section_id, zone FROM zones WHERE list_contains(regexp_split_to_array(lower(body), '[^\\p{L}\\p{N}]+'), 'reasonable') AND list_contains(regexp_split_to_array(lower(body), '[^\\p{L}\\p{N}]+'), 'pasture')",
    "token_counts": "WITH t AS (SELECT section_id, zone, unnest(regexp_split_to_array(lower(body), '[^\\p{L}\\p{N}]+')) AS token FROM (SELECT DISTINCT * FROM zones)), c AS (SELECT section_id, zone, token, count(*) AS n FROM t WHERE token <> '' GROUP BY ALL) SELECT token, count(*) AS texts, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY token HAVING count(*) > 20",
    "short_documents": "WITH x AS (SELECT source, coalesce(length(text), 0) < 700 AS bad FROM documents), g AS (SELECT source, count(*) FILTER (bad) > greatest(2.0, count(*) * 0.30) AS q FROM x GROUP BY source) SELECT x.source, g.q AS quarantined, count(*) AS n FROM x JOIN g ON x.source IS NOT DISTINCT FROM g.source GROUP BY x.source, g.q",
    "implemented_by": f"WITH {ATT} SELECT dst AS statute, count(DISTINCT CASE WHEN relation = 'implements' THEN src END) AS implementing, count(DISTINCT CASE WHEN relation = 'authorized_by' THEN src END) AS authorized FROM e WHERE relation IN ('implements', 'authorized_by') GROUP BY dst",
    "double_amendments": f"""WITH h AS (SELECT section_id, unnest(regexp_extract_all(body, 'L [0-9]{{4}}, c [0-9]+')) AS l FROM zones WHERE zone = 'history'),
 n AS (SELECT target, src, {_NUM_SRC} AS num FROM edge WHERE kind = 'session_law' AND src IS NOT NULL AND regexp_matches(target, '^slh:[0-9]{{4}}:[0-9]+')),
 z AS (SELECT section_id, substr(l, 3, 4) AS year, regexp_extract(l, 'c ([0-9]+)', 1) AS act FROM h UNION SELECT {_LAYER_SRC} || ':' || num, split_part(target, ':', 2), regexp_extract(target, '^slh:[0-9]+:([0-9]+)', 1) FROM n)
 SELECT section_id, year, count(*) AS acts FROM z GROUP BY 1, 2 HAVING count(*) > 1""",
    "range_repeals": """WITH s AS (SELECT DISTINCT num, repealed, TRY_CAST(regexp_extract(num, '-([0-9]+)$', 1) AS INT) AS n FROM sections WHERE layer = 'hrs'),
 r AS (SELECT DISTINCT num, n, regexp_replace(num, '-[^-]*$', '-') AS lead FROM s WHERE n IS NOT NULL AND repealed = 1), x AS (SELECT *, unnest(generate_series(n + 1, n + 3)) AS k FROM r)
 SELECT num, 'REPEALED (§§' || num || ' to ' || lead || (n + 3) || ')' AS catchline, lead || k AS member FROM x WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.n IS NOT NULL AND s.num = x.lead || x.k)""",
    "crosswalk_totals": "SELECT attestation, count(*) AS edges, count(DISTINCT src) AS sources, count(DISTINCT dst) AS targets, count(DISTINCT CASE WHEN dst_kind = 'session_law' OR dst LIKE 'slh:%' THEN dst END) AS acts FROM edges GROUP BY attestation",
    "subpart_sizes": "SELECT unit_path, count(DISTINCT id) AS sections FROM sections WHERE unit_path LIKE 'Part I%' GROUP BY unit_path",
    "repealed_targets": f"WITH {GRAPH}, s AS (SELECT id FROM sections GROUP BY id HAVING max(repealed) = 1) SELECT dst, count(*) AS citations, count(DISTINCT src) AS sources FROM g WHERE zone = 'operative' AND dst IN (SELECT id FROM s) GROUP BY dst",
    "unit_children": "WITH u AS (SELECT DISTINCT id, kind, parent FROM units) SELECT t.id, (SELECT count(*) FROM u c WHERE c.parent = t.id) AS children FROM u t WHERE kind = 'title'",
    "drift": "WITH u AS (SELECT DISTINCT layer, num, TRY_CAST(json_extract_string(TRY_CAST(nullif(extra, '') AS JSON), '$.sections') AS INT) AS printed FROM units WHERE kind = 'chapter'), s AS (SELECT layer, chapter AS num, count(DISTINCT id) AS held FROM sections GROUP BY 1, 2) SELECT layer, num, printed, held FROM u JOIN s USING (layer, num) WHERE printed IS NOT NULL AND printed <> held",
}
QUERIES = {k: globals()[k] for k in SQL}
SQL = {k: v for k, v in SQL.items() if v}
