"""Problem 6: the two attestations of the rule-to-statute relations."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions.ids import proper_section, proper_target
from lexloom.operators.reconcile import latest, reconcile
from lexloom.plans.p2 import _SQL_LAYER, _SQL_NUM
from lexloom.session import durable
from lexloom.sources.tables import table


NAMES = ("rule_text", "lrb2025")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "edges").where(F.col("attestation").isin(*NAMES))
    e = e.select("attestation", proper_section(F.col("src")).alias("src"), proper_target(F.col("dst")).alias("dst"), "relation", "dst_kind", "id")
    # The last row of each pair is written once; all that follows reads it from there.
    rows = durable(latest(e.where(F.col("src").isNotNull() & F.col("dst").isNotNull()), ["attestation", "src", "dst"], "id", ["relation", "dst_kind"]))
    both = rows.groupBy("src").agg(F.min("attestation").alias("a"), F.max("attestation").alias("b")).where("a <> b").select("src")
    rows = durable(rows.join(both, "src", "left_semi"))
    # The number of buckets follows the rows read, an upper bound of the pairs, known from the files' footers.
    return reconcile(rows, "attestation", ["src", "dst"], ["relation", "dst_kind"], NAMES, buckets=max(1, math.ceil(table(spark, d, "edges").count() / 64)))


_SQUEEZED = "regexp_replace(regexp_replace(translate({c}, '‐‑‒–—―−﹘﹣－', '----------'), '[\\p{{Cf}}\\p{{Z}}\\s§]+', '', 'g'), '^(?i)(sections?|secs?\\.)', '')"
_SQ = _SQUEEZED.format(c="dst")
SQL = {
    "p6_found": f"""
WITH n AS (SELECT attestation, id, relation, dst_kind, src, dst, {_SQL_NUM.format(c="src")} AS sn, {_SQL_NUM.format(c="dst")} AS dn, {_SQ} AS q
 FROM edges WHERE attestation IN ('rule_text', 'lrb2025') AND src IS NOT NULL AND dst IS NOT NULL),
e AS (SELECT attestation, id, relation, dst_kind, {_SQL_LAYER.format(c="src", n="sn")} || ':' || sn AS src,
 CASE WHEN regexp_matches(lower(q), '^(hrs|har):?ch:') THEN regexp_extract(lower(q), '^(hrs|har)', 1) || ':ch:' || upper(regexp_replace(regexp_replace(q, '^(?i)(hrs|har):?ch:', ''), '\\(.*$', ''))
 WHEN regexp_matches(lower(q), '^usc:') THEN 'usc:' || upper(regexp_replace(substr(q, 5), '\\(.*$', ''))
 ELSE {_SQL_LAYER.format(c="dst", n="dn")} || ':' || dn END AS dst FROM n),
l AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY attestation, src, dst ORDER BY id DESC) = 1),
b AS (SELECT src FROM e GROUP BY src HAVING count(DISTINCT attestation) = 2),
x AS (SELECT * FROM l WHERE src IN (SELECT src FROM b)),
r AS (SELECT * FROM x WHERE attestation = 'rule_text'), t AS (SELECT * FROM x WHERE attestation = 'lrb2025'),
j AS (SELECT coalesce(r.src, t.src) AS src, coalesce(r.dst, t.dst) AS dst, r.src AS a, t.src AS b, r.relation AS ra, t.relation AS rb, r.dst_kind AS ka, t.dst_kind AS kb
 FROM r FULL JOIN t ON r.src = t.src AND r.dst = t.dst)
SELECT src, dst, 'only_rule_text' AS finding FROM j WHERE b IS NULL
UNION ALL SELECT src, dst, 'only_lrb2025' FROM j WHERE a IS NULL
UNION ALL SELECT src, dst, 'relation' FROM j WHERE a IS NOT NULL AND b IS NOT NULL AND ra IS DISTINCT FROM rb
UNION ALL SELECT src, dst, 'dst_kind' FROM j WHERE a IS NOT NULL AND b IS NOT NULL AND ka IS DISTINCT FROM kb
""",
}
QUERIES = {"p6_found": p6_found}
