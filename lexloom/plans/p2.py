"""Problem 2: citations of sections that do not exist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions.ids import proper_section
from lexloom.operators.orphans import orphans_by_period, reference_status
from lexloom.sources.tables import table


def edge_ends(edge: DataFrame) -> DataFrame:
    """Both ends of each citation that name a section: edge_id, side, ref_key, ref_ts."""
    target = F.when(F.col("kind").isin("hrs_section", "har_section"), proper_section(F.col("target"), F.substring("kind", 1, 3)))
    ends = F.array(*[F.struct(F.lit(side).alias("side"), key.alias("ref_key")) for side, key in (("src", proper_section(F.col("src"))), ("target", target))])
    return edge.select("edge_id", F.col("loaded_at").alias("ref_ts"), F.inline(ends)).where(F.col("ref_key").isNotNull())


def _status(spark: SparkSession, d: str) -> DataFrame:
    sections = table(spark, d, "sections").select(proper_section(F.col("id")).alias("key"), F.col("loaded_at").alias("start_ts"), F.col("deleted_at").alias("end_ts"))
    return reference_status(edge_ends(table(spark, d, "edge")), sections)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _status(spark, d).where(F.col("status") != "ok").select("edge_id", "side")


def p2_orphans(spark: SparkSession, d: str) -> DataFrame:
    return orphans_by_period(_status(spark, d), "edge")


# The same in SQL: one number per spelling, then intervals that hold the moment.
_SQL_NUM = """
upper(regexp_replace(regexp_replace(regexp_replace(regexp_replace(translate({c}, '‐‑‒–—―−﹘﹣－', '----------'),
 '[\\p{{Cf}}\\p{{Z}}\\s§]+', '', 'g'), '^(?i)(sections?|secs?\\.)', ''), '^(?i)(hrs|har):?', ''), '\\(.*$', ''))
"""
_SQL_LAYER = """
CASE WHEN regexp_matches(lower(regexp_replace({c}, '[\\p{{Cf}}\\p{{Z}}\\s§]+', '', 'g')), '^(sections?|secs?\\.)?(hrs|har)')
 THEN regexp_extract(lower({c}), '(hrs|har)', 1)
 WHEN length({n}) - length(replace({n}, '-', '')) = 2 THEN 'har' ELSE 'hrs' END
"""
_SQL_STATUS = f"""
WITH e AS (
 SELECT edge_id, 'src' AS side, loaded_at, src AS c FROM edge WHERE src IS NOT NULL
 UNION ALL SELECT edge_id, 'target', loaded_at, target FROM edge WHERE target IS NOT NULL AND kind IN ('hrs_section','har_section')),
n AS (SELECT *, {_SQL_NUM.format(c="c")} AS num FROM e),
k AS (SELECT edge_id, side, loaded_at, {_SQL_LAYER.format(c="c", n="num")} || ':' || num AS ref_key FROM n),
s AS (SELECT DISTINCT id, loaded_at AS a, deleted_at AS b FROM sections),
f AS (SELECT id, min(a) AS first_a FROM s GROUP BY id),
o AS (SELECT k.*, f.first_a, EXISTS (SELECT 1 FROM s WHERE s.id = k.ref_key AND s.a <= k.loaded_at AND (s.b IS NULL OR k.loaded_at < s.b)) AS alive
 FROM k LEFT JOIN f ON f.id = k.ref_key),
st AS (SELECT edge_id, side, loaded_at, CASE WHEN first_a IS NULL THEN 'missing' WHEN alive THEN 'ok' WHEN first_a <= loaded_at THEN 'deleted' ELSE 'late' END AS status FROM o)
"""

QUERIES = {"p2_found": p2_found, "p2_orphans": p2_orphans}
SQL = {
    "p2_found": _SQL_STATUS + "SELECT edge_id, side FROM st WHERE status <> 'ok'",
    "p2_orphans": _SQL_STATUS
    + "SELECT 'edge' AS ref_table, side, strftime(loaded_at, '%Y-%m') AS month, status, count(*) AS n FROM st WHERE status <> 'ok' GROUP BY side, strftime(loaded_at, '%Y-%m'), status",
}
