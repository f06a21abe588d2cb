"""SQL that several oracles share."""

from lexloom.plans.p2 import _SQL_LAYER, _SQL_NUM

NUM, LAYER = _SQL_NUM, _SQL_LAYER

#: Citations between sections with both ends in proper form: g(edge_id, src, dst, kind, zone, raw).
GRAPH = f"""
gn AS (SELECT edge_id, kind, zone, raw, src, target, {NUM.format(c="src")} AS sn, {NUM.format(c="target")} AS tn FROM edge WHERE kind IN ('hrs_section', 'har_section')),
g AS (SELECT edge_id, kind, zone, raw, {LAYER.format(c="src", n="sn")} || ':' || sn AS src, {LAYER.format(c="target", n="tn")} || ':' || tn AS dst FROM gn)
"""
_SQUEEZED = "regexp_replace(regexp_replace(translate({c}, '‐‑‒–—―−﹘﹣－', '----------'), '[\\p{{Cf}}\\p{{Z}}\\s§]+', '', 'g'), '^(?i)(sections?|secs?\\.)', '')"
#: Citations of all kinds, targets of other kinds than sections in their own name spaces: ga(edge_id, src, dst, kind, zone, raw).
GRAPH_ALL = f"""
gx AS (SELECT edge_id, kind, zone, raw, src, target, {NUM.format(c="src")} AS sn, {NUM.format(c="target")} AS tn, {_SQUEEZED.format(c="target")} AS q FROM edge),
ga AS (SELECT edge_id, kind, zone, raw, {LAYER.format(c="src", n="sn")} || ':' || sn AS src,
 CASE WHEN kind IN ('hrs_section', 'har_section') THEN {LAYER.format(c="target", n="tn")} || ':' || tn
 WHEN kind IN ('hrs_chapter', 'har_chapter') THEN left(kind, 3) || ':ch:' || upper(regexp_replace(regexp_replace(q, '^(?i)((hrs|har):?)?(ch:)?', ''), '\\(.*$', ''))
 ELSE target END AS dst FROM gx)
"""


def proper_target_sql(c: str) -> str:
    """A typed target in proper form."""
    n, q = NUM.format(c=c), _SQUEEZED.format(c=c)
    return f"""CASE WHEN {c} IS NULL THEN NULL WHEN regexp_matches(lower({q}), '^(hrs|har):?ch:') THEN regexp_extract(lower({q}), '^(hrs|har)', 1) || ':ch:' || upper(regexp_replace(regexp_replace({q}, '^(?i)(hrs|har):?ch:', ''), '\\(.*$', ''))
 WHEN regexp_matches(lower({q}), '^usc:') THEN 'usc:' || upper(regexp_replace(substr({q}, 5), '\\(.*$', '')) ELSE {LAYER.format(c=c, n=n)} || ':' || {n} END"""


#: The parts by which statute numbers are ordered: chapter, its letter, numbers behind.
def natural_sql(num: str) -> str:
    return f"""coalesce(TRY_CAST(nullif(regexp_extract({num}, '^([0-9]+)', 1), '') AS BIGINT), 1000000000), regexp_extract({num}, '^[0-9]+([A-Za-z]*)', 1), list_transform(regexp_extract_all(regexp_replace({num}, '^[0-9]+[A-Za-z]*', ''), '[0-9]+'), lambda x: CAST(x AS BIGINT))"""


#: Sections that exist at the end: live(id).
LIVE = "live AS (SELECT DISTINCT id FROM sections WHERE deleted_at IS NULL AND repealed = 0)"
