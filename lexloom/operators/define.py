"""Definitions, and which of them governs at a place.

A definition counts within its scope: section, subpart, part, chapter or title. At a place the narrowest scope with a definition wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Scopes from the narrowest, the words that declare each of them before `this <scope>`, the verbs of a definition, and the words before a definition taken from elsewhere.
SCOPES = ["section", "subpart", "part", "chapter", "title", "unstated"]
LEADS = {"section": ["for purposes of", "for the purposes of", "as used in"], "subpart": ["in"], "part": ["in", "for purposes of", "for the purposes of"], "chapter": ["in", "for purposes of", "for the purposes of"], "title": ["in", "for purposes of", "for the purposes of"]}
HERE = "for this purpose"
VERB_WORDS = ["means", "includes", "has the same meaning", "shall mean", "shall have the same meaning", "denotes", "refers to"]
ELSEWHERE = ["defined in", "same meaning as in", "same meaning as defined in", "same meaning as that in", "same meaning as that defined in"]


def _any(phrases: list[str]) -> str:
    """A pattern of any of some phrases, the longest first, with white space between their words and `purpose` beside `purposes`."""
    return "(?:" + "|".join(r"\s+".join(p.split()).replace("purposes", "purposes?") for p in sorted(phrases, key=len, reverse=True)) + ")"


VERBS = _any(VERB_WORDS)
_DECLARE = re.compile(r"\b(?:" + "|".join(rf"{_any(LEADS[k])}\s+this\s+(?P<{k}>{k})" for k in LEADS) + rf"|{_any([HERE])})\b", re.I)
_TERM = r"[\"“]([^\"“”\n]{2,80})[\"”]"
_QUOTED, _COMMA = re.compile(rf"{_TERM}\s+({VERBS})\b", re.I), re.compile(rf"{_TERM},\s+(?=[a-z\"“])")
_PLAIN = re.compile(rf"\bin\s+this\s+(?:{'|'.join(LEADS)}),\s+the\s+([a-z][a-z \-]{{2,60}}?)\s+({VERBS})\b", re.I)
_IMPORT = re.compile(rf"{_any(ELSEWHERE)}\s+(?:section\s+)?([0-9A-Z]+(?::[0-9A-Z]+)?-[0-9]+(?:\.[0-9]+)?)", re.I)
#: Some of these is in every verb above.
_STEMS = ("mean", "include", "denote", "refer")
#: Declarations this close to the last kept one count as one, of the narrower kind.
NEAR = 12
BODY, BODY_MOST, IMPORT_WITHIN = 700, 1200, 300


def norm(term: str) -> str:
    """A term as it is compared: in lower case, on one line, without marks at its ends."""
    return " ".join(term.lower().split()).strip(" .,")


def declarations(text: str) -> list[tuple[int, str]]:
    """(end, scope) of each scope declaration, in order; near ones collapse to the narrower."""
    kept: list[tuple[int, str]] = []
    for end, kind in ((m.end(), m.lastgroup or "section") for m in _DECLARE.finditer(text)):
        if kept and end - kept[-1][0] < NEAR:
            if SCOPES.index(kind) < SCOPES.index(kept[-1][1]):
                kept[-1] = (kept[-1][0], kind)
            continue
        kept.append((end, kind))
    return kept


def definitions(text: str, is_definitions: bool) -> list[tuple[str, str, str, str, str | None]]:
    """(term, verb, scope, body, imported from) of each term, the first of several of one name."""
    low = text.lower()
    if not is_definitions and not any(stem in low for stem in _STEMS):
        return []
    at = [(m.start(), m.end(), m[1], " ".join(m[2].lower().split())) for p in (_QUOTED, _PLAIN) for m in p.finditer(text)]
    if is_definitions:
        at += [(m.start(), m.end(), m[1], ",") for m in _COMMA.finditer(text)]
    at.sort()
    declared = declarations(text)
    out, seen = [], set()
    for i, (start, end, term, verb) in enumerate(at):
        stop = at[i + 1][0] if i + 1 < len(at) else end + BODY
        name = norm(term)
        if name in seen or len(name) < 2:
            continue
        seen.add(name)
        scope = next((k for e, k in reversed(declared) if e <= max(start, end - len(term) - len(verb) - 2)), "unstated")
        body = " ".join(text[start:stop].split())[:BODY_MOST]
        m = _IMPORT.search(body[:IMPORT_WITHIN])
        out.append((term.strip(), verb, scope, body, m[1].upper() if m else None))
    return out


def extract_definitions(df: DataFrame, section: str, text: str, catchline: str) -> DataFrame:
    """One row per term and section: section, seq, term, term_norm, verb, scope, body, imports_from. Null and empty texts have none.

    A term without a declaration counts for the chapter in a section of definitions, else for its section."""
    src = df.select(F.col(section).alias("section"), F.col(text).alias("t"), F.coalesce(F.col(catchline), F.lit("")).alias("c")).where(F.col("t") != "")
    names = ["section", "seq", "term", "term_norm", "verb", "scope", "body", "imports_from"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for s, t, c in zip(*(b.column(x).to_pylist() for x in ("section", "t", "c"))):
                general = c.lower().startswith("definitions")
                default = "chapter" if general else "section"
                out += [(s, n, term, norm(term), verb, default if scope == "unstated" else scope, body, imp) for n, (term, verb, scope, body, imp) in enumerate(definitions(t, general))]
            cols = list(zip(*out)) if out else [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "seq" else pa.string()) for c, n in zip(cols, names)], names=names)

    return src.mapInArrow(run, "section string, seq int, term string, term_norm string, verb string, scope string, body string, imports_from string")


def scope_key(scope: Column, section: Column, chapter: Column, part: Column, subpart: Column, title: Column) -> Column:
    """The place where a scope of a section counts; a part or subpart that the section lacks gives null."""
    p, s = F.nullif(part, F.lit("")), F.nullif(subpart, F.lit(""))
    return (
        F.when(scope == "section", F.concat(F.lit("sec:"), section)).when(scope == "subpart", F.concat(F.lit("ch:"), chapter, F.lit(":"), p, F.lit(":"), s))
        .when(scope == "part", F.concat(F.lit("ch:"), chapter, F.lit(":"), p)).when(scope == "chapter", F.concat(F.lit("ch:"), chapter)).when(scope == "title", F.concat(F.lit("title:"), title))
    )


def resolve(places: DataFrame, defined: DataFrame) -> DataFrame:
    """Which definition governs each term at each place that is in the scope of any.

    places: section, chapter, part, subpart, title. defined: term_norm, scope_key and a total order `seq`. Result: section, term_norm, scope_key, seq, rank, controls;
    rank counts from the narrowest scope, and only the first controls, the others are shadowed. A place outside of all scopes of a term has no row for it.
    Keys of one section are few, so the join is an equi-join on the scope key, whatever the number of terms."""
    keys = [scope_key(F.lit(k), *[F.col(c) for c in ("section", "chapter", "part", "subpart", "title")]) for k in SCOPES[:5]]
    places = places.select("section", "chapter", "part", "subpart", "title").distinct()
    chain = places.select("section", F.posexplode(F.array(*keys)).alias("depth", "scope_key")).where(F.col("scope_key").isNotNull())
    j = chain.join(defined.where(F.col("term_norm").isNotNull()), "scope_key")
    w = Window.partitionBy("section", "term_norm").orderBy("depth", "seq")
    return j.withColumn("rank", F.row_number().over(w)).select("section", "term_norm", "scope_key", "seq", "rank", (F.col("rank") == 1).alias("controls"))


def collisions(defined: DataFrame) -> DataFrame:
    """Terms defined in several scopes: term_norm, scopes."""
    return defined.groupBy("term_norm").agg(F.count_distinct("scope_key").alias("scopes")).where("scopes > 1")


def terms_of(defined: DataFrame, section: str) -> DataFrame:
    """The terms that a section defines, in order."""
    return defined.where(F.col("section") == section).orderBy("term_norm")


def scopes_of(defined: DataFrame, term: str) -> DataFrame:
    """All definitions of one term, the narrowest scope first, then by section."""
    rank = F.array_position(F.array(*[F.lit(k) for k in SCOPES]), F.col("scope"))
    return defined.where(F.col("term_norm") == norm(term)).withColumn("scope_rank", (rank - 1).cast("int")).orderBy("scope_rank", "section")


def suggest(defined: DataFrame, part_of_term: str, n: int = 8) -> DataFrame:
    """Terms that hold a text, in order, at most n."""
    return defined.where(F.col("term_norm").contains(norm(part_of_term))).select("term_norm").distinct().orderBy("term_norm").limit(n)
