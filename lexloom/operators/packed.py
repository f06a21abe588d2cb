"""Several values packed in one field: one row per value, with its position.

A field is cut by a dictionary of whole values, not by its delimiters. The dictionary has closed entries (titles known
from elsewhere in the corpus, found by an Aho-Corasick automaton) and open classes (section numbers and ranges of them,
session-law entries, quoted texts), found by one alternation of patterns. A dynamic program over the character
positions picks the cheapest cover by values, delimiters and furniture (labels, layer names, section signs, words like
"section"), so a delimiter inside a known value is never a cut. Text that nothing covers becomes a value of its own up
to the next delimiter outside a known value.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words and signs around values that aren't part of them, and delimiters between values.
FURNITURE = r"(?:auth|imp)\s*:|\bhrs\b|\bhar\b|§+|\b(?:sections?|secs?\.|sec\b)|[\[\]()]"
DELIMITER = r"[;,|/&\n\r\t]+|\b(?:and|or)\b"
NUMBER = r"\d+[A-Za-z]?(?:[:\-‐‑–]\d+[A-Za-z]?(?:\.\d+)?){1,3}(?:\([0-9A-Za-z]{1,5}\))*"
RANGE = rf"{NUMBER}(?:\s+to\s+(?:(?:hrs|har)\s*)?(?:§\s*)?{NUMBER})?"
LAW = (
    r"(?:(?:am|ren|gen\s+ch|comp|rep|ree)\s+(?:and\s+(?:am|ren|comp|rep|ree)\s+)?)?L\s+(?:Sp\s+)?\d{4}(?:,?\s+\d(?:st|d|nd|rd|th)\s+Sp\s+Sess)?"
    r"\s*,\s*c\s+[A-Za-z]?\s?\d+[A-Za-z]?\s*,\s*(?:§+\s*|pt\s+)[0-9A-Za-z.\-]+(?:\s+to\s+[0-9A-Za-z.\-]+)?"
)
#: Doubled quotes inside a double-quoted value stand for one.
QUOTED = r"\"[^\"]*(?:\"\"[^\"]*)*\"|“[^”]+”|(?<![0-9A-Za-z])'[^'\n]+'(?![0-9A-Za-z])"
#: A whole field that is one section number: nothing is packed in it.
SINGLE = r"(?i)^[\s(\[]*((auth|imp)\s*:)?\s*(hrs|har|sections?|secs?\.?|§|\s){0,9}\d+[a-z]?([:\-]\d+[a-z]?(\.\d+)?){1,3}(\([0-9a-z]{1,5}\))*[\s)\]]*$"

_VALUES = re.compile(rf"(?P<quoted>{QUOTED})|(?P<law>{LAW})|(?P<number>{RANGE})", re.I)
_FURNITURE = re.compile(FURNITURE, re.I)
_DELIMITER = re.compile(DELIMITER, re.I)
#: Costs of the cover: a value, furniture, a blank, a delimiter, and each character that nothing covers.
COST = {"value": 1.0, "furniture": 0.2, "blank": 0.0, "delimiter": 0.1, "loose": 3.0}


def automaton(titles: list[str]):
    """An Aho-Corasick automaton of known whole values, or None if there are none."""
    if not titles:
        return None
    import ahocorasick

    a = ahocorasick.Automaton()
    for t in titles:
        a.add_word(t, len(t))
    a.make_automaton()
    return a


def _arcs(text: str, known) -> list[list[tuple[int, str]]]:
    """Per start the ends and kinds of all entries of the dictionary, furniture and delimiters found there."""
    arcs: list[list[tuple[int, str]]] = [[] for _ in text]
    at = 0
    while m := _VALUES.search(text, at):
        arcs[m.start()].append((m.end(), "value"))
        at = m.end() if m.lastgroup != "quoted" else m.start() + 1  # what begins inside quotes competes with the quoted whole
    starts, ends = set(), set()  # of what may stand beside a whole value
    for pattern, kind in ((_FURNITURE, "furniture"), (_DELIMITER, "delimiter")):
        for m in pattern.finditer(text):
            arcs[m.start()].append((m.end(), kind))
            starts.add(m.start())
            ends.add(m.end())
    for end, n in known.iter(text) if known else ():
        s, e = end + 1 - n, end + 1
        before, behind = s, e
        while before and text[before - 1].isspace():
            before -= 1
        while behind < len(text) and text[behind].isspace():
            behind += 1
        if (before == 0 or before in ends) and (behind == len(text) or behind in starts):
            arcs[s].append((e, "value"))
    return arcs


def _clean(v: str) -> str:
    v = v.strip()
    while len(v) > 1 and (v[0], v[-1]) in (('"', '"'), ("'", "'"), ("“", "”")):
        v = (v[1:-1].replace('""', '"') if v[0] == '"' else v[1:-1]).strip()
    m = re.fullmatch(rf"({NUMBER})\s+to\s+(?:(?:hrs|har)\s*)?(?:§\s*)?({NUMBER})", v, re.I)
    return f"{m[1]} to {m[2]}" if m else v


def segment(text: str | None, known=None) -> list[str]:
    """The values of a field in order; a null, empty or blank field has none."""
    if not text or not text.strip():
        return []
    n, arcs = len(text), _arcs(text, known)
    best: list[float] = [0.0] * (n + 1)
    step: list[tuple[int, str]] = [(0, "")] * n
    for i in range(n - 1, -1, -1):
        c, to = (COST["blank"], "blank") if text[i].isspace() else (COST["loose"], "loose")
        best[i], step[i] = c + best[i + 1], (i + 1, to)
        for end, kind in arcs[i]:
            if (c := COST[kind] + best[end]) < best[i]:
                best[i], step[i] = c, (end, kind)
    out: list[str] = []
    i, loose = 0, ""
    while i <= n:
        end, kind = step[i] if i < n else (n + 1, "end")
        piece = text[i:end]
        if kind == "loose" or kind == "blank" and loose or kind == "value" and loose and not loose[-1].isspace():
            loose += piece
        elif kind == "furniture" and loose and piece in "()[]" and not loose.isspace():
            loose += piece
        else:
            if loose.strip():
                out.append(_clean(loose.strip().strip("[]").strip()))
            loose = ""
            if kind == "value":
                out.append(_segment_quoted(piece))
        i = end
    return [v for v in out if v]


def _segment_quoted(piece: str) -> str:
    """A quoted number or entry loses its own furniture too."""
    v = _clean(piece)
    inner = _VALUES.search(v)
    if inner and inner.lastgroup != "quoted" and not _FURNITURE.sub("", v.replace(inner.group(), "", 1)).strip():
        return _clean(inner.group())
    return v


def split_packed(df: DataFrame, keys: list[str], text: str, titles: DataFrame | None = None) -> DataFrame:
    """One row per value of each field that holds two or more: the key columns, pos (from 1) and value.

    titles: optional, one column `title` of whole values known from elsewhere, each with a letter or digit; its length and the delimiters in it don't matter.
    It is never broadcast: to a field that the open classes don't cover come the titles whose rarest word it holds, and an automaton of these
    finds which of them stand in it, and where. Null, empty and blank fields and fields of one value give no rows. Repeated
    rows give repeated rows. Only the key columns and the text are read, so other columns may have any names.
    """
    schema = df.select(*[F.col(f"`{k}`") for k in keys]).schema.add("pos", "integer").add("value", "string")
    src = df.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{text}`").alias("_text")).where(F.col("_text").isNotNull() & ~F.col("_text").rlike(SINGLE))
    if titles is not None:
        src = _with_known(src, titles)
    else:
        src = src.withColumn("_known", F.lit(None).cast("array<string>"))
    arrow_schema = pa.schema([(f.name, pa.int32() if f.name == "pos" else _arrow(f.dataType.simpleString())) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            memo: dict = {}
            rows, pos, value = [], [], []
            for i, (t, known) in enumerate(zip(b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist())):
                k = (t, tuple(known or ()))
                if (vs := memo.get(k)) is None:
                    vs = memo[k] = segment(t, automaton(sorted(set(known or ()))))
                if len(vs) > 1:
                    rows += [i] * len(vs)
                    pos += range(1, len(vs) + 1)
                    value += vs
            taken = [b.column(j).take(pa.array(rows, pa.int64())) for j in range(b.num_columns - 2)]
            yield pa.RecordBatch.from_arrays([*taken, pa.array(pos, pa.int32()), pa.array(value, pa.string())], schema=arrow_schema)

    return src.mapInArrow(run, schema)


def _arrow(kind: str) -> pa.DataType:
    return {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}[kind]


#: What the open classes and the furniture cover; a field of which more remains may hold titles without quotes.
COVERED = rf"(?i){QUOTED}|{LAW}|{RANGE}|{FURNITURE}|{DELIMITER}|\s+"


def _words(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))


def _with_known(src: DataFrame, titles: DataFrame) -> DataFrame:
    """Adds _known: titles that may stand in a field which the open classes don't cover.

    Every title that stands there has its rarest word there, counted over those fields; so no title is missed, a common word brings
    few titles with it, and a title with a word that no field holds goes nowhere."""
    t = titles.select(F.trim("title").alias("title")).where(F.col("title") != "").distinct()
    open_ = src.where(F.regexp_replace("_text", COVERED, "") != "").select("_text").distinct()
    held = open_.select("_text", F.explode(_words(F.col("_text"))).alias("word"))
    often = held.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    anchors = t.select("title", F.explode(_words(F.col("title"))).alias("word")).join(often, "word", "left").groupBy("title")
    anchors = anchors.agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word")).alias("a")).where("a.n > 0").select("title", F.col("a.word").alias("word"))
    known = held.join(anchors, "word").groupBy("_text").agg(F.collect_set("title").alias("_known"))
    return src.join(known, "_text", "left").select(*[c for c in src.columns if c != "_text"], "_text", "_known")


def quoted_titles(texts: DataFrame, text: str) -> DataFrame:
    """Whole values known from quotes: the quoted texts of a column that hold a letter word, one column `title`."""
    t = texts.where(F.col(f"`{text}`").contains('"')).select(F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(QUOTED), F.lit(0))).alias("q"))
    return t.select(F.replace(F.expr("substring(q, 2, length(q) - 2)"), F.lit('""'), F.lit('"')).alias("title")).where(F.col("title").rlike("[A-Za-z]{3}")).distinct()
