"""Documents in zones, headings and rows.

Splits that need places in one text are Arrow passes over it; what depends on neighbouring rows (headings carried forward, wrapped
lines, columns) is windows over an order that is kept as a column.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions.text import fuzzy_pattern
from lexloom.operators.graph import as_of, forward_fill

# Headings of editorial notes, and the shapes of section starts and history notes.
NOTE_HEADS = ["Case Notes", "Cross References", "Law Journals and Reviews", "Attorney General Opinions", "Revision Note", "Rules of Court", "Historical Note", "Note"]
_MARK = re.compile(r"(?m)^\s*\[?§{1,2}\s*([0-9A-Z]+(?::[0-9A-Z]+)?-[0-9.]+)\]?\s")
_HISTORY = re.compile(r"\[(?:L|HRS|[Aa]m\s+L|CC|RL|Sup)\s[^\]]{6,600}\]")
_HEAD = re.compile(r"(?m)^\s*(?:" + "|".join(NOTE_HEADS) + r")\s*$")
_PART = re.compile(r"(?m)^\s*PART\s+([IVXLC]+[A-Z]?)\.?[ \t]*\n?[ \t]*([A-Z][A-Z ,;&'’-]+[A-Z])?")
_SUBPART = re.compile(r"(?m)^\s*([A-Z])\.[ \t]+([A-Z][^\n]{2,80})$")


def split_statute(text: str) -> dict[str, str | None]:
    """preamble, operative (with its history note), body (without), history, annotation, catchline, part, part_title, subpart of one section's page.

    All before the first section mark is preamble; the last history note ends the operative text, else the first editorial heading does."""
    m = _MARK.search(text)
    pre, rest = (text[: m.start()], text[m.start() :]) if m else ("", text)
    notes = list(_HISTORY.finditer(rest))
    head = _HEAD.search(rest)
    if notes and head and any(n.start() < head.start() for n in notes):
        notes = [n for n in notes if n.start() < head.start()]
    if notes:
        last = notes[-1]
        operative, history, annotation = rest[: last.end()], last.group(), rest[last.end() :]
        body = rest[: last.start()]
    else:
        cut = head.start() if head else len(rest)
        operative = body = rest[:cut]
        history, annotation = None, rest[cut:]
    title = re.sub(r"^\s*\[?§{1,2}\s*\S+\s*", "", " ".join(body.split()))
    catchline = title.split(". ")[0].rstrip(".")[:250] if m else None
    parts = list(_PART.finditer(pre))
    part = parts[-1] if parts else None
    sub = _SUBPART.search(pre[part.end() :] if part else pre)
    part_title = re.sub(r"\s+[A-Z]$", "", part[2].strip()) if part and part[2] else None
    return {
        "preamble": pre.strip() or None, "operative": operative.strip(), "body": body.strip(), "history": history, "annotation": annotation.strip() or None, "catchline": catchline or None,
        "part": f"PART {part[1]}." + (f" {part_title}" if part_title else "") if part else None, "subpart": f"{sub[1]}. {sub[2].strip()}" if sub else None,
    }


_PARENTHESIS = re.compile(r"[()]")


def balanced(text: str, start: int) -> int:
    """End of the parenthesis that opens at `start`, or -1 if it never closes."""
    places = [(m.start(), 1 if m.group() == "(" else -1) for m in _PARENTHESIS.finditer(text, start)]
    depths = accumulate(step for _, step in places)
    return next((at + 1 for (at, _), depth in zip(places, depths) if depth == 0), -1)


_NOTE = {k: re.compile(rf"\(\s*{a}\s*:", re.I) for k, a in (("auth", r"A\s?u\s?t\s?h"), ("imp", r"[I1l]\s?m\s?p"))}


#: A source note that lost its bracket, on one side or both, and a heading of the next sub-chapter behind a section.
_UNBRACKETED = re.compile(r"(?s)((?:\[|(?<=\.\s)|(?<=\s))(?:Eff|R)\b[^()\[\]]{0,150}?)\s*\Z")
_HEADING_BEHIND = re.compile(r"(?:\A|\s)SUBCHAPTER\s+\d+\s+[A-Z0-9 ,;-]+\s*\Z", re.I)


def split_rule(text: str) -> dict[str, str | None]:
    """operative, source_note, auth, imp, annotation of one rule section; an authority note that never closes ends where the next begins,
    a source note that lost its bracket begins at its first word."""
    spans: dict[str, tuple[int, int]] = {}
    for k, p in _NOTE.items():
        if found := list(p.finditer(text)):
            spans[k] = (found[-1].start(), balanced(text, found[-1].start()))
    if "auth" in spans and spans["auth"][1] < 0:
        spans["auth"] = (spans["auth"][0], spans["imp"][0] if "imp" in spans and spans["imp"][0] > spans["auth"][0] else len(text))
    if "imp" in spans and spans["imp"][1] < 0:
        spans["imp"] = (spans["imp"][0], len(text))
    first = min((s for s, _ in spans.values()), default=len(text))
    note = None
    if text.rfind("]", 0, first) >= 0:
        end = text.rfind("]", 0, first)
        start = text.rfind("[", 0, end)
        note = (start, end + 1) if start >= 0 else None
    if not note and first < len(text) and (m := _UNBRACKETED.search(text, 0, first)):
        note = m.span(1)
    cut = note[0] if note else first
    after = max([e for _, e in spans.values()] + ([note[1]] if note else [len(text)]))
    get = lambda s: text[s[0] : s[1]].strip() if s else None
    return {"operative": text[:cut].strip(), "source_note": get(note), "auth": get(spans.get("auth")), "imp": get(spans.get("imp")), "annotation": _HEADING_BEHIND.sub("", text[after:]).strip() or None}


def _zones(df: DataFrame, key: str, text: str, split, names: list[str]) -> DataFrame:
    src = df.select(F.col(key).alias("k"), F.col(text).alias("t")).where(F.col("t").isNotNull())
    kind = src.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [split(t) for t in b.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("k"), *(pa.array([p[n] for p in parts], pa.string()) for n in names)], names=["k", *names])

    return src.mapInArrow(run, f"k {kind}, " + ", ".join(f"{n} string" for n in names)).withColumnRenamed("k", key)


def statute_zones(df: DataFrame, key: str, text: str) -> DataFrame:
    """Statute pages in zones, one row each. Null texts give no row; an empty text gives empty zones."""
    return _zones(df, key, text, split_statute, ["preamble", "operative", "body", "history", "annotation", "catchline", "part", "subpart"])


def rule_zones(df: DataFrame, key: str, text: str) -> DataFrame:
    return _zones(df, key, text, split_rule, ["operative", "source_note", "auth", "imp", "annotation"])


def as_rows(zones: DataFrame, key: str, names: list[str]) -> DataFrame:
    """Wide zones as rows (key, zone, body), empty ones left out."""
    return zones.select(key, F.inline(F.array(*[F.struct(F.lit(n).alias("zone"), F.col(n).alias("body")) for n in names]))).where(F.coalesce("body", F.lit("")) != "")


def strip_page(page: str, running: str | None = None, tail: int = 5) -> str:
    """A page without its running header in the first line and its number in the last lines; a tail that ends in a citation stays."""
    lines = page.split("\n")
    if running and lines and running.lower() in lines[0].lower():
        lines = lines[1:]
    for i in range(len(lines) - 1, max(-1, len(lines) - 1 - tail), -1):
        if re.fullmatch(r"\s*(?:[-–]\s*)?\d{1,4}(?:-\d{1,4})?(?:\s*[-–])?\s*", lines[i]):
            before = next((x for x in reversed(lines[:i]) if x.strip()), "")
            if not re.search(r"(?:§+|sections?|-)\s*$", before):
                lines = lines[:i]
            break
        if lines[i].strip() and len(lines[i].strip()) > 12:
            break
    return "\n".join(lines).strip("\n")


def repair(df: DataFrame, key: str, text: str, rules: list[tuple[str, str, str]]) -> tuple[DataFrame, DataFrame]:
    """Texts with (name, pattern, replacement) applied in turn, and a log of each match: key, rule, before, after."""
    c, logs = F.col(text), []
    for name, pattern, new in rules:
        hits = df.select(key, c.alias("_c")).select(key, F.lit(name).alias("rule"), F.explode(F.regexp_extract_all("_c", F.lit(pattern), F.lit(0))).alias("before"))
        logs.append(hits.withColumn("after", F.regexp_replace("before", pattern, new)))
        c = F.regexp_replace(c, pattern, new)
    log = logs[0]
    for x in logs[1:]:
        log = log.unionByName(x)
    return df.withColumn(text, c), log


def sections_of(df: DataFrame, doc: str, text: str, header: str) -> DataFrame:
    """Sections of a document by header lines: doc, pos, id (first group of the header), body up to the next header."""
    lines = df.select(doc, F.posexplode(F.split(text, "\n")).alias("line", "t"))
    w = Window.partitionBy(doc).orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = lines.withColumn("id", F.nullif(F.regexp_extract("t", header, 1), F.lit(""))).withColumn("pos", F.count("id").over(w))
    x = x.where("pos > 0").groupBy(doc, "pos").agg(F.max("id").alias("id"), F.array_sort(F.collect_list(F.struct("line", "t"))).alias("m"))
    return x.select(doc, "pos", "id", F.array_join(F.transform("m", lambda y: y["t"]), "\n").alias("body"))


def longest_of_each(sections: DataFrame, doc: str) -> DataFrame:
    """Of repeated section ids the occurrence with most text, the first on ties."""
    w = Window.partitionBy(doc, "id").orderBy(F.desc(F.length("body")), "pos")
    return sections.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def heading_of(sections: DataFrame, headings: DataFrame, doc: str) -> DataFrame:
    """Each section (doc, pos) with the last heading strictly before it."""
    return as_of(sections, headings, [doc], "pos", "heading", inclusive=False)


def toc_repair(sections: DataFrame, toc: DataFrame, lines: DataFrame, doc: str) -> DataFrame:
    """Second pass: sections that the contents name (doc, id) and the first pass lacks, found again in lines (doc, line, t) by a header whose blanks or dashes were misprinted."""
    missing = toc.select(doc, "id").join(sections.select(doc, "id"), [doc, "id"], "left_anti")
    squeezed = F.regexp_replace(F.translate("t", "‐‑‒–—―−", "-------"), r"[\s§]", "")
    return lines.join(missing, doc).where(squeezed.startswith(F.regexp_replace("id", r"\s", ""))).groupBy(doc, "id").agg(F.min("line").alias("line"))


def reparse(df: DataFrame, doc: str, text: str, header: str, toc: DataFrame, least: str = r"[\s]{0,4}(?:[§S5$]\s*)?") -> tuple[DataFrame, DataFrame]:
    """Sections of documents in two passes: what the contents (doc, id) name and the first pass lacks is looked for under usual misreadings of its header line,
    section sign included; that line gets the printed header, and the document is cut again. Gives the sections, and a log: doc, id, line, before.

    A number is only found whole: 1-1-40 is not 1-1-4. Of several lines the first is mended."""
    missing = toc.select(doc, "id").distinct().join(sections_of(df, doc, text, header).select(doc, "id"), [doc, "id"], "left_anti")
    pattern = F.concat(F.lit(rf"^{least}("), fuzzy_pattern(F.col("id")), F.lit(r")\s+(?=[A-Z(\"'])"))
    lines = df.select(doc, F.posexplode(F.split(text, "\n")).alias("line", "t"))
    log = lines.join(missing, doc).where(F.regexp_count("t", pattern) > 0).groupBy(doc, "id").agg(F.min_by("t", "line").alias("before"), F.min("line").alias("line")).select(doc, "id", "line", "before")
    hit = log.groupBy(doc, "line").agg(F.min("id").alias("id"))
    mended = lines.join(hit, [doc, "line"], "left").withColumn("t", F.when(F.col("id").isNotNull(), F.concat(F.lit("§"), F.col("id"), F.lit(" "), F.regexp_replace("t", pattern, F.lit("")))).otherwise(F.col("t")))
    again = mended.groupBy(doc).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "t"))), lambda x: x["t"]), "\n").alias(text))
    return sections_of(again, doc, text, header), log


def strip_pages(df: DataFrame, key: list[str], text: str, running: str | None = None, tail: int = 5) -> DataFrame:
    """Pages without running headers and page numbers (strip_page): the key columns and the text. running: a column with each page's header. A null page stays null."""
    src = df.select(F.struct(*[F.col(f"`{k}`") for k in key]).alias("_key"), F.col(text).alias("_t"), (F.col(running) if running else F.lit(None)).cast("string").alias("_r"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [None if t is None else strip_page(t, r, tail) for t, r in zip(b.column("_t").to_pylist(), b.column("_r").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("_key"), pa.array(done, pa.string())], names=["_key", "_t"])

    out = src.mapInArrow(run, f"_key {src.schema['_key'].dataType.simpleString()}, _t string")
    return out.select(*[F.col(f"_key.`{k}`").alias(k) for k in key], F.col("_t").alias(text))


def constitution(df: DataFrame, doc: str, text: str) -> DataFrame:
    """A constitution's sections: doc, article, section, catchline, body, history, repealed. A line in capitals (over 90 %, under 220 characters) is the title of what follows."""
    lines = df.select(doc, F.posexplode(F.split(text, "\n")).alias("line", "t")).withColumn("t", F.trim("t")).where("t <> ''")
    letters, caps = F.regexp_count("t", F.lit(r"\p{L}")), F.regexp_count("t", F.lit(r"\p{Lu}"))
    article = F.nullif(F.regexp_extract("t", r"^ARTICLE\s+([IVXL]+)", 1), F.lit(""))
    number = F.nullif(F.regexp_extract("t", r"^Section\s+(\d+)\.", 1), F.lit(""))
    title = F.when((letters > 0) & (caps / letters >= 0.9) & (F.length("t") < 220) & article.isNull(), F.col("t"))
    x = lines.select(doc, "line", "t", article.alias("article"), number.alias("number"), title.alias("title"))
    f = forward_fill(x, [doc], ["line"], "article", "title")
    w = Window.partitionBy(doc, "article_filled").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    f = f.withColumn("n", F.count("number").over(w)).where("n > 0 and title is null and article is null")
    g = f.groupBy(doc, F.col("article_filled").alias("article"), "n").agg(F.max("number").alias("section"), F.min_by("title_filled", "line").alias("catchline"), F.array_sort(F.collect_list(F.struct("line", "t"))).alias("m"))
    body = F.array_join(F.transform("m", lambda y: y["t"]), " ")
    g = g.select(doc, "article", "section", "catchline", body.alias("body"))
    history = F.nullif(F.regexp_extract("body", r"(\[[^\]]*\])\s*$", 1), F.lit(""))
    return g.withColumn("history", history).withColumn("repealed", F.col("body").rlike(r"(?i)^Section \d+\.\s*\[?Repealed"))


def word_lines(words: DataFrame, page: str, gutter: float, tolerance: float = 3.5, least_size: float = 9.0) -> DataFrame:
    """Words with geometry (page, x0, x1, top, size, text) as lines per column: page, side, line, top, text.

    A word belongs to the column of its centre. Small digits are marks and left out. A line holds the words within `tolerance` of its first word's top: an
    aggregate carries that top along one column of one page, which bounds it."""
    side = F.when((F.col("x0") + F.col("x1")) / 2 < gutter, 0).otherwise(1)
    w = words.where(~((F.col("size") < least_size) & F.col("text").rlike(r"^\d+$"))).withColumn("side", side)
    g = w.groupBy(page, "side").agg(F.array_sort(F.collect_list(F.struct("top", "x0", "text"))).alias("ws"))
    start = F.struct(F.lit(-1e9).cast("double").alias("first"), F.lit(-1).alias("line"), F.array().cast("array<struct<line: int, top: double, x0: double, text: string>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        new = x["top"] - acc["first"] > tolerance
        line = F.when(new, acc["line"] + 1).otherwise(acc["line"])
        first = F.when(new, x["top"]).otherwise(acc["first"])
        return F.struct(first.alias("first"), line.alias("line"), F.array_append(acc["out"], F.struct(line.alias("line"), first.alias("top"), x["x0"].alias("x0"), x["text"].alias("text"))).alias("out"))

    x = g.select(page, "side", F.inline(F.aggregate("ws", start, step, lambda a: a["out"])))
    x = x.groupBy(page, "side", "line").agg(F.min("top").alias("top"), F.array_sort(F.collect_list(F.struct("x0", "text"))).alias("m"))
    return x.select(page, "side", "line", "top", F.array_join(F.transform("m", lambda y: y["text"]), " ").alias("text"))


def directory_rows(lines: DataFrame, order: list[str], by: list[str]) -> DataFrame:
    """A printed directory (text lines in order) as chapters with their title, subtitle and part: by, title, subtitle, part, chapter, catchline.

    A line that is no heading and no chapter continues the chapter before it, over columns and pages."""
    t = F.col("text")
    get = lambda p: F.nullif(F.regexp_extract(t, p, 1), F.lit(""))
    x = lines.select(*by, *order, "text", get(r"(?i)^title\s+(\d+)\b").alias("title"), get(r"(?i)^subtitle\s+(\d+)\b").alias("subtitle"), get(r"(?i)^part\s+([IVXL]+)\b").alias("part"), get(r"^(?:Chapter\s+)?(\d+[A-Z]?)\s+\S").alias("chapter"))
    f = forward_fill(x, by, order, "title", "subtitle")
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a new title or subtitle ends a part
    f = f.withColumn("_g", F.count(F.coalesce("title", "subtitle")).over(w))
    v = Window.partitionBy(*by, "_g").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    f = f.withColumn("part_filled", F.last("part", ignorenulls=True).over(v))
    heading = F.coalesce("title", "subtitle", "part").isNotNull()
    f = f.withColumn("run", F.sum(F.when(heading | F.col("chapter").isNotNull(), 1).otherwise(0)).over(w)).where(~heading)
    rest = F.when(F.col("chapter").isNotNull(), F.regexp_replace("text", r"^(?:Chapter\s+)?\d+[A-Z]?\s+", "")).otherwise(F.col("text"))
    f = f.withColumn("rest", rest).groupBy(*by, "run").agg(
        F.max("chapter").alias("chapter"), F.max("title_filled").alias("title"), F.max("subtitle_filled").alias("subtitle"), F.max("part_filled").alias("part"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "rest"))), lambda y: y["rest"]), " ").alias("catchline"),
    )
    return f.where("chapter is not null").select(*by, "title", "subtitle", "part", "chapter", "catchline")


def keyed_lists(rows: DataFrame, order: list[str], by: list[str]) -> DataFrame:
    """Table rows of a key column and a list column: an empty key continues the key above it, over columns and pages. by, key, list."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    key = F.nullif(F.trim("key"), F.lit(""))
    x = rows.withColumn("_k", key).withColumn("run", F.count("_k").over(w)).where("run > 0")
    g = x.groupBy(*by, "run").agg(F.max("_k").alias("key"), F.array_sort(F.collect_list(F.struct(*order, F.col("val")))).alias("m"))
    return g.select(*by, "run", "key", F.array_join(F.transform(F.filter("m", lambda y: F.trim(y["val"]) != ""), lambda y: F.trim(y["val"])), " ").alias("list"))


def session_laws(rows: DataFrame, order: list[str], by: list[str]) -> DataFrame:
    """`Act N` under a year of its own row: by, year, act; the year is carried forward within a table and not beyond it."""
    year = F.nullif(F.regexp_extract("key", r"\b((?:18|19|20)\d{2})\b", 1), F.lit(""))
    act = F.nullif(F.regexp_extract("key", r"(?i)\bAct\s+(\d+)", 1), F.lit(""))
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("year", F.last(year, ignorenulls=True).over(w)).withColumn("act", act).where("act is not null").select(*by, *order, "year", "act")


def footnotes(chapters: DataFrame, notes: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Chapters with the note of their mark, and notes whose mark no chapter bears."""
    return chapters.join(notes, [*by, "mark"], "left"), notes.join(chapters.select(*by, "mark"), [*by, "mark"], "left_anti")
