"""Citations in text.

Finding them needs the claims of earlier patterns and the places of matches, so one Arrow pass over the text emits spans;
everything behind it is relational. Statutes are read by one scanner of lexemes and a small grammar; a
citation that overlaps a claimed span is rejected whole. In rules claimed text is blanked out before the next pattern runs.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions.ids import SECTION
from lexloom.functions.text import DASHES

_TO_HYPHEN = str.maketrans({c: "-" for c in DASHES})
SEC = SECTION

# Words that open a citation, that stand between its members, and the names of the constitutions and rules.
OPENING = {"section": "section", "sections": "section", "chapter": "chapter", "chapters": "chapter"}
TO, JOIN, DETAIL = ("to", "through", "-"), (",", ";", "and", "or"), {"usc": ("section", "sections", "sec", "secs"), "cfr": ("section", "sections", "part", "parts")}
PHRASES = {"rules": "hawaii administrative rules", "state": "state constitution", "us": "constitution of the united states", "us2": "united states constitution", "law": "public law"}
#: Kinds of citations in order of precedence: what an earlier kind claims rejects an overlapping later one whole.
PRECEDENCE = ("range", "list", "chapters", "part", "usc", "cfr", "law", "har", "state", "federal")

_KEYWORDS = sorted({*OPENING, *(w for p in PHRASES.values() for w in p.split()), *DETAIL["usc"], *DETAIL["cfr"], "to", "through", "and", "or", "title", "article"}, key=len, reverse=True)
_LEXEME = re.compile(
    rf"(?P<section>{SECTION})|(?P<number>\d+[A-Z]?(?![^\W_]))|(?P<code>(?:U\.?\s?S|C\.?\s?F)\.?\s?[CR]\.?(?-i:(?![a-z])))|(?P<roman>(?<!\w)[IVXL]+(?!\w))|(?P<word>(?<!\w)(?:{'|'.join(_KEYWORDS)})(?!\w))"
    r"|(?P<pin>\([a-z0-9]{1,4}\))|(?P<sign>§§?)|(?P<mark>[,;-])",
    re.I,
)
_DIGITS_END, _LEADING, _DETAIL, _RULE_NUMBER = re.compile(r"\d+$"), re.compile(r"\d+[A-Z]?\b", re.I), re.compile(r"\d[\w\-]*"), re.compile(r"[\d\-]+")
_OF_STATE = re.compile(r"[^.]{0,60}?constitution\s+of\s+the\s+State", re.I)
_US_SIGN = re.compile(r"\bU\.S\.\s+$", re.I)

#: Characters of context on either side.
AROUND = 110

Cite = tuple[str, str, str, int, int]  # kind, target, raw, start, end


def _flat(s: str) -> str:
    return " ".join(s.split())


class Lexemes:
    """The parts of a text that citations consist of, with their places; what lies between two of them decides whether they belong together."""

    def __init__(self, text: str):
        self.text = text
        self.kind, self.form, self.at, self.end = [], [], [], []
        for m in _LEXEME.finditer(text):
            self.kind.append(m.lastgroup)
            self.form.append(m.group().lower())
            self.at.append(m.start())
            self.end.append(m.end())

    def joined(self, i: int, blank: bool = False) -> bool:
        """Whether lexeme i follows the one before it over nothing but blanks (at least one, if asked for)."""
        if not 0 < i < len(self.kind):
            return False
        gap = self.text[self.end[i - 1] : self.at[i]]
        return gap.isspace() or not gap and not blank

    def phrase(self, i: int, words: str) -> int:
        """The index behind a phrase that begins at i, or 0."""
        for n, w in enumerate(words.split()):
            if i + n >= len(self.form) or self.form[i + n] != w or n and not self.joined(i + n, True):
                return 0
        return i + len(words.split())

    def members(self, i: int, read: Callable[[int], tuple[str, int, bool] | None], pins: bool) -> tuple[list[str], int]:
        """A list from i on: its members and where it ends. read gives a member's number, its end and whether the list may go on; pins: subsections may follow."""
        out, end = [], -1
        while i < len(self.kind) and (got := read(i)):
            number, end, more = got
            out.append(number)
            i += 1
            while pins and self.joined(i) and self.kind[i] == "pin":
                end = self.end[i]
                i += 1
            if not more or not self.joined(i) or self.form[i] not in JOIN:
                break
            i += 1
            if self.joined(i) and self.form[i] in ("and", "or"):
                i += 1
            if not self.joined(i):
                break
        return out, end

    def section(self, i: int) -> tuple[str, int, bool] | None:
        return (self.form[i].upper(), self.end[i], True) if self.kind[i] == "section" else None

    def chapter(self, i: int) -> tuple[str, int, bool] | None:
        """A chapter number, which is none where a code of federal law follows it; of a longer number the first part."""
        if self.kind[i] == "number":
            return None if self.joined(i + 1, True) and self.kind[i + 1] == "code" else (self.form[i].upper(), self.end[i], True)
        m = _LEADING.match(self.text, self.at[i]) if self.kind[i] == "section" else None
        return (m.group().upper(), m.end(), False) if m else None


Found = tuple[str, int, int, list[tuple[str, str]]]  # kind of PRECEDENCE, start, end, targets


def _opened(x: Lexemes, i: int, chapter: str | None, compat: bool) -> Iterator[Found]:
    """Citations that the word, sign, number or code at i opens."""
    form, kind, start = x.form[i], x.kind[i], x.at[i]
    if OPENING.get(form) == "section" or kind == "sign":
        if kind != "sign" and x.joined(i + 2, True) and x.form[i + 2] in TO and x.joined(i + 1, True) and x.joined(i + 3, True) and x.kind[i + 1] == x.kind[i + 3] == "section":
            yield "range", start, x.end[i + 3], [("hrs_section", x.form[k].upper()) for k in (i + 1, i + 3)]
        elif x.joined(i + 1, kind != "sign"):
            found, end = x.members(i + 1, x.section, True)
            if found:
                yield "list", start, end, [("hrs_section", n) for n in found]
    elif OPENING.get(form) == "chapter" and x.joined(i + 1, True):
        found, end = x.members(i + 1, x.chapter, False)
        if found:
            yield "chapters", start, end, [("hrs_chapter", "ch:" + n) for n in found]
    elif form == "part" and x.text[start : x.end[i]] == "part" and x.joined(i + 1, True) and x.kind[i + 1] == "roman" and x.text[x.at[i + 1] : x.end[i + 1]].isupper():
        of, end = chapter, x.end[i + 1]
        k = i + 2
        if m := re.compile(r"\s+of\s+chapter\s+(\d+[A-Z]?)", re.I).match(x.text, end):
            of, end = chapter if compat else m[1].upper(), m.end()
        if of:
            yield "part", start, end, [("hrs_part", f"part:{of}:{x.form[k - 1].upper()}")]
    elif kind == "code" and x.joined(i, True) and (title := _DIGITS_END.search(x.text, 0, x.end[i - 1])):
        code = "usc" if form[0] == "u" else "cfr"
        k, end = i, x.end[i]
        if x.joined(i + 1) and (x.kind[i + 1] == "sign" or x.form[i + 1] in DETAIL[code]):
            k = i + 1
            while x.kind[k] == "sign" and k + 1 < len(x.kind) and x.kind[k + 1] == "sign" and x.at[k + 1] == x.end[k]:
                k += 1
        at = x.end[k] + (x.form[k] in ("sec", "secs") and x.text[x.end[k] : x.end[k] + 1] == ".")
        while at < len(x.text) and x.text[at].isspace():
            at += 1
        number = _DETAIL.match(x.text, at)
        end = number.end() if number else at if k > i else end
        yield code, title.start(), end, [(code, f"{code}:{title.group()}" + (f":{number.group()}" if number else ""))]
    elif (k := x.phrase(i, PHRASES["law"])) and x.joined(k, True) and x.kind[k] == "section" and (m := re.compile(r"(\d+)-(\d+)").match(x.text, x.at[k])):
        yield "law", start, m.end(), [("public_law", f"pl:{m[1]}-{m[2]}")]
    elif form == "title" and x.joined(i + 1, True) and x.kind[i + 1] == "number" and x.form[i + 1].isdigit():
        k = i + 2
        if x.joined(k) and x.form[k] == ",":
            k += 1
        if x.joined(k, x.form[k - 1] != ","):
            if behind := x.phrase(k, PHRASES["rules"]):
                yield "har", start, x.end[behind - 1], [("har", f"har:{x.form[i + 1]}")]
            elif x.form[k] == "chapter" and x.joined(k + 1, True) and (m := _RULE_NUMBER.match(x.text, x.at[k + 1])):
                yield "har", start, m.end(), [("har", f"har:{x.form[i + 1]}:{m.group()}")]
    elif form == "article" or (k := x.phrase(i, PHRASES["state"])):
        k = i if form == "article" else k + (x.joined(k) and x.form[k] == ",")
        place = _article(x, k)
        if place and (end := place[2] if form != "article" else (m.end() if (m := _OF_STATE.match(x.text, place[2])) else 0)):
            yield "state", start, end, [("hi_const", f"hiconst:{place[0]}:{place[1]}")]
    elif (k := x.phrase(i, PHRASES["us"]) or x.phrase(i, PHRASES["us2"])) or form == "constitution" and (m := _US_SIGN.search(x.text, max(0, start - 40), start)):
        yield "federal", start if k else m.start(), x.end[k - 1] if k else x.end[i], [("us_const", "usconst")]


def _article(x: Lexemes, i: int) -> tuple[str, str, int] | None:
    """Article and section of a constitution from the word `article` at i on, and the end."""
    if i >= len(x.kind) or x.form[i] != "article" or not x.joined(i + 1, True) or x.kind[i + 1] != "roman":
        return None
    k = i + 2 + (x.joined(i + 2) and x.form[i + 2] == ",")
    if x.joined(k, x.form[k - 1] != ",") and x.form[k] == "section" and x.joined(k + 1, True) and x.kind[k + 1] in ("number", "section"):
        m = re.compile(r"\d+").match(x.text, x.at[k + 1])
        return x.form[i + 1].upper(), m.group(), m.end()
    return None


def statute_citations(text: str, chapter: str | None = None, compat: bool = False) -> list[Cite]:
    """Citations in statute text, by kind in order of precedence, then by place. `compat` names the citing chapter for every part, as older outputs did."""
    t = text.translate(_TO_HYPHEN)
    x = Lexemes(t)
    found = [f for i in range(len(x.kind)) for f in _opened(x, i, chapter, compat)]
    taken = bytearray(len(t))
    out: list[Cite] = []
    for _, s, e, targets in sorted(found, key=lambda f: (PRECEDENCE.index(f[0]), f[1])):
        if not any(taken[s:e]):
            taken[s:e] = b"\1" * (e - s)
            out += [(k, target, _flat(t[s:e]), s, e) for k, target in targets]
    return out


# Reporters of cases, opinions and law reviews.
CASE = r"\b(?P<vol>\d{1,4})\s+(?P<rep>H\.\s?App\.|Haw\.\s?App\.|Haw\.|H\.|P\.(?:2d|3d)?|U\.S\.(?!C)|S\.\s?Ct\.|L\.\s?Ed\.(?:\s?2d)?|F\.\s?Supp\.(?:\s?[23]d)?|F\.(?:2d|3d|4th)?)\s+(?P<page>\d{1,5})"
SEP = r"\s*(?:,|;|\band\b|\bor\b)(?:\s*(?:and|or)\b)?\s*"
_SPLIT = re.compile(SEP, re.I)
_RULE_RANGE = re.compile(r"(?P<a>\b\d+-\d+[A-Z]?-\d+(?:\.\d+)?)\s+(?:to|through)\s+(?P<b>\d+-\d+[A-Z]?-\d+(?:\.\d+)?)", re.I)
_RULE = re.compile(r"\b\d+-\d+[A-Z]?-\d+(?:\.\d+)?(?=\W|$)")
_RULE_CHAPTER = re.compile(r"\bchapters?\s+(?P<list>\d+-\d+[A-Z]?(?:" + SEP + r"\d+-\d+[A-Z]?)*)(?![-\d])", re.I)
_COLON = re.compile(r"\b\d{3}[A-Z]?:\d+[A-Z]?-\d+(?:\.\d+)?")
_CASE = re.compile(CASE)
_YEAR = re.compile(r"\s*\((\d{4})\)")
_OPINION = re.compile(r"Att(?:'|’)?y\.?\s+Gen\.?\s+Op(?:s|in)?\.?\s+(?:No\.\s*)?(\d+-\d+)", re.I)
_REVIEW = re.compile(r"(?P<vol>\d+)\s+(?P<rep>UH\s+L\.\s?Rev\.|U\.?\s?Haw\.?\s+L\.\s?Rev\.|HBJ|Haw\.\s?B\.\s?J\.)\s+(?P<page>\d+)")


def rule_citations(text: str, chapter: str | None = None) -> list[Cite]:
    """Citations in rule text: statute numbers with a colon, ranges, single numbers and chapters of rules, then statutes in what remains."""
    t = text.translate(_TO_HYPHEN)
    out: list[Cite] = []

    def claim(pattern: re.Pattern, make: Callable[[re.Match], list[tuple[str, str]]]) -> None:
        nonlocal t

        def blank(m: re.Match) -> str:
            out.extend((k, x, _flat(m.group()), *m.span()) for k, x in make(m))
            return " " * len(m.group())

        t = pattern.sub(blank, t)

    claim(_COLON, lambda m: [("hrs_section", m.group().upper())])
    claim(_RULE_RANGE, lambda m: [("har_section", m["a"].upper()), ("har_section", m["b"].upper())])
    claim(_RULE_CHAPTER, lambda m: [("har_chapter", "ch:" + x.strip().upper()) for x in _SPLIT.split(m["list"]) if x.strip()])
    claim(_RULE, lambda m: [("har_section", m.group().upper())])
    return out + statute_citations(t, chapter)


def case_citations(text: str, _: str | None = None) -> list[Cite]:
    """Reported cases, one for each run of parallel citations (named by its first reporter), opinions and law reviews."""
    out: list[Cite] = []
    run: list[re.Match] = []

    def close() -> None:
        if run:
            a, b = run[0], run[-1]
            year = _YEAR.match(text, b.end())
            end = year.end() if year else b.end()
            out.append(("case", f"case:{a['vol']}-{re.sub(r'[^A-Za-z0-9]', '', a['rep'])}-{a['page']}", _flat(text[a.start() : end]), a.start(), end))
            run.clear()

    for m in _CASE.finditer(text):
        if run and text[run[-1].end() : m.start()].strip(" ,;\n\t"):
            close()
        run.append(m)
    close()
    out += [("ag_opinion", f"agop:{m[1]}", _flat(m.group()), *m.span()) for m in _OPINION.finditer(text)]
    out += [("law_review", f"lrev:{m['vol']}-{re.sub(r'[^A-Za-z0-9]', '', m['rep'])}-{m['page']}", _flat(m.group()), *m.span()) for m in _REVIEW.finditer(text)]
    return out


def opinion_citations(text: str, chapter: str | None = None) -> list[Cite]:
    """Citations in opinions: single rule numbers, each on its own, and chapters of rules, in the name space of rules, then statutes in what remains."""
    t = text.translate(_TO_HYPHEN)
    out = [("har_section", "har:" + m.group().upper(), m.group(), *m.span()) for m in _RULE.finditer(t)]
    t = _RULE.sub(lambda m: " " * len(m.group()), t)
    for m in _RULE_CHAPTER.finditer(t):
        out += [("har_chapter", "har:ch:" + x.strip().upper(), _flat(m.group()), *m.span()) for x in _SPLIT.split(m["list"]) if x.strip()]
    return out + statute_citations(_RULE_CHAPTER.sub(lambda m: " " * len(m.group()), t), chapter)


_NOTE_TOKEN = re.compile(rf"(?P<usc>\d+\s+U\.?\s?S\.?\s?C\.?\s*§*\s*\d[\w\-]*)|(?P<cfr>\d+\s+C\.?\s?F\.?\s?R\.?\s*(?:part|§)*\s*\d[\w\-]*)|(?P<law>P(?:ub)?\.\s?L\.\s*(?:No\.\s*)?\d+-\d+)|(?P<rule>\b\d+-\d+[A-Z]?-\d+(?:\.\d+)?)|(?P<sec>{SEC})|(?:chapters?|ch\.)\s*(?P<chapter>\d+[A-Z]?)", re.I)


def note_tokens(text: str) -> tuple[list[tuple[str, str]], str]:
    """Every citation of an authority note as (kind, target), and what remains of it where that holds a digit."""
    t = text.translate(_TO_HYPHEN)
    out = []
    for m in _NOTE_TOKEN.finditer(t):
        k, v = m.lastgroup, m.group(m.lastgroup)
        nums = re.findall(r"\d[\w\-]*", v)
        out.append({"usc": ("usc", "usc:" + ":".join(nums[:2])), "cfr": ("cfr", "cfr:" + ":".join(nums[:2])), "law": ("public_law", "pl:" + nums[-1]), "rule": ("har_section", v.upper()), "sec": ("hrs_section", v.upper()), "chapter": ("hrs_chapter", "ch:" + v.upper())}[k])
    rest = re.sub(r"\([a-z0-9]{1,4}\)", "", _NOTE_TOKEN.sub(" ", t))
    return out, _flat(rest) if re.search(r"\d", rest) else ""


FAMILIES = {"statute": statute_citations, "rule": rule_citations, "case": case_citations, "opinion": opinion_citations}


def extract(df: DataFrame, key: list[str], text: str, family: str, chapter: str | None = None) -> DataFrame:
    """One row per citation: the key columns, seq (order within the text), kind, target, raw, start, end, context (flat).

    family: `statute`, `rule`, `case` or `opinion`. chapter: a column with the citing chapter, for parts named without one. Null and empty texts give no
    rows, repeated rows repeated citations."""
    find = FAMILIES[family]
    src = df.select(F.struct(*[F.col(f"`{k}`") for k in key]).alias("_key"), F.col(f"`{text}`").alias("_t"), (F.col(chapter) if chapter else F.lit(None)).cast("string").alias("_c")).where(F.col("_t") != "")
    kind = src.schema["_key"].dataType.simpleString()
    names = ["_key", "seq", "kind", "target", "raw", "start", "end", "context"]
    kinds = [pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, out = [], []
            for i, (t, c) in enumerate(zip(b.column("_t").to_pylist(), b.column("_c").to_pylist())):
                for n, (k, x, raw, s, e) in enumerate(find(t, c)):
                    rows.append(i)
                    out.append((n, k, x, raw, s, e, _flat(t[max(0, s - AROUND) : e + AROUND])))
            cols = list(zip(*out)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays([b.column("_key").take(pa.array(rows, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, kinds))], names=names)

    x = src.mapInArrow(run, f"_key {kind}, seq int, kind string, target string, raw string, start int, end int, context string")
    return x.select(*[F.col(f"_key.`{k}`").alias(k) for k in key], *names[1:])


def case_notes(df: DataFrame, key: list[str], text: str, around: int = 400) -> DataFrame:
    """Cases, opinions and reviews cited in editorial notes: the key columns, paragraph, seq, kind, target, raw, context.

    A note is a paragraph between blank lines, read on one line; a run of parallel citations never goes over its end. context is the beginning of
    the paragraph. Null and empty texts give no rows."""
    p = df.select(*[F.col(f"`{k}`") for k in key], F.posexplode(F.split(F.col(f"`{text}`"), r"\n\s*\n")).alias("paragraph", "_p"))
    p = p.select(*key, "paragraph", F.trim(F.regexp_replace("_p", r"(?U)\s+", " ")).alias("_p")).withColumn("_head", F.substring("_p", 1, around))
    return extract(p, [*key, "paragraph", "_head"], "_p", "case").select(*key, "paragraph", "seq", "kind", "target", "raw", F.col("_head").alias("context"))


def note_citations(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """Every citation of authority notes: the key columns, seq, kind, target; what remains of a note and holds a digit comes as kind `leftover`, so that nothing is lost unseen."""
    src = df.select(F.struct(*[F.col(f"`{k}`") for k in key]).alias("_key"), F.col(f"`{text}`").alias("_t")).where(F.col("_t") != "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, out = [], []
            for i, t in enumerate(b.column("_t").to_pylist()):
                tokens, rest = note_tokens(t)
                for n, (k, x) in enumerate([*tokens, ("leftover", rest)] if rest else tokens):
                    rows.append(i)
                    out.append((n, k, x))
            cols = list(zip(*out)) if out else [()] * 3
            yield pa.RecordBatch.from_arrays([b.column("_key").take(pa.array(rows, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.string(), pa.string())))], names=["_key", "seq", "kind", "target"])

    x = src.mapInArrow(run, f"_key {src.schema['_key'].dataType.simpleString()}, seq int, kind string, target string")
    return x.select(*[F.col(f"_key.`{k}`").alias(k) for k in key], "seq", "kind", "target")


def without_self(cites: DataFrame, section: str, chapter: str) -> DataFrame:
    """Citations without those of the citing section and its own chapter."""
    return cites.where((F.col("target") != F.col(section)) & (F.col("target") != F.concat(F.lit("ch:"), F.col(chapter))))


def missed_tokens(texts: DataFrame, key: list[str], text: str, cites: DataFrame, token: str) -> DataFrame:
    """Strict sweep: tokens of a pattern found again, independently of the extractor, that no citation of their text has as target."""
    found = texts.select(*key, F.explode(F.array_distinct(F.regexp_extract_all(F.translate(F.col(text), DASHES, "-" * len(DASHES)), F.lit(token), F.lit(0)))).alias("target"))
    return found.join(cites.select(*key, "target"), [*key, "target"], "left_anti").distinct()


def heal(note: str, attested: list[str]) -> tuple[str, list[tuple[str, str, str]]]:
    """A note whose damaged citations are mended where an independent list attests the right one: the note, and (how, before, after) of each repair.

    A glued digit goes first (`§1111-2` for 11-2 is not touched unless attested), then misread characters, then a lost hyphen."""
    have = {t for _, t in note_tokens(note)[0]}
    log = []
    look = {"0": "[0Oo]", "1": "[1lI|]", "5": "[5Ss]", "8": "[8B]", "6": "[6b]", "-": r"\s*-\s*", ".": r"\s*[.,]\s*"}
    for want in attested:
        if want in have:
            continue
        tries = [
            ("glued", re.compile(rf"(?<!\d)\d(?={re.escape(want)}(?!\d))")),
            ("misread", re.compile("(?<![0-9A-Za-z-])" + "".join(look.get(c, re.escape(c)) for c in want) + "(?![0-9A-Za-z-])")),
            ("hyphen", re.compile(r"(?<![0-9A-Za-z-])" + re.escape(want.replace("-", "")) + r"(?![0-9A-Za-z-])")),
        ]
        for how, pattern in tries:
            if m := pattern.search(note):
                before = note[m.start() : m.end() + (len(want) if how == "glued" else 0)]
                if len(before) > 3 * len(want):
                    continue
                note = note[: m.start()] + ("" if how == "glued" else want) + note[m.end() :]
                log.append((how, before, want))
                break
    return note, log


def heal_notes(notes: DataFrame, key: str, text: str, attested: DataFrame) -> DataFrame:
    """Notes mended where an independent source attests the right citation: key, `text`, and repairs, an array of (how, before, after).

    attested: the key and `target`, the citations that the source has for it; those of one note are few, so they travel with it. A note without an attestor,
    a null and an empty one come out as they are, without repairs. Repeated notes come out repeated."""
    have = attested.where(F.col("target").isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.sort_array(F.collect_set("target")).alias("_want"))
    src = notes.select(F.col(key).alias("_key"), F.col(text).alias("_t")).join(have, F.col("_key") == F.col("_k"), "left").select("_key", "_t", "_want")
    log = pa.list_(pa.struct([("how", pa.string()), ("before", pa.string()), ("after", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [heal(t, want) if t and want else (t, []) for t, want in zip(b.column("_t").to_pylist(), b.column("_want").to_pylist())]
            logs = pa.array([[dict(zip(("how", "before", "after"), r)) for r in d[1]] for d in done], log)
            yield pa.RecordBatch.from_arrays([b.column("_key"), pa.array([d[0] for d in done], pa.string()), logs], names=["k", "t", "repairs"])

    out = src.mapInArrow(run, f"k {src.schema['_key'].dataType.simpleString()}, t string, repairs array<struct<how: string, before: string, after: string>>")
    return out.select(F.col("k").alias(key), F.col("t").alias(text), "repairs")


def runs(spans: DataFrame, by: list[str], start: str, end: str, gap: int = 2) -> DataFrame:
    """Neighbouring spans as runs: a span that begins over `gap` characters behind the end of all before it opens a new run."""
    w = Window.partitionBy(*by).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = spans.withColumn("_new", F.when(before.isNull() | (F.col(start) > before + gap), 1).otherwise(0)).withColumn("run", F.sum("_new").over(w))
    return x.groupBy(*by, "run").agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count(F.lit(1)).alias("members"))
