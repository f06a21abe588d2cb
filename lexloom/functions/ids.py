"""Identifiers in proper form, as Column expressions (no Python in the plan)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that print like a hyphen, and the full-width forms of letters, digits and marks.
HYPHENS = "‐‑‒–—―−﹘﹣－"
WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F))

#: White space, separators, format characters and section signs, none of which belongs to an identifier.
NOISE = r"[\p{Cf}\p{Z}\s§]+"
LEAD = r"(?i)^(sections?|secs?\.)"
LAYER = r"^(hrs|har|usc)(:|(?=\d))"


def squeeze(c: Column) -> Column:
    """Hyphens of one kind, narrow forms, no blanks and no invisible characters."""
    c = F.translate(c, HYPHENS + WIDE, "-" * len(HYPHENS) + NARROW)
    return F.regexp_replace(F.regexp_replace(c, NOISE, ""), LEAD, "")


def bare(c: Column) -> Column:
    """A number without its subsections in parentheses, in capital letters."""
    return F.upper(F.regexp_replace(c, r"\(.*$", ""))


def proper_section(c: Column, fallback: Column | None = None) -> Column:
    """`layer:num` of a section in any of its spellings, e.g. ` § 9–1‑2(a)` becomes `har:9-1-2`.

    A number without a layer is of `har` if it has two hyphens and of `hrs` if it has one; otherwise it takes the
    layer `fallback` (by default `hrs`). Null stays null; an empty text becomes the layer with an empty number.
    Most numbers are in proper form but for the layer, which one look tells; only the others go through all steps."""
    proper, two, one = (c.rlike(rf"^{p}$") for p in (rf"(?:hrs|har):{_PLAIN}(?:-{_TAIL})*", rf"{_PLAIN}-{_TAIL}", _PLAIN))
    return F.when(proper, c).when(two, F.concat(F.lit("har:"), c)).when(one, F.concat(F.lit("hrs:"), c)).otherwise(_any_section(c, fallback))


_TAIL = r"[0-9A-Z.]+"
_PLAIN = rf"\d[0-9A-Z.:]*-{_TAIL}"


def _any_section(c: Column, fallback: Column | None) -> Column:
    s = squeeze(c)
    low = F.lower(s)
    given = F.regexp_extract(low, r"^(hrs|har):?", 1)
    num = bare(F.regexp_replace(s, r"(?i)^(hrs|har):?", ""))
    hyphens = F.length(num) - F.length(F.replace(num, F.lit("-"), F.lit("")))
    layer = (
        F.when(given != "", given)
        .when(hyphens == 2, F.lit("har"))
        .when(hyphens == 1, F.lit("hrs"))
        .otherwise(F.coalesce(fallback, F.lit("hrs")) if fallback is not None else F.lit("hrs"))
    )
    return F.when(c.isNotNull(), F.concat(layer, F.lit(":"), num))


def proper_target(c: Column) -> Column:
    """Like proper_section, but also for chapters (`hrs:ch:1A`) and federal citations (`usc:5:552`)."""
    s = squeeze(c)
    low = F.lower(s)
    chapter = r"^(hrs|har):?ch:(.+)$"
    federal = r"^usc:(.+)$"
    return (
        F.when(low.rlike(chapter), F.concat(F.regexp_extract(low, chapter, 1), F.lit(":ch:"), bare(F.regexp_extract(low, chapter, 2))))
        .when(low.rlike(federal), F.concat(F.lit("usc:"), bare(F.regexp_extract(low, federal, 1))))
        .otherwise(proper_section(c))
    )


# Fixed value: the forms of a statute section number.
SECTION = r"(?:\d{3}[A-Z]?:\d+[A-Z]?-\d+(?:\.\d+)?|\d+[A-Z]?-\d+(?:\.\d+)?)"


def statute_key(num: Column) -> Column:
    """Natural order of statute numbers: (chapter, its letter, numbers behind)."""
    chapter = F.regexp_extract(num, r"^(\d+)", 1)
    rest = F.regexp_extract_all(F.regexp_replace(num, r"^\d+[A-Za-z]*", ""), F.lit(r"\d+"), F.lit(0))
    return F.struct(F.when(chapter != "", chapter.cast("long")).otherwise(F.lit(10**9)).alias("chapter"), F.regexp_extract(num, r"^\d+([A-Za-z]*)", 1).alias("letter"), F.transform(rest, lambda x: x.cast("long")).alias("rest"))


def rule_key(num: Column) -> Column:
    """Natural order of rule numbers: per part (number, decimals or -1, letter); what can't be read comes last."""
    def part(x: Column) -> Column:
        n = F.regexp_extract(x, r"^(\d+)", 1)
        d = F.regexp_extract(x, r"^\d+[A-Za-z]*\.(\d+)", 1)
        return F.struct(F.when(n != "", n.cast("long")).otherwise(F.lit(10**9)).alias("n"), F.when(d != "", d.cast("long")).otherwise(F.lit(-1)).alias("d"), F.regexp_extract(x, r"([A-Za-z]*)$", 1).alias("s"))

    return F.transform(F.split(num, "-"), part)


def valid_section(c: Column) -> Column:
    """A statute number without its pin cite in capital letters, or null if it is none."""
    s = F.upper(F.regexp_replace(F.trim(c), r"\s*\([^)]{1,6}\)\s*$", ""))
    return F.when(s.rlike(f"^{SECTION}$"), s)


def chapter_id(title: Column, number: Column) -> Column:
    """`title-number`, or the number as it is where it has its title already."""
    return F.when(number.contains("-"), number).otherwise(F.concat_ws("-", title, number))


def namespaced(kind: Column, target: Column) -> Column:
    """The target of a citation in its name space, by kind: `hrs:…`, `har:…`, `hrs:ch:…`, others as they are."""
    number = F.regexp_replace(target, r"^(ch:|har:|hrs:)", "")
    article, whole = r"(?i)^art\.?\s*([IVXL]+),?\s*(?:§|sec\.)\s*(\d+(?:\.\d+)?)$", r"(?i)^art\.?\s*([IVXL]+)$"
    return (
        F.when(kind.isin("hrs_section", "hrs_section_colon"), F.concat(F.lit("hrs:"), bare(number)))
        .when(kind == "har_section", F.concat(F.lit("har:"), bare(number)))
        .when(kind == "hrs_chapter", F.concat(F.lit("hrs:ch:"), number))
        .when(kind == "har_chapter", F.concat(F.lit("har:ch:"), number))
        .when((kind == "hi_const") & target.rlike(article), F.concat_ws(":", F.lit("hiconst"), F.regexp_extract(target, article, 1), F.regexp_extract(target, article, 2)))
        .when((kind == "hi_const") & (F.lower(F.trim(target)) == "preamble"), F.lit("hiconst:preamble"))
        .when((kind == "hi_const") & target.rlike(whole), F.concat(F.lit("hiconst:art:"), F.regexp_extract(target, whole, 1)))
        .when(kind == "hrs_part", F.concat(F.lit("hrs:"), F.regexp_replace(target, "^hrs:", "")))
        .otherwise(target)
    )


def pin_cite(target: Column) -> Column:
    """The subsections in parentheses behind a number, or null."""
    return F.nullif(F.regexp_extract(target, r"(\(.*\))\s*$", 1), F.lit(""))


def session_law_id(year: Column, act: Column, special: Column) -> Column:
    return F.concat(F.lit("slh:"), year.cast("string"), F.lit(":"), act.cast("string"), F.when(F.coalesce(special, F.lit(False)), F.lit(":ss")).otherwise(F.lit("")))


def file_section(name: Column) -> Column:
    """The section number in a file name such as `HRS_0011-0102_.htm`: leading zeros go, further groups are decimals; old copies give null."""
    clean = F.translate(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), "\u00ad", "")
    m = r"(?i)^HRS_?(\d+)([A-Z]?)(?:-(\d+)([A-Z]?))?-(\d+)((?:_\d+)*)_?\.(?:htm|html|docx)$"
    plain = lambda i: F.regexp_replace(F.regexp_extract(clean, m, i), r"^0+(?=\d)", "")
    decimals = F.array_join(F.transform(F.filter(F.split(F.regexp_extract(clean, m, 6), "_"), lambda x: x != ""), lambda x: F.regexp_replace(x, r"^0+(?=\d)", "")), "")
    article = F.when(plain(3) != "", F.concat(F.lit(":"), plain(3), F.upper(F.regexp_extract(clean, m, 4)))).otherwise(F.lit(""))
    tail = F.when(decimals != "", F.concat(F.lit("."), decimals)).otherwise(F.lit(""))
    return F.when(clean.rlike(m) & ~clean.contains("[OLD]"), F.concat(plain(1), F.upper(F.regexp_extract(clean, m, 2)), article, F.lit("-"), plain(5), tail))


def restore_dash(c: Column) -> Column:
    """A number that lost its hyphen, where only one reading is possible: a letter between the digits (`11A5` is `11A-5`)."""
    return F.when(c.rlike(r"^\d{1,3}[A-Z]\d+(\.\d+)?$"), F.regexp_replace(c, r"^(\d{1,3}[A-Z])(\d)", "$1-$2")).otherwise(c)


def classify_key(c: Column) -> Column:
    """What a key of a printed table is: a struct of kind, value and repealed. The first rule that fits decides."""
    s = F.trim(c)
    repealed = F.coalesce(s.rlike(r"\[R\]"), F.lit(False))
    v = F.trim(F.regexp_replace(s, r"\[R\]", ""))
    chapter = r"(?i)^(?:ch\.?|chapter)\s+(\d+[A-Z]?)$"
    part = r"(?i)^(?:ch\.?|chapter)\s+(\d+[A-Z]?),?\s+(?:pt\.?|part)\s+([IVXL]+)$"
    usc = r"(?i)^(\d+)\s+U\.?S\.?C\.?\s*§*\s*(\d[0-9A-Za-z\-]*)"
    num = restore_dash(bare(v))
    kinds = [
        (s.isNull() | (s == ""), "skip", F.lit(None).cast("string")),
        (v.rlike(r"(?i)^(?:hawaii\s+constitution|hawaiian\s+homes\s+commission\s+act|united\s+states\s+constitution)$"), "group", v),
        (v.rlike(part), "hrs_chapter_part", F.concat_ws(":", F.regexp_extract(v, part, 1), F.upper(F.regexp_extract(v, part, 2)))),
        (v.rlike(chapter), "hrs_chapter", F.regexp_extract(v, chapter, 1)),
        (v.rlike(usc), "usc", F.concat_ws(":", F.lit("usc"), F.regexp_extract(v, usc, 1), F.regexp_extract(v, usc, 2))),
        (num.rlike(r"^\d+[A-Z]?:\d+[A-Z]?-\d+(\.\d+)?$"), "hrs_section_colon", num),
        (num.rlike(r"^\d+[A-Z]?-\d+(\.\d+)?$"), "hrs_section", num),
        (num.rlike(r"^\d+-\d+[A-Z]?-\d+(\.\d+)?$"), "har_section", num),
    ]
    kind = value = None
    for test, k, x in kinds:
        kind = F.when(test, k) if kind is None else kind.when(test, k)
        value = F.when(test, x) if value is None else value.when(test, x)
    return F.struct(kind.otherwise("prose").alias("kind"), value.otherwise(v).alias("value"), repealed.alias("repealed"))


def display(kind: Column, target: Column) -> Column:
    """How a target reads in a report."""
    return (
        F.when(kind == "hrs_section", F.concat(F.lit("HRS §"), F.regexp_replace(target, "^hrs:", "")))
        .when(kind == "har_section", F.concat(F.lit("HAR §"), F.regexp_replace(target, "^har:", "")))
        .when(kind == "hrs_chapter", F.concat(F.lit("HRS chapter "), F.regexp_replace(target, "^(hrs:)?ch:", "")))
        .when(kind == "hrs_part", F.regexp_replace(target, r"^(?:hrs:)?part:([^:]*):(.*)$", "HRS chapter $1, part $2"))
        .when(kind == "har_chapter", F.concat(F.lit("HAR chapter "), F.regexp_replace(target, "^(har:)?ch:", "")))
        .when(kind == "har", F.regexp_replace(F.regexp_replace(target, r"^har:(\d+):(.*)$", "HAR title $1, chapter $2"), r"^har:(\d+)$", "HAR title $1"))
        .when(kind == "hi_const", F.regexp_replace(target, r"^hiconst:([IVXL]+):(.*)$", "Haw. Const. art. $1, §$2"))
        .when(kind == "us_const", F.lit("U.S. Constitution"))
        .when(kind == "usc", F.regexp_replace(target, r"^usc:(\d+):(.*)$", "$1 U.S.C. §$2"))
        .when(kind == "cfr", F.regexp_replace(target, r"^cfr:(\d+):(.*)$", "$1 C.F.R. §$2"))
        .when(kind == "session_law", F.regexp_replace(target, r"^slh:(\d+):(\d+).*$", "Act $2, Session Laws $1"))
        .otherwise(target)
    )
