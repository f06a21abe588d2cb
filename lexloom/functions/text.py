"""Text functions as Column expressions. Null in, null out; patterns are Unicode-aware where it matters."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What the numbers 128 to 159 mean in pages, by the Windows code page; unassigned ones stay.
WINDOWS = [bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(128, 160)]
# Fixed values.
DASHES = "‐‑‒–—―−"
MONTHS = {"january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12}


def unescape(c: Column) -> Column:
    """Entities as characters, by name (all of HTML, also the old ones without a semicolon where they end at a word's end) or by number; unknown ones stay.

    The table of names is one folded constant. Numbers outside of Unicode, of surrogates and 0 give U+FFFD; 128 to 159 mean the Windows characters."""
    names = F.from_json(F.lit(json.dumps(html5)), "map<string, string>")

    def one(x: Column, i: Column) -> Column:
        hexa, deci = F.regexp_extract(x, r"^#[xX]([0-9a-fA-F]{1,8});?", 1), F.regexp_extract(x, r"^#([0-9]{1,9});?", 1)
        n = F.when(hexa != "", F.conv(hexa, 16, 10).cast("bigint")).when(deci != "", deci.cast("bigint"))
        windows = F.element_at(F.array(*[F.lit(w) for w in WINDOWS]), (n - 127).cast("int"))
        char = F.when((n <= 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF), F.lit("\ufffd")).when(n.between(128, 159), windows).otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
        name = F.regexp_extract(x, r"^([A-Za-z][A-Za-z0-9]*;?)", 1)
        rest = F.when(n.isNotNull(), F.regexp_replace(x, r"^#(?:[xX][0-9a-fA-F]{1,8}|[0-9]{1,9});?", "")).otherwise(F.substr(x, F.length(name) + 1))
        return F.when(i == 0, x).when(n.isNotNull(), F.concat(char, rest)).otherwise(F.coalesce(F.concat(F.try_element_at(names, name), rest), F.concat(F.lit("&"), x)))

    return F.when(c.contains("&"), F.array_join(F.transform(F.split(c, "&"), one), "")).otherwise(c)


def strip_html(c: Column) -> Column:
    """HTML as text: scripts and styles go, block ends become line breaks, cells are parted by blanks, entities are read."""
    c = F.regexp_replace(c, r"(?is)<(script|style)\b.*?</(script|style)\s*>", "")
    c = F.regexp_replace(c, r"(?i)<br\s*/?>|</(p|div|tr|h[1-6])\s*>", "\n")
    c = F.regexp_replace(c, r"(?i)</td\s*>", " ")
    c = unescape(F.regexp_replace(c, r"<[^>]*>", ""))
    c = F.translate(c, "\u00a0\ufeff", " ")
    c = F.regexp_replace(c, r"[ \t]+", " ")
    c = F.array_join(F.transform(F.split(c, "\n"), lambda x: F.trim(x)), "\n")
    return F.regexp_replace(F.regexp_replace(c, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def strip_tags(c: Column) -> Column:
    """Tags as blanks, on one line."""
    return flatten(unescape(F.regexp_replace(c, r"<[^>]*>", " ")))


def clean(c: Column) -> Column:
    """A fragment of HTML on one line: line breaks part words, other tags vanish, entities are read."""
    return flatten(unescape(F.regexp_replace(F.regexp_replace(c, r"(?i)<br\s*/?>", "\n"), r"<[^>]*>", "")))


def flatten(c: Column) -> Column:
    """White space as single blanks, none at the ends."""
    return F.trim(F.regexp_replace(c, r"[\s\p{Z}]+", " "))


def dewrap(c: Column) -> Column:
    """On one line, with a number that was cut behind its hyphen made whole."""
    return F.regexp_replace(flatten(c), r"-\s+(?=\d)", "-")


def normalize_dashes(c: Column, drop_soft: bool = False) -> Column:
    """Seven dashes as ASCII hyphens; optionally without soft hyphens."""
    return F.translate(c, DASHES + ("\u00ad" if drop_soft else ""), "-" * len(DASHES))


def slug(layer: Column, num: Column) -> Column:
    return F.concat(F.lower(layer), F.lit("-"), F.lower(F.regexp_replace(num, r"[^0-9A-Za-z.\-]", "-")))


def reporter_slug(c: Column) -> Column:
    return F.regexp_replace(c, r"[^A-Za-z0-9]", "")


def caps_ratio(c: Column) -> Column:
    """Capital letters among all letters; 0 without letters."""
    letters = F.regexp_count(c, F.lit(r"\p{L}"))
    return F.when(letters > 0, F.regexp_count(c, F.lit(r"\p{Lu}")) / letters).otherwise(F.when(c.isNotNull(), F.lit(0.0)))


def long_date(c: Column) -> Column:
    """The first date of the form `Month D, YYYY`."""
    pattern = r"(?i)\b(" + "|".join(MONTHS) + r")\s+(\d{1,2}),\s+(\d{4})\b"
    month = F.lower(F.regexp_extract(c, pattern, 1))
    number = F.coalesce(*[F.when(month == name, F.lit(n)) for name, n in MONTHS.items()])
    return F.when(month != "", F.make_date(F.regexp_extract(c, pattern, 3).cast("int"), number, F.regexp_extract(c, pattern, 2).cast("int")))


def printed_date(c: Column, pivot: int = 30) -> Column:
    """`M/D/YY` or `M/D/YYYY` as a date; two-digit years up to `pivot` belong to this century. Impossible dates are null."""
    part = [F.try_element_at(F.split(c, "/"), F.lit(i)).try_cast("int") for i in (1, 2, 3)]
    year = F.when(part[2] >= 100, part[2]).when(part[2] <= pivot, part[2] + 2000).otherwise(part[2] + 1900)
    return F.try_to_date(F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(part[0].cast("string"), 2, "0"), F.lpad(part[1].cast("string"), 2, "0")), "yyyy-MM-dd")


#: A date as printed, and a date as stamped: a month's letters, a day of two signs, a year with stray blanks.
PRINTED, STAMP = r"\d{1,2}/\d{1,2}/\d{2,4}", r"\b[A-Za-z]{2,4}\s*[O0-9]\s*\d\s*[,.]?\s*[12]\s*[09]\s*\d\s*\d\b"


def stamp_to_date(c: Column) -> Column:
    """A stamp as it would be printed, `12/9/2016` for `DEC 0 9 2016`; an unreadable month gives null. The month is told by its last two letters."""
    s = F.regexp_replace(c, r"[\s,.]", "")
    p = r"^([A-Za-z]+?)([Oo0-9]\d)([12][09]\d\d)$"
    tail = F.lower(F.right(F.regexp_extract(s, p, 1), F.lit(2)))
    month = F.coalesce(*[F.when(tail == n[:3][-2:], F.lit(m)) for n, m in MONTHS.items()])
    return F.when(month.isNotNull(), F.concat_ws("/", month.cast("string"), F.translate(F.regexp_extract(s, p, 2), "Oo", "00").cast("int").cast("string"), F.regexp_extract(s, p, 3)))


def dates_of(c: Column) -> Column:
    """All dates of a note in order, as printed; stamped ones are read, and those with an unreadable month left out."""
    found = F.regexp_extract_all(c, F.lit(rf"{PRINTED}|{STAMP}"), F.lit(0))
    return F.array_compact(F.transform(found, lambda x: F.when(x.contains("/"), x).otherwise(stamp_to_date(x))))


def last_date(c: Column, pivot: int = 30) -> Column:
    """The last date of a note, printed or stamped, such as the effective date of its last amendment."""
    return printed_date(F.try_element_at(dates_of(c), F.lit(-1)), pivot)


def stamp_date(c: Column) -> Column:
    """A stamped date misread by a scanner, e.g. `0CT - 5 l998`: the month by its last two letters, O as 0, l as 1; else null."""
    ends = {n[:3][-2:]: m for n, m in MONTHS.items()}
    pattern = r"(?i)\b([a-z0-9]{3,4})\s*[-.]?\s*([0-9olI]{1,2})\s*[-,.]?\s*([0-9olI]{4})\b"
    tail = F.lower(F.right(F.regexp_extract(c, pattern, 1), F.lit(2)))
    digits = lambda i: F.translate(F.regexp_extract(c, pattern, i), "OolI", "0011").try_cast("int")
    month = F.coalesce(*[F.when(tail == k, F.lit(v)) for k, v in ends.items()])
    day, year = digits(2), digits(3)
    return F.when(month.isNotNull() & day.between(1, 31), F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day), "yyyy-MM-dd"))


def is_repealed(catchline: Column, body: Column) -> Column:
    """Whether a section reads as repealed or reserved: by its catchline, or early in its text."""
    by_title = F.coalesce(catchline.rlike(r"(?i)^\s*\(?(repealed|reserved)\b"), F.lit(False))
    return by_title | F.coalesce(F.substring(body, 1, 180).contains("REPEALED"), F.lit(False))


def fuzzy_pattern(want: Column) -> Column:
    """A pattern that finds a citation despite usual misreadings: a column of patterns, one per row."""
    classes = {"0": "[0Oo]", "1": "[1lI|]", "5": "[5Ss]", "8": "[8B]", "6": "[6b]", "9": "[9g]", "-": r"\\s*[-\u2010-\u2015]\\s*", ".": r"\\s*[.,]\\s*", ":": r"\\s*[:;]\\s*"}
    one = lambda x: F.coalesce(*[F.when(x == k, F.lit(v.replace("\\\\", "\\"))) for k, v in classes.items()], x)
    return F.array_join(F.transform(F.filter(F.split(want, ""), lambda x: x != ""), one), "")


def wikilinks(c: Column) -> Column:
    """Links `[[page|alias]]` of a markdown text: structs of page and alias (an escaped bar parts them too)."""
    found = F.regexp_extract_all(c, F.lit(r"\[\[([^\]\n]+)\]\]"), F.lit(1))
    return F.transform(found, lambda x: F.struct(F.trim(F.regexp_extract(x, r"^(.*?)(\\?\||$)", 1)).alias("page"), F.nullif(F.trim(F.regexp_extract(x, r"\\?\|(.*)$", 1)), F.lit("")).alias("alias")))


def mask_federal(c: Column) -> Column:
    """Federal citations, public laws among them, blanked out, so that their numbers aren't taken for sections."""
    c = F.regexp_replace(c, r"\d+\s+(?:U\.?\s?S\.?\s?C\.?|C\.?\s?F\.?\s?R\.?)\s*(?:§+\s*|sections?\s+|parts?\s+)?\d[0-9A-Za-z.\-]*", " ")
    return F.regexp_replace(c, r"\bP(?:ub(?:lic)?)?\.?\s*L(?:aw)?\.?\s*(?:No\.?\s*)?\d+-\d+", " ")


def rejoin_keyword(c: Column, words: tuple[str, ...] = ("Subchapter", "Chapter", "Subtitle", "Title", "Part")) -> Column:
    """Headings whose keyword was set with stray blanks (`S ubchap ter 2`) with the keyword in one piece."""
    for w in words:
        c = F.regexp_replace(c, r"(?i)^\s*" + r"\s*".join(w) + r"\b", w)
    return c


def page_tags(part: Column, chapter: Column, repealed: Column) -> Column:
    """Tags of a section's page, without those that don't apply."""
    return F.array_compact(F.array(F.concat(F.lit("chapter/"), chapter), F.when(F.coalesce(part, F.lit("")) != "", F.concat(F.lit("part/"), F.lower(F.regexp_extract(part, r"(?i)part\s+([IVXLC]+)", 1)))), F.when(repealed, F.lit("repealed"))))


def repealed_range(catchline: Column, number: Column) -> Column:
    """The catchline of a range that was repealed as a whole: `REPEALED (§§7-20 to 7-22)` for `to 22 REPEALED.` at 7-20; others as they are."""
    p = r"(?i)^\s*(?:to|through|-)\s*(?:(\d+[A-Z]?-))?(\d+(?:\.\d+)?)\s*\]?\.?\s*REPEALED"
    last = F.when(F.regexp_extract(catchline, p, 1) != "", F.concat(F.regexp_extract(catchline, p, 1), F.regexp_extract(catchline, p, 2))).otherwise(F.concat(F.regexp_replace(number, r"-[^-]*$", "-"), F.regexp_extract(catchline, p, 2)))
    return F.when(catchline.rlike(p), F.concat(F.lit("REPEALED (§§"), number, F.lit(" to "), last, F.lit(")"))).otherwise(catchline)


def chapter_hint(label: Column, url: Column) -> Column:
    """The chapter that a document's link or file name hints at, by ordered attempts: a full number in the label, in the file name, a plain number in either; else null."""
    name = F.regexp_extract(F.parse_url(url, F.lit("PATH")), r"([^/]*)$", 1)
    get = lambda c, p: F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), p, 1), F.lit(""))
    full, plain = r"(?<![\d-])(\d{1,2}-\d{1,3}(?:\.\d+)?[A-Z]?)(?![\d-])", r"(?i)ch(?:apter|ap|\.)?[ _-]*(\d{1,3}(?:\.\d+)?)"
    return F.coalesce(get(label, full), get(F.translate(name, "_", " "), full), get(label, plain), get(name, plain))
