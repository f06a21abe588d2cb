"""Visually identical text with different characters, brought to one form.

Texts that may differ from the form are exploded to positioned code points. A broadcast table, fixed by the Unicode
version of the interpreter, gives each its compatibility decomposition and its combining class; marks are sorted by
class within their cluster and recomposed by a table of pairs. Letters of a word that mixes Latin with Greek or Cyrillic are
replaced through a look-alike table, then each text is rebuilt from its code points.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.session import durable

# Cyrillic and Greek letters and the Latin letters that they look like.
LOOK_ALIKE = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "к": "k", "в": "b", "т": "t", "м": "m", "н": "h", "ӏ": "l",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "χ": "x", "ϲ": "c", "ϳ": "j", "γ": "y", "η": "n", "τ": "t", "ω": "w", "ε": "e",
}
# Characters besides ASCII that are in the form already and stand for themselves beside any others.
STABLE = "§¬¶©®±°·×÷¡¿«»“”‘’„†‡•–—ʻ" + "āēīōūĀĒĪŌŪáéíóúýÁÉÍÓÚÝàèìòùÀÈÌÒÙäëïöüÿÄËÏÖÜâêîôûÂÊÎÔÛãñõÃÑÕåÅæøÆØçÇß"
HYPHENS = "‐‑"
#: Any other character sends a text through the whole operator.
SUSPECT = "[^\\x00-\\x7F" + STABLE + "]"

HANGUL_S, HANGUL_L, HANGUL_V, HANGUL_T = 0xAC00, 0x1100, 0x1161, 0x11A7


def script_of(c: str) -> str:
    """l, g or c for Latin, Greek and Cyrillic letters, o for other letters, m for marks, else nothing."""
    kind = unicodedata.category(c)
    if kind[0] == "M":
        return "m"
    if kind[0] != "L":
        return ""
    name = unicodedata.name(c, "")
    return "l" if name.startswith("LATIN") or "FULLWIDTH LATIN" in name else "g" if name.startswith("GREEK") else "c" if name.startswith("CYRILLIC") else "o"


@lru_cache(1)
def decompositions() -> list[tuple[str, list[tuple[str, int]]]]:
    """Each character with a decomposition or a combining class, a space or a hyphen of another kind, or of category Cf:
    the characters it stands for with their classes."""
    out = []
    for i in range(0x110000):
        if 0xD800 <= i < 0xE000:
            continue
        c = chr(i)
        d = unicodedata.normalize("NFKD", c)
        kind = unicodedata.category(c)
        if d == c and kind not in ("Cf", "Zs") and c not in HYPHENS and not unicodedata.combining(c):
            continue
        d = "".join(" " if unicodedata.category(x) == "Zs" else "-" if x in HYPHENS else x for x in d if unicodedata.category(x) != "Cf")
        out.append((c, [(x, unicodedata.combining(x)) for x in d]))
    return out


@lru_cache(1)
def compositions() -> dict[str, str]:
    """Pairs of characters (as two-character strings) that compose to one, but for Hangul syllables, which a rule gives."""
    out = {}
    for i in range(0x110000):
        if 0xD800 <= i < 0xE000 or HANGUL_S <= i < HANGUL_S + 11172:
            continue
        d = unicodedata.decomposition(chr(i))
        if d and d[0] != "<" and " " in d:
            a, b = (chr(int(x, 16)) for x in d.split())
            if unicodedata.normalize("NFC", a + b) == chr(i):
                out[a + b] = chr(i)
    return out


@lru_cache(1)
def joining() -> str:
    """Starters that may compose with a starter before them."""
    own = {p[1] for p in compositions() if not unicodedata.combining(p[1])}
    return "".join(sorted(own)) + "".join(map(chr, range(HANGUL_V, HANGUL_V + 21))) + "".join(map(chr, range(HANGUL_T + 1, HANGUL_T + 28)))


def compose(cluster: str, classes: list[int]) -> str:
    """Canonical composition of a cluster whose marks are in order."""
    pairs, out, starter, last = compositions(), [], -1, -1
    for c, k in zip(cluster, classes):
        if starter >= 0 and (last < k or last == -1):
            a = out[starter]
            whole = pairs.get(a + c)
            x, y = ord(a), ord(c)
            if HANGUL_L <= x < HANGUL_L + 19 and HANGUL_V <= y < HANGUL_V + 21:
                whole = chr(HANGUL_S + ((x - HANGUL_L) * 21 + y - HANGUL_V) * 28)
            elif HANGUL_S <= x < HANGUL_S + 11172 and (x - HANGUL_S) % 28 == 0 and HANGUL_T < y < HANGUL_T + 28:
                whole = chr(x + y - HANGUL_T)
            if whole:
                out[starter] = whole
                continue
        out.append(c)
        if k == 0:
            starter, last = len(out) - 1, -1
        else:
            last = k
    return "".join(out)


@lru_cache(1)
def other_letters() -> list[str]:
    """All Greek and Cyrillic letters."""
    return [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000 and script_of(chr(i)) in ("g", "c")]


def _tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """The two broadcast tables; their sizes are fixed by Unicode (about 30,000 and 2,500 rows)."""
    d = spark.createDataFrame([(c, [(x, k) for x, k in m]) for c, m in decompositions()], "ch string, parts array<struct<x: string, k: int>>")
    back = {script: {v: k for k, v in reversed(LOOK_ALIKE.items()) if script_of(k) == script} for script in "gc"}
    rows = [(c, script_of(c), LOOK_ALIKE.get(unicodedata.normalize("NFKC", c)), None, None) for c in other_letters()]
    rows += [(c, "l", None, back["g"].get(c), back["c"].get(c)) for c in sorted(set(back["g"]) | set(back["c"]))]
    return d, spark.createDataFrame(rows, "x string, script string, latin string, greek string, cyrillic string")


def token_forms(tokens: DataFrame) -> DataFrame:
    """The consistent form of each distinct token: token, form, mixed, from its code points."""
    decomposition, look_alike = _tables(tokens.sparkSession)
    tokens = tokens.withColumn("rid", F.struct(F.xxhash64("token"), F.md5("token")))
    points = tokens.select("rid", F.posexplode(F.split("token", "")).alias("pos", "ch")).where(F.col("ch") != "")
    points = points.join(F.broadcast(decomposition), "ch", "left").select("rid", "pos", F.posexplode_outer(F.coalesce("parts", F.array(F.struct(F.col("ch").alias("x"), F.lit(0).alias("k"))))).alias("sub", "p"))
    points = points.where(F.col("p").isNotNull()).select("rid", "pos", "sub", "p.x", "p.k")
    # Clusters: a starter with what may compose with it.
    w = Window.partitionBy("rid").orderBy("pos", "sub")
    starts = (F.col("k") == 0) & ~F.lit(joining()).contains(F.col("x"))
    points = points.withColumn("cluster", F.sum(F.when(starts, 1).otherwise(0)).over(w))
    # Marks move by class only up to the next starter, joining or not.
    points = points.withColumn("run", F.sum(F.when(F.col("k") == 0, 1).otherwise(0)).over(w))
    clusters = points.groupBy("rid", "cluster").agg(F.min("pos").alias("at"), F.array_sort(F.collect_list(F.struct("run", "k", "pos", "sub", "x"))).alias("m"))

    @F.pandas_udf("string")
    def composed(xs, ks):
        return xs.combine(ks, lambda x, k: compose(x, list(k)))

    raw = F.array_join(F.transform("m", lambda m: m["x"]), "")
    # Only clusters of several characters are composed; one character is itself.
    single = clusters.where(F.size("m") == 1).select("rid", "cluster", F.element_at("m", 1)["x"].alias("c"))
    several = clusters.where(F.size("m") > 1).select("rid", "cluster", composed(raw, F.transform("m", lambda m: m["k"])).alias("c"))
    forms = single.unionByName(several).select("rid", "cluster", F.posexplode(F.split("c", "")).alias("n", "c")).where(F.col("c") != "")
    # Words of letters and marks, and the scripts in each.
    letter = F.col("c").rlike(r"^[\p{L}\p{M}]$")
    w = Window.partitionBy("rid").orderBy("cluster", "n")
    forms = forms.join(F.broadcast(look_alike), F.col("c") == F.col("x"), "left").withColumn("letter", letter).withColumn("word", F.sum(F.when(letter, 0).otherwise(1)).over(w))
    in_word = Window.partitionBy("rid", "word")
    is_latin, is_other = F.col("c").rlike(r"^\p{IsLatin}$") & F.col("letter"), F.col("script").isin("g", "c")
    forms = forms.select(
        "rid", "cluster", "n", "c", "latin", "greek", "cyrillic", "letter", is_latin.alias("is_latin"), is_other.alias("is_other"),
        F.bool_or(is_latin).over(in_word).alias("has_latin"), F.coalesce(F.bool_or(is_other).over(in_word), F.lit(False)).alias("has_other"),
        F.coalesce(F.bool_or(is_other & F.col("latin").isNull()).over(in_word), F.lit(False)).alias("strange"),
        F.coalesce(F.bool_or(F.col("script") == "c").over(in_word), F.lit(False)).alias("cyr"),
        F.bool_or(is_latin & F.col("cyrillic").isNull()).over(in_word).alias("no_cyr"), F.bool_or(is_latin & F.col("greek").isNull()).over(in_word).alias("no_gr"),
    )
    both = F.col("letter") & F.col("has_latin") & F.col("has_other")
    mended = (
        F.when(both & ~F.col("strange") & F.col("is_other"), F.col("latin"))
        .when(both & F.col("strange") & F.col("cyr") & ~F.col("no_cyr") & F.col("is_latin"), F.col("cyrillic"))
        .when(both & F.col("strange") & ~F.col("cyr") & ~F.col("no_gr") & F.col("is_latin"), F.col("greek"))
        .otherwise(F.col("c"))
    )
    rebuilt = forms.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("cluster", "n", mended.alias("c")))).alias("m"), F.bool_or(both).alias("mixed"))
    rebuilt = rebuilt.select("rid", F.array_join(F.transform("m", lambda m: m["c"]), "").alias("form"), "mixed")
    return tokens.join(rebuilt, "rid", "left").select("token", F.coalesce("form", F.lit("")).alias("form"), F.coalesce("mixed", F.lit(False)).alias("mixed"))


def unify(df: DataFrame, keys: list[str], text: str, suspects_only: bool = False) -> DataFrame:
    """Each row with its text in one consistent form: keys, `original`, `text`, `mixed`.

    The form is NFKC without invisible formatting characters (category Cf), with U+0020 for every space separator and an
    ASCII hyphen for U+2010 and U+2011. In a word of letters that mixes Latin with Greek or Cyrillic, look-alikes go to Latin if all its other
    letters have a Latin look-alike, else Latin letters go to the other script if all of them can. Words of one script, macrons,
    the okina, quotes and dashes stay. `mixed` says that the original holds a mixed word, also one that no table can mend.

    A null text stays null (mixed false), an empty one empty; repeated rows stay repeated, long texts are brought to the form whole.
    The columns named in keys may have any names but `original`, `text` and `mixed`. suspects_only leaves out the rows whose characters are all
    of the stable set, which are in the form already. The others are written once, so that the source is read once for them.
    """
    base = df.select(F.struct(*[F.col(f"`{k}`") for k in keys]).alias("_key"), F.col(f"`{text}`").alias("original"))
    keep = [F.col(f"_key.`{k}`").alias(k) for k in keys]
    suspect = durable(base.where(F.col("original").rlike(SUSPECT)))
    sound = base.where(F.col("original").isNull() | ~F.col("original").rlike(SUSPECT)).select(*keep, "original", F.col("original").alias("text"), F.lit(False).alias("mixed"))
    # Each distinct text once: repeated texts are joined back by their own value. Nothing in the form reaches over an ASCII
    # blank, so that texts come apart there, and each distinct token that may differ is exploded to its code points once.
    texts = suspect.select("original").distinct().withColumn("tid", F.struct(F.xxhash64("original"), F.md5("original")))
    tokens = texts.select("tid", F.posexplode(F.split("original", " ", -1)).alias("i", "token"))
    odd = tokens.where(F.col("token").rlike(SUSPECT))
    forms = token_forms(odd.select("token").distinct())
    parts = odd.join(forms, "token").select("tid", "i", "form", "mixed").unionByName(tokens.where(~F.col("token").rlike(SUSPECT)).select("tid", "i", F.col("token").alias("form"), F.lit(False).alias("mixed")))
    rebuilt = parts.groupBy("tid").agg(F.array_sort(F.collect_list(F.struct("i", "form"))).alias("m"), F.bool_or("mixed").alias("mixed"))
    done = texts.join(rebuilt.select("tid", F.array_join(F.transform("m", lambda m: m["form"]), " ").alias("text"), "mixed"), "tid").select("original", "text", "mixed")
    changed = suspect.join(done, "original").select(*keep, "original", "text", "mixed")
    return changed if suspects_only else sound.unionByName(changed)


def differs(original: Column, text: Column, mixed: Column) -> Column:
    """Whether a text was not in the consistent form."""
    return F.coalesce(original != text, F.lit(False)) | mixed
