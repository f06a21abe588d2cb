"""Comparisons, precedence, upserts and range expansion over tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions.ids import squeeze


def compare_sets(left: DataFrame, right: DataFrame, by: str, item: str) -> DataFrame:
    """Per key whether two attestations hold the same set of items: by, outcome (agree, differ, left_unread, right_unread), only_left, only_right, shared.

    Pairs are compared by a full join on (key, item) and counted per key, so no set is collected. Null keys or items are no members."""
    a = left.where(F.col(by).isNotNull() & F.col(item).isNotNull()).select(by, item).distinct().withColumn("_a", F.lit(1))
    b = right.where(F.col(by).isNotNull() & F.col(item).isNotNull()).select(by, item).distinct().withColumn("_b", F.lit(1))
    c = a.join(b, [by, item], "full").groupBy(by).agg(
        F.count_if(F.col("_b").isNull()).alias("only_left"), F.count_if(F.col("_a").isNull()).alias("only_right"), F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("shared"),
        F.count("_a").alias("_na"), F.count("_b").alias("_nb"),
    )
    outcome = F.when(F.col("_nb") == 0, "right_unread").when(F.col("_na") == 0, "left_unread").when((F.col("only_left") == 0) & (F.col("only_right") == 0), "agree").otherwise("differ")
    return c.select(by, outcome.alias("outcome"), "only_left", "only_right", "shared")


def compare_pairs(left: DataFrame, right: DataFrame, key: list[str], field: str, order: str) -> DataFrame:
    """Pairs in one attestation alone, or in both with different values of a field; per pair the last row (largest order) holds."""
    last = lambda df, n: df.groupBy(*key).agg(F.max_by(F.struct(field), order).alias(n))
    j = last(left, "_a").join(last(right, "_b"), key, "full")
    finding = F.when(F.col("_b").isNull(), "only_left").when(F.col("_a").isNull(), "only_right").when(~F.col(f"_a.{field}").eqNullSafe(F.col(f"_b.{field}")), "conflict").otherwise("equal")
    return j.select(*key, finding.alias("finding"), F.col(f"_a.{field}").alias(f"left_{field}"), F.col(f"_b.{field}").alias(f"right_{field}"))


def by_precedence(df: DataFrame, key: list[str], trust: Column, order: str) -> DataFrame:
    """Per key the row of the most trusted source (least trust, then least order)."""
    w = Window.partitionBy(*key).orderBy(trust, order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def upsert(old: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """Insert-or-replace by key: of all rows of a key the last written one stays (new over old, then the largest order)."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*key).orderBy(F.desc("_new"), F.desc(order))
    return both.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_new")


#: An element of a list: quoted, or what lies between separators; an apostrophe inside a word is no quote.
_ELEMENT = r"""\"[^\"]*+(?:\"\"[^\"]*+)*+\"|(?<![\p{L}\p{N}])'[^']*'(?![\p{L}\p{N}])|[^,;|/&\n\t\"']+(?:(?<=\p{L})'[^,;|/&\n\t\"']*)*"""
_BETWEEN = r"(?i)[\s\p{Z}]+(?:and|or)[\s\p{Z}]+|(?<=[\d)])[\s\p{Z}]+(?=§*\s*\d)"
_RANGE = r"(?i)^(.*?\S)[\s\p{Z}]+(?:to|through)[\s\p{Z}]+(\S.*)$"
_FULL = r"^(\d+[A-Z]?(?::\d+[A-Z]?)?-\d+[A-Z]?(?:\.\d+)?)(?:-(\d+(?:\.\d+)?(?:-\d+)*))?$"
_BARE = r"^\d+(\.\d+)?$"


def expand_lists(df: DataFrame, key: str, text: str) -> DataFrame:
    """Compressed lists of rule numbers, one row per member: key, pos, member, parsed.

    `13-275-1, 2, 5 to 8` gives 13-275-1, -2, -5, -6, -7, -8: a bare number takes the prefix of the last full number before it, a range between
    two whole numbers behind the same prefix gives its members, another range both ends. Elements lie between commas, semicolons, bars, slashes, `&`, `and`, `or`,
    line ends and tabs, but for those in quotes; section signs, layer names and subsections in parentheses are no part of a number.
    What can't be read comes as it stands with parsed = false. Null or empty lists give no rows."""
    quoted = lambda c: c.startswith('"') | c.startswith("'")
    inner = lambda c: F.replace(F.regexp_replace(c, r"(?s)^([\"'])(.*)\1$", "$2"), F.lit('""'), F.lit('"'))
    parts = F.flatten(F.transform(F.regexp_extract_all(F.col(text), F.lit(_ELEMENT), F.lit(0)), lambda c: F.when(quoted(c), F.array(inner(c))).otherwise(F.split(c, _BETWEEN))))
    x = df.select(key, F.posexplode(parts).alias("i", "t")).withColumn("t", F.regexp_replace(F.trim("t"), r"(?i)^(?:and|or)\s+", "")).where(F.col("t").rlike(r"[\p{L}\p{N}]") & ~F.col("t").rlike(r"(?i)^(?:sections?|secs?\.?|hrs|har|[§\s])+$"))

    def number(c: Column) -> Column:
        c = F.regexp_replace(squeeze(c), r"(?i)^(?:hrs|har):?(?:sections?|secs?\.)?", "")
        return F.upper(F.regexp_replace(c, r"(?:\([^()]{1,12}\))*\.?$", ""))

    span = F.col("t").rlike(_RANGE)
    x = x.withColumn("a", number(F.when(span, F.regexp_extract("t", _RANGE, 1)).otherwise(F.col("t")))).withColumn("b", F.when(span, number(F.regexp_extract("t", _RANGE, 2))))
    x = x.withColumn("own", F.when(F.col("a").rlike(_FULL), F.regexp_extract("a", _FULL, 1)))
    w = Window.partitionBy(key).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn("prefix", F.last("own", ignorenulls=True).over(w))
    x = x.withColumn("first", F.when(F.col("own").isNotNull(), F.col("a")).when(F.col("a").rlike(_BARE), F.concat("prefix", F.lit("-"), "a")))
    before, behind = (lambda c: F.regexp_extract(c, r"^(.*)-[^-]*$", 1)), (lambda c: F.regexp_extract(c, r"([^-]*)$", 1))
    x = x.withColumn("last", F.when(F.col("b").rlike(_FULL), F.col("b")).when(F.col("b").rlike(_BARE), F.concat(before(F.col("first")), F.lit("-"), F.col("b"))))
    x = x.withColumn("lo", behind(F.col("first"))).withColumn("hi", behind(F.col("last")))
    whole = F.col("lo").rlike(r"^\d{1,6}$") & F.col("hi").rlike(r"^\d{1,6}$") & (F.col("lo").try_cast("int") <= F.col("hi").try_cast("int")) & (before(F.col("first")) == before(F.col("last")))
    inside = F.transform(F.sequence(F.col("lo").try_cast("int"), F.col("hi").try_cast("int")), lambda n: F.concat(before(F.col("first")), F.lit("-"), n.cast("string")))
    members = F.when(F.col("b").isNull(), F.array("first")).when(whole, inside).otherwise(F.array("first", "last"))
    ok = F.col("first").isNotNull() & (F.col("b").isNull() | F.col("last").isNotNull())
    x = x.select(key, "i", ok.alias("parsed"), F.posexplode(F.when(ok, members).otherwise(F.array("t"))).alias("j", "member"))
    w = Window.partitionBy(key).orderBy("i", "j")
    return x.select(key, F.row_number().over(w).alias("pos"), "member", "parsed")


def covered(df: DataFrame, key: str, catchline: str) -> DataFrame:
    """Numbers that one repealing section stands for: key, catchline, member. `REPEALED (§§7-20 to 7-22)` covers 7-21 and 7-22; of ends that are no whole numbers
    behind one prefix only the far end; other catchlines none."""
    p = r"REPEALED \(§§(\S+?) to (\S+?)\)"
    a, b = F.regexp_extract(catchline, p, 1), F.regexp_extract(catchline, p, 2)
    x = df.select(key, catchline, a.alias("_a"), b.alias("_b")).where("_a <> ''")
    lead, number = (lambda c: F.regexp_extract(c, r"^(.*-)[^-]*$", 1)), (lambda c: F.regexp_extract(c, r"-(\d{1,6})$", 1).try_cast("int"))
    whole = (lead(F.col("_a")) == lead(F.col("_b"))) & (number(F.col("_a")) < number(F.col("_b")))
    inside = F.transform(F.sequence(number(F.col("_a")) + 1, number(F.col("_b"))), lambda n: F.concat(lead(F.col("_a")), n.cast("string")))
    return x.select(key, catchline, F.explode(F.when(whole, inside).otherwise(F.array("_b"))).alias("member"))


def quarantine(df: DataFrame, by: list[str], bad: Column, share: float, least: int = 0) -> DataFrame:
    """Every row with `quarantined`: whether more than max(least, share of the rows) of its group are bad. Nothing is dropped."""
    group = df.groupBy(*by).agg(F.count_if(bad).alias("_bad"), F.count(F.lit(1)).alias("_n"))
    flag = F.col("_bad") > F.greatest(F.lit(float(least)), F.col("_n") * share)
    g = group.select(*by, flag.alias("quarantined"))
    g2 = g.select(*[F.col(c).alias(f"_g_{c}") for c in by], "quarantined")
    on = None
    for c in by:
        e = F.col(c).eqNullSafe(F.col(f"_g_{c}"))
        on = e if on is None else on & e
    return df.join(g2, on).drop(*[f"_g_{c}" for c in by])


def search(texts: DataFrame, key: list[str], text: str, query: str) -> DataFrame:
    """Full-text search without ranking: the keys of texts that hold every word of the query. Words are runs of letters and digits in lower case."""
    words = sorted({w for w in query.lower().split() if w})
    if not words:
        raise ValueError("a query has at least one word")
    x = texts.select(*key, F.array_distinct(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+")).alias("_w"))
    cond = F.array_contains("_w", words[0])
    for w in words[1:]:
        cond = cond & F.array_contains("_w", w)
    return x.where(cond).select(*key).distinct()


def token_index(texts: DataFrame, key: list[str], text: str) -> DataFrame:
    """Inverted index: key, token, n. Writing it bucketed by token serves many searches with one semi-join each."""
    t = F.explode(F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), lambda x: x != ""))
    return texts.select(*key, t.alias("token")).groupBy(*key, "token").agg(F.count(F.lit(1)).alias("n"))
