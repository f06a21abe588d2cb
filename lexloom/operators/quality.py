"""Validation: checks as rows, conservation, contents against body, regression gates, a log of problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Kinds of problems.
KINDS = ["toc_body_mismatch", "toc_absent", "duplicate_section", "missing_auth", "missing_imp", "empty_operative", "note_cite_healed", "note_leftover_digits", "hint_mismatch", "no_text_layer", "chapter_duplicate_docs", "header_repaired", "unread_document"]


def run_checks(spark: SparkSession, checks: list[tuple[str, str, str, int]]) -> DataFrame:
    """(name, sql of one number, op `=` or `>=`, expected) as a report: name, value, op, expected, passed. All run as one query."""
    parts = [f"SELECT '{n}' AS name, CAST(({q}) AS BIGINT) AS value, '{op}' AS op, CAST({e} AS BIGINT) AS expected" for n, q, op, e in checks]
    r = spark.sql(" UNION ALL ".join(parts))
    return r.withColumn("passed", F.coalesce(F.when(F.col("op") == ">=", F.col("value") >= F.col("expected")).otherwise(F.col("value") == F.col("expected")), F.lit(False)))


def conservation(source: DataFrame, kept: DataFrame, problems: DataFrame) -> DataFrame:
    """Whether nothing was dropped silently: rows_in, rows_out, problems, conserved."""
    n = lambda df, c: df.agg(F.count(F.lit(1)).alias(c))
    x = n(source, "rows_in").withColumn("k", F.lit(1)).join(n(kept, "rows_out").withColumn("k", F.lit(1)), "k").join(n(problems, "problems").withColumn("k", F.lit(1)), "k").drop("k")
    return x.withColumn("conserved", F.col("rows_in") == F.col("rows_out") + F.col("problems"))


def toc_against_body(toc: DataFrame, body: DataFrame, by: list[str], item: str = "id") -> DataFrame:
    """Items that the contents name and the body lacks, and the other way round: by, id, problem."""
    a, b = toc.select(*by, item).distinct(), body.select(*by, item).distinct()
    return a.join(b, [*by, item], "left_anti").withColumn("problem", F.lit("not_in_body")).unionByName(b.join(a, [*by, item], "left_anti").withColumn("problem", F.lit("not_in_toc")))


def regression(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that only one of two runs has, as often as they differ: side and the columns."""
    cols = old.columns
    return old.exceptAll(new.select(*cols)).withColumn("side", F.lit("old")).unionByName(new.select(*cols).exceptAll(old).withColumn("side", F.lit("new")))


def problem(df: DataFrame, origin: str, kind: str, *columns: str) -> DataFrame:
    """Rows as problems of one schema: origin, kind, item (JSON of the named columns)."""
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind}")
    return df.select(F.lit(origin).alias("origin"), F.lit(kind).alias("kind"), F.to_json(F.struct(*columns)).alias("item"))


def stray_groups(items: DataFrame, group: str, doc: str, universe: DataFrame, most: int = 3) -> DataFrame:
    """Groups that look misread: unknown to the universe, with at most `most` items, in a document where a known group has more."""
    n = items.groupBy(doc, group).agg(F.count(F.lit(1)).alias("n"))
    n = n.join(universe.select(group).distinct().withColumn("known", F.lit(True)), group, "left")
    top = n.where("known").groupBy(doc).agg(F.max("n").alias("top"))
    return n.where(F.col("known").isNull() & (F.col("n") <= most)).join(top, doc).where("top > n").select(doc, group, "n")


def handwritten_kept(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """Hand-written rows lost by a rebuild: none expected."""
    return before.join(after.select(*key), key, "left_anti")
