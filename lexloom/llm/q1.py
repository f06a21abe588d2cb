"""Problem 1: bodies, catchlines and titles in one consistent form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm.unify import differs, unify
from lexloom.sources.tables import table

KEYS = ["rec_table", "rec_id", "zone"]


def texts(spark: SparkSession, d: str) -> DataFrame:
    """Every body, catchline and title once: rec_table, rec_id, zone, text."""
    parts = [("zones", "section_id", F.col("zone"), "body"), ("sections", "id", F.lit(""), "catchline"), ("units", "id", F.lit(""), "title")]
    out = [table(spark, d, t).select(F.lit(t).alias("rec_table"), F.col(i).alias("rec_id"), z.alias("zone"), F.col(c).alias("body")) for t, i, z, c in parts]
    return out[0].unionByName(out[1]).unionByName(out[2]).distinct()


def _unified(spark: SparkSession, d: str, suspects_only: bool) -> DataFrame:
    return unify(texts(spark, d), KEYS, "body", suspects_only).select(*KEYS, "text", differs(F.col("original"), F.col("text"), F.col("mixed")).alias("changed"))


def p1_unified(spark: SparkSession, d: str) -> DataFrame:
    return _unified(spark, d, False)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _unified(spark, d, True).where("changed").select(*KEYS).distinct()


QUERIES = {"p1_found": p1_found, "p1_unified": p1_unified}
SQL: dict[str, str] = {}
