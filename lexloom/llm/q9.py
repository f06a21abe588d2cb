"""Problem 9: passages that documents share character for character."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexloom.llm.spans import SharedSpans
from lexloom.sources.tables import table


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return SharedSpans(table(spark, d, "documents"), "doc_id", "text").pairs()


def p9_shared(spark: SparkSession, d: str) -> DataFrame:
    return SharedSpans(table(spark, d, "documents"), "doc_id", "text").coverage()


QUERIES = {"p9_found": p9_found, "p9_shared": p9_shared}
SQL: dict[str, str] = {}
