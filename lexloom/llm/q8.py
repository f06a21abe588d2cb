"""Problem 8: questions of the evaluation set in the training documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexloom.llm.leaks import find_leaks
from lexloom.sources.tables import table


def _leaks(spark: SparkSession, d: str, near: bool) -> DataFrame:
    return find_leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text", near=near)


def p8_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Exact and near leaks with their extent."""
    return _leaks(spark, d, True)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d, False).select("doc_id", "item_id")


QUERIES = {"p8_found": p8_found, "p8_leaks": p8_leaks}
SQL: dict[str, str] = {}
