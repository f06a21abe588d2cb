"""Problem 7: the corpus as ids of byte_bpe_50k."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexloom.llm.tokenize import encode_documents
from lexloom.sources.tables import table


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_documents(table(spark, d, "documents"), "doc_id", "text")


QUERIES = {"p7_ids": p7_ids}
SQL: dict[str, str] = {}
