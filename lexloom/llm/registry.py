"""All queries on training text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexloom.llm import q1, q3, q4, q7, q8, q9

MODULES = [q1, q3, q4, q7, q8, q9]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.SQL.items()}
