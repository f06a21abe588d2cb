"""Problem 5: several session-law entries, section numbers or act titles in one field."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.operators.packed import quoted_titles, split_packed
from lexloom.sources.tables import table


def packed_fields(spark: SparkSession, d: str) -> DataFrame:
    """The fields that may hold several values: rec_table, rec_id, zone, text."""
    zones = table(spark, d, "zones").where(F.col("zone").isin("history", "auth", "imp")).select(F.lit("zones").alias("rec_table"), F.col("section_id").alias("rec_id"), "zone", F.col("body").alias("text"))
    edge = table(spark, d, "edge").where(F.col("kind").isin("hrs_section", "har_section"))
    edge = edge.select(F.lit("edge").alias("rec_table"), F.col("edge_id").cast("string").alias("rec_id"), F.lit("").alias("zone"), F.col("raw").alias("text"))
    return zones.distinct().unionByName(edge)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    fields = packed_fields(spark, d)
    return split_packed(fields, ["rec_table", "rec_id", "zone"], "text", quoted_titles(fields, "text"))


QUERIES = {"p5_found": p5_found}
SQL: dict[str, str] = {}
