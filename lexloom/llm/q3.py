"""Problem 3: bodies of zones in pieces of at most 2,000 characters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.llm.pieces import split_oversized
from lexloom.sources.tables import table


def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split_oversized(table(spark, d, "zones").select("section_id", "zone", "body").distinct(), ["section_id", "zone"], "body")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_pieces(spark, d).where("pieces > 1 and piece = 1").select("section_id", "zone").distinct()


def p3_whole(spark: SparkSession, d: str) -> DataFrame:
    """What has to hold of the pieces of each text: put together they are the text, none is over 2,000 characters, and each begins with the end of the one before it, up to 200 characters."""
    z = table(spark, d, "zones").select("section_id", "zone", "body", F.md5("body").alias("print")).distinct()
    x = split_oversized(z, ["section_id", "zone", "print"], "body")
    shared = F.substring("body", F.lit(1), F.col("new_from") - F.col("start"))
    before = F.lag("body").over(Window.partitionBy("section_id", "zone", "print").orderBy("piece"))
    x = x.withColumn("ok", (F.length(shared) <= 200) & F.coalesce(before.endswith(shared), F.length(shared) == 0))
    g = x.groupBy("section_id", "zone", "print").agg(F.array_sort(F.collect_list(F.struct("piece", F.expr("substring(body, new_from - start + 1)").alias("t")))).alias("m"), F.max(F.length("body")).alias("longest"), F.bool_and("ok").alias("overlaps"))
    return g.select("section_id", "zone", (F.md5(F.array_join(F.transform("m", lambda p: p["t"]), "")) == F.col("print")).alias("whole"), (F.col("longest") <= 2000).alias("short"), "overlaps", "print")


QUERIES = {"p3_found": p3_found, "p3_pieces": p3_pieces, "p3_whole": p3_whole}
SQL = {
    "p3_found": "SELECT DISTINCT section_id, zone FROM zones WHERE length(body) > 2000",
    "p3_whole": "SELECT DISTINCT section_id, zone, true AS whole, true AS short, true AS overlaps, md5(body) AS print FROM zones WHERE body IS NOT NULL",
}
