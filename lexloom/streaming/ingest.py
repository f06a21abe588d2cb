"""Documents and events as they arrive, with Structured Streaming.

A stream's checkpoint is the manifest of finished work: a file or a row is taken once, also after a restart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexloom.operators.cite import extract


def stream_table(spark: SparkSession, path: str, files_per_batch: int = 64) -> DataFrame:
    """New Parquet files of a folder as a stream; the schema is that of the files there."""
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def citations_of(stream: DataFrame, key: list[str], text: str, family: str = "statute") -> DataFrame:
    """Citations of each text as it arrives; the same operator as for tables, without state."""
    return extract(stream, key, text, family)


def sessions_of(events: DataFrame, ts: str = "ts", user: str = "user_id", gap: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Sessions of users: a gap of `gap` closes one; events that come over `late` behind the newest are dropped by the watermark. Appended once closed."""
    e = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    s = e.groupBy(user, F.session_window(ts, gap).alias("w")).agg(F.count(F.lit(1)).alias("events"))
    return s.select(user, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events")


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Everything there is now, appended to a table exactly once; a later call goes on from the checkpoint."""
    return stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start()
