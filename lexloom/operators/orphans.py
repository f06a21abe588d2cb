"""References to records that do not exist (or not yet, or no more).

References and the validity intervals of the parents are brought into one stream per key, sorted by time, and read
once: a running sum over the interval ends says whether the parent exists at the moment of each reference. Spark's
window operator is that merge: both sides share one hash partitioning and one sort, and rows stream through a frame
that ends at the current row, so no key is ever collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A key of more rows than HOT_ROWS, or than one HOT_KEYS-th of all rows where that is more, is salted. No more than HOT_KEYS keys can be,
#: which bounds what is broadcast at any size of the input, and no key is left out.
HOT_KEYS = 100_000
HOT_ROWS = 20_000


def hot_keys(refs: DataFrame, key: str, keys: int = HOT_KEYS, rows: int = HOT_ROWS) -> DataFrame:
    """Every key to salt with its number of salts: a table of at most `keys` rows, since each of them has over one `keys`-th of all references."""
    counts = refs.groupBy(F.col(key).alias("hot_key")).agg(F.count(F.lit(1)).alias("n"))
    least = F.greatest(F.lit(rows), (counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).scalar() / keys).cast("bigint"))
    return counts.where(F.col("n") > least).select("hot_key", F.ceil(F.col("n") / least).cast("int").alias("salts"))


def reference_status(refs: DataFrame, parents: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Say of each reference whether its parent exists at its moment.

    refs: ref_key, ref_ts and any other columns. parents: key, start_ts, end_ts (null: open), one row per validity
    interval; repeated and overlapping intervals are allowed. Result: the columns of refs and `status`:

    - `ok`: some interval holds ref_ts (start inclusive, end exclusive);
    - `missing`: the key has no interval at all; `deleted`: the key was there before and isn't at ref_ts;
      `late`: its first interval starts after ref_ts.

    A null ref_key is no reference and gives no row. A reference without a moment is judged by the key alone (`ok` if
    the key has any interval, else `missing`). An interval without a start holds from the beginning; a null key in
    parents is ignored. Repeated references each give a row. Columns of refs may have any names but those that begin with `_rs_`.
    """
    cols = refs.columns
    r = refs.where(F.col("ref_key").isNotNull()).select(
        F.col("ref_key").alias("_rs_key"), F.col("ref_ts").cast("timestamp_ntz").alias("_rs_ts"), F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_rs_row")
    )
    hot = F.broadcast(hot_keys(r, "_rs_key", rows=hot_rows))
    r = r.join(hot, F.col("_rs_key") == F.col("hot_key"), "left")
    r = r.select(
        "_rs_key",
        F.when(F.col("salts") > 1, F.pmod(F.xxhash64("_rs_row"), F.col("salts")).cast("int")).otherwise(F.lit(0)).alias("_rs_salt"),
        "_rs_ts", F.lit(2).alias("_rs_order"), F.lit(0).alias("_rs_delta"), F.lit(0).alias("_rs_known"), F.lit(0).alias("_rs_open"), "_rs_row",
    )
    p = (
        parents.where(F.col("key").isNotNull())
        .select(F.col("key").alias("_rs_key"), F.col("start_ts").cast("timestamp_ntz").alias("s"), F.col("end_ts").cast("timestamp_ntz").alias("e"))
        .distinct()
        .where(F.col("s").isNull() | F.col("e").isNull() | (F.col("s") < F.col("e")))
    )
    p = p.join(hot, F.col("_rs_key") == F.col("hot_key"), "left").withColumn("_rs_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1)))
    begin = F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")

    def event(ts: Column, order: int, delta: int, known: int, opened: int) -> Column:
        return F.struct(ts.alias("_rs_ts"), F.lit(order).alias("_rs_order"), F.lit(delta).alias("_rs_delta"), F.lit(known).alias("_rs_known"), F.lit(opened).alias("_rs_open"))

    events = F.array(event(begin, 0, 0, 1, 0), event(F.coalesce("s", begin), 1, 1, 0, 1), F.when(F.col("e").isNotNull(), event(F.col("e"), 1, -1, 0, 0)))
    p = p.select("_rs_key", "_rs_salt", F.inline(F.array_compact(events))).withColumn("_rs_row", F.lit(None).cast(r.schema["_rs_row"].dataType))
    w = Window.partitionBy("_rs_key", "_rs_salt").orderBy(F.col("_rs_ts").asc_nulls_last(), "_rs_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = r.unionByName(p).select(
        "_rs_row", "_rs_ts",
        F.sum("_rs_delta").over(w).alias("alive"), F.sum("_rs_known").over(w).alias("known"), F.sum("_rs_open").over(w).alias("opened"),
    )
    status = (
        F.when(F.col("known") == 0, "missing")
        .when(F.col("_rs_ts").isNull() | (F.col("alive") > 0), "ok")
        .when(F.col("opened") > 0, "deleted")
        .otherwise("late")
    )
    return both.where(F.col("_rs_row").isNotNull()).select("_rs_row.*", status.alias("status"))


def orphans_by_period(status: DataFrame, ref_table: str) -> DataFrame:
    """Orphans per table, side, month of the reference and kind; a reference without a moment counts under a null month."""
    return (
        status.where(F.col("status") != "ok")
        .groupBy(F.lit(ref_table).alias("ref_table"), "side", F.date_format("ref_ts", "yyyy-MM").alias("month"), "status")
        .agg(F.count(F.lit(1)).alias("n"))
    )
