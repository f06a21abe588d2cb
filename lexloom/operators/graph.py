"""Questions to a citation graph: an edge table with the columns src, dst and others."""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.session import durable


def reach(edges: DataFrame, seeds: DataFrame, depth: int | None, reverse: bool = False) -> DataFrame:
    """Everything that each seed reaches in up to `depth` steps (None: until nothing new is met): seed, node, depth (the least), on_cycle.

    edges: src, dst. seeds: seed. Breadth first: each round joins the last level with the edges and drops what a seed has
    met before, so a node comes once per seed, at its least depth. on_cycle marks the seed itself where it is met again. Targets
    without edges of their own are leaves. Null ends and seeds are ignored; no seed or no edge gives no rows."""
    a, b = ("dst", "src") if reverse else ("src", "dst")
    e = durable(edges.select(F.col(a).alias("from_"), F.col(b).alias("node")).where("from_ is not null and node is not null").distinct())
    level = seeds.select("seed").where(F.col("seed").isNotNull()).distinct().select("seed", F.col("seed").alias("at"))
    met = None
    for d in count(1) if depth is None else range(1, depth + 1):
        level = level.join(e, F.col("at") == F.col("from_")).select("seed", "node").distinct()
        if met is not None:
            level = level.join(met.select("seed", "node"), ["seed", "node"], "left_anti")
        level = durable(level)  # read by the next rounds; else each would begin from the edges again
        step = level.select("seed", "node", F.lit(d).alias("depth"))
        met = step if met is None else met.unionByName(step)
        if depth is None and level.isEmpty():
            break
        level = level.where(F.col("seed") != F.col("node")).select("seed", F.col("node").alias("at"))
    return met.withColumn("on_cycle", F.col("seed") == F.col("node"))


def hubs(edges: DataFrame, n: int = 25) -> DataFrame:
    """The n targets that most different sources cite; ties by name. Null ends don't count."""
    return (
        edges.where("src is not null and dst is not null").groupBy(F.col("dst").alias("node")).agg(F.count_distinct("src").alias("sources"))
        .orderBy(F.desc("sources"), "node").limit(n)
    )


def orphans(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The rows of nodes (id, …) that no edge leaves or enters."""
    return nodes.join(edges.select(F.col("src").alias("id")), "id", "left_anti").join(edges.select(F.col("dst").alias("id")), "id", "left_anti")


def unresolved(edges: DataFrame, nodes: DataFrame, examples: int = 6, order: Callable[[Column], Column] | None = None, parts: int = 64) -> DataFrame:
    """Targets (kind, dst) that nodes (id) doesn't hold: citations, different sources, the first ones in order (of a key of the name, or by name) and the raw text first seen (least seq).

    The first sources of a hot target are found in `parts` parts, of which each gives its first ones on; so no target's sources meet in one task, and no list of all of them is made."""
    key = order or (lambda c: c)
    miss = edges.where(F.col("dst").isNotNull()).join(nodes.select(F.col("id").alias("dst")).distinct(), "dst", "left_anti")
    per = miss.groupBy("kind", "dst", "src").agg(F.count(F.lit(1)).alias("n"), F.min_by("raw", "seq").alias("raw"), F.min("seq").alias("seq"))
    counts = per.groupBy("kind", "dst").agg(F.sum("n").alias("citations"), F.count("src").alias("sources"), F.min_by("raw", "seq").alias("first_raw"))
    first = per.where(F.col("src").isNotNull()).select("kind", "dst", "src", key(F.col("src")).alias("_key"), F.pmod(F.xxhash64("src"), F.lit(parts)).alias("_part"))
    for by in (["kind", "dst", "_part"], ["kind", "dst"]):
        first = first.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy("_key", "src"))).where(F.col("_rank") <= examples)
    names = first.groupBy("kind", "dst").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rank", "src"))), lambda x: x["src"]), ", ").alias("examples"))
    return counts.join(names, ["kind", "dst"], "left").select("kind", "dst", "citations", "sources", F.coalesce("examples", F.lit("")).alias("examples"), "first_raw")


def as_of(left: DataFrame, right: DataFrame, by: list[str], order: str, value: str, inclusive: bool = True) -> DataFrame:
    """Backward as-of join: each row of left with the value of the last row of right at or before it (before it, if not inclusive).

    Both sides are one stream per key, sorted once; rows without an earlier match get null. Of right rows at the same place the one with the largest value holds.
    The order column must not be null; rows of left come out once each."""
    r = right.select(*by, F.col(order), F.lit(0 if inclusive else 2).alias("_side"), F.col(value).alias("_v"), F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("_row"))
    x = left.select(*by, F.col(order), F.lit(1).alias("_side"), F.lit(None).cast(r.schema["_v"].dataType).alias("_v"), F.struct("*").alias("_row"))
    w = Window.partitionBy(*by).orderBy(order, "_side", F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return x.unionByName(r).withColumn("_last", F.last("_v", ignorenulls=True).over(w)).where(F.col("_row").isNotNull()).select("_row.*", F.col("_last").alias(f"{value}_as_of"))


def islands(df: DataFrame, by: list[str], order: str, new: Column) -> DataFrame:
    """Rows with the number of their island in `island`: a row where `new` holds (an expression over the previous row as `prev`) begins one."""
    w = Window.partitionBy(*by).orderBy(*([order] if isinstance(order, str) else order))
    x = df.withColumn("prev", F.lag(order if isinstance(order, str) else order[0]).over(w))
    return x.withColumn("island", F.sum(F.when(F.coalesce(new, F.lit(True)), 1).otherwise(0)).over(w)).drop("prev")


def forward_fill(df: DataFrame, by: list[str], order: list[Column | str], outer: str, inner: str) -> DataFrame:
    """`outer` and `inner` carried forward to the rows behind them; a new value of outer resets inner."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = df.withColumn("_g", F.count(outer).over(w)).withColumn(f"{outer}_filled", F.last(outer, ignorenulls=True).over(w))
    v = Window.partitionBy(*by, "_g").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return x.withColumn(f"{inner}_filled", F.last(inner, ignorenulls=True).over(v)).drop("_g")


def keep_one(df: DataFrame, by: list[str], order: list[Column | str]) -> DataFrame:
    """The first row per key in the given order, which has to be total for a definite result."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def upper_median(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """The element in the upper middle of each group's sorted values (index count // 2), with the count, least, greatest; nulls don't count.

    Equal values are counted first, and a running sum over the different ones finds the middle, so that no group is sorted or collected as a whole."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*by)
    x = counts.withColumn("_upto", F.sum("_n").over(w.orderBy(value))).withColumn("_all", F.sum("_n").over(w))
    return x.groupBy(*by).agg(F.min(F.when(F.col("_upto") > F.floor(F.col("_all") / 2), F.col(value))).alias("median"), F.sum("_n").alias("n"), F.min(value).alias("least"), F.max(value).alias("greatest"))


def contents_split(df: DataFrame, by: list[str], order: str, item: str, share: float = 0.4, least: int = 2) -> DataFrame:
    """best_split where the first half is a table of contents: by, split, accepted. No item comes twice, or fewer than `least` or `share` of the items of
    the first half come again in the second: then there are no contents, and the split is 0."""
    s = best_split(df, by, order, item)
    x = df.select(*by, F.row_number().over(Window.partitionBy(*by).orderBy(order)).alias("_i"), F.col(item).alias("_x")).join(s, by)
    sides = x.groupBy(*by, "split", "_x").agg(F.max((F.col("_i") <= F.col("split")).cast("int")).alias("_a"), F.max((F.col("_i") > F.col("split")).cast("int")).alias("_b"), F.count(F.lit(1)).alias("_n"))
    g = sides.groupBy(*by, "split").agg(F.sum("_a").alias("_toc"), F.sum(F.col("_a") * F.col("_b")).alias("_again"), F.max("_n").alias("_most"))
    ok = (F.col("_most") > 1) & (F.col("_again") >= F.greatest(F.lit(float(least)), F.col("_toc") * share))
    return g.select(*by, F.when(ok, F.col("split")).otherwise(0).alias("split"), ok.alias("accepted"))


def cycles(edges: DataFrame, seeds: DataFrame, depth: int) -> DataFrame:
    """Edges that lead back to where a walk of up to `depth` steps from a seed came through: seed, src, dst, depth (the least at which that happens).

    A walk is carried as its path, which has at most `depth` nodes, and ends at such an edge or at a target without edges."""
    e = durable(edges.where("src is not null and dst is not null").select("src", "dst").distinct())
    walk = seeds.select("seed").where("seed is not null").distinct().select("seed", F.col("seed").alias("at"), F.array("seed").alias("path"))
    out = None
    for d in range(1, depth + 1):
        step = durable(walk.join(e, F.col("at") == F.col("src")).select("seed", "src", "dst", "path", F.array_contains("path", F.col("dst")).alias("back")))
        found = step.where("back").select("seed", "src", "dst", F.lit(d).alias("depth"))
        out = found if out is None else out.unionByName(found)
        walk = step.where("not back").select("seed", F.col("dst").alias("at"), F.concat("path", F.array("dst")).alias("path"))
    return out.groupBy("seed", "src", "dst").agg(F.min("depth").alias("depth"))


def best_split(df: DataFrame, by: list[str], order: str, item: str) -> DataFrame:
    """Per group the place that parts its sequence into two halves of nearly the same set of items: by, split, difference.

    split is the number of rows before the cut (1 to n - 1) with the least symmetric difference of the sets on both sides; ties take the first.
    An item counts from its first row on in the left set and up to its last row in the right set, so running sums of first and last occurrences
    give the differences without any set."""
    w, k = Window.partitionBy(*by).orderBy(order), Window.partitionBy(*by, item)
    x = df.select(*by, F.row_number().over(w).alias("i"), F.col(item).alias("_x"))
    k = Window.partitionBy(*by, "_x")
    x = x.withColumn("first", F.min("i").over(k)).withColumn("last", F.max("i").over(k))
    v = Window.partitionBy(*by).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n = F.count(F.lit(1)).over(Window.partitionBy(*by))
    # at a cut behind row i: items only on the left have last <= i; items only on the right have first > i
    x = x.withColumn("left_only", F.sum(F.when(F.col("i") == F.col("last"), 1).otherwise(0)).over(v))
    x = x.withColumn("begun", F.sum(F.when(F.col("i") == F.col("first"), 1).otherwise(0)).over(v)).withColumn("n", n)
    x = x.withColumn("all_items", F.max("begun").over(Window.partitionBy(*by)))
    x = x.where(F.col("i") < F.col("n")).withColumn("difference", F.col("left_only") + F.col("all_items") - F.col("begun"))
    return x.groupBy(*by).agg(F.min(F.struct("difference", "i")).alias("b")).select(*by, F.col("b.i").alias("split"), F.col("b.difference").alias("difference"))
