"""Writing: staged tables, upserts, kept hand-written rows, dumps, pages and snapshots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.operators.relations import upsert
from lexloom.session import durable


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, key: list[str] | None = None) -> None:
    """A table rebuilt as a whole: written aside, checked (no repeated key), then put in place. A failed build leaves the old table as it is."""
    spark, aside = df.sparkSession, f"{path}.staged"
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(aside)
    if key and (bad := spark.read.parquet(aside).groupBy(*key).count().where("count > 1").limit(1).collect()):
        raise ValueError(f"repeated key {bad[0]} in {path}")
    fs, src = _fs(spark, aside)
    dst = spark._jvm.org.apache.hadoop.fs.Path(path)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.old")
    fs.delete(old, True)
    if fs.exists(dst):
        fs.rename(dst, old)
    if not fs.rename(src, dst):
        if fs.exists(old) and not fs.exists(dst):
            fs.rename(old, dst)
        raise OSError(f"could not put {path} in place")
    fs.delete(old, True)


def build(spark: SparkSession, tables: dict[str, DataFrame], root: str, validate: Callable[[str], DataFrame] | None = None, check_only: bool = False) -> DataFrame | None:
    """All tables of a warehouse; `check_only` builds aside, validates and removes. Returns the validation report (name, passed, …)."""
    target = f"{root}.check" if check_only else root
    for name, df in tables.items():
        write_table(df, f"{target}/{name}")
    report = validate(target) if validate else None
    if check_only:
        report = durable(report) if report is not None else None
        fs, p = _fs(spark, target)
        fs.delete(p, True)
    return report


def upsert_table(spark: SparkSession, path: str, new: DataFrame, key: list[str], order: str) -> None:
    """Insert-or-replace into a table; the old rows are cut from the path before it is written again."""
    write_table(durable(upsert(spark.read.parquet(path), new, key, order)), path, key=key)


def keep_handwritten(spark: SparkSession, path: str, rebuilt: DataFrame, key: list[str]) -> DataFrame:
    """A rebuilt table with the hand-written rows of the old one, which win where both have a key; a first build has none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return rebuilt
    old = durable(spark.read.parquet(path))
    return old.unionByName(rebuilt.join(old.select(*key), key, "left_anti"), allowMissingColumns=True)


def dump_json(df: DataFrame, path: str, group: list[str]) -> None:
    """JSON documents, one per group, with a stamp. Groups are documents, so each is bounded by its source."""
    rest = [c for c in df.columns if c not in group]
    df.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias("items")).withColumn("generated", F.current_timestamp()).write.mode("overwrite").json(path)


def section_pages(sections: DataFrame, cites_out: DataFrame, cites_in: DataFrame, curated: DataFrame | None = None) -> DataFrame:
    """Markdown pages: path, content. sections: id, catchline, body. cites_*: id, other. A curated block (id, note) is kept between its marks."""
    names = lambda df, n: df.groupBy("id").agg(F.concat_ws("\n", F.transform(F.array_sort(F.collect_set("other")), lambda x: F.concat(F.lit("- [["), x, F.lit("]]")))).alias(n))
    x = sections.join(names(cites_out, "o"), "id", "left").join(names(cites_in, "i"), "id", "left")
    x = x.join(curated, "id", "left") if curated is not None else x.withColumn("note", F.lit(None).cast("string"))
    block = F.concat(F.lit("<!-- curated -->\n"), F.coalesce("note", F.lit("")), F.lit("\n<!-- /curated -->"))
    page = F.concat_ws("\n\n", F.concat(F.lit("# "), F.col("id"), F.lit(" "), F.coalesce("catchline", F.lit(""))), block, "body", F.concat(F.lit("## Cites\n"), F.col("o")), F.concat(F.lit("## Cited by\n"), F.col("i")))
    return x.select(F.concat(F.regexp_replace(F.lower("id"), "[^0-9a-z.-]", "-"), F.lit(".md")).alias("path"), page.alias("content"))


def curated_blocks(pages: DataFrame) -> DataFrame:
    """The hand-written blocks of pages: path, note."""
    return pages.select("path", F.regexp_extract("content", r"(?s)<!-- curated -->\n(.*?)\n<!-- /curated -->", 1).alias("note")).where("note <> ''")


def inject_notes(notes: DataFrame, sections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Notes (id, note) with their sections, and those whose section is missing."""
    return notes.join(sections.select("id").distinct(), "id", "left_semi"), notes.join(sections.select("id"), "id", "left_anti")


def queue_page(queue: DataFrame, title: str, per_group: int = 50) -> DataFrame:
    """A report in groups as one page: queue has grp, item, n; each group lists its `per_group` largest, a top-k report."""
    w = Window.partitionBy("grp").orderBy(F.desc("n"), "item")
    x = queue.withColumn("r", F.row_number().over(w)).where(F.col("r") <= per_group)
    line = F.concat(F.lit("- "), F.col("item"), F.lit(" ("), F.col("n").cast("string"), F.lit(")"))
    g = x.groupBy("grp").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", line.alias("l")))), lambda y: y["l"]), "\n").alias("t"))
    return g.agg(F.concat(F.lit(f"# {title}\n\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("grp", "t"))), lambda y: F.concat(F.lit("## "), y["grp"], F.lit("\n"), y["t"])), "\n\n")).alias("content"))


def snapshot(df: DataFrame, root: str, day: str) -> DataFrame:
    """A dated, compressed copy with a manifest: rows and an order-free fingerprint, read back and compared."""
    spark, path = df.sparkSession, f"{root}/{day}"
    df.write.mode("overwrite").option("compression", "gzip").parquet(path)
    back = spark.read.parquet(path)
    print_ = lambda x: x.select(F.count(F.lit(1)).alias("rows"), F.sha2(F.coalesce(F.sum(F.xxhash64(*x.columns).cast("decimal(38,0)")), F.lit(0)).cast("string"), 256).alias("sha256"))
    a, b = print_(df).first(), print_(back).first()
    if a != b:
        raise OSError(f"the snapshot in {path} differs from what was written")
    m = spark.createDataFrame([(day, path, a.rows, a.sha256)], "day string, path string, rows bigint, sha256 string")
    m.write.mode("overwrite").json(f"{path}_manifest")
    return m
