"""Raw documents, manifests, listings and work lists.

Fetching is outside of the engine: files land on disk, and these readers start from there."""

from __future__ import annotations

import importlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Provenance-headed documents: path, meta (map), body. The header stands between two `---` lines, one `key: value` each (cut at the first colon,
    quotes trimmed); a comment behind it is dropped. A file without a header has an empty map."""
    return parse_raw(spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value"))


def parse_raw(texts: DataFrame) -> DataFrame:
    """read_raw for texts that are at hand: path, value."""
    t = texts.select("path", F.regexp_replace("value", "^﻿", "").alias("v"))
    head = F.regexp_extract("v", r"(?s)^---\r?\n(.*?)\r?\n---\r?\n", 1)
    lines = F.filter(F.split(head, r"\r?\n"), lambda x: x.contains(":"))
    entry = lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("key"), F.regexp_replace(F.trim(F.regexp_replace(x, r"^[^:]*:", "")), r"^[\"']|[\"']$", "").alias("value"))
    last = F.aggregate(F.transform(lines, entry), F.create_map().cast("map<string, string>"), lambda a, e: F.map_concat(F.map_filter(a, lambda k, _: k != e["key"]), F.create_map(e["key"], e["value"])))
    body = F.regexp_replace(F.regexp_replace("v", r"(?s)^---\r?\n.*?\r?\n---\r?\n", ""), r"(?s)^\s*<!--.*?-->\s*", "")
    return t.select("path", last.alias("meta"), body.alias("body"))


def read_json(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """JSON files, tolerant of a byte order mark and of text around the outermost braces: parsed rows (path, r), and the paths that can't be read."""
    return parse_json(spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value"), schema)


def parse_json(texts: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """read_json for texts that are at hand: path, value."""
    t = texts.select("path", F.regexp_replace("value", "^﻿", "").alias("v"))
    whole = F.coalesce(F.nullif(F.regexp_extract("v", r"(?s)\{.*\}", 0), F.lit("")), F.col("v"))
    x = t.select("path", F.from_json(whole, schema + ", _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("r"))
    ok = F.col("r").isNotNull() & F.col("r._bad").isNull()
    return x.where(ok), x.where(~ok).select("path")


def read_manifest(spark: SparkSession, path: str, item: str, field: str = "sections") -> DataFrame:
    """The list of file records in a manifest, one row each."""
    return parse_manifest(spark.read.text(path, wholetext=True), item, field)


def parse_manifest(texts: DataFrame, item: str, field: str = "sections") -> DataFrame:
    """read_manifest for texts that are at hand: value."""
    t = texts.select(F.from_json(F.regexp_replace("value", "^﻿", ""), f"{field} array<struct<{item}>>").alias("m"))
    return t.select(F.inline(F.col(f"m.{field}")))


def read_pdf(spark: SparkSession, path: str, library: str = "pdfplumber") -> DataFrame:
    """Words of PDF files with their geometry: path, page (from 1), x0, x1, top, size, text, and error for a file that can't be read. Needs a PDF library on the workers;
    without it every file comes as one row with the error, so that none is lost unseen."""
    src = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path).select("path", "content")
    out = "path string, page int, x0 double, x1 double, top double, size double, text string, error string"
    names = [x.split()[0] for x in out.split(", ")]
    kinds = [pa.string(), pa.int32(), *[pa.float64()] * 4, pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                try:
                    with importlib.import_module(library).open(io.BytesIO(content)) as pdf:
                        rows = [(name, n, float(w["x0"]), float(w["x1"]), float(w["top"]), float(w["size"]), w["text"], None) for n, page in enumerate(pdf.pages, 1) for w in page.extract_words(extra_attrs=["size"])]
                except Exception as e:  # noqa: BLE001
                    rows = [(name, *[None] * 6, f"{type(e).__name__}: {e}"[:200])]
                cols = list(zip(*rows)) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return src.mapInArrow(run, out)


def pages(df: DataFrame, key: str, text: str) -> DataFrame:
    """Texts whose pages are parted by form feeds: key, page (from 1), text."""
    return df.select(key, F.posexplode(F.split(text, "\f")).alias("p", "text")).select(key, (F.col("p") + 1).alias("page"), "text")


def hrefs(df: DataFrame, key: str, html: str) -> DataFrame:
    """Links of a page in order: key, seq, href, label."""
    p = r"(?is)<a\b[^>]*?href\s*=\s*[\"']([^\"']+)[\"'][^>]*>(.*?)</a>"
    found = F.arrays_zip(F.regexp_extract_all(html, F.lit(p), F.lit(1)).alias("href"), F.regexp_extract_all(html, F.lit(p), F.lit(2)).alias("label"))
    x = df.select(key, F.posexplode(found).alias("seq", "a"))
    return x.select(key, "seq", F.col("a.href").alias("href"), F.trim(F.regexp_replace(F.regexp_replace("a.label", r"<[^>]*>", " "), r"\s+", " ")).alias("label"))


def universe(listings: DataFrame, group: str, html: str, pattern: str) -> DataFrame:
    """What should exist, by directory listings: the group and its number of matching links without the contents page; -1 where no listing was had."""
    n = F.size(F.array_distinct(F.regexp_extract_all(html, F.lit(pattern), F.lit(1))))
    return listings.select(group, F.when(F.col(html).isNull(), F.lit(-1)).otherwise(F.greatest(n - 1, F.lit(0))).alias("expected"))


def discover(seeds: DataFrame, links: DataFrame, wanted: str = r"(?i)rule|admin|chapter", skip: str = r"(?i)\.(jpe?g|png|gif|zip|css|js|mp4)$", most: int = 40) -> DataFrame:
    """One hop from the seeds (url): pages they link to on the same host or state domain whose address looks wanted, with their depth. `most` pages a seed, the first by place, are the feature."""
    host = lambda c: F.lower(F.parse_url(c, F.lit("HOST")))
    x = seeds.select("url").distinct().join(links.select(F.col("page").alias("url"), "seq", "href"), "url")
    same = (host(F.col("url")) == host(F.col("href"))) | (host(F.col("href")).rlike(r"(^|\.)gov$") & (F.substring_index(host(F.col("href")), ".", -2) == F.substring_index(host(F.col("url")), ".", -2)))
    x = x.where(same & F.col("href").rlike(wanted) & ~F.col("href").rlike(skip)).groupBy("url", "href").agg(F.min("seq").alias("seq"))
    x = x.withColumn("r", F.row_number().over(Window.partitionBy("url").orderBy("seq", "href"))).where(F.col("r") <= most)
    one = x.select(F.col("href").alias("url"), F.lit(1).alias("depth"))
    return seeds.select("url", F.lit(0).alias("depth")).unionByName(one).groupBy("url").agg(F.min("depth").alias("depth"))


def first_listed(df: DataFrame, key: str, order: Column) -> DataFrame:
    """The first listing of each key."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_r = 1").drop("_r")


def chapter_index(df: DataFrame, doc: str, text: str) -> DataFrame:
    """A master index in blocks parted by blank lines: a TITLE block heads the blocks behind it, and a block that is a number names the next one. doc, title, num, name.

    A block used as a name isn't itself read as a number; the first name of a number stays."""
    b = df.select(doc, F.posexplode(F.split(text, r"\n\s*\n")).alias("i", "b")).withColumn("b", F.trim(F.regexp_replace("b", r"\s+", " "))).where("b <> ''")
    w = Window.partitionBy(doc).orderBy("i")
    title = F.nullif(F.regexp_extract("b", r"^TITLE\s+(\d+[A-Z]?)", 1), F.lit(""))
    x = b.withColumn("title", F.last(title, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("next", F.lead("b").over(w))
    num = F.col("b").rlike(r"^\d+[A-Z]?\.?$")
    # in a run of number blocks every second one is a name
    run = x.withColumn("is_num", num).withColumn("gap", F.sum(F.when(num, 0).otherwise(1)).over(w))
    run = run.withColumn("k", F.row_number().over(Window.partitionBy(doc, "gap", "is_num").orderBy("i")))
    x = run.where("is_num and k % 2 = 1 and next is not null").select(doc, "i", "title", F.rtrim(F.regexp_replace("b", r"\.$", "")).alias("num"), F.col("next").alias("name"))
    return x.withColumn("_r", F.row_number().over(Window.partitionBy(doc, "num").orderBy("i"))).where("_r = 1").drop("_r", "i")


def pages_from(pages_: DataFrame, doc: str, heading: str) -> DataFrame:
    """The pages from the first one that bears a heading on."""
    w = Window.partitionBy(doc).orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    return pages_.withColumn("_on", F.max(F.col("text").rlike(heading)).over(w)).where("_on").drop("_on")


def pages_by_mode(pages_: DataFrame, doc: str, modes: dict[str, str]) -> DataFrame:
    """Pages with the table that they belong to: the last of the headings seen (name -> pattern)."""
    hit = F.coalesce(*[F.when(F.col("text").rlike(p), F.lit(name)) for name, p in modes.items()])
    w = Window.partitionBy(doc).orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    return pages_.withColumn("mode", F.last(hit, ignorenulls=True).over(w))


def work_list(*sources: DataFrame) -> DataFrame:
    """Links of several sources in order of trust (url and others): each url once, from the most trusted source that has it, in its order (seq)."""
    out = None
    for trust, s in enumerate(sources):
        s = s.withColumn("trust", F.lit(trust))
        out = s if out is None else out.unionByName(s, allowMissingColumns=True)
    return out.withColumn("_r", F.row_number().over(Window.partitionBy("url").orderBy("trust", "seq"))).where("_r = 1").drop("_r")


def with_archived(primary: DataFrame, archived: DataFrame, key: str) -> DataFrame:
    """Documents with archived copies for those that the primary source lacks; `status` says which (ok, ok_archived), never one as the other."""
    a = archived.join(primary.select(key), key, "left_anti").withColumn("status", F.lit("ok_archived"))
    return primary.withColumn("status", F.lit("ok")).unionByName(a, allowMissingColumns=True)


def still_to_do(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a manifest of finished work (key, sha256) lacks or has with another content."""
    return work.join(done.select(key, "sha256"), [key, "sha256"], "left_anti")


def document_state(df: DataFrame, content: str, text: str) -> DataFrame:
    """Validity of fetched documents: not_a_pdf, too_small, scan (under 500 characters of text), else ok."""
    c, t = F.col(content), F.col(text)
    state = F.when(c.isNull(), "fetch_failed").when(F.length(c) < 200, "too_small").when(F.substring(c, 1, 5) != F.lit("%PDF-").cast("binary"), "not_a_pdf").when(F.coalesce(F.length(t), F.lit(0)) < 500, "scan").otherwise("ok")
    return df.withColumn("state", state)
