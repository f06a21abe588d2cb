"""Long exact spans shared between records.

A suffix automaton of a reference shard gives, for a document streamed through it, the longest match that ends at each
character (matching statistics); the maximal matches of at least `min_chars` are the shared spans. Broadcasting the
automata of all shards to all documents costs the square of the corpus, so each document is streamed only through the
shards that it can share a span with. Routing loses none: of every span of min_chars characters the k-gram of smallest
hash is a key, so two texts with a common span have a common key. A reference goes once to each group of its documents; its shards' automata
are built when a document comes that holds a span with the hash of one of theirs, and only the stretches of such spans are streamed.

Keys that many texts have (standing phrases shorter than min_chars) are replaced by the hashes of all spans of
min_chars characters around them, which is exact and spreads them over as many keys as there are contexts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexloom.llm.words import code_points, prefix_hash, span_hash
from lexloom.session import durable

#: A key of more texts than this gives way to the hashes of whole spans.
WIDE = 48
#: Documents in SAMPLE_ONE_IN are looked at to know such keys beforehand (which only moves work, and never the result).
SAMPLE_ONE_IN, SAMPLE_HITS, SAMPLE_KEYS = 64, 12, 4096
#: Bits of the filter that keeps documents without partners out of the shuffle; its table has at most FILTER_BITS / 64 rows.
FILTER_BITS = 1 << 23
#: Characters of one reference shard, and automata of one reference that are kept built.
SHARD, BUILT = 100_000, 4
#: Documents that one copy of a reference serves; a reference of more is sent to several tasks.
PARTNERS = 256


def sliding(x: np.ndarray, w: int, op) -> np.ndarray:
    """op (np.minimum or np.maximum) over x[i : i + w] for each i; the last w - 1 windows are cut off."""
    step, out = 1, x
    while step * 2 <= w:
        out = op(out[:-step], out[step:])
        step *= 2
    return op(out[: len(x) - w + 1], out[w - step : len(x) - step + 1]) if step < w else out


def winnow(texts: list[str], length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(index of the text, position among all characters, hash) of the selected k-grams, the prefix hashes and the texts' bounds.

    Each span of `length` characters within a text holds at least one selected k-gram, chosen by the span's characters alone."""
    codes = code_points("".join(texts))
    bounds = np.cumsum([0, *(len(t) for t in texts)])
    prefix = prefix_hash(codes)
    none = np.zeros(0, np.int64)
    if len(codes) < length:
        return none, none, np.zeros(0, np.uint64), prefix, bounds
    at = np.arange(len(codes) - k + 1)
    h = span_hash(prefix, at, at + k) | np.uint64(1)
    w = length - k + 1
    low = sliding(h, w, np.minimum)
    end = np.repeat(bounds[1:], np.diff(bounds))
    low[np.arange(len(low)) + length > end[: len(low)]] = 0  # a window over two texts is none
    pad = np.zeros(w - 1, np.uint64)
    high = sliding(np.concatenate([pad, low, pad]), w, np.maximum)
    pick = np.flatnonzero(high == h)
    return np.searchsorted(bounds, pick, side="right") - 1, pick, h[pick], prefix, bounds


def around(prefix: np.ndarray, bounds: np.ndarray, text: np.ndarray, pos: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the text, hash) of every span of `length` characters that holds a k-gram at one of the positions."""
    off = np.arange(length - k + 1)
    start = (pos[:, None] - off[None, :]).ravel()
    t = np.repeat(text, len(off))
    ok = (start >= bounds[t]) & (start + length <= bounds[t + 1])
    start, t = start[ok], t[ok]
    return t, span_hash(prefix, start, start + length) & ~np.uint64(1)


class Automaton:
    """The suffix automaton of a text."""

    def __init__(self, text: str):
        nxt: list[dict[str, int]] = [{}]
        link, length = [-1], [0]
        last = 0
        for c in text:
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(nxt)
                    nxt.append(nxt[q].copy())
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and nxt[p].get(c) == q:
                        nxt[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        self.nxt, self.link, self.length = nxt, link, length

    def spans(self, text: str, least: int) -> list[tuple[int, int]]:
        """The maximal spans of `text` of at least `least` characters that the automaton's text holds."""
        nxt, link, length = self.nxt, self.link, self.length
        state, size, out = 0, 0, []
        for i, c in enumerate(text):
            before = size
            while state and c not in nxt[state]:
                state = link[state]
                size = length[state]
            if c in nxt[state]:
                state = nxt[state][c]
                size += 1
            if before >= least and size != before + 1:
                out.append((i - before, i))
        if size >= least:
            out.append((len(text) - size, len(text)))
        return out


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def stretches(at: np.ndarray, length: int) -> list[tuple[int, int]]:
    """The union of the windows of `length` characters that begin at each of the sorted places."""
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > length)
    first, last = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(at) - 1]])
    return list(zip(at[first].tolist(), (at[last] + length).tolist()))


def among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of x are in known, a sorted array."""
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


class Shards:
    """A reference text in shards that overlap by one character less than a span, and the automata of those that were asked for."""

    def __init__(self, text: str, least: int):
        self.text, self.least = text, least
        self.prefix = prefix_hash(code_points(text))
        self.h = self._windows(self.prefix, least)
        self.shards = [np.unique(self.h[i : i + SHARD]) for i in range(0, len(self.h), SHARD)]
        self.built: dict[int, Automaton] = {}

    @staticmethod
    def _windows(prefix: np.ndarray, size: int, start: int = 0, end: int | None = None) -> np.ndarray:
        at = np.arange(start, max(start, (len(prefix) - 1 if end is None else end) - size + 1))
        return span_hash(prefix, at, at + size)

    def automaton(self, n: int) -> Automaton:
        if (auto := self.built.pop(n, None)) is None:
            if len(self.built) >= BUILT:
                del self.built[next(iter(self.built))]
            auto = Automaton(self.text[n * SHARD : (n + 1) * SHARD + self.least - 1])
        self.built[n] = auto
        return auto

    def shared(self, text: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]], int]:
        """The shared spans in the reference and in `text`, each as a union, and the longest match.

        The automaton decides which spans of `text` the reference holds; where they stand in the reference is looked up by their hashes."""
        least = self.least
        prefix = prefix_hash(code_points(text))
        h = self._windows(prefix, least)
        sure, found, longest = np.zeros(len(h), bool), [], 0
        for n, known in enumerate(self.shards):
            for s, e in stretches(np.flatnonzero(among(h, known)), least):
                for x, y in self.automaton(n).spans(text[s:e], least):
                    sure[s + x : s + y - least + 1] = True
                    found.append((s + x, s + y))
                    longest = max(longest, y - x)
        if not longest:
            return [], [], 0
        theirs = union(found)
        mine = stretches(np.flatnonzero(among(self.h, np.unique(h[sure]))), least)
        return mine, theirs, longest if len(self.shards) == 1 else self._longest(prefix, mine, theirs, longest)

    def _longest(self, prefix: np.ndarray, mine: list[tuple[int, int]], theirs: list[tuple[int, int]], low: int) -> int:
        """The longest match where one may go over the ends of shards: at least `low`, at most the longest stretch on both sides."""
        high = min(max(e - s for s, e in x) for x in (mine, theirs))

        def common(size: int) -> bool:
            a, b = (np.concatenate([self._windows(p, size, s, e) for s, e in x if e - s >= size]) for p, x in ((self.prefix, mine), (prefix, theirs)))
            return bool(among(a, np.sort(b)).any())

        if high > low and common(high):
            return high
        while low < high - 1:
            size = (low + high) // 2
            low, high = (size, high) if common(size) else (low, size)
        return low


def _keyed(src: DataFrame, length: int, k: int, hot: np.ndarray) -> DataFrame:
    """(key, doc) of the selected k-grams of each text; a hot one gives the keys of the spans around it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, a = b.column("t").to_pylist(), 0
            while a < len(texts):
                z, chars = a, 0
                while z < len(texts) and (z == a or chars + len(texts[z]) <= 400_000):
                    chars += len(texts[z])
                    z += 1
                t, pos, h, prefix, bounds = winnow(texts[a:z], length, k)
                if len(hot):
                    wide = np.isin(h, hot)
                    t2, h2 = around(prefix, bounds, t[wide], pos[wide], length, k)
                    t, h = np.concatenate([t[~wide], t2]), np.concatenate([h[~wide], h2])
                order = np.lexsort((h, t))
                t, h = t[order], h[order]
                first = np.ones(len(t), bool)
                first[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
                t, h = t[first], h[first]
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), b.column("doc").take(pa.array(t + a))], names=["key", "doc"])
                a = z

    return src.select("t", "doc").mapInArrow(run, "key bigint, doc bigint")


def _in_common(keyed: DataFrame) -> DataFrame:
    """(key, doc, n, least) of the keys that several documents have, with their number and the smallest of them.

    The keys are written once; a partial aggregate finds the common ones, so that the rows of one key never have to meet in one task, and the join
    with them is one that adaptive execution splits."""
    spark, folder = keyed.sparkSession, checkpoint_folder(keyed.sparkSession)
    path = f"{folder}/keys-{uuid.uuid4()}"
    keyed.write.parquet(path)
    rows = spark.read.parquet(path)
    common = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("least"), F.max("doc").alias("most")).where("least <> most").select("key", "n", "least")
    out = durable(rows.join(common, "key").select("key", "doc", "n", "least"))
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return out


def checkpoint_folder(spark) -> str:
    """The shared folder that lineage cuts go to."""
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        durable(spark.range(1))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def listed(docs: DataFrame, key: str, ids: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """docs with `_listed`: true for every row whose key is in ids, and for few others. A bit table of fixed size is broadcast, whatever the number of ids."""
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    words = ids.select(slot(F.col(ids.columns[0])).alias("s")).groupBy((F.col("s") / 64).cast("int").alias("_word")).agg(F.expr("bit_or(shiftleft(1L, cast(pmod(s, 64) as int)))").alias("_bits"))
    x = docs.withColumn("_s", slot(F.col(f"`{key}`"))).withColumn("_w", (F.col("_s") / 64).cast("int"))
    x = x.join(F.broadcast(words), F.col("_w") == F.col("_word"), "left")
    hit = F.expr("coalesce((shiftright(_bits, cast(pmod(_s, 64) as int)) & 1) = 1, false)")
    return x.select(*[f"`{c}`" for c in docs.columns], hit.alias("_listed"))


def only(docs: DataFrame, key: str, ids: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """docs without most rows whose key is not in ids."""
    return listed(docs, key, ids, bits).where("_listed").drop("_listed")


def without(docs: DataFrame, key: str, ids: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """docs without the rows whose key is in ids. Only rows that the bit table lists are shuffled to be sure."""
    x = listed(docs, key, ids, bits)
    sure = x.where("not _listed").drop("_listed")
    return sure.unionByName(x.where("_listed").drop("_listed").join(ids.select(F.col(ids.columns[0]).alias(key)), key, "left_anti").select(*docs.columns))


class SharedSpans:
    """Spans of at least min_chars characters that texts of different documents hold character for character.

    docs: `key` (bigint) and `text`. Null keys, null texts and texts under min_chars characters share nothing; repeated rows count as
    one document. Copies of one text form a class, named by its smallest key, and only one of them is compared. Extra columns are not read.
    """

    def __init__(self, docs: DataFrame, key: str, text: str, min_chars: int = 240, k: int | None = None):
        self.least, self.k = min_chars, k or min_chars * 7 // 12
        t = F.col(f"`{text}`")
        self.docs = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc"), t.alias("t")).where(F.col("doc").isNotNull() & (F.length("t") >= min_chars))
        # Of copies one goes on; a text that many documents have meets in a partial aggregate, never in one task.
        self.members = durable(self._copies())

    @cached_property
    def common(self) -> DataFrame:
        """(key, doc, n, least): k-grams (odd) of at most WIDE texts, and whole spans (even) of any number of texts, which prove that they share."""
        src = without(self.docs, "doc", self.members.where("doc <> rep").select("doc"))
        first = _in_common(_keyed(src, self.least, self.k, self._hot(src)))
        # a k-gram of many texts is replaced by the whole spans around it
        wide = (F.col("n") > WIDE) & (F.col("key").bitwiseAND(1) == 1)
        again = first.where(wide).groupBy("doc").agg(F.collect_set("key").alias("keys"))
        texts = only(self.docs, "doc", again.select("doc")).join(again, "doc")
        return first.where(~wide).unionByName(_in_common(self._whole_spans(texts)))

    def candidates(self, one_each: bool = False) -> DataFrame:
        """Pairs (a, b), a < b, that may share a span. one_each: of a whole span the first text stands for all, so that there are as many pairs as texts."""
        a, b = self.common.select("key", F.col("doc").alias("a")), self.common.select("key", F.col("doc").alias("b"))
        if not one_each:
            return durable(a.join(b, "key").where("a < b").select("a", "b").distinct())
        odd = F.col("key").bitwiseAND(1) == 1
        narrow = a.where(odd).join(b.where(odd), "key").where("a < b").select("a", "b")
        return durable(narrow.unionByName(self.common.where(~odd & (F.col("least") < F.col("doc"))).select(F.col("least").alias("a"), F.col("doc").alias("b"))).distinct())

    def _hot(self, src: DataFrame) -> np.ndarray:
        some = src.where(F.pmod(F.xxhash64("doc"), F.lit(SAMPLE_ONE_IN)) == 0)
        keys = _keyed(some, self.least, self.k, np.zeros(0, np.uint64)).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SAMPLE_HITS)
        rows = keys.orderBy(F.desc("n"), "key").limit(SAMPLE_KEYS).select("key").collect()
        return np.array([r.key for r in rows], np.int64).view(np.uint64)

    def _whole_spans(self, texts: DataFrame) -> DataFrame:
        least, k = self.least, self.k

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for doc, t, keys in zip(*(b.column(c).to_pylist() for c in ("doc", "t", "keys"))):
                    i, pos, g, prefix, bounds = winnow([t], least, k)
                    ok = np.isin(g, np.array(keys, np.int64).view(np.uint64))
                    x = np.unique(around(prefix, bounds, i[ok], pos[ok], least, k)[1])
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(np.full(len(x), doc, np.int64))], names=["key", "doc"])

        return texts.select("doc", "t", "keys").mapInArrow(run, "key bigint, doc bigint")

    def representatives(self, pairs: DataFrame) -> DataFrame:
        """The verified ones of some pairs of different texts: a, b, longest, and the shared spans in a and in b.

        The text of a goes once to each group of PARTNERS of its documents, and they are streamed through its automata."""
        least = self.least
        groups = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).alias("groups"))
        work = pairs.join(groups, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("groups")).cast("int").alias("part"))
        ends = work.select("a", "part", F.lit(None).cast("bigint").alias("b"), F.col("a").alias("doc")).distinct().unionByName(work.select("a", "part", "b", F.col("b").alias("doc")))
        texts = only(self.docs, "doc", ends.select("doc")).dropDuplicates(["doc"])
        tasks = int(self.docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # by number: small texts may be much work, which sizes don't tell
        rows = ends.join(texts, "doc").select("a", "part", "b", "t").repartition(tasks, "a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
        span = "array<struct<s: int, e: int>>"
        kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            reference = None
            for x in batches:
                out = []
                for a, b, t in zip(*(x.column(c).to_pylist() for c in ("a", "b", "t"))):
                    if b is None:
                        reference = Shards(t, least)
                        continue
                    mine, theirs, longest = reference.shared(t)
                    if longest:
                        out.append((a, b, longest, [{"s": s, "e": e} for s, e in mine], [{"s": s, "e": e} for s, e in theirs]))
                cols = list(zip(*out)) if out else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), kind, kind))], names=["a", "b", "longest", "sa", "sb"])

        return rows.mapInArrow(run, f"a bigint, b bigint, longest int, sa {span}, sb {span}")

    def _copies(self) -> DataFrame:
        """(doc, rep, chars) of the documents whose text another document has too."""
        x = self.docs.select("doc", F.md5("t").alias("m"), F.length("t").alias("chars")).distinct()
        many = x.groupBy("m").agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1")
        return x.join(many, "m").select("doc", "rep", "chars")

    def pairs(self) -> DataFrame:
        """All pairs of documents that share a span: doc_a < doc_b, each once, whole copies included.

        Pairs of different texts come from the automata; copies of one text are pairs by their class, without being compared again."""
        members = self.members.select("rep", "doc")
        reps = self.representatives(self.candidates()).select("a", "b")
        x = reps.join(members.select(F.col("rep").alias("a"), F.col("doc").alias("da")), "a", "left").join(members.select(F.col("rep").alias("b"), F.col("doc").alias("db")), "b", "left")
        x = x.select(F.coalesce("da", "a").alias("x"), F.coalesce("db", "b").alias("y"))
        same = members.select("rep", F.col("doc").alias("x")).join(members.select("rep", F.col("doc").alias("y")), "rep").where("x < y").select("x", "y")
        return x.unionByName(same).select(F.least("x", "y").alias("doc_a"), F.greatest("x", "y").alias("doc_b")).distinct()

    def coverage(self) -> DataFrame:
        """Per document that shares anything: its class (the smallest document of the same text), characters, how many of them other
        documents share, and in how many separate stretches. A copy of another document is shared as a whole.

        A phrase that many texts have is compared with the first of them alone, so the work follows the texts and not their pairs."""
        members = self.members
        pairs = durable(self.representatives(self.candidates(one_each=True)))
        spans = pairs.select(F.col("a").alias("rep"), F.explode("sa").alias("x")).unionByName(pairs.select(F.col("b").alias("rep"), F.explode("sb").alias("x"))).select("rep", "x.s", "x.e").distinct()
        w = Window.partitionBy("rep").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
        new = spans.withColumn("to", F.coalesce(F.max("e").over(w), F.lit(-1))).select("rep", F.greatest(F.lit(0), F.col("e") - F.greatest("s", "to")).alias("n"), (F.col("s") > F.col("to")).cast("int").alias("begins"))
        covered = new.groupBy("rep").agg(F.sum("n").alias("covered"), F.sum("begins").alias("stretches"))
        plain = members.select("doc", "rep", "chars", F.col("chars").cast("bigint").alias("shared"), F.lit(1).cast("bigint").alias("stretches"))
        single = covered.join(members.select("rep").distinct(), "rep", "left_anti")
        single = only(self.docs, "doc", single.select("rep")).dropDuplicates(["doc"]).select("doc", F.length("t").alias("chars")).join(single, F.col("doc") == F.col("rep"))
        single = single.select("doc", "rep", "chars", F.col("covered").cast("bigint").alias("shared"), "stretches")
        return plain.unionByName(single).select(F.col("doc").alias("doc_id"), F.col("rep").alias("class_id"), F.col("chars").alias("n_chars"), F.col("shared").alias("n_shared"), F.col("stretches").alias("n_stretches"))
