"""Evaluation texts leaking into training text.

Every window of as many words as a passage must have gets a 64-bit SimHash, in corpus and items alike. Fingerprints are
compared in blocks: with `radius` differing bits and radius + 1 blocks, some block is equal, so looking up each block of
a corpus window among those of the items finds every window within the radius. Windows whose words are the same make runs of shared words: an
exact leak.

A near leak is a window in which one word is another one. A single word can turn only those bits of a SimHash whose votes are nearly even; so each item
window is entered under all values of these bits in that block of 16 which has the fewest of them, and no window with one changed word is missed.
The weighted similarity of the words decides.

The sums behind the SimHash are kept as 16 counters of 4 bits in a word; sliding windows are differences of running
sums modulo 2^64, exact since a window of at most 15 words never overflows a counter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.words import mix, word_hashes

_ONES = np.uint64(0x1111111111111111)
_TOPS = np.uint64(0x8888888888888888)


def simhash_windows(words: np.ndarray, n: int) -> np.ndarray:
    """The SimHash of each window of n words (n odd, at most 15): a bit is set if more than half of the words have it."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    bias = np.uint64(8 - (n + 1) // 2) * _ONES  # lifts a majority to 8, the top bit of its counter
    for k in range(4):
        lane = np.zeros(len(words) + 1, np.uint64)
        np.cumsum((words >> np.uint64(k)) & _ONES, dtype=np.uint64, out=lane[1:])
        out |= (((lane[n:] - lane[:-n] + bias) & _TOPS) >> np.uint64(3)) << np.uint64(k)
    return out


class Blocks:
    """Fingerprints of the items in blocks of bits, each block with a bit table before the exact search."""

    def __init__(self, prints: np.ndarray, radius: int, table_bits: int = 22):
        self.prints, self.bits = prints, table_bits
        cuts = np.linspace(0, 64, radius + 2).astype(int)
        self.parts = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            mask = np.uint64((1 << int(b)) - (1 << int(a)))
            keys, order = np.unique(prints & mask, return_inverse=True)
            seen = np.zeros(1 << table_bits, bool)
            seen[self._slot(keys)] = True
            by = np.argsort(order, kind="stable")
            self.parts.append((mask, keys, seen, by, np.searchsorted(order[by], np.arange(len(keys) + 1))))

    def _slot(self, x: np.ndarray) -> np.ndarray:
        return (mix(x) >> np.uint64(64 - self.bits)).astype(np.int64)

    def candidates(self, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (index of a print, index of an item print) within the radius, each once."""
        left, right = [], []
        for mask, keys, seen, by, at in self.parts:
            if not len(keys):
                continue
            x = prints & mask
            hit = np.flatnonzero(seen[self._slot(x)])
            k = np.minimum(np.searchsorted(keys, x[hit]), len(keys) - 1)
            ok = keys[k] == x[hit]
            hit, k = hit[ok], k[ok]
            size = at[k + 1] - at[k]
            ends = np.cumsum(size)
            left.append(np.repeat(hit, size))
            right.append(by[np.repeat(at[k] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
        near = np.bitwise_count(prints[a] ^ self.prints[b]) <= radius
        pairs = np.unique(np.stack([a[near], b[near]], axis=1), axis=0)
        return pairs[:, 0], pairs[:, 1]


class Changed:
    """Item windows under every fingerprint that a window with one changed word may have."""

    def __init__(self, windows: np.ndarray, prints: np.ndarray):
        n = windows.shape[1] if windows.ndim == 2 else 1
        votes = np.stack([((windows >> np.uint64(b)) & np.uint64(1)).sum(axis=1) for b in range(64)], axis=1) if len(prints) else np.zeros((0, 64), np.uint64)
        even = (votes == (n - 1) // 2) | (votes == (n + 1) // 2)
        self.prints = prints
        self.firm = ~(even.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        block = even.reshape(-1, 4, 16).sum(axis=2).argmin(axis=1)
        self.tables = []
        for k in range(4):
            keys, owner = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i in np.flatnonzero(block == k):
                base = int(prints[i] & self.firm[i]) >> 16 * k & 0xFFFF
                values = np.array([base])
                for b in np.flatnonzero(even[i, 16 * k : 16 * k + 16]):
                    values = np.concatenate([values, values | 1 << int(b)])
                keys.append(values)
                owner.append(np.full(len(values), i))
            key, of = np.concatenate(keys), np.concatenate(owner)
            by = np.argsort(key, kind="stable")
            self.tables.append((of[by], np.searchsorted(key[by], np.arange((1 << 16) + 1))))

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (index of a print, index of an item window) that agree in all bits which one changed word can't turn."""
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k, (of, at) in enumerate(self.tables):
            v = ((prints >> np.uint64(16 * k)) & np.uint64(0xFFFF)).astype(np.int64)
            size = at[v + 1] - at[v]
            hit = np.flatnonzero(size)
            size = size[hit]
            ends = np.cumsum(size)
            a = np.repeat(hit, size)
            b = of[np.repeat(at[v[hit]] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
            same = ((prints[a] ^ self.prints[b]) & self.firm[b]) == 0
            left.append(a[same])
            right.append(b[same])
        return np.concatenate(left), np.concatenate(right)


def word_similarity(a: np.ndarray, b: np.ndarray, weight: dict[int, float]) -> float:
    """Weighted Jaccard similarity of the words of two windows, each word as often as it stands; a word that no item has weighs 1."""
    x, y = Counter(a.tolist()), Counter(b.tolist())
    shared = sum(weight.get(w, 1.0) * n for w, n in (x & y).items())
    total = sum(weight.get(w, 1.0) * n for w, n in (x | y).items())
    return shared / total if total else 1.0


class ItemIndex:
    """The words and window fingerprints of the evaluation items."""

    def __init__(self, ids: list[int], texts: list[str | None], n: int, radius: int, near: bool = False):
        self.ids, self.n = ids, n
        self.words, self.at = word_hashes(texts)
        item, pos, prints = [], [], []
        for i in range(len(ids)):
            p = simhash_windows(self.words[self.at[i] : self.at[i + 1]], n)
            item += [i] * len(p)
            pos += range(len(p))
            prints.append(p)
        self.item, self.pos = np.array(item, np.int64), np.array(pos, np.int64)
        every = np.concatenate(prints) if prints else np.zeros(0, np.uint64)
        self.blocks = Blocks(every, radius)
        self.windows = self.words[(self.at[self.item] + self.pos)[:, None] + np.arange(n)] if len(item) else np.zeros((0, n), np.uint64)
        self.changed = Changed(self.windows, every) if near else None
        seen, count = np.unique(np.concatenate([np.unique(self.words[self.at[i] : self.at[i + 1]]) for i in range(len(ids))] or [np.zeros(0, np.uint64)]), return_counts=True)
        self.weight = {int(w): float(np.log(1 + len(ids) / c)) for w, c in zip(seen, count)}

    def _within(self, w: np.ndarray, k: np.ndarray, at: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Candidates that lie in one text, with the text, and how many words are the same place by place."""
        doc = np.searchsorted(at, w, side="right") - 1
        inside = w + self.n <= at[doc + 1]
        w, k, doc = w[inside], k[inside], doc[inside]
        same = [(words[w[a : a + 65536, None] + np.arange(self.n)] == self.windows[k[a : a + 65536]]).sum(axis=1) for a in range(0, len(w), 65536)]
        return w, k, doc, np.concatenate(same) if same else np.zeros(0, np.int64)

    def leaks(self, texts: list[str | None], radius: int, similarity: float) -> Iterator[tuple[int, int, str, float, int, int, int]]:
        """(text, item, kind, similarity, words of the item, first word in the text, most words in a row) of each leak."""
        words, at = word_hashes(texts)
        n = self.n
        prints = simhash_windows(words, n)
        w, k, doc, same = self._within(*self.blocks.candidates(prints, radius), at, words)
        runs: dict[tuple[int, int, str], list[tuple[int, int, float]]] = {}
        for j in np.flatnonzero(same == n).tolist():
            i = int(self.item[k[j]])
            runs.setdefault((int(doc[j]), i, "exact"), []).append((int(w[j] - at[doc[j]]), int(self.pos[k[j]]), 1.0))
        if self.changed:
            w, k, doc, same = self._within(*self.changed.candidates(prints), at, words)
            for j in np.flatnonzero(same == n - 1).tolist():
                t, i = int(doc[j]), int(self.item[k[j]])
                if (t, i, "exact") not in runs and (q := word_similarity(words[w[j] : w[j] + n], self.windows[k[j]], self.weight)) >= similarity:
                    runs.setdefault((t, i, "near"), []).append((int(w[j] - at[t]), int(self.pos[k[j]]), q))
        for (t, i, kind), found in sorted(runs.items()):
            covered = {q for _, p, _ in found for q in range(p, p + n)}
            longest, diagonal = n, {}
            for x, p, _ in sorted(found):
                start, last = diagonal.get(x - p, (x, x - 1))
                start = x if x > last + 1 else start
                diagonal[x - p] = (start, x)
                longest = max(longest, x - start + n)
            yield t, i, kind, max(q for _, _, q in found), len(covered), min(x for x, _, _ in found), longest


#: Items beyond this many characters in all are not broadcast as one index but in several passes over the corpus.
SHARD_CHARS = 20_000_000


def find_leaks(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, min_words: int = 13, radius: int = 1, similarity: float = 0.8, near: bool = False) -> DataFrame:
    """Which documents hold at least `min_words` consecutive words of which items.

    Result, one row per row of docs and item: `key`, `item_key`, kind, similarity, n_words (words of the item that lie in the shared windows),
    first_word (where the first of them begins in the document, in words from 0), longest_run (in words), item_words (words
    of the item). kind is `exact`, or, if `near` is asked for, `near` for a document without such a run, in which one word of it is
    another and the words' weighted similarity is at least `similarity`. Words are the runs of letters and digits of the NFKC form in lower case, so punctuation, case and
    line breaks don't matter. Null and empty texts and items under min_words words give no rows; repeated documents
    each give theirs, repeated items too. The items are a bounded evaluation set: they are read to the driver in shards of at most
    SHARD_CHARS characters (or one item), each of which is one pass over the documents."""
    if min_words % 2 == 0 or not 1 <= min_words <= 15:
        raise ValueError("min_words is an odd number up to 15")
    out = "k bigint, i bigint, kind string, similarity double, n_words int, first_word bigint, longest_run int, item_words int"
    src = docs.select(F.col(f"`{key}`").cast("bigint").alias("k"), F.col(f"`{text}`").alias("t"))
    src = src.where(F.length("t") > 0)
    shards: list[tuple[list[int], list[str]]] = [([], [])]
    chars = 0
    for r in items.select(F.col(f"`{item_key}`").cast("bigint").alias("i"), F.col(f"`{item_text}`").alias("t")).where(F.length("t") > 0).toLocalIterator():
        if chars and chars + len(r.t) > SHARD_CHARS:
            shards.append(([], []))
            chars = 0
        shards[-1][0].append(r.i)
        shards[-1][1].append(r.t)
        chars += len(r.t)
    parts = []
    for ids, texts in shards:
        shared = df_broadcast(docs, (ids, texts))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = None
            for b in batches:
                index = index or ItemIndex(*shared.value, min_words, radius, near)
                size = np.diff(index.at)
                for a in range(0, b.num_rows, 512):
                    keys = b.column(0).slice(a, 512).to_pylist()
                    rows = [
                        (keys[t], index.ids[i], kind, q, words, first, longest, int(size[i]))
                        for t, i, kind, q, words, first, longest in index.leaks(b.column(1).slice(a, 512).to_pylist(), radius, similarity)
                    ]
                    kinds = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
                    cols = list(zip(*rows)) if rows else [()] * 8
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(cols, kinds)], names=[x.split()[0] for x in out.split(", ")])

        parts.append(src.mapInArrow(run, out))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found.select(F.col("k").alias(key), F.col("i").alias(item_key), "kind", "similarity", "n_words", "first_word", "longest_run", "item_words")


def df_broadcast(df: DataFrame, value):
    return df.sparkSession.sparkContext.broadcast(value)
