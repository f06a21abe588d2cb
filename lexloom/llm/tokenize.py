"""Encoding of a corpus with a public byte-level BPE vocabulary.

Texts are cut into pre-tokens by the vocabulary's pattern. Only pre-tokens not met before in the task are merged, all
at once: they are grouped by length into padded matrices of symbol ids, and in each round every row merges its
leftmost pair of minimum rank, looked up in an open-addressing hash table of pairs; rows without a pair leave the matrix,
and the others are compacted. Ids of a document are then gathered from the pool of merged pre-tokens.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the pattern that cuts text into pre-tokens for byte-level BPE vocabularies of this family.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NONE = np.int32(2**31 - 1)
#: Pre-tokens of more bytes are merged one by one with a heap, since a round costs the whole row.
LONG = 256
#: Pre-tokens that a task remembers; beyond it the memory starts afresh, the ids are the same.
REMEMBER = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> id, from a file of lines `base64 id`."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PairTable:
    """(left id, right id) -> merged id, in arrays with linear probing."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        keys, ids = [], []
        for token, i in ranks.items():
            for cut in range(1, len(token)):
                if (a := ranks.get(token[:cut])) is not None and (b := ranks.get(token[cut:])) is not None:
                    keys.append(a << 32 | b)
                    ids.append(i)
        self.bits = max(4, (4 * len(keys)).bit_length())
        size = 1 << self.bits
        self.keys, self.ids = np.full(size, -1, np.int64), np.full(size, NONE, np.int32)
        k, v = np.array(keys, np.int64), np.array(ids, np.int32)
        slot = self._slot(k)
        while len(k):  # one entry settles in each free slot per round, the others move on
            free = self.keys[slot] == -1
            _, first = np.unique(slot[free], return_index=True)
            at = np.flatnonzero(free)[first]
            self.keys[slot[at]], self.ids[slot[at]] = k[at], v[at]
            rest = np.ones(len(k), bool)
            rest[at] = False
            k, v, slot = k[rest], v[rest], (slot[rest] + 1) & (size - 1)
        self.pairs = dict(zip(keys, ids))

    def _slot(self, k: np.ndarray) -> np.ndarray:
        return ((k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        k = left.astype(np.int64) << 32 | right
        slot = self._slot(k)
        out = np.full(k.shape, NONE, np.int32)
        todo = np.arange(k.size)
        k, slot, flat, mask = k.ravel(), slot.ravel(), out.ravel(), len(self.keys) - 1
        while len(todo):
            found = self.keys[slot[todo]]
            hit = found == k[todo]
            flat[todo[hit]] = self.ids[slot[todo[hit]]]
            todo = todo[~hit & (found != -1)]
            slot[todo] = (slot[todo] + 1) & mask
        return flat.reshape(out.shape)


def merge_rows(table: PairTable, tokens: list[bytes]) -> list[np.ndarray]:
    """Ids of byte strings of at most LONG bytes."""
    out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(tokens)
    lens = np.array([len(t) for t in tokens], np.int64)
    bucket = np.ceil(np.log2(np.maximum(lens, 1))).astype(int)
    for w in np.unique(bucket[lens > 0]):
        rows = np.flatnonzero((bucket == w) & (lens > 0))
        width = 1 << w
        raw = np.frombuffer(b"".join(tokens[i].ljust(width, b"\0") for i in rows), np.uint8).reshape(len(rows), width)
        ids, n = table.byte_ids[raw], lens[rows].copy()
        rank = table.lookup(ids[:, :-1], ids[:, 1:]) if width > 1 else np.full((len(rows), 0), NONE, np.int32)
        col = np.arange(width)
        rank[col[None, 1:] >= n[:, None]] = NONE
        while True:
            best = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(rows), int)
            at = np.arange(len(rows))
            low = rank[at, best] if rank.shape[1] else np.full(len(rows), NONE)
            done = low == NONE
            for i in np.flatnonzero(done):
                out[rows[i]] = ids[i, : n[i]].copy()
            if done.all():
                break
            go = ~done
            rows, ids, rank, n, best, low = rows[go], ids[go], rank[go], n[go], best[go], low[go]
            at = np.arange(len(rows))
            # shift what lies right of the merged pair by one
            width = ids.shape[1]
            src = np.arange(width)[None, :] + (np.arange(width)[None, :] > best[:, None])
            ids = np.take_along_axis(ids, np.minimum(src, width - 1), axis=1)
            ids[at, best] = low
            src = np.arange(width - 1)[None, :] + (np.arange(width - 1)[None, :] > best[:, None])
            rank = np.take_along_axis(rank, np.minimum(src, width - 2), axis=1)
            n = n - 1
            rank[np.arange(1, width)[None, :] >= n[:, None]] = NONE
            has = best > 0
            rank[at[has], best[has] - 1] = table.lookup(ids[at[has], best[has] - 1], ids[at[has], best[has]])
            has = best + 1 < n
            rank[at[has], best[has]] = table.lookup(ids[at[has], best[has]], ids[at[has], best[has] + 1])
            if (keep := int(n.max())) <= width // 2:
                ids, rank = ids[:, :keep], rank[:, : max(keep - 1, 0)]
    return out


def merge_long(table: PairTable, token: bytes) -> np.ndarray:
    """Ids of one long byte string: the same merges, the next one taken from a heap."""
    ids = table.byte_ids[np.frombuffer(token, np.uint8)].tolist()
    n = len(ids)
    nxt, prv, alive = [*range(1, n), -1], [*range(-1, n - 1)], [True] * n
    heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := table.pairs.get(ids[i] << 32 | ids[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        r, i, a, b = heapq.heappop(heap)
        j = nxt[i]
        if not alive[i] or j < 0 or ids[i] != a or ids[j] != b:
            continue
        ids[i], alive[j], nxt[i] = r, False, nxt[j]
        if nxt[j] >= 0:
            prv[nxt[j]] = i
        for x in (prv[i], i):
            if x >= 0 and (y := nxt[x]) >= 0 and (q := table.pairs.get(ids[x] << 32 | ids[y])) is not None:
                heapq.heappush(heap, (q, x, ids[x], ids[y]))
    return np.array([x for x, ok in zip(ids, alive) if ok], np.int32)


class Encoder:
    """Encodes lists of texts; keeps what it merged."""

    def __init__(self, path: str):
        self.table = PairTable(read_ranks(path))
        self.split = regex.compile(PATTERN).findall
        self.code: dict[str, int] = {}
        self.pool, self.start, self.size, self.used = np.zeros(1 << 16, np.int32), [], [], 0

    def _learn(self, tokens: list[str]) -> None:
        raw = [t.encode("utf-8", "surrogatepass") for t in tokens]
        whole = [self.table.ranks.get(r) for r in raw]
        small = [i for i, r in enumerate(raw) if whole[i] is None and len(r) <= LONG]
        ids: list = [None if w is None else np.array([w], np.int32) for w in whole]
        for i, x in zip(small, merge_rows(self.table, [raw[i] for i in small])):
            ids[i] = x
        for i, x in enumerate(ids):
            if x is None:
                x = merge_long(self.table, raw[i])
            while self.used + len(x) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            self.pool[self.used : self.used + len(x)] = x
            self.code[tokens[i]] = len(self.start)
            self.start.append(self.used)
            self.size.append(len(x))
            self.used += len(x)
        self.starts, self.sizes = np.array(self.start, np.int64), np.array(self.size, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): the ids of text i are ids[offsets[i]:offsets[i + 1]]; a null or empty text has none."""
        if len(self.code) > REMEMBER:
            self.code, self.start, self.size, self.used = {}, [], [], 0
        parts = [self.split(t) if t else [] for t in texts]
        count = np.array([len(p) for p in parts], np.int64)
        flat = [t for p in parts for t in p]
        if new := list(set(flat).difference(self.code)):
            self._learn(new)
        codes = np.fromiter(map(self.code.__getitem__, flat), np.int64, len(flat))
        bounds = np.concatenate([[0], np.cumsum(count)])
        if not len(codes):
            return bounds, np.zeros(0, np.int32)
        size = self.sizes[codes]
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.starts[codes] - ends[:-1], size) + np.arange(ends[-1])
        return ends[bounds], self.pool[at]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_path() -> str:
    """The vocabulary byte_bpe_50k: $LEXLOOM_BYTE_BPE, else the installed public file."""
    if path := os.environ.get("LEXLOOM_BYTE_BPE"):
        return path
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def encode_documents(df: DataFrame, key: str, text: str, path: str | None = None, chunk_chars: int = 1_000_000) -> DataFrame:
    """The ids of each row's text by a byte-level BPE vocabulary, without special tokens: `key` (bigint) and `ids`.

    Every row gives one row. Null, empty texts give an empty list, blank texts the ids of their white space; the text
    of a special token is ordinary text. Repeated rows give repeated rows, a null key stays null. Very long texts and very
    long words are encoded whole. Only the two columns are read, so other columns may have any names."""
    path = path or default_path()
    src = df.select(F.col(f"`{key}`").cast("bigint").alias("k"), F.col(f"`{text}`").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            keys, texts, a = b.column(0), b.column(1).to_pylist(), 0
            while a < len(texts):
                z, chars = a, 0
                while z < len(texts) and (z == a or chars + len(texts[z] or "") <= chunk_chars):
                    chars += len(texts[z] or "")
                    z += 1
                offsets, ids = enc.encode(texts[a:z])
                out = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([keys.slice(a, z - a), out], names=["k", "ids"])
                a = z

    return src.mapInArrow(run, "k bigint, ids array<int>").select(F.col("k").alias(key), "ids")
