"""Oversized texts in pieces at natural boundaries.

Lexical cohesion marks topics: at each gap between sentences the words of a block before it are compared with those of
a block after it (cosine of counts), and how far the similarity lies below the peaks on either side is the depth of the
valley. Each cut is the deepest valley in the window that the size limit allows; where no natural boundary lies in the
window, smaller ones are taken in turn.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Boundaries by strength. A piece ends behind the match.
BOUNDARIES = [
    (r"\n\s*\n\s*", 0.5),  # paragraph
    (r"\n(?=\s*(?:\(?[0-9A-Za-z]{1,3}[.)]|[A-Z\"“§]))", 0.25),  # item or line that begins anew
    (r"[.!?][)\]\"”’']*\s+(?=[^\sa-z])", 0.0),  # sentence
]
#: Weaker places, where the window has none of the above: a clause, a line end, a blank, a delimiter without blanks.
WEAKER = [r"[;:]\s+", r",\s+", r"\n", r"\s+", r"[|;,/\t–—-]"]
_BOUNDARIES = [(re.compile(p), bonus) for p, bonus in BOUNDARIES]
_WEAKER = [re.compile(p) for p in WEAKER]
_WORD = re.compile(r"[^\W\d_]{3,}")
#: Sentences in the blocks compared at a gap.
BLOCK = 4


def gaps(text: str) -> dict[int, float]:
    """End of each sentence, line item or paragraph, with the bonus of its kind."""
    out: dict[int, float] = {}
    for pattern, bonus in _BOUNDARIES:
        for m in pattern.finditer(text):
            if 0 < m.end() < len(text):
                out[m.end()] = max(out.get(m.end(), 0.0), bonus)
    return dict(sorted(out.items()))


def _cosine(a: Counter, b: Counter) -> float:
    norm = math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
    return sum(v * b[w] for w, v in a.items() if w in b) / norm if norm else 0.0


def depths(text: str, at: list[int]) -> list[float]:
    """Depth of the cohesion valley at each gap: how far its similarity lies below the nearest peaks on either side."""
    cuts = [0, *at, len(text)]
    bags = [Counter(w.lower() for w in _WORD.findall(text[s:e])) for s, e in zip(cuts, cuts[1:])]
    left, right, sim = Counter(bags[0]), Counter(), []
    for b in bags[1 : 1 + BLOCK]:
        right.update(b)
    for g in range(1, len(bags)):  # the blocks slide by one sentence
        sim.append(_cosine(left, right))
        left.update(bags[g])
        if g - BLOCK >= 0:
            left.subtract(bags[g - BLOCK])
        right.subtract(bags[g])
        if g + BLOCK < len(bags):
            right.update(bags[g + BLOCK])
        left, right = +left, +right
    up_left, up_right, n = list(sim), list(sim), len(sim)
    for i in range(1, n):  # climb while the similarity rises
        up_left[i] = up_left[i - 1] if sim[i - 1] >= sim[i] else sim[i]
    for i in range(n - 2, -1, -1):
        up_right[i] = up_right[i + 1] if sim[i + 1] >= sim[i] else sim[i]
    return [up_left[i] + up_right[i] - 2 * sim[i] for i in range(n)]


def tail_start(text: str, start: int, end: int, overlap: int) -> int:
    """Where the overlap with text[start:end] begins: a sentence, else a word, within its last `overlap` characters."""
    low = max(start, end - overlap)
    if low == end:
        return end
    for pattern in (_BOUNDARIES[2][0], _WEAKER[3], _WEAKER[4]):
        for m in pattern.finditer(text, max(start, low - 1), end):
            if low <= m.end() < end:
                return m.end()
    return low


def _between(text: str, low: int, end: int) -> int:
    """The last place up to `end` that doesn't part a mark from its letter."""
    at = end
    while at > low and unicodedata.combining(text[at]):
        at -= 1
    return at if at > low else end


def split_text(text: str, limit: int = 2000, overlap: int = 200) -> list[tuple[int, int, int]]:
    """(start, cut, end) of each piece: text[start:end], of which text[start:cut] repeats the piece before it."""
    if len(text) <= limit:
        return [(0, 0, len(text))]
    bonus = gaps(text)
    at = list(bonus)
    depth = {g: d + bonus[g] for g, d in zip(at, depths(text, at))}
    out, start, cut, i = [], 0, 0, 0
    while len(text) - start > limit:
        stop = start + limit
        while i < len(at) and at[i] <= cut:
            i += 1
        window, j = [], i
        while j < len(at) and at[j] <= stop:
            window.append(at[j])
            j += 1
        # A piece of under half the limit is only made where the window offers nothing later.
        late = [g for g in window if g - start >= limit // 2]
        if late or window:
            end = max(late or window[-1:], key=lambda g: (depth[g], g))
        else:
            end = 0
            for pattern in _WEAKER:
                if ends := [m.end() for m in pattern.finditer(text, max(cut, start + limit // 2), stop) if m.end() > cut]:
                    end = ends[-1]
                    break
            end = end or _between(text, max(cut + 1, start + 1), stop)
        out.append((start, cut, end))
        start, cut = tail_start(text, start, end, overlap), end
    out.append((start, cut, len(text)))
    return out


def split_oversized(df: DataFrame, keys: list[str], text: str, limit: int = 2000, overlap: int = 200) -> DataFrame:
    """The texts in pieces of at most `limit` characters: the key columns, piece (from 1), pieces, start, new_from, body.

    A piece is the text from `start` (code points from 0); up to `new_from` it repeats the end of the piece before it, at most
    `overlap` characters. Joining the parts from new_from on gives the text back, character for character. Cuts lie at
    the ends of paragraphs, items or sentences, where there are none at clauses, lines or blanks, and within a run without blanks at the limit.
    Texts within the limit, empty ones too, are one piece; null texts give no piece. Repeated rows give repeated pieces. Key
    columns may have any other names than those of the result.
    """
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap has to be under half the limit")
    src = df.select(F.struct(*[F.col(f"`{k}`") for k in keys]).alias("_key"), F.col(f"`{text}`").alias("t")).where(F.col("t").isNotNull())
    short = src.where(F.length("t") <= limit).select("_key", F.lit(1).alias("piece"), F.lit(1).alias("pieces"), F.lit(0).alias("start"), F.lit(0).alias("new_from"), F.col("t").alias("body"))
    out = "piece int, pieces int, start int, new_from int, body string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, cols = [], []
            for i, t in enumerate(b.column("t").to_pylist()):
                parts = split_text(t, limit, overlap)
                rows += [i] * len(parts)
                cols += [(n + 1, len(parts), s, c, t[s:e]) for n, (s, c, e) in enumerate(parts)]
            cols = list(zip(*cols)) if cols else [()] * 5
            arrays = [pa.array(c, k) for c, k in zip(cols, [pa.int32()] * 4 + [pa.string()])]
            yield pa.RecordBatch.from_arrays([b.column("_key").take(pa.array(rows, pa.int64())), *arrays], names=["_key", *(x.split()[0] for x in out.split(", "))])

    kind = src.schema["_key"].dataType.simpleString()
    long = src.where(F.length("t") > limit).mapInArrow(run, f"_key {kind}, {out}")
    return short.unionByName(long).select(*[F.col(f"_key.`{k}`").alias(k) for k in keys], "piece", "pieces", "start", "new_from", "body")
