"""Texts as arrays of word hashes, without a Python object per word."""

from __future__ import annotations

import unicodedata

import numpy as np

_ALNUM: list[np.ndarray] = []
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(BASE), -1, 1 << 64))
_POW: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def alnum() -> np.ndarray:
    """Which code points are letters or digits."""
    if not _ALNUM:
        _ALNUM.append(np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000))
    return _ALNUM[0]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2^64."""
    if len(_POW[0]) < n:
        size = 1 << max(n, 1024).bit_length()
        for k, base in enumerate((BASE, _INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POW[k] = np.cumprod(p, dtype=np.uint64)
    return _POW[0][:n], _POW[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(codes: np.ndarray) -> np.ndarray:
    """Sums of code * BASE^i, modulo 2^64: the hash of a span is the difference of two of them, shifted back."""
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers(len(codes))[0], dtype=np.uint64, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((prefix[end] - prefix[start]) * powers(len(prefix))[1][start])


def normal(text: str) -> str:
    """The form in which words are compared: NFKC in lower case."""
    return unicodedata.normalize("NFKC", text).lower()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word of all texts in order, offsets of the texts in it): words are runs of letters and digits."""
    forms = [normal(t) if t else "" for t in texts]
    codes = code_points("\n".join(forms) + "\n")
    inside = np.concatenate([[False], alnum()[codes]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[0::2], edge[1::2]  # the last code is a line break, so every word ends
    hashes = span_hash(prefix_hash(codes), start, end)
    bounds = np.cumsum([0, *(len(f) + 1 for f in forms)])
    return hashes, np.searchsorted(start, bounds)
