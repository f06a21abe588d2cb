"""Differences between two copies of data, by set reconciliation per bucket.

Each copy of a bucket is seen as a set of row hashes in GF(p), p = 2^61 - 1, and stands for its characteristic
polynomial, the product of (z - h). The quotient of the two polynomials at a few points depends on the differing rows
alone; a rational function through the values gives, for a large enough degree bound, the polynomials whose roots are
the differing hashes. The bound is doubled until the recovered difference explains the quotient at further points, so
a bucket costs work in proportion to its differences. The rows of the recovered hashes are then fetched and compared
field by field.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

P = (1 << 61) - 1
_P = np.uint64(P)
_M31, _M30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_31, _30, _61, _1 = np.uint64(31), np.uint64(30), np.uint64(61), np.uint64(1)
#: Points beyond the degree bound at which a recovered difference must hold.
CHECKS = 4


def mul(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product in GF(p) of arrays of reduced uint64."""
    ah, al, bh, bl = a >> _31, a & _M31, b >> _31, b & _M31
    mid = ah * bl + al * bh
    s = ((ah * bh) << _1) + (mid >> _30) + ((mid & _M30) << _31) + al * bl
    s = (s & _P) + (s >> _61)
    return np.where(s >= _P, s - _P, s)


def sub(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    s = a + (_P - b)
    return np.where(s >= _P, s - _P, s)


def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    s = a + b
    return np.where(s >= _P, s - _P, s)


def points(n: int) -> np.ndarray:
    """Evaluation points, the same for both copies: a fixed walk through the field."""
    return np.array([(0x9E3779B97F4A7C15 * (i + 1) ** 3 + 0x1234567) % P for i in range(n)], np.uint64)


def inverses(x: np.ndarray) -> np.ndarray:
    """Inverses by Fermat's theorem: x to the power p - 2, all bits of which but the second are set."""
    out, square = np.ones_like(x), x
    for bit in range(61):
        if (P - 2) >> bit & 1:
            out = mul(out, square)
        square = mul(square, square)
    return out


def solve(a: np.ndarray) -> np.ndarray:
    """Some solution of each of many square systems in GF(p), given as (system, row, column and right side): free unknowns become 0,
    impossible equations are left to the caller's check."""
    many, n = a.shape[:2]
    top, row_of = np.zeros(many, np.int64), np.full((many, n), -1)
    rows = np.arange(n)
    for col in range(n):
        usable = (a[:, :, col] != 0) & (rows >= top[:, None])
        at = np.flatnonzero(usable.any(axis=1))
        if len(at) == 0:
            continue
        k, t = usable[at].argmax(axis=1), top[at]
        pivot = a[at, k]
        a[at, k] = a[at, t]
        pivot = mul(pivot, inverses(pivot[:, col])[:, None])
        part = sub(a[at], mul(a[at, :, col][:, :, None], pivot[:, None, :]))
        part[np.arange(len(at)), t] = pivot
        a[at] = part
        row_of[at, col] = t
        top[at] += 1
    out = np.zeros((many, n), np.uint64)
    s, c = np.nonzero(row_of >= 0)
    out[s, c] = a[s, row_of[s, c], n]
    return out


def product(m: np.ndarray) -> np.ndarray:
    """Products along the last axis, by halving."""
    while m.shape[-1] > 1:
        odd = m[..., -1:] if m.shape[-1] % 2 else None
        m = mul(m[..., 0 : m.shape[-1] - m.shape[-1] % 2 : 2], m[..., 1::2])
        if odd is not None:
            m = np.concatenate([m, odd], axis=-1)
    return m[..., 0]


def char_polys(h: np.ndarray, there: np.ndarray, z: np.ndarray) -> np.ndarray:
    """The characteristic polynomials of many sets (padded rows, of which `there` counts) at each point."""
    if h.shape[1] == 0:
        return np.ones((len(h), len(z)), np.uint64)
    return product(np.where(there[:, None, :], sub(z[None, :, None], h[:, None, :]), np.uint64(1)))


def roots(coef: np.ndarray, size: np.ndarray, x: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Which of x are roots of each monic polynomial, its lower coefficients given from the constant up, `size` of them."""
    y = np.ones_like(x)
    for k in range(coef.shape[1] - 1, -1, -1):
        y = np.where((k < size)[:, None], add(mul(y, x), coef[:, k : k + 1]), y)
    return (y == 0) & there


def padded(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(s) for s in sets])
    out = np.zeros((len(sets), int(size.max(initial=0))), np.uint64)
    there = np.arange(out.shape[1]) < size[:, None]
    out[there] = np.concatenate(sets) if len(sets) else []
    return out, there


def differing(left: list[np.ndarray], right: list[np.ndarray], bound: list[int]) -> list[tuple[np.ndarray, np.ndarray] | None]:
    """For each pair of sets which hashes of one are not in the other, as masks, recovered from the quotient of their polynomials at the pair's degree bound
    (one bound for all); None where the bound doesn't explain the quotient at the further points."""
    m = bound[0]
    a, in_a = padded(left)
    b, in_b = padded(right)
    z = points(m + CHECKS)
    f = mul(char_polys(a, in_a, z), inverses(char_polys(b, in_b, z)))
    delta = in_a.sum(axis=1) - in_b.sum(axis=1)
    da, db = (m + delta) // 2, (m - delta) // 2
    coef = np.zeros((len(a), m), np.uint64)
    if m:
        zs, fs, col = z[:m], f[:, :m], np.arange(m)
        powers = [np.ones(m, np.uint64)]
        for _ in range(m):
            powers.append(mul(powers[-1], zs))
        powers = np.stack(powers, axis=1)  # (point, exponent)
        of_b = col[None, :] >= da[:, None]
        grid = powers[:, np.where(of_b, col[None, :] - da[:, None], col[None, :])].transpose(1, 0, 2)
        grid = np.where(of_b[:, None, :], sub(np.zeros_like(grid), mul(fs[:, :, None], grid)), grid)
        rhs = sub(mul(fs, powers[:, db].T), powers[:, da].T)
        coef = solve(np.concatenate([grid, rhs[:, :, None]], axis=2))
    shift = np.minimum(np.arange(m)[None, :] + da[:, None], max(m - 1, 0))
    hit_a, hit_b = roots(coef, da, a, in_a), roots(np.take_along_axis(coef, shift, axis=1) if m else coef, db, b, in_b)
    ra, rb = char_polys(a, hit_a, z[-CHECKS:]), char_polys(b, hit_b, z[-CHECKS:])
    ok = (hit_a.sum(axis=1) - hit_b.sum(axis=1) == delta) & (ra == mul(f[:, -CHECKS:], rb)).all(axis=1)
    return [(hit_a[i][in_a[i]], hit_b[i][in_b[i]]) if ok[i] else None for i in range(len(a))]


#: Numbers in one array of a batch of pairs.
BATCH = 2_000_000


def recover_all(left: list[np.ndarray], right: list[np.ndarray], start: int = 4) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Which hashes of each left set are not in the right one, and the other way round, as masks, and the degree bound at which they were found.

    Each side evaluates its own polynomial and looks for its own roots; between the sides only the values and the coefficients of the quotient pass.
    Each set holds distinct hashes. Pairs of one bound are worked on together; the bound of those that fail is doubled."""
    out: list = [None] * len(left)

    def fit(bound: int, i: int) -> int:
        """A bound that the sizes allow: the two degrees have to differ by the difference of the sizes."""
        na, nb = len(left[i]), len(right[i])
        bound = min(max(bound, abs(na - nb)), na + nb)
        return bound + (bound - na + nb) % 2

    todo = {i: fit(start, i) for i in range(len(left))}
    while todo:
        m = min(todo.values())
        of_m = sorted((i for i in todo if todo[i] == m), key=lambda i: len(left[i]) + len(right[i]))
        while of_m:
            widest = max(len(left[of_m[-1]]), len(right[of_m[-1]]), m, 1)
            group = of_m[-max(1, BATCH // ((m + CHECKS) * widest)) :]
            del of_m[-len(group) :]
            for i, found in zip(group, differing([left[i] for i in group], [right[i] for i in group], [m])):
                if found is not None:
                    out[i] = (*found, m)
                    del todo[i]
                elif m >= len(left[i]) + len(right[i]):  # a root by chance at full degree: compare the hashes themselves
                    out[i] = (~np.isin(left[i], right[i]), ~np.isin(right[i], left[i]), m)
                    del todo[i]
                else:
                    todo[i] = fit(2 * m, i)
    return out


def recover(a: np.ndarray, b: np.ndarray, start: int = 4) -> tuple[np.ndarray, np.ndarray, int]:
    """recover_all for one pair."""
    return recover_all([a], [b], start)[0]


def differing_hashes(hashes: DataFrame, buckets: int) -> DataFrame:
    """(side, hash) of two copies (side 0 and 1) reduced to those that the other copy lacks. Only a bucket number, the side and the hash are shuffled."""
    tasks = int(hashes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = hashes.select(F.pmod("hash", F.lit(buckets)).alias("bucket"), "side", "hash").repartition(tasks, "bucket").sortWithinPartitions("bucket")
    kinds = {"side": pa.int32(), "hash": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(side: np.ndarray, h: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
            left, right = [], []
            for s, x in zip(np.split(side, cuts), np.split(h, cuts)):
                left.append(np.unique(x[s == 0]))
                right.append(np.unique(x[s == 1]))
            found = recover_all(left, right)
            a = [x[m] for x, (m, _, _) in zip(left, found)]
            b = [x[m] for x, (_, m, _) in zip(right, found)]
            n = sum(map(len, a))
            both = np.concatenate([*a, *b]) if a else np.zeros(0, np.uint64)
            return pa.RecordBatch.from_arrays([pa.array(np.repeat([0, 1], [n, len(both) - n]), pa.int32()), pa.array(both.astype(np.int64))], names=list(kinds))

        rest = [np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint64)]
        for x in batches:
            new = [x.column(c).to_numpy() for c in ("bucket", "side", "hash")]
            bucket, side, h = (np.concatenate([r, y.astype(r.dtype)]) for r, y in zip(rest, new))
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            if len(cuts):  # the last bucket may go on in the next batch
                yield done(side[: cuts[-1]], h[: cuts[-1]], cuts[:-1])
                bucket, side, h = bucket[cuts[-1] :], side[cuts[-1] :], h[cuts[-1] :]
            rest = [bucket, side, h]
        if len(rest[0]):
            yield done(rest[1], rest[2], np.zeros(0, np.int64))

    return x.mapInArrow(run, "side int, hash bigint")


def reconcile(rows: DataFrame, side: str, key: list[str], fields: list[str], names: tuple[str, str] = ("left", "right"), bucket_rows: int = 32, buckets: int | None = None) -> DataFrame:
    """Rows of either copy that the other lacks, and fields that differ: the key columns and `finding`.

    rows: both copies, told apart by the column `side`, whose values are the two names; rows of other sides are ignored. finding is `only_<name>` for
    a key that the other copy lacks, else the name of each field that differs, one row each; nulls count as a value of their own. Each copy holds each key at most once
    (take the last row first) and keys are strings without nulls. `buckets` is the number of hash buckets; by default so many that a bucket holds about `bucket_rows`
    rows a side. Copies that agree, and empty copies, give no rows. rows is read twice: for the hashes, and to fetch the rows of those that differ."""
    if buckets is None:
        buckets = max(1, math.ceil(rows.count() / 2 / bucket_rows))
    cols = [F.col(f"`{c}`") for c in key + fields]
    h = F.pmod(F.xxhash64(F.struct(*cols), *[c.isNull() for c in cols]), F.lit(P))
    x = rows.where(F.col(side).isin(*names)).select((F.col(side) == names[1]).cast("int").alias("_side"), h.alias("_hash"), *cols)
    lone = differing_hashes(x.select(F.col("_side").alias("side"), F.col("_hash").alias("hash")), buckets).select(F.col("side").alias("_side"), F.col("hash").alias("_hash"))
    found = x.join(lone, ["_side", "_hash"], "left_semi")
    of = lambda s: F.max(F.when(F.col("_side") == s, F.struct(*[F.col(f"`{c}`") for c in fields], F.lit(1).alias("_there"))))
    pairs = found.groupBy(*[f"`{k}`" for k in key]).agg(of(0).alias("_l"), of(1).alias("_r"))
    differ = [F.when(F.col("_l").isNotNull() & F.col("_r").isNotNull() & ~F.col(f"_l.`{f}`").eqNullSafe(F.col(f"_r.`{f}`")), F.lit(f)) for f in fields]
    findings = F.array_compact(F.array(F.when(F.col("_r").isNull(), F.lit(f"only_{names[0]}")), F.when(F.col("_l").isNull(), F.lit(f"only_{names[1]}")), *differ))
    return pairs.select(*[f"`{k}`" for k in key], F.explode(findings).alias("finding"))


def latest(df: DataFrame, key: list[str], order: str, fields: list[str]) -> DataFrame:
    """Per key the row with the largest `order`: a partial aggregate, so repeated keys never meet in one task unreduced."""
    last = F.max_by(F.struct(*[F.col(f"`{f}`") for f in fields]), F.col(f"`{order}`"))
    return df.groupBy(*[f"`{k}`" for k in key]).agg(last.alias("_last")).select(*[f"`{k}`" for k in key], "_last.*")
