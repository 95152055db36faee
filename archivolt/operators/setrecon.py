"""Differences between two copies of a dataset by characteristic-polynomial set reconciliation.

Every row of a side becomes one element of the field with 2**61 - 1 elements (a hash of key and fields). Elements are
spread over buckets small enough that a bucket holds few differences. Each side evaluates the characteristic polynomials
of its own buckets at a few points, and only bucket, size and evaluations are exchanged: the quotient of two polynomials is a
rational function in which all common elements cancel, so its degree is the number of differences, whatever the size of
the sets. It is interpolated under a degree bound, and its two polynomials go back to the sides, where those elements of a
bucket that are zeros of the one are what only the first side has, zeros of the other what only the second has.
The recovered sets are verified at further points against the exchanged evaluations; only the buckets that fail are tried again,
with the bound doubled and at new points. Only then are rows fetched, by their hashes, and compared field by field.

All arithmetic is vectorised over the buckets of an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivolt.session import kept

P = np.uint64((1 << 61) - 1)
_P = (1 << 61) - 1
_32, _29, _M32, _M29, _61, _3 = (np.uint64(x) for x in (32, 29, (1 << 32) - 1, (1 << 29) - 1, 61, 3))

#: Rows a side and bucket on average, first degree bound, and points that only verify.
BUCKET_ROWS, FIRST_BOUND, CHECKS = 32, 8, 2
#: Hashes that may be sent to every task, 8 bytes each.
FEW = 4_000_000


def mul(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b in the field, element by element; operands below 2**61 - 1."""
    ah, al, bh, bl = a >> _32, a & _M32, b >> _32, b & _M32
    low, mid, high = al * bl, ah * bl + al * bh, ah * bh
    # 2**61 = 1, so 2**64 = 8 and mid * 2**32 = (mid >> 29) + ((mid & mask) << 32)
    s = (high << _3) + (mid >> _29) + ((mid & _M29) << _32) + (low >> _61) + (low & P)
    s = (s & P) + (s >> _61)
    return np.where(s >= P, s - P, s)


def sub(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.where(a >= b, a - b, a + P - b)


def inverse(a: np.ndarray) -> np.ndarray:
    """a ** (p - 2), the inverse of what isn't zero."""
    out, e, base = np.ones_like(a), _P - 2, a.copy()
    while e:
        if e & 1:
            out = mul(out, base)
        base = mul(base, base)
        e >>= 1
    return out


def points(n: int, first: int = 0) -> np.ndarray:
    """n evaluation points, the same on every machine; another ``first`` gives others."""
    x, out = 0x9E3779B97F4A7C15 + first, []
    for _ in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append((x >> 3) % _P)
    return np.array(out, dtype=np.uint64)


def evaluate(elements: np.ndarray, bucket: np.ndarray, n_buckets: int, at: np.ndarray) -> np.ndarray:
    """Characteristic polynomials at the points: out[b, j] = product of (at[j] - h) over the elements h of bucket b.

    ``bucket`` must be sorted. Products are formed pairwise within a bucket, so a batch takes a number of steps
    logarithmic in the largest bucket.
    """
    out = np.ones((n_buckets, len(at)), dtype=np.uint64)
    if not len(elements):
        return out
    v, b = sub(np.broadcast_to(at, (len(elements), len(at))), elements[:, None]), bucket
    while True:
        first = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
        if len(first) == len(b):
            break
        place = np.arange(len(b)) - np.repeat(first, np.diff(np.r_[first, len(b)]))
        even = np.flatnonzero(place % 2 == 0)
        partner = np.minimum(even + 1, len(b) - 1)
        has = (even + 1 < len(b)) & (b[partner] == b[even])
        merged = v[even]
        merged[has] = mul(merged[has], v[partner[has]])
        v, b = merged, b[even]
    out[b] = v
    return out


def solve(matrix: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solutions x of matrix[i] @ x = right[i] for a stack of square systems; free unknowns are zero."""
    n, size = matrix.shape[0], matrix.shape[1]
    a = np.concatenate([matrix, right[:, :, None]], axis=2)
    row_of = np.full((n, size), -1)
    rank = np.zeros(n, dtype=int)
    every = np.arange(n)
    for col in range(size):
        below = (np.arange(size)[None, :] >= rank[:, None]) & (a[:, :, col] != 0)
        ok = below.any(axis=1)
        if not ok.any():
            continue
        i, r, p = every[ok], rank[ok], below.argmax(axis=1)[ok]
        swap = a[i, r].copy()
        a[i, r] = a[i, p]
        a[i, p] = swap
        pivot = mul(a[i, r], inverse(a[i, r, col])[:, None])
        factor = a[i, :, col].copy()
        factor[np.arange(len(i)), r] = 0
        a[i] = sub(a[i], mul(np.broadcast_to(factor[:, :, None], a[i].shape), np.broadcast_to(pivot[:, None, :], a[i].shape)))
        a[i, r] = pivot
        row_of[i, col] = r
        rank[i] += 1
    out = a[every[:, None], np.maximum(row_of, 0), -1]
    return np.where(row_of >= 0, out, np.uint64(0))


def horner(coefficients: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Monic polynomials at x: x**d + coefficients[:, d-1] x**(d-1) + ... + coefficients[:, 0], row by row."""
    out = np.ones_like(x)
    for k in range(coefficients.shape[1] - 1, -1, -1):
        out = mul(out, x) + coefficients[:, k]
        out = np.where(out >= P, out - P, out)
    return out


def _powers(x: np.ndarray, n: int) -> np.ndarray:
    out = np.ones((len(x), n), dtype=np.uint64)
    for k in range(1, n):
        out[:, k] = mul(out[:, k - 1], x)
    return out


def interpolate(quotient: np.ndarray, delta: np.ndarray, bound: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numerators and denominators of the rational functions with the given values, as coefficients without the leading
    one, and their degrees: (numerators, denominators, degrees), a row each.

    ``delta`` is the difference of the degrees, that of the set sizes. The degrees' sum is the bound, or one above it;
    a row whose delta is beyond the bound has the degrees -1.
    """
    n = len(delta)
    top, low, degrees = np.zeros((n, bound + 1), np.uint64), np.zeros((n, bound + 1), np.uint64), np.full((n, 2), -1)
    for d in np.unique(delta):
        if abs(d) > bound:
            continue
        total = bound + (bound + int(d)) % 2
        da, db = (total + int(d)) // 2, (total - int(d)) // 2
        for who in np.array_split(np.flatnonzero(delta == d), max(1, int((delta == d).sum()) * bound * bound // 2_000_000)):
            z, f = at[:total], quotient[who][:, :total]
            pa, pb = _powers(z, da + 1), _powers(z, db + 1)
            left = np.broadcast_to(pa[:, :da], (len(who), total, da))
            side = mul(f[:, :, None], np.broadcast_to(pb[:, :db], (len(who), total, db)))
            right = sub(mul(f, np.broadcast_to(pb[:, db], f.shape)), np.broadcast_to(pa[:, da], f.shape))
            # P(z) - f Q(z) = 0 with both monic
            x = solve(np.concatenate([left, sub(np.zeros_like(side), side)], axis=2), right)
            top[who, :da], low[who, :db], degrees[who] = x[:, :da], x[:, da:], (da, db)
    return top, low, degrees


def zeros_of(elements: np.ndarray, of: np.ndarray, own: np.ndarray, other: np.ndarray, degrees: np.ndarray) -> np.ndarray:
    """Which elements are zeros of their bucket's polynomial ``own`` and not of ``other``: what both share has no meaning."""
    hit = np.zeros(len(elements), bool)
    for da, db in np.unique(degrees, axis=0):
        if da < 0:
            continue
        mine = np.flatnonzero((degrees[of] == (da, db)).all(axis=1))
        x, rows = elements[mine], of[mine]
        hit[mine] = (horner(own[rows][:, :da], x) == 0) & (horner(other[rows][:, :db], x) != 0)
    return hit


def _flat(sets) -> tuple[np.ndarray, np.ndarray]:
    """(elements, index of their set) of a column of arrays; null is the empty set."""
    arrays = [np.zeros(0, np.uint64) if s is None else np.asarray(s, dtype=np.int64).astype(np.uint64) for s in sets]
    of = np.repeat(np.arange(len(arrays)), [len(x) for x in arrays])
    return (np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)), of


def _per_set(values: np.ndarray, of: np.ndarray, n: int) -> list[np.ndarray]:
    return np.split(values.astype(np.int64), np.searchsorted(of, np.arange(1, n))) if n else []


def _rows_of(column) -> np.ndarray:
    return np.array([np.asarray(x, dtype=np.int64) for x in column], dtype=np.int64).astype(np.uint64)


def _round(sets: Sequence[DataFrame], bound: int) -> DataFrame:
    """One exchange under a degree bound: bucket, good, a, b (the elements that only one side has, where good)."""
    n_points = bound + 1 + CHECKS
    at = points(n_points, bound)

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            elements, of = _flat(batch["elements"])
            values = evaluate(elements, of, len(batch), at)
            yield pd.DataFrame({"bucket": batch["bucket"], "n": np.bincount(of, minlength=len(batch)), "f": list(values.astype(np.int64))})

    def solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                # an empty bucket has the polynomial 1
                fa, fb = (_rows_of([np.ones(n_points, np.int64) if x is None else x for x in batch[c]]) for c in ("fa", "fb"))
                delta = (batch["na"].fillna(0) - batch["nb"].fillna(0)).to_numpy().astype(np.int64)
                quotient = mul(fa, inverse(fb.ravel()).reshape(fb.shape))
                # an element at an evaluation point makes the values useless; other points are taken in the next round
                useless = ~((fa != 0).all(axis=1) & (fb != 0).all(axis=1))
                top, low, degrees = interpolate(quotient, np.where(useless, 4 * bound, delta), bound, at)
                out = {"bucket": batch["bucket"], "delta": delta, "q": list(quotient.astype(np.int64)), "top": list(top.astype(np.int64)), "low": list(low.astype(np.int64)), "degrees": list(degrees)}
                yield pd.DataFrame(out)

    def found(side: int):
        own, other = ("top", "low") if side == 0 else ("low", "top")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    elements, of = _flat(batch["elements"])
                    degrees = np.array([list(x) for x in batch["degrees"]])
                    hit = zeros_of(elements, of, _rows_of(batch[own]), _rows_of(batch[other]), degrees if side == 0 else degrees[:, ::-1])
                    yield pd.DataFrame({"bucket": batch["bucket"], "x": _per_set(elements[hit], of[hit], len(batch))})

        return run

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                n = len(batch)
                (a, ia), (b, ib) = _flat(batch["a"]), _flat(batch["b"])
                ra, rb, q = evaluate(a, ia, n, at), evaluate(b, ib, n, at), _rows_of(batch["q"])
                good = (ra == mul(q, rb)).all(axis=1) & (np.bincount(ia, minlength=n) - np.bincount(ib, minlength=n) == batch["delta"].to_numpy())
                good &= np.array([d[0] >= 0 for d in batch["degrees"]])
                yield pd.DataFrame({"bucket": batch["bucket"], "good": good, "a": _per_set(a, ia, n), "b": _per_set(b, ib, n)})

    fa, fb = (s.mapInPandas(sketch, "bucket long, n long, f array<long>").select("bucket", F.col("n").alias(f"n{x}"), F.col("f").alias(f"f{x}")) for s, x in zip(sets, "ab"))
    schema = "bucket long, delta long, q array<long>, top array<long>, low array<long>, degrees array<long>"
    solution = kept(fa.join(fb, "bucket", "full").mapInPandas(solved, schema), "solution")
    back = solution.select("bucket", "top", "low", "degrees")
    a, b = (s.join(back, "bucket").mapInPandas(found(i), "bucket long, x array<long>").withColumnRenamed("x", "ab"[i]) for i, s in enumerate(sets))
    recovered = solution.select("bucket", "delta", "q", "degrees").join(a, "bucket", "left").join(b, "bucket", "left")
    return kept(recovered.mapInPandas(verified, "bucket long, good boolean, a array<long>, b array<long>"), "verified")


def element(columns: Sequence[Column]) -> Column:
    """Row hash as an element of the field; a null and an empty text differ from each other and from any other value."""
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in columns]
    return F.pmod(F.xxhash64(*parts), F.lit(_P - 1)) + 1


def set_difference(a: DataFrame, b: DataFrame, h: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Elements of column ``h`` that only one side holds: side (0: a, 1: b) and h.

    Each side groups its own elements by bucket, equal ones once; a bucket's size follows from the number of different
    elements over all, never from a key. Between the sides go sizes, evaluations and polynomials only. Bounds double
    until every bucket is verified, at most to the size of both sides' buckets.
    """
    n = max(1, -(-max(a.count(), b.count()) // bucket_rows))
    bucket = F.pmod(F.xxhash64(h), F.lit(n)).alias("bucket")
    sets = [kept(x.groupBy(bucket).agg(F.collect_set(h).alias("elements")), f"side{i}") for i, x in enumerate((a, b))]
    out, bound = None, FIRST_BOUND
    while True:
        done = _round(sets, bound)
        good = done.where("good AND (size(a) > 0 OR size(b) > 0)")
        part = good.select(F.explode(F.concat(_tagged("a", 0), _tagged("b", 1))).alias("d")).select("d.*")
        out = part if out is None else out.unionByName(part)
        failed = done.where("NOT good").select("bucket")
        if failed.isEmpty():
            return out
        sets = [kept(s.join(failed, "bucket", "left_semi"), "side") for s in sets]
        bound *= 2


def _tagged(column: str, side: int) -> Column:
    return F.transform(column, lambda x: F.struct(F.lit(side).cast("byte").alias("side"), x.alias("h")))


def among(df: DataFrame, column: str, hashes: DataFrame) -> DataFrame:
    """Rows whose hash is among those of ``hashes``.

    Up to FEW hashes go to the tasks as one sorted array, so the rows stay where they are; beyond that both sides are
    shuffled by their hash.
    """
    if hashes.count() > FEW:
        return df.join(hashes.distinct(), column, "left_semi")
    sent = df.sparkSession.sparkContext.broadcast(np.unique(hashes.toPandas()[column].to_numpy(dtype=np.int64)))

    @F.pandas_udf("boolean")
    def hit(h: pd.Series) -> pd.Series:
        known, x = sent.value, h.to_numpy()
        at = np.searchsorted(known, x)
        return pd.Series((at < len(known)) & (known[np.minimum(at, len(known) - 1)] == x) if len(known) else np.zeros(len(x), bool))

    return df.where(hit(column))


def differences(a: DataFrame, b: DataFrame, keys: Sequence[str], fields: Sequence[str], names: tuple[str, str]) -> DataFrame:
    """Rows missing on either side and fields that differ: keys and ``difference``.

    ``difference`` is ``names[0]`` for a key only ``a`` has, ``names[1]`` for one only ``b`` has, else the name of a
    field whose values differ (one row per field). Both inputs must hold normalised values, in which null means
    missing; rows with a null key take no part. Where a side has several versions of a key, the fields compare by
    the sets of their values. Inputs are read several times: pass tables, not plans that are dear to compute.
    """
    with_hash = lambda df: df.where(" AND ".join(f"{k} IS NOT NULL" for k in keys)).select(
        *keys, *fields, element([F.col(c) for c in (*keys, *fields)]).alias("_h"), F.xxhash64(*keys).alias("_k")
    )
    a, b = with_hash(a), with_hash(b)
    found = kept(set_difference(a, b, "_h"), "found")
    own = [among(df, "_h", found.where(F.col("side") == i).select(F.col("h").alias("_h"))) for i, df in enumerate((a, b))]
    changed = kept(own[0].select("_k").unionByName(own[1].select("_k")).distinct(), "changed")
    # fetch all rows of the keys concerned, whichever version of them differs
    fetch = lambda df, s: among(df, "_k", changed).select(F.lit(s).alias("_s"), *keys, *fields)
    both = fetch(a, 0).unionByName(fetch(b, 1))
    side = lambda s, f: F.array_sort(F.collect_set(F.when(F.col("_s") == s, F.coalesce(F.concat(F.lit("="), F.col(f).cast("string")), F.lit("-")))))
    compared = both.groupBy(*keys).agg(
        F.max(F.col("_s") == 0).alias("_in_a"),
        F.max(F.col("_s") == 1).alias("_in_b"),
        *[(side(0, f) != side(1, f)).alias(f"_d_{f}") for f in fields],
    )
    what = F.when(~F.col("_in_b"), F.array(F.lit(names[0]))).when(~F.col("_in_a"), F.array(F.lit(names[1]))).otherwise(
        F.array_compact(F.array(*[F.when(F.col(f"_d_{f}"), F.lit(f)) for f in fields]))
    )
    return compared.select(*keys, F.explode(what).alias("difference"))
