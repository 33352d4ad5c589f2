"""Embedding whitening: centred covariance over all vectors, its leading eigenvectors, a broadcast projection.

1. Every entry c becomes the whole number x = floor(scale * c) + shift, so sums are exact in any order.
2. *Covariance*: each task centres its rows (n*x - S, exact, then divided by n) and adds up their products;
   the partial matrices are added per row of the matrix on the executors.
3. *Eigenvectors* of the d x d matrix, on the driver (d is the vectors' length, not their number;
   ``max_dim`` bounds it): Householder reflections make it tridiagonal; Sturm
   counts bisect the leading eigenvalues; inverse iteration finds their vectors, which are made
   orthogonal again within clusters of close eigenvalues; the reflections carry them back.
4. *Projection*: the components are broadcast (k x d numbers).
"""

from __future__ import annotations

import decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
MAX_DIM = 4096
ROWS = 4096        # rows handled at a time
FITS = 2.0**62     # numbers from here on are left out: they are no long
CLUSTER = 1e-3     # eigenvalues closer than this share of the largest are made orthogonal together
FLAT = 1e-13       # eigenvalues up to this share of the largest count as zero


def valid_vectors(rows: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id", dim: int | None = None) -> tuple[DataFrame, int]:
    """``(vec_id, vec)`` of the rows whose vector can be used, and the vectors' length: ``dim``, or
    that of most vectors (of equally many the longer; 0 without any). A NULL or empty vector, one with a NULL, NaN,
    infinite or too large entry, and one of another length is left out."""
    out = rows.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    out = out.filter((F.size("vec") > 0) & F.forall("vec", lambda c: F.coalesce(F.abs(c) < FITS / SCALE, F.lit(False))))  # (NaN is above all)
    if dim is None:
        most = out.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
        dim = most["d"] if most else 0
    return out.filter(F.size("vec") == dim), dim


def _whole(batch: pa.RecordBatch, d: int, scale: int, shift: int):
    """The rows' numbers x, some rows at a time, with the place of the first."""
    flat = batch.column(1).flatten().to_numpy().reshape(-1, d)
    for at in range(0, len(flat), ROWS):
        yield at, np.floor(scale * flat[at:at + ROWS]).astype(np.int64) + shift


def _sums(vectors: DataFrame, d: int, scale: int, shift: int) -> tuple[int, list[int], int]:
    """Number of vectors, sum of each entry, largest magnitude."""

    def run(batches):
        n, high, low, most = 0, np.zeros(d, np.int64), np.zeros(d, np.int64), 0
        for b in batches:
            for _, x in _whole(b, d, scale, shift):
                n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)  # halves: no overflow
                most = max(most, int(x.max()), -int(x.min()))
        if n:
            columns = [np.arange(d), np.full(d, n), high, low, np.full(d, most)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["i", "n", "high", "low", "most"])

    parts = vectors.mapInArrow(run, "i long, n long, high long, low long, most long")
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"),
                                  F.sum(F.col("low").cast("decimal(38,0)")).alias("low"), F.max("most").alias("most")).collect()  # d rows
    sums = {r["i"]: (int(r["high"]) << 32) + int(r["low"]) for r in rows}
    return (rows[0]["n"], [sums[i] for i in range(d)], max(r["most"] for r in rows)) if rows else (0, [0] * d, 0)


def _centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """n*x - S, exact; ``total`` is of Python numbers where longs would overflow."""
    return n * (x if total.dtype == np.int64 else x.astype(object)) - total


def _products(vectors: DataFrame, d: int, k: int, make) -> np.ndarray:
    """Sum of z z' over all rows z that ``make`` gives for a batch (k entries each)."""

    def run(batches):
        total, some = np.zeros((k, k)), False
        for b in batches:
            for z in make(b):
                total, some = total + z.T @ z, True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int64()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])

    def add(batches):  # what it holds is at most the matrix
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, row in zip(b.column(0).to_pylist(), b.column(1).flatten().to_numpy().reshape(-1, k)):
                total[i] = total[i] + row if i in total else row.copy()
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int64()), pa.array(list(total.values()), pa.list_(pa.float64()))], ["i", "row"])

    schema = "i long, row array<double>"
    found = vectors.mapInArrow(run, schema).repartition("i").mapInArrow(add, schema).collect()  # k rows of k numbers
    return np.array([r["row"] for r in sorted(found, key=lambda r: r["i"])])


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and Householder vectors of a symmetric matrix."""
    a, mirrors = matrix.astype(float).copy(), []
    for k in range(len(a) - 2):
        v = a[k + 1:, k].copy()
        length = np.linalg.norm(v)
        if length:
            v[0] += np.copysign(length, v[0])
            v /= np.linalg.norm(v)
            part = a[k + 1:, k + 1:]
            p = part @ v
            w = 2 * (p - (v @ p) * v)
            part -= np.outer(v, w) + np.outer(w, v)
            a[k + 1, k] = -np.copysign(length, a[k + 1, k])
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def count_below(diag: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm count: how many eigenvalues are below each number."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    q, below = diag[0] - at, np.zeros(len(at), np.int64)
    for i in range(len(diag)):
        if i:
            q = diag[i] - at - off[i - 1] ** 2 / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        below += q < 0
    return below


def leading_eigenvalues(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest, falling, by bisection down to neighbouring numbers."""
    d = len(diag)
    radius = np.abs(np.r_[off, 0]) + np.abs(np.r_[0, off])
    low, high = np.full(k, (diag - radius).min()), np.full(k, (diag + radius).max())
    high += np.abs(high) * 1e-15 + np.finfo(float).tiny
    rank = d - 1 - np.arange(k)  # as many are below it
    while True:
        middle = low + (high - low) / 2
        go = (middle > low) & (middle < high) & (high - low > 1e-16 * np.maximum(np.abs(low), np.abs(high)))
        if not go.any():
            return high
        over = count_below(diag, off, middle) > rank
        high, low = np.where(go & over, middle, high), np.where(go & ~over, middle, low)


def _solve(diag: np.ndarray, off: np.ndarray, at: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    """(T - at) z = rhs for every number ``at`` (columns), by elimination with row exchange."""
    d, eps = len(diag), np.finfo(float).eps * max(np.abs(diag).max(), np.abs(off).max(initial=0), np.finfo(float).tiny)
    zero = np.zeros(len(at))
    main, up, up2, z = [], [], [], rhs.copy()
    a, b = diag[0] - at, zero + (off[0] if d > 1 else 0)
    for i in range(d - 1):
        below, mid, right = zero + off[i], diag[i + 1] - at, zero + (off[i + 1] if i + 2 < d else 0)
        swap = np.abs(below) > np.abs(a)
        top, top1, top2 = np.where(swap, below, a), np.where(swap, mid, b), np.where(swap, right, 0)
        low, low1, low2 = np.where(swap, a, below), np.where(swap, b, mid), np.where(swap, 0, right)
        z[i], z[i + 1] = np.where(swap, z[i + 1], z[i]), np.where(swap, z[i], z[i + 1])
        top = np.where(np.abs(top) < eps, eps, top)
        f = low / top
        z[i + 1] -= f * z[i]
        main.append(top)
        up.append(top1)
        up2.append(top2)
        a, b = low1 - f * top1, low2 - f * top2
    main.append(np.where(np.abs(a) < eps, eps, a))
    for i in range(d - 1, -1, -1):
        if i + 1 < d:
            z[i] -= up[i] * z[i + 1]
        if i + 2 < d:
            z[i] -= up2[i] * z[i + 2]
        z[i] /= main[i]
        big = np.abs(z).max(axis=0)
        z /= np.where(big > 1e100, big, 1.0)
    return z


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit vectors (rows) of a symmetric matrix."""
    d = len(matrix)
    k = min(k, d)
    size = np.abs(matrix).max()
    if not size:
        return np.zeros(k), np.eye(d)[:k]
    diag, off, mirrors = tridiagonal(matrix / size)
    values = leading_eigenvalues(diag, off, k)
    scale = max(np.abs(diag).max(), np.abs(off).max(initial=0))
    eps = np.finfo(float).eps
    start = values.copy()
    for j in range(1, k):  # equal eigenvalues are asked for a little apart
        start[j] = min(start[j], start[j - 1] - eps * scale)
    firsts = np.r_[True, values[:-1] - values[1:] > CLUSTER * scale]
    z = np.random.default_rng(1).standard_normal((d, k))
    for _ in range(4):
        z = _solve(diag, off, start, z / np.linalg.norm(z, axis=0))
        first = 0
        for j in range(k):
            first = j if firsts[j] else first
            for _ in range(2):  # twice is enough
                z[:, j] -= z[:, first:j] @ (z[:, first:j].T @ z[:, j])
                z[:, j] /= np.linalg.norm(z[:, j])
    for i in range(len(mirrors) - 1, -1, -1):
        v = mirrors[i]
        if v.any():
            z[i + 1:] -= 2 * np.outer(v, v @ z[i + 1:])
    return values * size, z.T


def whiten(rows: DataFrame, components: int = 32, scale: int = SCALE, shift: int = SHIFT, dim: int | None = None, max_dim: int = MAX_DIM,
           vec_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """``(vec_id, n, deviation, explained, whitened, identity_error)``, one row per usable vector
    (:func:`valid_vectors`): arrays of the ``components`` leading components, or the vector's length if that is less.

    ``deviation`` is the exact sum of (n*x - S)^2, a decimal (NULL beyond 38 digits). ``explained`` is each eigenvalue over the trace.
    A component of eigenvalue zero has NULL in ``whitened`` and no part in ``identity_error``, which is the largest
    entry of the whitened rows' own covariance minus the identity, measured by another pass
    (NULL if no component is left). Repeated rows and ids count again. No usable vector: no rows.
    The vectors are read five times; nothing but d x d sums reaches the driver.
    """
    vectors, d = valid_vectors(rows, vec_col, id_col, dim)
    if d > max_dim:
        raise ValueError(f"vectors of {d} entries; max_dim is {max_dim}")
    schema = f"vec_id {rows.schema[id_col].dataType.simpleString()}, n long, deviation decimal(38,0), explained array<double>, whitened array<double>, identity_error double"
    n, sums, most = _sums(vectors, d, scale, shift) if d else (0, [], 0)
    if not n:
        return rows.sparkSession.createDataFrame([], schema)
    total = np.array(sums, np.int64 if n * most < 2**61 else object)

    def centred(b):
        for _, x in _whole(b, d, scale, shift):
            yield (_centred(x, n, total) / n).astype(float)

    covariance = _products(vectors, d, d, centred) / n
    covariance = (covariance + covariance.T) / 2
    trace = float(np.trace(covariance))
    values, vectors_of = leading_components(covariance, components)
    kept = values > FLAT * max(values[0], 0) if trace > 0 else np.zeros(len(values), bool)
    k = len(values)
    projection = np.where(kept, 1 / np.sqrt(np.where(kept, values, 1)), 0)[:, None] * vectors_of
    shared = rows.sparkSession.sparkContext.broadcast(projection)  # k x d numbers
    error = None
    if kept.any():
        own = _products(vectors, d, k, lambda b: (z @ shared.value.T for z in centred(b))) / n
        error = float(np.abs(own - np.eye(k))[np.ix_(kept, kept)].max())
    explained = (values / trace).tolist() if trace > 0 else [None] * k

    def run(batches):
        for b in batches:
            for at, x in _whole(b, d, scale, shift):
                dev = _centred(x, n, total)
                largest = int(np.abs(dev).max())
                exact = (dev if d * largest * largest < 2**63 else dev.astype(object)) ** 2
                sums_of = exact.sum(axis=1).tolist()
                z = (dev / n).astype(float) @ shared.value.T
                m = len(x)
                whitened = pa.array(z.reshape(-1), mask=np.tile(~kept, m))
                offsets = pa.array(np.arange(m + 1, dtype=np.int32) * k)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(at, m), pa.array(np.full(m, n)), pa.array([decimal.Decimal(v) if v < 10**38 else None for v in sums_of], pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(offsets, pa.array(explained * m, pa.float64())), pa.ListArray.from_arrays(offsets, whitened),
                    pa.array([error] * m, pa.float64())], ["vec_id", "n", "deviation", "explained", "whitened", "identity_error"])

    return vectors.mapInArrow(run, schema)


def per_component(whitened: DataFrame) -> DataFrame:
    """One row per vector and component, numbered from 1."""
    both = F.arrays_zip(F.col("whitened").alias("w"), F.col("explained").alias("e"))
    return whitened.select("vec_id", "n", "deviation", "identity_error", F.posexplode(both).alias("at", "c")) \
        .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
                F.col("c.w").alias("whitened"), F.col("c.e").alias("explained"), "identity_error")
