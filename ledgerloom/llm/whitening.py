"""Embedding whitening: exact integer scatter from bit planes, then eigenvectors of the covariance.

Entries become integers. A dimension's values, shifted by its smallest one, are cut into bit planes; each
plane is packed across rows into 64-bit words. The sum of products of two dimensions is the popcount of
the AND of their planes, weighted by two to the planes' numbers: whole numbers, summed by Spark without
rounding. The driver holds one number for each pair of dimensions, whatever the rows.

Defined cases: vectors that are null or hold a null or non-finite entry take no part, nor do vectors of
another length than the most frequent one (of equally frequent ones the longest); an empty table, or one
without entries, gives no rows. A component without variance (equal vectors, fewer distinct vectors than
dimensions) has whitened 0 and no share in identity_error. Repeated rows and ids each get their own rows,
but repeated vectors count once in the fit. deviation is null where it exceeds a long. A null id stays
null. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, written

#: Rows whose planes are packed at a time.
BLOCK = 4096
#: Partial sums of this many bits each stay within a long.
LIMB = 24


def _matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return a.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def scaled(vectors: DataFrame, key: str, vector: str, scale: float, offset: int) -> DataFrame:
    """(key, x): rows that take part, their entries as integers floor(scale * entry) + offset."""
    c = F.col(vector).cast("array<double>")
    fine = c.isNotNull() & ~F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.select(F.col(key).alias("key"), c.alias("c"), fine.alias("fine")).where("fine")
    return rows.select("key", F.transform("c", lambda v: F.floor(v * F.lit(float(scale))).cast("long") + F.lit(offset)).alias("x"))


def planes(y: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Words of the bit planes of y (rows x dims, not negative): bits[0] planes of the first dimension, then the next."""
    out = np.zeros((int(bits.sum()), (len(y) + 63) // 64 * 8), np.uint8)
    k = 0
    for j, b in enumerate(bits):
        v = y[:, j]
        for s in range(b):
            p = np.packbits((v >> np.uint64(s)).astype(np.uint8) & 1)
            out[k, : len(p)] = p
            k += 1
    return out.view(np.uint64)


def cross_counts(words: np.ndarray) -> np.ndarray:
    """Rows in which both of two planes have a one, for each pair of planes."""
    k = len(words)
    out = np.zeros((k, k), np.int64)
    for a in range(k):
        out[a, a:] = out[a:, a] = np.bitwise_count(words[a] & words[a:]).sum(axis=1, dtype=np.int64)
    return out


def _extent(rows: DataFrame, dims: int) -> tuple[list[int], list[int], int]:
    """Smallest and largest entry of each dimension and the number of rows."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, n = None, None, 0
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(0), dims)
                lo, hi = x.min(axis=0), x.max(axis=0)
                low, high = (lo, hi) if low is None else (np.minimum(low, lo), np.maximum(high, hi))
                n += b.num_rows
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(low), pa.array(high), pa.array([n] + [0] * (dims - 1), pa.int64())], ["j", "low", "high", "n"])

    found = rows.select("x").mapInArrow(part, "j long, low long, high long, n long").groupBy("j").agg(F.min("low"), F.max("high"), F.sum("n")).orderBy("j").collect()
    return [r[1] for r in found], [r[2] for r in found], found[0][3]


def scatter(rows: DataFrame, dims: int) -> tuple[int, list[int], list[list[int]], list[int], list[int]]:
    """(n, sums, cross, low, high) of the rows' x: exact sums of entries and of products of two dimensions, as Python integers."""
    low, high, n = _extent(rows, dims)
    bits = np.array([max(1, (h - lo).bit_length()) for lo, h in zip(low, high)])
    place = np.concatenate([np.arange(b) for b in bits])  # the exponent of a plane's weight
    least = np.array(low, np.int64)
    start = np.concatenate([[0], np.cumsum(bits)[:-1]])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            x = _matrix(b.column(0), dims)
            for at in range(0, len(x), BLOCK):
                y = x[at : at + BLOCK].view(np.uint64) - least.view(np.uint64)  # wraps to the right difference
                counts = cross_counts(planes(y, bits))
                total = counts if total is None else total + counts
        if total is None:
            return
        both = place[:, None] + place[None, :]
        for limb in range(int(both.max()) // LIMB + 1):
            weighted = np.where(both // LIMB == limb, total << (both % LIMB), 0)
            pairs = np.add.reduceat(np.add.reduceat(weighted, start, axis=0), start, axis=1)
            single = np.add.reduceat(np.where(place // LIMB == limb, np.diag(total) << (place % LIMB), 0), start)
            i, j = np.triu_indices(dims)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(i, np.full(dims, -1))), pa.array(np.append(j, np.arange(dims))), pa.array(np.full(len(i) + dims, limb)), pa.array(np.append(pairs[i, j], single))], ["i", "j", "limb", "v"])

    sums, cross = [0] * dims, [[0] * dims for _ in range(dims)]
    parts = rows.select("x").mapInArrow(part, "i long, j long, limb long, v long").groupBy("i", "j", "limb").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    for i, j, limb, v in parts.collect():
        if i < 0:
            sums[j] += int(v) << LIMB * limb
        else:
            cross[i][j] += int(v) << LIMB * limb
            cross[j][i] = cross[i][j]
    # back from the shifted entries: x = y + low
    full = [[cross[i][j] + low[i] * sums[j] + low[j] * sums[i] + n * low[i] * low[j] for j in range(dims)] for i in range(dims)]
    return n, [s + n * lo for s, lo in zip(sums, low)], full, low, high


def components(n: int, sums: list[int], cross: list[list[int]], k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of the covariance, k at most, and its trace. Centred as integers, then divided."""
    dims = len(sums)
    v = np.array([[(n * cross[i][j] - sums[i] * sums[j]) / (n * n) for j in range(dims)] for i in range(dims)])
    e, u = np.linalg.eigh(v)
    return e[::-1][:k], u[:, ::-1][:, :k], float(np.trace(v))


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 16, scale: float = 64.0, offset: int = 1_000_000) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): each vector on the first k components.

    The fit is over distinct integer vectors, which Spark brings together with partial distincts, so many
    copies of one vector cost one row a task.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    schema = f"{key} {vectors.schema[key].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = scaled(vectors, key, vector, scale, offset)
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).where("d > 0").orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], schema)
    dims = sizes[0][0]
    rows = rows.where(F.size("x") == dims)
    fit = written(rows.select("x").distinct(), "whitening")
    n, sums, cross, low, high = scatter(fit, dims)
    e, u, trace = components(n, sums, cross, min(k, dims))
    some = e > max(float(e[0]), 0.0) * 1e-13  # what is left of rounding is no variance
    size = np.where(some, np.sqrt(np.where(some, e, 1.0)), 1.0)
    share = np.where(some, e / trace if trace else 0.0, 0.0)
    count, total = n, np.array(sums, object)
    small = dims * max(abs(n * v - s) for lo, hi, s in zip(low, high, sums) for v in (lo, hi)) ** 2 < 1 << 63

    def project(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n * x - S, exact, and the whitened rows."""
        d = count * x - total.astype(np.int64) if small else count * x.astype(object) - total
        return d, np.where(some, (d.astype(np.float64) / count) @ u / size, 0.0)

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, s, rows_in = np.zeros((len(e), len(e))), np.zeros(len(e)), 0
        for b in batches:
            w = project(_matrix(b.column(0), dims))[1]
            m, s, rows_in = m + w.T @ w, s + w.sum(axis=0), rows_in + len(w)
        if rows_in:
            i, j = np.indices(m.shape).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(i, np.full(len(s), -1))), pa.array(np.append(j, np.arange(len(s)))), pa.array(np.append(m.ravel(), s))], ["i", "j", "v"])

    second, first = np.zeros((len(e), len(e))), np.zeros(len(e))
    for i, j, v in fit.mapInArrow(outer, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v")).collect():
        if i < 0:
            first[j] = v
        else:
            second[i, j] = v
    off = np.abs(second / n - np.outer(first / n, first / n) - np.eye(len(e)))[np.ix_(some, some)]
    error = float(off.max()) if off.size else 0.0

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(e)
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                d, w = project(_matrix(part.column(1), dims))
                deviation = (d * d).sum(axis=1)
                longs = pa.array(deviation, pa.int64()) if small else pa.array([int(v) if v < 1 << 63 else None for v in deviation], pa.int64())
                m = part.num_rows
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, count)), longs.take(each), pa.array(w.ravel()),
                    pa.array(np.tile(share, m)), pa.array(np.full(m * k, error)),
                ], names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(F.col("key").alias(key), "x").mapInArrow(apply, schema)
