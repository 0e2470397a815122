"""Nearest neighbours by inner product with score-aware anisotropic quantisation.

A product quantiser with 16 centroids for each pair of dimensions is trained for maximum inner
product: the part of a residual that is parallel to its vector costs eta times as much as the
orthogonal part, in the choice of codes as well as in the centroids. Two four-bit codes share a
byte. All rows are encoded. A query block scans the codes of a row block by table look-ups; the
best of each block are scored exactly, in double precision, then all others whose look-up lies
within the likely error of the k-th exact score: `sure` standard deviations of what the codes lose
at right angles to a vector, taken as spread evenly over the dimensions. So rows that the codes
cannot tell apart, as near copies, are all scored, while few others are. With sure=None the proven
error counts, and the result is exact.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no
part, nor do vectors whose length is not the most frequent one (ties: the larger). Ties of the
score go to the smaller id, null ids take no part. Rows that repeat an id are rows of their own, each
a query, and candidates of each other. Empty tables give empty results. The key and the vector alone
are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Rows of the training sample, at most.
SAMPLE = 16_384
#: Rows and queries of a block, and how many of a row block are scored exactly at first.
ROWS, QUERIES, RERANK = 32_768, 16_384, 32
#: Standard deviations of the codes' error that count.
SURE = 1.25
#: Rows of a block as long as there are fewer blocks than cores.
FEW = 4_096


class Quantiser:
    """Codebooks of 16 centroids for each pair of dimensions; odd dimensions are padded with zero."""

    def __init__(self, sample: np.ndarray, threshold: float = 0.2, rounds: int = 6, seed: int = 7):
        x = self.padded(sample)
        n, d = x.shape
        self.parts, self.dims = d // 2, d
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        u = x / np.where(norm > 0, norm, 1)
        weight = max(d - 1, 1) * threshold**2 / (1 - threshold**2)
        self.extra = max(0.0, weight - 1)  # eta - 1
        draws = np.random.default_rng(seed)
        self.books = np.stack([self._start(x[:, 2 * m : 2 * m + 2], draws) for m in range(self.parts)])
        for _ in range(rounds):
            codes = self._codes(x, u)
            self._fit(x, u, codes)

    @staticmethod
    def padded(x: np.ndarray) -> np.ndarray:
        x = np.ascontiguousarray(x, np.float64)
        return np.pad(x, ((0, 0), (0, -x.shape[1] % 4)))

    @staticmethod
    def _start(x: np.ndarray, draws: np.random.Generator) -> np.ndarray:
        book = x[draws.integers(0, len(x), 16)] + draws.normal(0, 1e-6, (16, 2))
        for _ in range(8):
            near = ((x[:, None] - book) ** 2).sum(2).argmin(1)
            n = np.bincount(near, minlength=16)
            for j in (0, 1):
                book[:, j] = np.where(n > 0, np.bincount(near, x[:, j], 16) / np.maximum(n, 1), book[:, j])
        return book

    def _codes(self, x: np.ndarray, u: np.ndarray) -> np.ndarray:
        """Coordinate descent on |r|^2 + extra * (r.u)^2, starting from the nearest centroids."""
        xs, us = x.reshape(len(x), self.parts, 2), u.reshape(len(x), self.parts, 2)
        codes = np.empty((len(x), self.parts), np.uint8)
        along = np.zeros(len(x))
        for m in range(self.parts):
            codes[:, m] = ((xs[:, m, None] - self.books[m]) ** 2).sum(2).argmin(1)
            along += ((xs[:, m] - self.books[m][codes[:, m]]) * us[:, m]).sum(1)
        for _ in range(2):
            for m in range(self.parts):
                r = xs[:, m, None] - self.books[m]
                own = (r * us[:, m, None]).sum(2)
                rest = along - np.take_along_axis(own, codes[:, m : m + 1].astype(np.intp), 1)[:, 0]
                best = ((r**2).sum(2) + self.extra * (rest[:, None] + own) ** 2).argmin(1)
                along = rest + own[np.arange(len(x)), best]
                codes[:, m] = best
        return codes

    def _fit(self, x: np.ndarray, u: np.ndarray, codes: np.ndarray) -> None:
        """The best centroids of each part, the others held."""
        xs, us = x.reshape(len(x), self.parts, 2), u.reshape(len(x), self.parts, 2)
        along = sum(((xs[:, m] - self.books[m][codes[:, m]]) * us[:, m]).sum(1) for m in range(self.parts))
        for m in range(self.parts):
            c, um = codes[:, m], us[:, m]
            rest = along - ((xs[:, m] - self.books[m][c]) * um).sum(1)
            n = np.bincount(c, minlength=16)
            right = xs[:, m] + self.extra * um * (rest + (xs[:, m] * um).sum(1))[:, None]
            a = np.empty((16, 2, 2))
            for i in (0, 1):
                for j in (0, 1):
                    a[:, i, j] = n * (i == j) + self.extra * np.bincount(c, um[:, i] * um[:, j], 16)
            b = np.stack([np.bincount(c, right[:, j], 16) for j in (0, 1)], 1)
            some = n > 0
            self.books[m][some] = np.linalg.solve(a[some] + 1e-12 * np.eye(2), b[some][..., None])[..., 0]
            along = rest + ((xs[:, m] - self.books[m][c]) * um).sum(1)

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Bytes of two four-bit codes each."""
        x = self.padded(x)
        out = []
        for k in range(0, len(x), 8192):
            part = x[k : k + 8192]
            norm = np.linalg.norm(part, axis=1, keepdims=True)
            codes = self._codes(part, part / np.where(norm > 0, norm, 1))
            out.append(codes[:, 0::2] | codes[:, 1::2] << 4)
        return np.concatenate(out) if out else np.empty((0, self.parts // 2), np.uint8)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The padded vectors that the bytes of encode stand for."""
        out = np.empty((len(codes), self.parts, 2))
        for m in range(self.parts):
            out[:, m] = self.books[m][codes[:, m // 2] >> 4 * (m % 2) & 15]
        return out.reshape(len(codes), self.dims)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """For each query and byte the sums that its 256 values stand for."""
        q = self.padded(q).reshape(len(q), self.parts, 2)
        single = np.einsum("qmj,mcj->qmc", q, self.books)
        low, high = single[:, 0::2], single[:, 1::2]
        return (high[:, :, :, None] + low[:, :, None, :]).reshape(len(q), self.parts // 2, 256).astype(np.float32)


def best_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest, of equal ones those that come first."""
    if len(scores) <= k:
        return np.arange(len(scores))
    edge = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > edge)
    return np.concatenate([above, np.flatnonzero(scores == edge)[: k - len(above)]])


class Errors:
    """Bounds of what look-ups may miss, for the rows of a block.

    With x = |x| u the code of a row is g u + w, w orthogonal to u, and its look-up is g c + q.w with
    c = q.u = score / |x|. As |q.w| <= |w| sqrt(|q|^2 - c^2), a row of score s or more (s >= 0, g >= 0)
    has a look-up of g c - |w| sqrt(|q|^2 - c^2) or more at c = s / |x|, which grows with c.
    Any row's look-up is at most |q| |x - code| below its score. With `sure`, q.w counts as one coordinate
    of a vector of that length in d - 1 dimensions, so many standard deviations of it.
    """

    def __init__(self, model: Quantiser, x: np.ndarray, codes: np.ndarray, sure: float | None = None):
        self.shrink = 1.0 if sure is None else min(1.0, sure / max(1, x.shape[1] - 1) ** 0.5)
        self.norm, self.g, self.w, self.r = (np.empty(len(x)) for _ in range(4))
        for k in range(0, len(x), 8192):
            at, part, y = slice(k, k + 8192), model.padded(x[k : k + 8192]), model.decode(codes[k : k + 8192])
            self.norm[at] = np.linalg.norm(part, axis=1)
            u = part / self.norm[at, None]
            self.g[at] = (y * u).sum(1)
            self.w[at] = np.linalg.norm(y - self.g[at, None] * u, axis=1)
            self.r[at] = np.linalg.norm(part - y, axis=1)

    def least(self, score: float, size: float) -> np.ndarray:
        """The least look-up that a row of this score or more can have, for a query of norm `size`."""
        plain = score - size * self.r
        if not score >= 0:
            return plain
        c = score / self.norm
        return np.where(self.g >= 0, np.fmax(plain, self.g * c - self.shrink * self.w * np.sqrt(np.maximum(size * size - c * c, 0) + 1e-12 * size * size)), plain)


def scan(model: Quantiser, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, codes: np.ndarray, asks: np.ndarray, q: np.ndarray, k: int, rerank: int, sure: float | None = None) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """For each query (the row asks) its k best of the other rows, and how many were scored exactly; ids must ascend.

    `rerank` rows are scored at first, and as many more as it takes.
    """
    columns, out = np.ascontiguousarray(codes.T), []
    errors = Errors(model, x, codes, sure)
    for a in range(0, len(q), 32):
        tables = model.tables(q[a : a + 32])
        for t, ask, v in zip(tables, asks[a : a + 32], q[a : a + 32].astype(np.float64)):
            rough = t[0][columns[0]]
            for j in range(1, len(columns)):
                rough += t[j][columns[j]]
            own = rows == ask
            rough[own] = -np.inf
            some = best_of(rough, max(rerank, k + 1))
            some = some[~own[some]]
            exact = x[some].astype(np.float64) @ v
            if len(some) + own.sum() < len(ids):
                size, edge = np.linalg.norm(v), np.partition(exact, len(exact) - k)[len(exact) - k] if len(exact) >= k else -np.inf
                # what single precision may lose in tables and sums, and double in bounds
                slack = 2.0**-23 * (len(columns) + 4) * np.abs(t).max(1).sum(dtype=np.float64) + 1e-9 * (abs(edge) + size * (errors.norm + errors.r))
                rest = ~(rough < errors.least(edge, size) - slack) & ~own
                rest[some] = False
                more = np.flatnonzero(rest)
                some, exact = np.concatenate([some, more]), np.concatenate([exact, x[more].astype(np.float64) @ v])
            top = np.lexsort((ids[some], -exact))[:k]
            out.append((np.full(len(top), ask), ids[some][top], exact[top], len(some)))
    return out


def clean(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v array<double>) of the rows that take part, before the rule on lengths."""
    v = F.col(vector).cast("array<double>")
    fine = F.col(key).isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))) & F.exists(v, lambda c: c != 0)
    return vectors.where(fine).select(F.col(key).cast("long").alias("id"), v.alias("v"))


def neighbours(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = 20, sample: int = SAMPLE, rows: int = ROWS, queries: int = QUERIES, rerank: int = RERANK, sure: float | None = SURE) -> DataFrame:
    """query_id, rank, vec_id and score of the k rows nearest to each row whose id is divisible by `every`."""
    spark = vectors.sparkSession
    schema = "query_id long, ask long, vec_id long, score double"
    good = clean(vectors, key, vector)
    kind = np.float32 if "array<float>" in vectors.schema[vector].dataType.simpleString() else np.float64  # products are in double
    lengths = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d, n = lengths[0]["d"], lengths[0]["count"]
    good = good.where(F.size("v") == d)
    share = min(1.0, sample / n)
    drawn = good.where(F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    drawn = drawn.orderBy(F.xxhash64(F.lit(12), "id"), "id", F.xxhash64("v")).select("v").limit(sample)
    model = Quantiser(np.array([r["v"] for r in drawn.collect()] or [[1.0] * d], np.float64))
    model_of = spark.sparkContext.broadcast(model)  # 16 centroids for each two dimensions

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.stack(b["v"].to_numpy()) if len(b) else np.empty((0, d))
            yield pd.DataFrame({"id": b["id"], "row": b["row"], "v": [r.tobytes() for r in x.astype(kind)], "code": [r.tobytes() for r in model_of.value.encode(x)]})

    n_rows, n_queries = max(-(-n // rows), min(spark.sparkContext.defaultParallelism, -(-n // FEW))), max(1, -(-n // (every * queries)))
    # rows get numbers of their own, written with them, as ids may repeat
    coded = written(good.withColumn("row", F.monotonically_increasing_id()).mapInPandas(encode, "id long, row long, v binary, code binary"), "codes")
    cell = lambda many, salt: F.pmod(F.xxhash64(F.lit(salt), "row"), F.lit(many)).cast("int")
    each = lambda many, name: F.explode(F.sequence(F.lit(0), F.lit(many - 1))).alias(name)
    left = coded.select("id", "row", "v", "code", cell(n_rows, 1).alias("r"), each(n_queries, "q")).withColumn("asks", F.lit(False))
    right = coded.where(F.col("id") % every == 0).select("id", "row", "v", "code", cell(n_queries, 2).alias("q"), each(n_rows, "r")).withColumn("asks", F.lit(True))

    def search(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["id", "row"], kind="stable")
        base, asks = g[~g["asks"]], g[g["asks"]]
        if not len(base) or not len(asks):
            return pd.DataFrame({"query_id": [], "ask": [], "vec_id": [], "score": []})
        as_rows = lambda c, of: np.frombuffer(b"".join(c), of).reshape(len(c), -1)
        found = scan(model_of.value, base["row"].to_numpy(), base["id"].to_numpy(), as_rows(base["v"], kind), as_rows(base["code"], np.uint8), asks["row"].to_numpy(), as_rows(asks["v"], kind), k, rerank, sure)
        out = pd.DataFrame(dict(zip(("ask", "vec_id", "score"), map(np.concatenate, zip(*(f[:3] for f in found))))))
        return out.assign(query_id=out["ask"].map(dict(zip(asks["row"], asks["id"]))))[["query_id", "ask", "vec_id", "score"]]

    hits = left.unionByName(right).groupBy("r", "q").applyInPandas(search, schema)
    best = hits.groupBy("query_id", "ask").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("top"))
    found = best.select("query_id", F.posexplode("top").alias("i", "t"))
    return found.select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("vec_id"), (-F.col("t.s")).alias("score"))
