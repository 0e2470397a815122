"""Mixing sources to target weights by balanced sampling with the cube method.

A source whose target is r times its size takes every document floor(r) times and one more copy
of some of them, each with the probability r - floor(r). Which ones the cube method decides: a
flight phase moves the vector of these probabilities through the null space of the balancing
constraints (document count and token total of the extra copies), settling one document a step.
It runs in parallel on blocks of a source; what a block leaves open meets in fewer blocks, until
one small landing problem for each source remains. That is settled by trying all its outcomes for
the one with the nearest token total.

Defined results: a null text has size 0; null is a source of its own, the last; a document of
size 0 may be taken any number of times and takes 0 words; an empty table gives an empty result;
repeated rows are documents of their own. The draws depend on ids, sizes and seed alone.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, running, written

#: Rows alike in id and size that are numbered at a time, where they stand together.
ALIKE = 4096
#: Documents that one flight takes, and those that it leaves open for the landing.
BLOCK, OPEN = 20_000, 14
_TINY = 1e-9


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[float] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """sources (source, source_size) plus target: shares by weight of the total of all sizes, at most `most` times a source's size.

    The excess of capped sources is shared out again by weight until no target is above its cap,
    which comes to one level L with target = min(cap, weight * L). One row for each source.
    """
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sources.withColumn("_w", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(F.row_number().over(rank) - 1, F.lit(len(weights))) + 1).cast("int")))
    sources = sources.withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    by = Window.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col("source").asc_nulls_last())
    before, everything = by.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    still = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    sources = sources.withColumn("_level", left / still)
    # the level counts from the first source, in this order, that is not capped
    level = F.min(F.when(F.col("_level") <= F.col("_cap") / F.col("_w"), F.struct(F.col("_cap") / F.col("_w"), F.col("_level").alias("level")))).over(everything).getField("level")
    return sources.withColumn("target", F.least("_cap", F.coalesce(F.col("_w") * level, F.col("_cap")))).drop("_w", "_cap", "_level")


def held_back(x: np.ndarray, n: int) -> list[int]:
    """Up to n units that a landing can fit a total with: the largest, then some near each halving of that size."""
    order = np.argsort(-x, kind="stable").tolist()
    out = order[: n // 3]
    rest, want = order[n // 3 :], float(x[order[0]]) if order else 0.0
    while rest and len(out) < n:
        want /= 2
        out.append(rest.pop(min(range(len(rest)), key=lambda i: abs(float(x[rest[i]]) - want)) if want >= 1 else -1))
    return out


def flight(p: np.ndarray, x: np.ndarray, draws: np.random.Generator, held: list[int]) -> np.ndarray:
    """Move p (0 to 1) until at most three units besides the held ones are open; sum(p) and sum(p * x) stay as they are."""
    p = p.astype(float).copy()
    p[p < _TINY], p[p > 1 - _TINY] = 0.0, 1.0
    aside = set(held)
    queue = [int(k) for k in np.flatnonzero((p > 0) & (p < 1)) if k not in aside]
    active = queue[:3]
    at = 3
    value = {k: float(p[k]) for k in active}
    coin = iter(draws.random(2 * len(queue) + 8).tolist())
    xs = x.astype(float)
    while len(active) == 3:
        a, b, c = active
        xa, xb, xc = float(xs[a]), float(xs[b]), float(xs[c])
        u = (xc - xb, xa - xc, xb - xa)  # in the null space of the rows (1, 1, 1) and x
        if u == (0.0, 0.0, 0.0):
            u = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for k, d in zip(active, u):
            v = value[k]
            if d > 0:
                up, down = min(up, (1 - v) / d), min(down, v / d)
            elif d < 0:
                up, down = min(up, v / -d), min(down, (1 - v) / -d)
        step = up if next(coin) * (up + down) < down else -down
        rest = []
        for k, d in zip(active, u):
            v = value[k] + step * d
            if v < _TINY or v > 1 - _TINY:
                p[k] = 0.0 if v < 0.5 else 1.0
                del value[k]
            else:
                value[k] = v
                rest.append(k)
        active = rest
        while len(active) < 3 and at < len(queue):
            k = queue[at]
            value[k] = float(p[k])
            active.append(k)
            at += 1
    for k, v in value.items():
        p[k] = v
    return p


def landing(p: np.ndarray, x: np.ndarray, want: float, draws: np.random.Generator) -> np.ndarray:
    """Settle the open units of p for the total of p * x nearest to want; ties go to the nearest count, then to chance."""
    p = p.copy()
    open_ = np.flatnonzero((p > 0) & (p < 1))
    if len(open_) > 20:
        raise ValueError("the flight left too much open")
    outcomes = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    settled = p.copy()
    settled[open_] = 0
    miss = np.abs(outcomes @ x[open_].astype(float) + float(settled @ x) - want)
    count = np.abs(outcomes.sum(1) - p[open_].sum())
    best = np.lexsort((draws.random(len(miss)), count, miss))[0]
    p[open_] = outcomes[best]
    return p


def _seed(*parts: object) -> np.random.Generator:
    import zlib

    return np.random.default_rng(zlib.crc32(repr(parts).encode()))


def mix(docs: DataFrame, seed: int = 0, weights: Sequence[float] = (1, 2, 3), most: float = 3.0, block: int = BLOCK, open_: int = OPEN, carry: Sequence[str] = ()) -> DataFrame:
    """docs (doc_id, source, size and what to carry) plus source_size, target, copies and taken = copies * size."""
    docs = docs.select("doc_id", "source", F.col("size").cast("long").alias("size"), *carry, F.monotonically_increasing_id().alias("_row"))
    docs = written(docs, "mix-sizes")
    sources = targets(docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_docs")), weights, most)
    sources = written(sources, "mix-sources")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = docs.join(sources.withColumn("_rate", rate).select(F.col("source").alias("_s"), "source_size", "target", "_rate"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    rows = rows.withColumn("_full", F.floor(F.col("_rate") + _TINY)).withColumn("_p", F.greatest(F.lit(0.0), F.col("_rate") - F.col("_full"))).drop("_rate")
    # rows alike in id and size are told apart by their number among them, so that they fly in different blocks; whichever gets which, reruns agree
    rows = running(rows, ["doc_id", "size"], [F.col("_row")], F.floor(F.col("_row") / ALIKE), {"_k": F.lit(1)}, {"_k": F.lit(0)})
    rows = rows.withColumn("_h", F.xxhash64(F.lit(seed), "doc_id", "size", F.when(F.col("_k") > 1, F.col("_k")))).drop("_row", "_k")

    def fly(level: int, last: bool):
        def run(g: pa.Table) -> pa.Table:
            g = g.sort_by([("_h", "ascending"), ("doc_id", "ascending"), ("size", "ascending")])
            x, p = g["size"].to_numpy(), g["_p"].to_numpy()
            draws = _seed(seed, level, g["source"][0].as_py(), g["_h"][0].as_py())
            undecided = np.flatnonzero((p > _TINY) & (p < 1 - _TINY))
            out = flight(p, x, draws, undecided[held_back(x[undecided], open_)].tolist())
            if last:
                out = landing(out, x, float(p @ x), draws)
            return g.set_column(g.schema.get_field_index("_p"), "_p", pa.array(out))

        return run

    done, level = [], 0
    count = docs.count()
    while True:
        blocks = max(1, -(-count // block))
        keyed = rows.withColumn("_b", F.pmod(F.xxhash64(F.lit(level), "_h"), F.lit(blocks)).cast("int"))
        settled = keyed.groupBy("source", "_b").applyInArrow(fly(level, blocks == 1), keyed.schema)
        if blocks == 1:
            done.append(settled)
            break
        settled = written(settled, f"mix-{level}")
        done.append(settled.where("_p <= 0 OR _p >= 1"))
        rows = settled.where("_p > 0 AND _p < 1").drop("_b")
        level, before, count = level + 1, count, rows.count()
        if count >= before:
            block *= 2  # many sources with few documents each: let them land
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    copies = (F.col("_full") + F.round("_p").cast("long")).cast("long")
    return out.select("doc_id", "source", *carry, "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
