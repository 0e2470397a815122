"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Each shard draws a number for the key; the shard with the smallest -ln(draw) / weight gets the
record. A new shard takes records only into itself, and a removed one gives only its own away.

Defined results: a null key is a key like any other (the empty one); null texts have size 1;
repeated rows go to one shard and get slots of their own; an empty table gives an empty result;
columns that are named like the new ones go on as <name>_in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import set_aside, unused, written

#: Records that one task numbers at a time.
BLOCK = 50_000


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard that gets key; only the key and the shards' weights decide."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    key = F.coalesce(key.cast("string"), F.lit(""))

    def draw(j: int) -> Column:
        bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"/{j}"))), 1, 13), 16, 10).cast("double")
        return (bits + 0.5) / float(1 << 52)

    return F.array_min(F.array(*(F.struct((-F.log(draw(j)) / float(w)).alias("cost"), F.lit(j).alias("shard")) for j, w in enumerate(weights)))).getField("shard")


def shard(rows: DataFrame, key: str, weights: Sequence[float], order: Sequence[str] = (), column: str = "shard", spread: bool = True) -> DataFrame:
    """rows plus their shard and a slot in it, gapless from 0 in each shard.

    A shard is numbered in blocks of rows with like hashes of key and order: a block is sorted in one
    task, and the counts of the blocks before it give its first slot. No task sees a whole shard. To
    `spread` rows that repeat key and order as well, all rows are written once with a number each;
    that is needless where few rows can be alike in both.
    """
    order = [key, *order]
    rows = set_aside(rows, column, "slot")
    block, row, n, first, at = unused(rows, "_block", "_row", "_n", "_first", "_at")
    placed = rows.withColumn(column, rendezvous(F.col(key), weights))
    if spread:
        placed = written(placed.withColumn(row, F.monotonically_increasing_id()), "placed")
    alike = [F.col(c) for c in order] + [F.col(row)] * spread
    blocks = F.lit(max(1, -(-placed.count() // BLOCK)))
    placed = placed.withColumn(block, F.pmod(F.xxhash64(F.lit(7), *alike), blocks).cast("int"))
    sizes = placed.groupBy(column, block).agg(F.count("*").alias(n))
    before = Window.partitionBy(column).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(column, block, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(first))
    inside = Window.partitionBy(column, block).orderBy(*(F.col(c).asc_nulls_first() for c in order), *[row] * spread)
    numbered = placed.withColumn(at, F.row_number().over(inside))
    return numbered.join(firsts, [column, block]).withColumn("slot", (F.col(first) + F.col(at) - 1).cast("long")).drop(block, first, at, row)
