"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it.

    Where the setting is absent a temporary folder is set once, on a single machine only.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("ledgerloom.shared.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("ledgerloom.shared.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, tag: str, compression: str = "snappy") -> DataFrame:
    """Cut the lineage: write df as a table in the shared folder and read it again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """Let Arrow batches to Python hold `size` bytes at most, where Spark's own settings name no bound."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(name):
        spark.conf.set(name, str(size))


def unused(df: DataFrame, *names: str) -> list[str]:
    """names, each with as many underscores behind it as it takes to be no column of df."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def set_aside(df: DataFrame, *new: str) -> DataFrame:
    """df with room for new columns: a column of the same name goes on as <name>_in."""
    for n in new:
        for c in [c for c in df.columns if c.lower() == n.lower()]:
            df = df.withColumnRenamed(c, unused(df, f"{c}_in")[0])
    return df


def running(rows: DataFrame, keys: list[str], order: list[Column], block: Column, sums: dict[str, Column], zero: dict[str, Column], agg=F.sum) -> DataFrame:
    """rows plus running aggregates up to and with each row, by keys: inside blocks, plus those of the blocks before.

    block must not fall along the order.
    """
    inside = Window.partitionBy(*keys, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    r = rows.withColumn("_b", block)
    r = r.select("*", *(agg(v).over(inside).alias(f"_in_{n}") for n, v in sums.items()))
    ends = r.groupBy(*keys, "_b").agg(*(agg(v).alias(n) for n, v in sums.items()))
    ahead = Window.partitionBy(*keys).orderBy(F.col("_b").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_b").alias("_kb"), *(agg(n).over(ahead).alias(f"_of_{n}") for n in sums))
    ends = ends.where(" OR ".join(f"_of_{n} IS NOT NULL" for n in sums))  # the first block of a key needs none
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("_b").eqNullSafe(F.col("_kb"))]
    both = r.join(ends, on, "left")
    plus = lambda n: F.col(f"_in_{n}").bitwiseXOR(F.coalesce(f"_of_{n}", zero[n])) if agg is F.bit_xor else F.col(f"_in_{n}") + F.coalesce(f"_of_{n}", zero[n])
    return both.select(*rows.columns, *(plus(n).alias(n) for n in sums))


def crc32_of_id(name: str = "doc_id") -> Column:
    """crc32 of the id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z alone."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser; x is uint64 and is not changed."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of data, and the offset at which each begins.

    data is UTF-8; words are runs of bytes other than ASCII white space.
    """
    a = np.frombuffer(data, np.uint8)
    if not len(a):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inside = ~_SPACE[a]
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    begin = np.flatnonzero(edge == 1)
    if not len(begin):
        return np.empty(0, np.uint64), begin
    end = np.flatnonzero(edge == -1)
    if len(end) < len(begin):
        end = np.append(end, len(a))
    return _segments(a, begin, end), begin


_ODD = np.uint64(0x9E3779B97F4A7C15)
#: The low bytes of a lane that belong to a segment of so many bytes.
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _segments(a: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of a[begin:end] for each segment, eight bytes at a time; equal bytes give equal hashes at any place."""
    with np.errstate(over="ignore"):
        length = end - begin
        h = mix64(length.astype(np.uint64) * _ODD)
        padded = np.concatenate([a, np.zeros(8, np.uint8)])
        lanes = np.ndarray((len(a) + 1,), np.uint64, padded, 0, (1,))  # one lane from each byte on
        rest, at, k = np.arange(len(begin)), begin, 0
        left = length
        while len(rest):
            lane = lanes[at] & _KEEP[np.minimum(left, 8)]
            h[rest] = mix64((h[rest] ^ lane) * _ODD + np.uint64(k))
            more = left > 8
            rest, at, left, k = rest[more], at[more] + 8, left[more] - 8, k + 1
        return h
