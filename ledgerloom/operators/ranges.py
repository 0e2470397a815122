"""Sequence ranges: epochs, gaps, order, offsets. Frames are rows (epoch, seq, length, ...)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Bytes of an upload part.
PART = 32 << 20
#: Rows of a manifest that are sent to all executors; a larger one is joined by buckets of its range.
SMALL = 1 << 16
#: Sequence numbers of a bucket in that join.
BUCKET = 1 << 20
#: Sequence numbers of a block in which offsets are summed.
BLOCK = 1 << 12


def locate_epoch(df: DataFrame, manifest: DataFrame, seq_col: str = "seq") -> DataFrame:
    """df plus the epoch whose [first_seq, last_seq] holds the sequence number; none is an error."""
    m = manifest.select(F.col("epoch").alias("_epoch"), "first_seq", "last_seq")
    inside = F.col(seq_col).between(F.col("first_seq"), F.col("last_seq"))
    if m.count() <= SMALL:
        found = df.join(F.broadcast(m), inside, "left")
    else:
        m = m.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("first_seq") / BUCKET), F.floor(F.col("last_seq") / BUCKET))))
        found = df.withColumn("_b", F.floor(F.col(seq_col) / BUCKET)).join(m, (F.col("_b") == F.col("_bucket")) & inside, "left").drop("_b", "_bucket")
    epoch = F.when(F.col("_epoch").isNull(), F.raise_error(F.concat(F.lit("no epoch holds "), F.coalesce(F.col(seq_col).cast("string"), F.lit("null"))))).otherwise(F.col("_epoch"))
    return found.withColumn("epoch", epoch.cast("bigint")).drop("_epoch", "first_seq", "last_seq")


def clip_epoch_ranges(manifest: DataFrame, from_: int, to: int) -> DataFrame:
    """The part of [from_, to] in each epoch; none if from_ > to."""
    hit = manifest.where((F.col("first_seq") <= to) & (F.col("last_seq") >= from_) & F.lit(from_ <= to))
    return hit.select("epoch", F.greatest("first_seq", F.lit(from_)).cast("bigint").alias("start_seq"), F.least("last_seq", F.lit(to)).cast("bigint").alias("end_seq"))


def epoch_bounds(first_seqs: DataFrame) -> DataFrame:
    """(epoch, first_seq, last_seq, complete): the last is the next epoch's first less one; unknown for the newest.

    The next epoch is found by a join on epoch + 1, so no window holds all epochs.
    """
    after = first_seqs.select((F.col("epoch") - 1).alias("epoch"), (F.col("first_seq") - 1).alias("last_seq"))
    return first_seqs.join(after, "epoch", "left").select("epoch", "first_seq", "last_seq", F.col("last_seq").isNotNull().alias("complete"))


def epoch_range_select(frames: DataFrame, manifest: DataFrame, epoch: int | None = None, from_: int | None = None, to: int | None = None) -> DataFrame:
    """frames of one epoch, or of an explicit range; the two exclude each other."""
    if (epoch is None) == (from_ is None or to is None) or (epoch is not None and (from_ is not None or to is not None)):
        raise ValueError("give either an epoch or both ends of a range")
    if epoch is not None:
        return frames.where(F.col("epoch") == epoch).join(F.broadcast(manifest.where(F.col("epoch") == epoch).select("first_seq", "last_seq").limit(1)), F.col("seq").between(F.col("first_seq"), F.col("last_seq"))).drop("first_seq", "last_seq")
    return frames.where(F.col("seq").between(from_, to))


def missing_seqs(frames: DataFrame, from_: int, to: int) -> DataFrame:
    return frames.sparkSession.range(from_, to + 1).select(F.col("id").alias("seq")).join(frames.select("seq"), "seq", "left_anti")


def frame_places(frames: DataFrame) -> DataFrame:
    """frames plus block, offset (bytes of the epoch's frames before) and rank (their number), in blocks of sequence numbers.

    Sums over blocks come first, as few narrow rows; a window holds one block, never an epoch.
    """
    placed = frames.withColumn("block", F.floor(F.col("seq") / BLOCK))
    sums = placed.groupBy("epoch", "block").agg(F.sum("length").alias("bytes"), F.count("*").alias("n"))
    earlier = Window.partitionBy("epoch").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begin = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    starts = sums.select("epoch", "block", begin("bytes").alias("block_offset"), begin("n").alias("block_rank"))
    inside = Window.partitionBy("epoch", "block").orderBy("seq")
    before = F.coalesce(F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = placed.join(starts, ["epoch", "block"]).withColumn("offset", (F.col("block_offset") + before).cast("bigint"))
    return out.withColumn("rank", (F.col("block_rank") + F.row_number().over(inside) - 1).cast("bigint")).drop("block_rank").select(*frames.columns, "block", "block_offset", "offset", "rank")


def frame_offsets(frames: DataFrame) -> DataFrame:
    """frames plus their byte offset in the epoch's archive."""
    return frame_places(frames).select(*frames.columns, "offset")


def pack_parts(offsets: DataFrame, part_bytes: int = PART) -> DataFrame:
    """(epoch, part, bytes, frames): the byte stream of each epoch cut into parts, numbered from 1."""
    p, last = F.lit(part_bytes), F.col("offset") + F.col("length") - 1
    cut = offsets.where("length > 0").select("epoch", "seq", "offset", "length", F.explode(F.sequence(F.floor(F.col("offset") / p) + 1, F.floor(last / p) + 1)).alias("part"))
    own = F.least(F.col("part") * p, F.col("offset") + F.col("length")) - F.greatest((F.col("part") - 1) * p, F.col("offset"))
    return cut.groupBy("epoch", "part").agg(F.sum(own).cast("bigint").alias("bytes"), F.count("*").alias("frames"))


def gap_ranges(frames: DataFrame) -> DataFrame:
    """(gap_start, gap_end) of missing sequence numbers between the first and the last frame.

    Gaps inside an epoch come from a window on it; gaps between epochs from the epochs' ends, which
    are few. No window holds all frames.
    """
    inside = frames.select("epoch", "seq", F.lag("seq").over(Window.partitionBy("epoch").orderBy("seq")).alias("prev")).where("seq - prev > 1").select((F.col("prev") + 1).alias("gap_start"), (F.col("seq") - 1).alias("gap_end"))
    ends = frames.groupBy("epoch").agg(F.min("seq").alias("a"), F.max("seq").alias("b"))
    between = ends.select("a", F.lag("b").over(Window.orderBy("a")).alias("prev")).where("a - prev > 1").select((F.col("prev") + 1).alias("gap_start"), (F.col("a") - 1).alias("gap_end"))
    return inside.unionByName(between)


def dedup_frames(frames: DataFrame, arrival_col: str) -> DataFrame:
    """The first frame of each seq by arrival; equal arrivals are told apart by their columns' hash, so reruns agree.

    The winner is chosen on keys alone: a combined aggregate of (seq, arrival, hash), joined back.
    """
    names = {c.lower() for c in frames.columns}
    hashed = "_h" + "_" * sum(1 for n in names if n.startswith("_h"))
    rows = frames.withColumn(hashed, F.xxhash64(*frames.columns))
    best = rows.groupBy(F.col("seq").alias("_seq")).agg(F.min(F.struct(F.col(arrival_col).alias("a"), F.col(hashed).alias("h"))).alias("_best"), F.count("*").alias("_n"))
    repeated = best.where("_n > 1")
    kept = rows.join(repeated, F.col("seq") == F.col("_seq"), "left").where(F.col("_best").isNull() | (F.col(arrival_col).eqNullSafe(F.col("_best.a")) & (F.col(hashed) == F.col("_best.h"))))
    # what is left of a seq is equal rows; only those that repeat are brought together
    once, more = kept.where("_n IS NULL"), kept.where("_n IS NOT NULL")
    return once.select(*frames.columns).unionByName(more.select(*frames.columns).dropDuplicates(["seq"]))


def ordered_frames(frames: DataFrame) -> DataFrame:
    """frames in order over the partitions and inside them, for writers; no single sorted stream."""
    return frames.repartitionByRange("epoch", "seq").sortWithinPartitions("epoch", "seq")


def first_n(frames: DataFrame, start: int, n: int) -> DataFrame:
    """The first n frames from start on; a gap among them is an error."""
    got = frames.where(F.col("seq") >= start).orderBy("seq").limit(n)
    span = got.agg((F.max("seq") - F.min("seq") + 1).alias("_span"), F.count("*").alias("_count"))
    checked = got.join(F.broadcast(span))  # one row
    dense = F.when(F.col("_span") != F.col("_count"), F.raise_error(F.lit("sequence numbers are not dense"))).otherwise(F.col("seq"))
    return checked.withColumn("seq", dense.cast("bigint")).drop("_span", "_count")
