"""Conversation prefix trie: which conversations begin alike, by screening prefix digests with a count-min sketch.

A prefix is known by the XOR of 128-bit digests of its turns, each taken with its place, so it is an
ordinary running aggregate. All prefixes are counted in a count-min sketch, whose counters stop at two. An
estimate never is below the true count, so an estimate of one proves that a single conversation has the
prefix: such nodes are written from their own row alone. Only the others, which may be shared, are shuffled
and grouped exactly; a wrong guess of the sketch costs a shuffled row, never a wrong one.

A node belongs to its smallest conversation. Since the members of a child are among its parent's, a
conversation owns the end of its own path, and sums over a subtree become: what the owner has from here
down, plus all that the other members own anywhere.

Running aggregates go by blocks of SPAN turns, whose ends are few, so no task holds a conversation.

Defined cases: rows without a conv_id take no part; a null role or text is empty; turns with the same
number follow their roles, then digests of role and text, and repeated rows stay; an empty table gives no
rows. The columns conv_id, turn, role and text alone are read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, bounded_batches, mix64, running, written

#: Turns, ids and nodes of a path that are aggregated at a time.
SPAN = 1024
#: Hash rows of the sketch, and the most counters of each; the broadcast holds one bit of each.
ROWS, WIDTH = 3, 1 << 24
#: Counters that travel together.
_CHUNK = 1 << 16


def _half(digest: Column, first: int) -> Column:
    """A long from 64 bits of a digest in hex."""
    return F.conv(F.substring(digest, first, 16), 16, -10).cast("long")


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, no, a, b, words): each turn by its place from 1, its content as a digest."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    words = F.regexp_count(text, F.lit(WORD)).cast("long")
    rows = conversations.where("conv_id IS NOT NULL").select("conv_id", "turn", role.alias("role"), digest.alias("h"), words.alias("words"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("h")]
    ranked = running(rows, ["conv_id"], order, F.floor(F.col("turn") / SPAN), {"no": F.lit(1)}, {"no": F.lit(0)})
    return ranked.select("conv_id", "no", _half(F.col("h"), 1).alias("a"), _half(F.col("h"), 17).alias("b"), "words")


def rebuilt(said: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """(conv_id, no, a, b, words) after each conversation got its head from the first one of its group.

    A conversation without turns keeps one row with no = 0.
    """
    host = (F.col("conv_id") - F.col("conv_id") % group).alias("host")
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads)).alias("h")
    first = said.where(F.col("no") < heads).groupBy(F.col("conv_id").alias("host")).agg(F.array_sort(F.collect_list(F.struct("no", "a", "b", "words"))).alias("head"))
    convs = said.where("no = 1").select("conv_id", host, h).join(first, "host", "left")
    head = F.filter(F.coalesce("head", F.array().cast("array<struct<no:bigint,a:bigint,b:bigint,words:bigint>>")), lambda t: t["no"] <= F.col("h"))
    convs = convs.select("conv_id", "h", head.alias("head"))
    begin = F.concat(F.array(F.struct(F.lit(0).cast("long").alias("no"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("words"))), F.col("head"))
    shift = convs.select("conv_id", "h", F.size("head").alias("got"))
    own = said.join(shift, "conv_id").where("no > h").select("conv_id", (F.col("no") - F.col("h") + F.col("got")).alias("no"), "a", "b", "words")
    return convs.select("conv_id", F.explode(begin).alias("t")).select("conv_id", "t.*").unionByName(own)


def prefixes(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, x, y, px, py, words, ends): the digest of each prefix and of the one before, from the root at depth 0."""
    rows = rebuilt(written(turns(conversations), "turns"))
    mixed = lambda seed: F.when(F.col("no") == 0, F.lit(0).cast("long")).otherwise(F.xxhash64("a", "b", "no", F.lit(seed)))
    rows = rows.select("conv_id", "no", mixed(1).alias("u"), mixed(2).alias("v"), "words")
    zero = F.lit(0).cast("long")
    run = running(rows, ["conv_id"], [F.col("no")], F.floor(F.col("no") / SPAN), {"x": F.col("u"), "y": F.col("v")}, {"x": zero, "y": zero}, F.bit_xor)
    last = rows.groupBy(F.col("conv_id").alias("_c")).agg(F.max("no").alias("_n"))
    run = run.join(last, F.col("conv_id") == F.col("_c"))
    return run.select("conv_id", F.col("no").alias("depth"), "x", "y", F.col("x").bitwiseXOR(F.col("u")).alias("px"), F.col("y").bitwiseXOR(F.col("v")).alias("py"), "words", (F.col("no") == F.col("_n")).alias("ends"))


def _places(x: np.ndarray, y: np.ndarray, width: int) -> np.ndarray:
    """The counter of each prefix in each row of the sketch."""
    a, b = x.view(np.uint64), y.view(np.uint64)
    with np.errstate(over="ignore"):
        return np.stack([mix64(a + np.uint64(k + 1) * (b | np.uint64(1))) & np.uint64(width - 1) for k in range(ROWS)]).astype(np.int64)


def sketch(rows: DataFrame, width: int) -> np.ndarray:
    """ROWS x width bits: the counters that came to two or more. Tasks send chunks of counters, which are added up by chunk."""
    chunk = min(_CHUNK, width)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for b in batches:
            counts = np.zeros((ROWS, width), np.uint8) if counts is None else counts
            at = _places(b.column(0).to_numpy(), b.column(1).to_numpy(), width)
            for k in range(ROWS):
                places, n = np.unique(at[k], return_counts=True)
                counts[k, places] = np.minimum(counts[k, places] + np.minimum(n, 2).astype(np.uint8), 2)
        if counts is None:
            return
        for k in range(ROWS):
            for c in range(width // chunk):
                held = counts[k, c * chunk : (c + 1) * chunk]
                if held.any():
                    once, more = np.flatnonzero(held == 1).astype(np.uint16), np.flatnonzero(held == 2).astype(np.uint16)
                    yield pa.RecordBatch.from_arrays([pa.array([k * (width // chunk) + c]), pa.array([once.tobytes()]), pa.array([more.tobytes()])], ["chunk", "once", "more"])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in the order of their chunks, so one chunk's counters are held at a time."""
        now, held = None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([np.packbits(held == 2).tobytes()])], ["chunk", "bits"])

        for b in batches:
            for c, once, more in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                if c != now:
                    if now is not None:
                        yield out()
                    now, held = c, np.zeros(chunk, np.uint8)
                i = np.frombuffer(once.as_buffer(), np.uint16)
                held[i] = np.minimum(held[i] + 1, 2)
                held[np.frombuffer(more.as_buffer(), np.uint16)] = 2
        if now is not None:
            yield out()

    parts = rows.select("x", "y").mapInArrow(part, "chunk long, once binary, more binary")
    found = parts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(together, "chunk long, bits binary")
    bits = np.zeros((ROWS * (width // chunk), (chunk + 7) // 8), np.uint8)
    for c, b in found.collect():  # ROWS * width bits at most
        bits[c] = np.frombuffer(b, np.uint8)
    return bits.reshape(ROWS, -1)


def screened(rows: DataFrame, width: int | None = None) -> DataFrame:
    """rows plus alone and lone_parent: that the sketch proves the prefix, and the one before, to be of one conversation."""
    n = rows.count()
    width = width or min(WIDTH, 1 << max(10, (4 * n).bit_length()))
    sent = rows.sparkSession.sparkContext.broadcast(sketch(rows, width))

    @F.pandas_udf("boolean")
    def alone(x, y):
        import pandas as pd

        at, bits = _places(x.to_numpy(), y.to_numpy(), width), sent.value
        shared = np.ones(len(x), bool)
        for k in range(ROWS):
            shared &= (bits[k, at[k] >> 3] >> (7 - (at[k] & 7)).astype(np.uint8) & 1).astype(bool)
        return pd.Series(~shared)

    return rows.select("*", alone("x", "y").alias("alone"), F.when(F.col("depth") > 0, alone("px", "py")).otherwise(F.lit(False)).alias("lone_parent"))


def _ends_of(shared: DataFrame) -> DataFrame:
    """(x, y, ends_sha256) of nodes where conversations end. Ids are joined in blocks, and the blocks of a node pass through one hash as a stream."""
    ids = shared.where("ends").groupBy("x", "y", F.floor(F.col("conv_id") / SPAN).alias("block")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        now, h = None, None
        for b in batches:
            xs, ys, hs = [], [], []
            for x, y, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if (x, y) == now:
                    h.update(b"," + ids.encode())
                    continue
                if now is not None:
                    xs.append(now[0]), ys.append(now[1]), hs.append(h.hexdigest())
                now, h = (x, y), hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array(ys, pa.int64()), pa.array(hs, pa.string())], ["x", "y", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]]), pa.array([h.hexdigest()])], ["x", "y", "ends_sha256"])

    return ids.repartition("x", "y").sortWithinPartitions("x", "y", "block").select("x", "y", "ids").mapInArrow(digest, "x long, y long, ends_sha256 string")


def trie(conversations: DataFrame, width: int | None = None) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): a row for each node."""
    bounded_batches(conversations.sparkSession)
    none = F.sha2(F.lit("").cast("binary"), 256)
    long = lambda v: F.lit(v).cast("long")
    rows = written(screened(written(prefixes(conversations), "prefixes"), width), "screened")
    lone, shared = rows.where("alone"), rows.where("NOT alone")

    nodes = shared.groupBy("x", "y").agg(
        F.min("conv_id").alias("owner"), F.min("depth").alias("depth"), F.count("*").alias("n"), F.first("words").alias("words"), F.first("px").alias("px"), F.first("py").alias("py"), F.first("lone_parent").alias("lone_parent"),
    )
    nodes = written(nodes, "nodes")
    # a child hangs at a node that may be shared: a grouped one, or the first that one conversation has alone
    tops = lone.where("NOT lone_parent AND depth > 0").select("px", "py", F.col("conv_id").alias("owner"), "depth")
    hung = nodes.where("NOT lone_parent AND depth > 0").select("px", "py", "owner", "depth").unionByName(tops)
    children = hung.groupBy(F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count("*").alias("n_children"))
    own = nodes.join(children, ["x", "y"], "left").select("x", "y", "owner", "depth", "n", ((F.col("n") - 1) * F.col("words")).alias("saved"), F.coalesce("n_children", long(0)).alias("n_children"))
    own = written(own, "owned")

    # what each conversation owns, in all and from each of its nodes down
    ended = lone.where("ends").select(F.col("conv_id").alias("owner"), long(0).alias("saved"), long(1).alias("leaf"), F.lit(None).cast("long").alias("from"))
    totals = own.select("owner", "saved", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaf"), F.col("depth").alias("from")).unionByName(ended)
    totals = totals.groupBy("owner").agg(F.sum("saved").alias("total"), F.sum("leaf").alias("leaf"), F.min("from").alias("from"))
    above = running(own.select("x", "y", "owner", "depth", "saved"), ["owner"], [F.col("depth")], F.floor(F.col("depth") / SPAN), {"upto": F.col("saved")}, {"upto": long(0)})
    below = above.join(totals.select("owner", "total"), "owner").select("x", "y", (F.col("total") - F.col("upto") + F.col("saved")).alias("down"))
    t = totals.where("total > 0 OR leaf > 0").select(F.col("owner").alias("conv_id"), "total", "leaf", "from")
    given = shared.select("conv_id", "depth", "x", "y").join(t, "conv_id")
    others = given.groupBy("x", "y").agg(F.sum("leaf").alias("n_leaves"), F.sum(F.when(F.col("from").isNull() | (F.col("depth") < F.col("from")), F.col("total")).otherwise(0)).alias("others"))

    parents = hung.select("owner", "depth", F.col("px").alias("x"), F.col("py").alias("y")).join(own.select("x", "y", F.col("owner").alias("parent")), ["x", "y"]).select("owner", "depth", "parent")
    known = own.join(below, ["x", "y"]).join(others, ["x", "y"], "left").join(_ends_of(shared), ["x", "y"], "left")
    known = known.select("owner", "depth", "n", "n_children", F.coalesce("n_leaves", long(0)).alias("n_leaves"), (F.col("down") + F.coalesce("others", long(0))).alias("saved_tokens"), F.coalesce("ends_sha256", none).alias("ends_sha256"))
    single = F.when(F.col("ends"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(none)
    alone = lone.select(F.col("conv_id").alias("owner"), "depth", long(1).alias("n"), F.when(F.col("ends"), 0).otherwise(1).cast("long").alias("n_children"), long(1).alias("n_leaves"), long(0).alias("saved_tokens"), single.alias("ends_sha256"))
    # a node is named by its owner and depth: the parent of one without an entry is its owner's own
    out = known.unionByName(alone).join(parents, ["owner", "depth"], "left")
    return out.select(
        F.col("owner").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "owner")).alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    )
