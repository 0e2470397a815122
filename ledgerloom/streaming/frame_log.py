"""A stream of frames written as archive parts, each batch exactly once.

Tasks put their frames into part files and tell what they wrote in commit messages. The driver lists the
parts of a batch in one small file of the log, named by the feed and the batch, and parts count only once they
are listed. A batch that is run again after it was listed adds nothing; what tasks wrote that died before
is never listed. Where a part begins in its epoch follows from the log alone, in the order of commits, so
places never change once given, and a commit reads the names of earlier ones alone.

Within an epoch the frames of one part are in the order of seq, and parts stand in the order in which they
were committed. The store is any that Arrow can open by its address.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sources.archive import inflated

_LOG = "part string, epoch bigint, first_seq bigint, last_seq bigint, frames bigint, bytes bigint, number bigint, place bigint, feed string, batch bigint"
_PARTS = "part string, entries array<struct<seq:bigint,offset:bigint,length:bigint,sha256:string>>, data binary"


class _Parts(WriterCommitMessage):
    """What the log says of the parts that one task wrote."""

    def __init__(self, parts: list[dict]) -> None:
        self.parts = parts


class _Writer(DataSourceStreamWriter):
    def __init__(self, options: dict) -> None:
        self.path, self.feed = options["path"].rstrip("/"), options.get("feed", "feed")
        self.per_part = int(options.get("partbytes", 32 << 20))

    def _store(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)

    def write(self, iterator: Iterator) -> _Parts:
        import pyarrow as pa
        import pyarrow.parquet as pq

        store, base = self._store()
        name, out, file, parts = uuid.uuid4().hex, None, None, []
        entry = pa.struct([("seq", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("sha256", pa.string())])
        schema = pa.schema([("part", pa.string()), ("entries", pa.list_(entry)), ("data", pa.binary())])
        held: dict[int, list[tuple[int, bytes]]] = {}
        size = 0

        def flush() -> None:
            nonlocal out, file
            if out is None:
                store.create_dir(f"{base}/parts")
                file = store.open_output_stream(f"{base}/parts/_{name}")
                out = pq.ParquetWriter(file, schema, compression="none")  # frames are zstd already
            for epoch in sorted(held):
                frames, entries, at = sorted(held[epoch]), [], 0
                for seq, content in frames:
                    entries.append({"seq": seq, "offset": at, "length": len(content), "sha256": hashlib.sha256(content).hexdigest()})
                    at += len(content)
                part = f"{name}-{len(parts)}"
                out.write_table(pa.table([[part], [entries], [b"".join(c for _, c in frames)]], schema=schema))
                parts.append({"part": part, "epoch": epoch, "first_seq": frames[0][0], "last_seq": frames[-1][0], "frames": len(frames), "bytes": at})
            held.clear()

        for row in iterator:
            epoch, seq, content = row["epoch"], row["seq"], row["content"]
            if epoch is None or seq is None or content is None:
                raise ValueError("a frame needs an epoch, a seq and a content")
            held.setdefault(epoch, []).append((seq, bytes(content)))
            size += len(content)
            if size >= self.per_part:
                flush()
                size = 0
        if held:
            flush()
        if out is not None:
            out.close()
            file.close()
            store.move(f"{base}/parts/_{name}", f"{base}/parts/{name}.parquet")
        return _Parts(parts)

    def commit(self, messages: list, batchId: int) -> None:
        from pyarrow import fs

        store, base = self._store()
        listed = [f.base_name for f in store.get_file_info(fs.FileSelector(f"{base}/log", allow_not_found=True)) if f.base_name.endswith(".json")]
        if any(n.split("-", 1)[1] == f"{self.feed}-{batchId}.json" for n in listed):
            return  # listed before; what this run wrote stays unlisted
        number = max((int(n.split("-", 1)[0]) for n in listed), default=-1) + 1
        parts = sorted((p for m in messages if m for p in m.parts), key=lambda p: (p["epoch"], p["first_seq"], p["last_seq"], p["part"]))
        store.create_dir(f"{base}/log")
        aside = f"{base}/log/_{uuid.uuid4().hex}"
        with store.open_output_stream(aside) as f:
            f.write("".join(json.dumps(p | {"number": number, "place": k, "feed": self.feed, "batch": batchId}) + "\n" for k, p in enumerate(parts)).encode())
        store.move(aside, f"{base}/log/{number}-{self.feed}-{batchId}.json")

    def abort(self, messages: list, batchId: int) -> None:
        """What tasks wrote stays unlisted."""


class FrameLog(DataSource):
    """writeStream.format("frame_log"): frames (epoch, seq, content) as parts below path. Options: feed, partBytes."""

    @classmethod
    def name(cls) -> str:
        return "frame_log"

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        return _Writer(dict(self.options))


def sink_frame_log(stream: DataFrame, path: str, checkpoint: str, feed: str = "feed", per_part: int = 32 << 20) -> StreamingQuery:
    """Write what is there now of a stream of frames (epoch, seq, content); a null in one of them is an error.

    Batches are known by feed and number: a query that begins with a new checkpoint needs a new name of its
    feed. A folder has one query at a time.
    """
    stream.sparkSession.dataSource.register(FrameLog)
    rows = stream.select(F.col("epoch").cast("bigint"), F.col("seq").cast("bigint"), F.col("content").cast("binary"))
    return rows.writeStream.format("frame_log").option("feed", feed).option("partBytes", per_part).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


def log_of(spark: SparkSession, path: str) -> DataFrame:
    """The committed parts, without contents: (part, epoch, begin, rank, first_seq, last_seq, frames, bytes, feed, batch)."""
    log = spark.read.schema(_LOG).json(f"{path}/log")
    before = Window.partitionBy("epoch").orderBy("number", "place").rowsBetween(Window.unboundedPreceding, -1)
    sums = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    return log.withColumn("begin", sums("bytes")).withColumn("rank", sums("frames")).drop("number", "place")


def logged_parts(spark: SparkSession, path: str) -> DataFrame:
    """(epoch, begin, rank, first_seq, last_seq, bytes, entries, data) of the committed parts: what an archive table holds."""
    stored = spark.read.schema(_PARTS).parquet(f"{path}/parts")
    placed = stored.join(log_of(spark, path), "part")
    entries = F.transform("entries", lambda e: F.struct(e["seq"].alias("seq"), (e["offset"] + F.col("begin")).alias("offset"), e["length"].alias("length"), e["sha256"].alias("sha256")))
    return placed.select("epoch", "begin", "rank", "first_seq", "last_seq", "bytes", entries.alias("entries"), "data")


def logged_frames(spark: SparkSession, path: str, from_: int | None = None, to: int | None = None) -> DataFrame:
    """(epoch, seq, body) of the committed frames with seq in [from_, to]."""
    low, high = F.lit(-(1 << 63) if from_ is None else from_), F.lit((1 << 63) - 1 if to is None else to)
    hit = logged_parts(spark, path).where((F.col("last_seq") >= low) & (F.col("first_seq") <= high))
    wanted = F.filter("entries", lambda e: e["seq"].between(low, high))
    return inflated(hit.withColumn("wanted", F.transform(wanted, lambda e: F.struct(e["seq"].alias("seq"), e["offset"].alias("offset"), e["length"].alias("length")))))
