"""Frames in files: one by one, or packed into epoch archives with a byte-offset index.

An archive has two forms. As files it is {epoch}.zst, the epoch's zstd frames one behind the other,
and {epoch}.idx, entries of 20 bytes (seq and offset as 8, length as 4 bytes, little-endian); the
data source `epoch_archive` reads and writes it on a file system that all machines mount. As a
table, for any store that Spark can reach, it has a row for each part of an epoch: where the part
begins, its sequence numbers, the entries of its frames, and their bytes. Parts are cut between
frames, so each frame is read from one part, and neither a task nor a cell holds an epoch.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    Not,
    WriterCommitMessage,
)

from ..operators.ranges import frame_places
from ..schemas import MANIFEST

ENTRY = 20
#: A body of fewer bytes is no frame.
LEAST = 10
#: Bytes that one task reads from an archive.
RUN = 16 << 20
#: Epochs that a reader names to the scan; of more, only the range is pushed down.
EPOCHS = 1 << 12


def frame_files(spark: SparkSession, path: str) -> DataFrame:
    """(seq, content, length, is_valid) of files named {seq}.binpb.zst; Spark passes files without a byte by."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.binpb.zst").load(path)
    return files.select(F.regexp_extract("path", r"(\d+)\.binpb\.zst$", 1).cast("bigint").alias("seq"), "content", "length", (F.col("length") >= LEAST).alias("is_valid"))


def write_frame_files(frames: DataFrame, path: str) -> None:
    """Write frames (seq, content) as {seq}.binpb.zst to a folder that all machines mount."""
    folder = local_path(path)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(folder, exist_ok=True)
        for b in batches:
            for seq, content in zip(b["seq"], b["content"]):
                part = f"{folder}/.{seq}.{uuid.uuid4().hex}"  # a task that is run again replaces whole files
                with open(part, "wb") as f:
                    f.write(content)
                os.replace(part, f"{folder}/{seq}.binpb.zst")
            yield pd.DataFrame({"n": [len(b)]})

    frames.select("seq", "content").mapInPandas(write, "n bigint").write.format("noop").mode("overwrite").save()


def local_path(path: str) -> str:
    """The path on a mounted file system; other stores are an error."""
    if "://" in path and not path.startswith("file://"):
        raise ValueError(f"{path} is on no mounted file system")
    return path.removeprefix("file://") if path.startswith("file://") else path.removeprefix("file:")


def _little(binary: Column, at: Column, n: int) -> Column:
    """Unsigned little-endian integer of n bytes at a place counted from 0."""
    digits = F.concat(*(F.hex(F.substring(binary, at + (k + 1), F.lit(1))) for k in reversed(range(n))))
    return F.conv(digits, 16, 10).cast("decimal(20,0)")


def parse_index(files: DataFrame, epoch: Column) -> DataFrame:
    """(epoch, seq, offset, length) of index files' `content`; a size that is no multiple of 20 raises."""
    n = F.octet_length("content")
    checked = F.when(n % ENTRY != 0, F.raise_error(F.concat(F.lit("index size is no multiple of 20: "), n.cast("string"))).cast("int")).otherwise((n / ENTRY).cast("int"))
    rows = files.select(epoch.cast("bigint").alias("epoch"), "content", checked.alias("n")).where("n > 0")
    rows = rows.select("epoch", "content", F.explode(F.sequence(F.lit(0), (F.col("n") - 1) * ENTRY, F.lit(ENTRY))).alias("at"))
    return rows.select("epoch", _little(F.col("content"), F.col("at"), 8).alias("seq"), _little(F.col("content"), F.col("at") + 8, 8).alias("offset"), _little(F.col("content"), F.col("at") + 16, 4).cast("bigint").alias("length"))


def epoch_index(spark: SparkSession, path: str) -> DataFrame:
    """Entries of all index files below a path; the epoch is in the folder's name."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.idx").option("recursiveFileLookup", "true").load(path)
    return parse_index(files, F.regexp_extract("path", r"epoch=(\d+)", 1))


def pack_index(entries: list[tuple[int, int, int]]) -> bytes:
    return b"".join(struct.pack("<QQI", *e) for e in entries)


def compressed(frames: DataFrame) -> DataFrame:
    """frames (epoch, seq, body) with `content`, the zstd frame of the body, and its length."""

    @F.pandas_udf("binary")
    def squeeze(body: pd.Series) -> pd.Series:
        import zstandard

        z = zstandard.ZstdCompressor()
        return body.map(lambda b: z.compress(bytes(b)))

    return frames.withColumn("content", squeeze("body")).withColumn("length", F.octet_length("content").cast("bigint")).drop("body")


def frame_checksums(frames: DataFrame) -> DataFrame:
    return frames.select("seq", F.sha2("content", 256).alias("sha256"))


def epoch_manifest(frames: DataFrame, part_bytes: int = 32 << 20) -> DataFrame:
    """Per epoch the first and last seq, counts, bytes, parts, and a checksum over the frames' checksums in order."""
    n, size = F.count("*"), F.sum("length")
    ordered = F.array_sort(F.collect_list(F.struct("seq", "sha256")))
    return frames.groupBy("epoch").agg(
        F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), n.alias("count"), size.cast("bigint").alias("zst_bytes"), (n * ENTRY).alias("idx_bytes"),
        F.greatest(F.lit(1), F.ceil(size / F.lit(part_bytes))).cast("bigint").alias("zst_parts"), F.sha2(F.array_join(F.transform(ordered, lambda x: x["sha256"]), "").cast("binary"), 256).alias("zst_sha256"),
    )


_MANIFEST = ("epoch", "first_seq", "last_seq", "count", "zst_bytes", "zst_sha256")


def upsert_manifest(existing: DataFrame, new: DataFrame, order: Column | None = None) -> DataFrame:
    """existing with the rows of new put in or in place by epoch, the six stored columns; one row an epoch.

    Of several new rows of an epoch the last by `order` (a column of new) counts, else the one whose range
    reaches furthest, then the largest of the rest: any order gives the same row.
    """
    whole = F.struct(*_MANIFEST)
    last = F.struct(*([order.alias("_order")] if order is not None else []), "last_seq", "count", "zst_bytes", "zst_sha256", "first_seq")
    latest = new.groupBy("epoch").agg(F.max_by(whole, last).alias("s")).select("s.*")
    return existing.select(*_MANIFEST).join(latest.select("epoch"), "epoch", "left_anti").select(*_MANIFEST).unionByName(latest)


class ManifestConflict(RuntimeError):
    """Another writer published the version that this one was about to."""


class ManifestStore:
    """A manifest as numbered snapshots below a path: a table for each version, and a mark that makes it count.

    A version counts once its mark `_versions/<n>`, which names the snapshot, exists. The mark is written
    aside and renamed without overwriting, so it is whole or absent, and of two writers that start from
    the same version one wins and the other raises ManifestConflict. A writer that dies before leaves a
    snapshot that nobody reads, in a folder of its own. Needs a store with such a rename, as HDFS has it.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._fs_path = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._fs_path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The newest version; 0 before the first."""
        marks = self._fs_path(f"{self.path}/_versions")
        if not self._fs.exists(marks):
            return 0
        return max((int(f.getPath().getName()) for f in self._fs.listStatus(marks) if f.getPath().getName().isdigit()), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, else of the newest."""
        n = self.version() if version is None else version
        if n == 0:
            return self.spark.createDataFrame([], MANIFEST)
        stream = self._fs.open(self._fs_path(f"{self.path}/_versions/{n}"))
        try:
            name = stream.readUTF()
        finally:
            stream.close()
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/{name}")

    def upsert(self, new: DataFrame, order: Column | None = None, base: int | None = None) -> int:
        """Publish the next version: `base`, else the newest one, with new put in by epoch. Returns its number."""
        n = self.version() if base is None else base
        name = self._stage(upsert_manifest(self.read(n), new, order))
        self._publish(n + 1, name)
        return n + 1

    def _stage(self, rows: DataFrame) -> str:
        name = f"snapshot-{uuid.uuid4().hex}"
        rows.coalesce(1).write.parquet(f"{self.path}/{name}")  # a row an epoch
        return name

    def _publish(self, version: int, name: str) -> None:
        jvm, mark = self.spark._jvm, self._fs_path(f"{self.path}/_versions/{version}")
        aside = self._fs_path(f"{self.path}/_versions/_{uuid.uuid4().hex}")
        out = self._fs.create(aside)
        out.writeUTF(name)
        out.close()
        plain = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)  # no overwriting
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(mark.toUri(), self.spark._jsc.hadoopConfiguration()).rename(aside, mark, plain)
        except Exception as e:
            self._fs.delete(aside, False)
            if self._fs.exists(mark):
                raise ManifestConflict(f"version {version} is taken") from e
            raise


def archive_parts(frames: DataFrame, per_part: int = 32 << 20) -> DataFrame:
    """(epoch, begin, rank, first_seq, last_seq, bytes, entries, data) of frames (epoch, seq, content, length).

    A block's frames are cut into parts of some per_part bytes; contents are shuffled once, by block.
    """
    placed = frame_places(frames.select("epoch", "seq", "length", "content")).withColumn("part", F.floor((F.col("offset") - F.col("block_offset")) / F.lit(per_part)))
    entry = F.struct("seq", "offset", "length", F.sha2("content", 256).alias("sha256"))
    parts = placed.groupBy("epoch", "block", "part").agg(
        F.min("offset").alias("begin"), F.min("rank").alias("rank"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.array_sort(F.collect_list(entry)).alias("entries"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", F.col("content").cast("string").alias("c")))), lambda x: x["c"]), "").cast("binary").alias("data"),
    )
    return parts.select("epoch", "begin", "rank", "first_seq", "last_seq", F.octet_length("data").cast("bigint").alias("bytes"), "entries", "data")


def sink_epoch_archive(frames: DataFrame, path: str, per_part: int = 32 << 20) -> DataFrame:
    """Write frames (epoch, seq, content, length) as an archive table; returns its manifest after a check of the sizes."""
    spark = frames.sparkSession
    archive_parts(frames, per_part).write.partitionBy("epoch").parquet(path)
    parts = _parts(spark, path)
    manifest = epoch_manifest(parts.select("epoch", F.explode("entries").alias("e")).select("epoch", "e.*"), per_part)
    wrote = parts.groupBy(F.col("epoch").alias("_epoch")).agg(F.sum("bytes").alias("_bytes"))
    short = manifest.join(wrote, F.col("epoch") == F.col("_epoch"), "left").where(~F.col("_bytes").eqNullSafe(F.col("zst_bytes")))
    if not short.isEmpty():
        raise RuntimeError("an archive holds other sizes than its manifest")
    return manifest


def _parts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("epoch", F.col("epoch").cast("bigint"))


def archive_index(spark: SparkSession, path: str) -> DataFrame:
    """(epoch, seq, offset, length) of an archive table; no contents are read."""
    return _parts(spark, path).select("epoch", F.explode("entries").alias("e")).select("epoch", "e.seq", "e.offset", "e.length")


def inflated(parts: DataFrame) -> DataFrame:
    """(epoch, seq, body) of the entries `wanted` of parts (epoch, begin, data, wanted)."""

    def inflate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        z = zstandard.ZstdDecompressor()
        for b in batches:
            for epoch, begin, data, wanted in zip(b["epoch"], b["begin"], b["data"], b["wanted"]):
                d = memoryview(bytes(data))
                for k in range(0, len(wanted), 256):
                    yield pd.DataFrame([(epoch, x["seq"], z.decompress(d[x["offset"] - begin : x["offset"] - begin + x["length"]], max_output_size=1 << 30)) for x in wanted[k : k + 256]], columns=["epoch", "seq", "body"])

    return parts.select("epoch", "begin", "data", "wanted").mapInPandas(inflate, "epoch bigint, seq bigint, body binary")


def epoch_frames(spark: SparkSession, path: str, from_: int, to: int) -> DataFrame:
    """(epoch, seq, body) of the frames in [from_, to]; a part's first and last seq are pushed down, and nothing is shuffled."""
    hit = _parts(spark, path).where((F.col("last_seq") >= from_) & (F.col("first_seq") <= to))
    wanted = F.filter("entries", lambda e: e["seq"].between(from_, to))
    return inflated(hit.withColumn("wanted", F.transform(wanted, lambda e: F.struct(e["seq"].alias("seq"), e["offset"].alias("offset"), e["length"].alias("length")))))


def frames_of(spark: SparkSession, path: str, seqs: DataFrame) -> DataFrame:
    """(epoch, seq, body) of the frames whose seq is in seqs. Entries are looked up first; contents are read of their epochs alone."""
    ends = seqs.agg(F.min("seq").alias("a"), F.max("seq").alias("b")).first()
    parts = _parts(spark, path)
    span = parts.where((F.col("last_seq") >= F.lit(ends["a"])) & (F.col("first_seq") <= F.lit(ends["b"])))
    entries = span.select("epoch", "begin", F.explode("entries").alias("e")).select("epoch", "begin", "e.seq", "e.offset", "e.length")
    wanted = entries.join(seqs.select("seq").distinct(), "seq", "left_semi").groupBy("epoch", "begin").agg(F.collect_list(F.struct("seq", "offset", "length")).alias("wanted"))
    epochs = [r["epoch"] for r in wanted.select("epoch").distinct().limit(EPOCHS + 1).collect()]
    if len(epochs) <= EPOCHS:
        span = span.where(F.col("epoch").isin(epochs))
    return inflated(span.select("epoch", "begin", "data").join(wanted, ["epoch", "begin"]))


class _Run(InputPartition):
    """Entries a to b of an epoch's index."""

    def __init__(self, epoch: int, a: int, b: int):
        self.epoch, self.a, self.b = epoch, a, b


class _RunReader(DataSourceReader):
    """Index files are searched by halving, so the driver holds no entries, only where runs begin."""

    def __init__(self, options: dict):
        self.path, self.first, self.last = local_path(options["path"]), int(options.get("from", 0)), int(options.get("to", (1 << 64) - 1))
        self.run = int(options.get("runBytes", RUN))
        self.epochs: tuple[int, int, frozenset[int] | None] = (0, (1 << 63) - 1, None)

    def partitions(self) -> list[InputPartition]:
        out = []
        for name in sorted(os.listdir(self.path)):
            if not name.endswith(".idx"):
                continue
            low, high, among = self.epochs
            epoch = int(name[:-4])
            if not low <= epoch <= high or (among is not None and epoch not in among) or self.first > self.last:
                continue
            size = os.path.getsize(f"{self.path}/{name}")
            if size % ENTRY:
                raise ValueError(f"{name}: size is no multiple of {ENTRY}")
            n = size // ENTRY
            with open(f"{self.path}/{name}", "rb") as f:
                a, b = self._before(f, n, self.first), self._before(f, n, self.last + 1)
            step = max(1, n * self.run // max(1, os.path.getsize(f"{self.path}/{epoch}.zst")))
            out += [_Run(epoch, k, min(k + step, b)) for k in range(a, b, step)]
        return out

    @staticmethod
    def _before(f, n: int, seq: int) -> int:
        """How many of the n entries have a smaller seq."""
        low, high = 0, n
        while low < high:
            mid = (low + high) // 2
            f.seek(mid * ENTRY)
            if struct.unpack("<Q", f.read(8))[0] < seq:
                low = mid + 1
            else:
                high = mid
        return low

    def read(self, partition: _Run | None) -> Iterator[tuple]:
        import zstandard

        if partition is None:  # what Spark makes of no partitions
            return
        z, p = zstandard.ZstdDecompressor(), partition
        with open(f"{self.path}/{p.epoch}.idx", "rb") as index, open(f"{self.path}/{p.epoch}.zst", "rb") as f:
            index.seek(p.a * ENTRY)
            for seq, offset, length in struct.iter_unpack("<QQI", index.read((p.b - p.a) * ENTRY)):
                f.seek(offset)
                yield p.epoch, seq, z.decompress(f.read(length), max_output_size=1 << 30)


class _ArchiveReader(_RunReader):
    """With filters pushed down, which Spark allows only where its setting is on."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons of seq and epoch become ranges, which index files are searched for; an epoch out of range is not opened. Spark keeps the rest."""
        for f in filters:
            name, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if name not in (("seq",), ("epoch",)) or isinstance(f, Not) or not (isinstance(f, In) or isinstance(value, int)):
                yield f
                continue
            if isinstance(f, In):
                known = [v for v in value if isinstance(v, int)]
                low, high, some = min(known, default=0), max(known, default=-1), frozenset(known)
                if name == ("seq",):
                    yield f  # numbers between those of the list are read, so Spark looks again
            else:
                some = None
                low = value + 1 if isinstance(f, GreaterThan) else value if isinstance(f, (GreaterThanOrEqual, EqualTo, EqualNullSafe)) else 0
                high = value - 1 if isinstance(f, LessThan) else value if isinstance(f, (LessThanOrEqual, EqualTo, EqualNullSafe)) else (1 << 64) - 1
                if not isinstance(f, (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, EqualTo, EqualNullSafe)):
                    yield f
                    continue
            if name == ("seq",):
                self.first, self.last = max(self.first, low), min(self.last, high)
            else:
                a, b, among = self.epochs
                self.epochs = (max(a, low), min(b, high), some if among is None else among if some is None else among & some)


class _Wrote(WriterCommitMessage):
    def __init__(self, sizes: dict[int, tuple[int, int]]):
        self.sizes = sizes


def _put(path: str, data: bytes, at: int) -> None:
    fd = os.open(path, os.O_CREAT | os.O_WRONLY, 0o644)
    try:
        view = memoryview(data)
        while len(view):
            n = os.pwrite(fd, view, at)
            view, at = view[n:], at + n
    finally:
        os.close(fd)


class _ArchiveWriter(DataSourceWriter):
    """Each part goes to its own place in its epoch's files, so tasks run again write the same bytes there.

    The files get their names once all parts are there and their sizes are right, the index last.
    """

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite, self.mark = local_path(options["path"]), overwrite, f".{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> _Wrote:
        os.makedirs(self.path, exist_ok=True)
        sizes: dict[int, tuple[int, int]] = {}
        for row in iterator:
            epoch = row["epoch"]
            _put(f"{self.path}/{epoch}.zst{self.mark}", bytes(row["data"]), row["begin"])
            _put(f"{self.path}/{epoch}.idx{self.mark}", pack_index([(e["seq"], e["offset"], e["length"]) for e in row["entries"]]), row["rank"] * ENTRY)
            n, data = sizes.get(epoch, (0, 0))
            sizes[epoch] = (n + len(row["entries"]) * ENTRY, data + len(row["data"]))
        return _Wrote(sizes)

    def commit(self, messages: list) -> None:
        total: dict[int, tuple[int, int]] = {}
        for m in messages:
            for epoch, (n, data) in (m.sizes if m else {}).items():
                a, b = total.get(epoch, (0, 0))
                total[epoch] = (a + n, b + data)
        for epoch, sizes in total.items():
            for kind, size in zip(("idx", "zst"), sizes):
                if os.path.getsize(f"{self.path}/{epoch}.{kind}{self.mark}") != size:
                    raise RuntimeError(f"{epoch}.{kind} has another size than its parts")
                if not self.overwrite and os.path.exists(f"{self.path}/{epoch}.{kind}"):
                    raise FileExistsError(f"{self.path}/{epoch}.{kind}")
        for epoch in total:
            for kind in ("zst", "idx"):
                os.replace(f"{self.path}/{epoch}.{kind}{self.mark}", f"{self.path}/{epoch}.{kind}")

    def abort(self, messages: list) -> None:
        if os.path.isdir(self.path):
            for name in os.listdir(self.path):
                if name.endswith(self.mark):
                    os.remove(f"{self.path}/{name}")


class EpochArchive(DataSource):
    """spark.read.format("epoch_archive"): {epoch}.zst with {epoch}.idx on a mounted file system, by byte ranges.

    Options of a read: path, from, to, runBytes (bytes of a task, about); index entries ascend by seq.
    register_archive makes it known with filters on seq and epoch pushed down.
    A write takes the rows of archive_parts; an epoch that is there is an error, or is replaced in mode
    overwrite. For other stores use the table form.
    """

    @classmethod
    def name(cls) -> str:
        return "epoch_archive"

    def schema(self) -> str:
        return "epoch bigint, seq bigint, body binary"

    def reader(self, schema) -> DataSourceReader:
        return _RunReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _ArchiveWriter(self.options, overwrite)


class PushedArchive(EpochArchive):
    """The same under the same name, with filters pushed down."""

    def reader(self, schema) -> DataSourceReader:
        return _ArchiveReader(self.options)


def register_archive(spark: SparkSession) -> None:
    """Make the format epoch_archive known, with filters pushed down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PushedArchive)


def sink_epoch_files(frames: DataFrame, path: str, per_part: int = 32 << 20, mode: str = "append") -> None:
    """Write frames (epoch, seq, content, length) as {epoch}.zst and {epoch}.idx."""
    register_archive(frames.sparkSession)
    archive_parts(frames, per_part).select("epoch", "begin", "rank", "entries", "data").write.format("epoch_archive").mode(mode).save(path)


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at += 1
        if byte < 0x80:
            return value, at
        if (shift := shift + 7) > 63:
            raise ValueError("a number is too long")


def fields_of(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a message; fixed-width ones come as bytes."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            n, at = _varint(data, at) if kind == 2 else ({1: 8, 5: 4}[kind], at) if kind in (1, 5) else (-1, at)
            if n < 0 or at + n > len(data):
                raise ValueError("a field is cut off or of an unknown kind")
            value, at = data[at : at + n], at + n
        yield tag >> 3, value


def envelope(content: bytes) -> dict:
    """Fields used downstream: sequence number, summary bytes, and the signature's epoch, bytes and bitmap."""
    import zstandard

    out: dict = {"seq": None, "summary": None, "sig_epoch": 0, "sig": None, "bitmap": None}
    for number, value in fields_of(zstandard.ZstdDecompressor().decompress(content, max_output_size=1 << 30)):
        if number == 1 and isinstance(value, int):
            out["seq"] = value
        elif number == 3 and isinstance(value, bytes):  # summary: field 1 holds a value whose field 2 are its bytes
            for n, v in fields_of(value):
                if n == 1 and isinstance(v, bytes):
                    out["summary"] = next((x for k, x in fields_of(v) if k == 2), None)
        elif number == 4 and isinstance(value, bytes):
            for n, v in fields_of(value):
                if n in (1, 2, 3):
                    out[("sig_epoch", "sig", "bitmap")[n - 1]] = v
    if lost := [k for k in ("summary", "sig", "bitmap") if out[k] is None]:
        raise ValueError(f"no {lost[0]}")
    if len(out["sig"]) != 48:
        raise ValueError(f"the signature has {len(out['sig'])} bytes")
    return out


def custom_decoder(frames: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """A user's function turns frames into rows of a declared schema."""
    return frames.mapInPandas(fn, schema)


def decode_frames(frames: DataFrame, decode: Callable[[bytes], dict] = envelope, fail_fast: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good, dead_letter) of frames (seq, content); dead letters have the reason in `error`."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for seq, content in zip(b["seq"], b["content"]):
                row = {"frame_seq": seq, "seq": None, "summary": None, "sig_epoch": None, "sig": None, "bitmap": None, "error": None}
                try:
                    row |= decode(bytes(content))
                except Exception as e:
                    if fail_fast:
                        raise
                    row["error"] = f"{type(e).__name__}: {e}"
                rows.append(row)
            yield pd.DataFrame(rows, columns=["frame_seq", "seq", "summary", "sig_epoch", "sig", "bitmap", "error"]).astype({"seq": "Int64", "sig_epoch": "Int64"})

    rows = frames.select("seq", "content").mapInPandas(run, "frame_seq bigint, seq bigint, summary binary, sig_epoch bigint, sig binary, bitmap binary, error string")
    return rows.where("error IS NULL").drop("error"), rows.where("error IS NOT NULL").select("frame_seq", "error")
