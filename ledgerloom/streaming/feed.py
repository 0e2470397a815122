"""An ordered feed: parquet files with a `seq`, read as a stream whose offset is the next sequence number.

Batches hold a bounded range of numbers, in order; a restart goes on behind the last one. Files may come
in any order: while `dense` holds, the feed waits at a number that no file has yet, so a file that comes
late is not passed over. Each number is given once, from the first file by name that has it; what comes
for a number that is behind the cursor is dropped. Files are read by tasks; the driver reads their
footers, once each. The store is any that Arrow can open by its address.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType


class _Range(InputPartition):
    def __init__(self, files: list[str], first: int, last: int) -> None:
        self.files, self.first, self.last = files, first, last


class _Reader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.names = schema.fieldNames()
        self.path, self.start = options["path"], int(options.get("start", 0))
        self.rows, self.per_task = int(options.get("rows", 100_000)), int(options.get("pertask", 25_000))
        self.dense = str(options.get("dense", "true")).lower() == "true"
        self.known: dict[str, tuple[int, int, int]] = {}  # first and last number and rows of a file
        self.at: int | None = None

    def _store(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)

    def _look(self) -> None:
        """Read the footers of files that are new."""
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, base = self._store()
        for f in store.get_file_info(fs.FileSelector(base, allow_not_found=True)):
            if f.base_name.endswith(".parquet") and f.base_name[0] not in "._" and f.path not in self.known:
                meta = pq.ParquetFile(f.path, filesystem=store).metadata
                place = next((k for k in range(meta.num_columns) if meta.schema.column(k).path == "seq"), None)
                stats = [meta.row_group(g).column(place).statistics for g in range(meta.num_row_groups)] if place is not None else []
                low, high = [s.min for s in stats if s and s.has_min_max], [s.max for s in stats if s and s.has_min_max]
                if low:
                    self.known[f.path] = (min(low), max(high), meta.num_rows)

    def _numbers(self, f: str):
        """The numbers of a file, in order."""
        import pyarrow.parquet as pq

        return sorted(set(pq.read_table(f, columns=["seq"], filesystem=self._store()[0])["seq"].drop_null().to_pylist()))

    def _frontier(self, at: int, most: int) -> int:
        """The first number from `at` on that no file has, `most` + 1 at most. Of files the numbers alone are read."""
        if not self.dense:
            return min(most + 1, max((v[1] + 1 for v in self.known.values()), default=at))
        for f, (low, high, n) in sorted(self.known.items(), key=lambda x: x[1]):
            if at > most or low > at:  # done, or nothing fills the number
                break
            if high >= at:
                if n < high - low + 1 or len(self._numbers(f)) < high - low + 1:
                    return self._walk(at, most)
                at = high + 1
        return min(at, most + 1)

    def _walk(self, at: int, most: int) -> int:
        """Step by step, where files have gaps that others fill."""
        held = set().union(*(self._numbers(f) for f, (low, high, _) in self.known.items() if high >= at and low <= most))
        while at <= most and at in held:
            at += 1
        return at

    def initialOffset(self) -> dict:
        return {"next": self.start}

    def latestOffset(self) -> dict:
        self.at = self.start if self.at is None else self.at
        self._look()
        self.at = max(self.at, self._frontier(self.at, self.at + self.rows - 1))
        return {"next": self.at}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        # after a restart Spark calls this with the last offset twice, before it asks for the latest one
        self.at = max(end["next"], self.at or self.start)
        if start["next"] >= end["next"]:
            return []
        self._look()
        ranges = [(a, min(a + self.per_task, end["next"]) - 1) for a in range(start["next"], end["next"], self.per_task)]
        return [_Range(sorted(f for f, (low, high, _) in self.known.items() if low <= b and high >= a), a, b) for a, b in ranges]

    def read(self, partition: InputPartition) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq

        store, seen, tables = self._store()[0], set(), []
        for f in partition.files:
            t = pq.read_table(f, columns=self.names, filters=[("seq", ">=", partition.first), ("seq", "<=", partition.last)], filesystem=store)
            new = []
            for k in t["seq"].to_pylist():
                new.append(k not in seen)
                seen.add(k)
            tables.append(t.filter(pa.array(new, pa.bool_())))
        if tables:
            yield from pa.concat_tables(tables).sort_by("seq").to_batches()


class SeqFeed(DataSource):
    """spark.readStream.format("seq_feed").schema(...).option("start", first).option("rows", most a batch).load(path)"""

    @classmethod
    def name(cls) -> str:
        return "seq_feed"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Reader(schema, dict(self.options))


def ordered_source(spark: SparkSession, path: str, schema: StructType | str, start_seq: int = 0, rows: int = 100_000, dense: bool = True) -> DataFrame:
    """An unbounded feed in the order of seq from start_seq on (inclusive), `rows` numbers a batch at most; the query's checkpoint is the cursor.

    Use a processing-time trigger: one that takes what is available now stops after one batch.
    """
    spark.dataSource.register(SeqFeed)
    return spark.readStream.format("seq_feed").schema(schema).option("start", start_seq).option("rows", rows).option("perTask", max(1, rows // 4)).option("dense", str(dense).lower()).load(path)
