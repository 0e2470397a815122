"""Tagged records: many tables as one JSON Lines stream or one message table, and back."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import rules
from ..schemas import LAYOUT, NUMBERS, TABLE_BITS, TABLES

#: Null fields stay visible in the records.
JSON = {"ignoreNullFields": "false"}


def tables_of(chosen: int | Iterable[str] | None) -> frozenset[str]:
    """Table names from names or from a bit mask; nothing chosen means all. Unknown names raise."""
    if chosen is None:
        return frozenset(TABLES)
    if isinstance(chosen, int):
        return frozenset(n for n, b in TABLE_BITS.items() if chosen >> b & 1) | {"checkpoints"}
    names = frozenset(chosen)
    if unknown := names - set(TABLES):
        raise ValueError(f"unknown tables: {', '.join(sorted(unknown))}")
    return names or frozenset(TABLES)


def table_filter(tables: Mapping[str, DataFrame], names: Iterable[str]) -> dict[str, DataFrame]:
    """The tables that are named; no names mean all, an unknown one raises."""
    names = list(names)
    if unknown := set(names) - set(tables):
        raise ValueError(f"unknown tables: {', '.join(sorted(unknown))}")
    return {k: v for k, v in tables.items() if not names or k in names}


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def laid_out(name: str, df: DataFrame) -> DataFrame:
    """A table in the layout of its record: its columns in order, 64-bit quantities as decimal strings. Other tables stay as they are."""
    if name not in LAYOUT:
        return df
    quantity = lambda c: c not in NUMBERS and df.schema[c].dataType.typeName() in ("long", "decimal", "integer")
    return df.select(*(F.col(c).cast("string").alias(c) if quantity(c) else F.col(c) for c in LAYOUT[name].split()))


def union_records(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, row_json) of all tables, in the tables' order."""
    return _union([laid_out(n, df).select(F.lit(n).alias("table"), F.to_json(F.struct("*"), JSON).alias("row_json")) for n, df in tables.items()])


def tagged(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Flat rows with a leading _table field, as JSON in `value`."""
    return _union([laid_out(n, df).select(F.to_json(F.struct(F.lit(n).alias("_table"), "*"), JSON).alias("value")) for n, df in tables.items()])


def wrapped(tables: Mapping[str, DataFrame]) -> DataFrame:
    """{"table": ..., "row": {...}} as JSON in `value`."""
    return _union([laid_out(n, df).select(F.to_json(F.struct(F.lit(n).alias("table"), F.struct("*").alias("row")), JSON).alias("value")) for n, df in tables.items()])


def _write_lines(lines: DataFrame, path: str, mode: str, compression: str | None) -> None:
    """compression names a codec of Spark's text files; readers tell it from the files' names."""
    w = lines.write.mode(mode)
    (w.option("compression", compression) if compression else w).text(path)


def sink_jsonl_tagged(tables: Mapping[str, DataFrame], path: str, mode: str = "errorifexists", compression: str | None = None) -> None:
    """One table alone is written without the tag, as sink_jsonl_single does."""
    if len(tables) == 1:
        return sink_jsonl_single(tables, next(iter(tables)), path, mode, compression)
    _write_lines(tagged(tables), path, mode, compression)


def sink_jsonl_single(tables: Mapping[str, DataFrame], table: str, path: str, mode: str = "errorifexists", compression: str | None = None) -> None:
    _write_lines(laid_out(table, tables[table]).select(F.to_json(F.struct("*"), JSON).alias("value")), path, mode, compression)


def sink_jsonl_wrapped(tables: Mapping[str, DataFrame], path: str, mode: str = "errorifexists", compression: str | None = None) -> None:
    _write_lines(wrapped(tables), path, mode, compression)


def sink_append_file(tables: Mapping[str, DataFrame], path: str, compression: str | None = None) -> None:
    sink_jsonl_wrapped(tables, path, "append", compression)


def sink_noop(tables: Mapping[str, DataFrame], mode: str = "no_write") -> DataFrame | None:
    """Run everything and keep nothing; fetch_only returns counts and bytes of the one table given."""
    if mode == "fetch_only":
        (frames,) = tables.values()
        return frames.agg(F.count("*").alias("frames"), F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("bytes"))
    for df in tables.values():
        df.write.format("noop").mode("overwrite").save()
    return None


def messages(tables: Mapping[str, DataFrame], prefix: str) -> DataFrame:
    """(topic, key, value): one message for each row on subject prefix.table, shaped as a Kafka writer wants it."""
    named = {n: laid_out(n, df) for n, df in tables.items()}
    parts = [df.select(rules.subject(prefix, F.lit(n)).alias("topic"), (F.col("checkpoint_seq") if "checkpoint_seq" in df.columns else F.col(df.columns[0])).cast("string").alias("key"), F.to_json(F.struct("*"), JSON).alias("value")) for n, df in named.items()]
    return _union(parts)


def sink_subject_messages(tables: Mapping[str, DataFrame], prefix: str, path: str, mode: str = "errorifexists") -> None:
    messages(tables, prefix).write.mode(mode).partitionBy("topic").parquet(path)


def read_tagged_jsonl(spark: SparkSession, path: str, schemas: Mapping[str, StructType]) -> dict[str, DataFrame]:
    """Tables by the tag of their lines, of either style; lines of other tables are left out."""
    lines = spark.read.text(path)
    name = F.coalesce(F.get_json_object("value", "$._table"), F.get_json_object("value", "$.table"))
    row = F.when(F.get_json_object("value", "$._table").isNotNull(), F.col("value")).otherwise(F.get_json_object("value", "$.row"))
    split = lines.select(name.alias("t"), row.alias("r"))
    return {n: split.where(F.col("t") == n).select(F.from_json("r", s).alias("x")).select("x.*") for n, s in schemas.items()}
