"""The chosen flat tables from one nested input: lazily one by one, or all in one pass."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.records import tables_of
from . import flatten, state
from .flatten import here

BUILDERS = {
    "checkpoints": flatten.checkpoints, "transactions": flatten.transactions, "move_calls": flatten.move_calls, "commands": flatten.commands, "events": flatten.events, "dependencies": flatten.dependencies,
    "transaction_signatures": flatten.transaction_signatures, "packages": flatten.packages, "package_modules": flatten.package_modules, "epoch_committees": flatten.epoch_committees,
    "object_changes": state.object_changes, "balance_changes": state.balance_changes, "coin_balances": state.coin_balances,
}
#: Tables whose rows come from the states of changed objects, and those that come from packages.
_STATED, _PACKAGED = {"object_changes", "balance_changes", "coin_balances"}, {"packages", "package_modules"}

#: Rows of a committee come again in every epoch: pages and dictionaries that hold more than a committee make them small.
_PAGES = {"parquet.page.row.count.limit": str(1 << 20), "parquet.page.size": str(8 << 20), "parquet.dictionary.page.size": str(8 << 20)}


def extract_tables(cp: DataFrame, tables: int | Iterable[str] | None = None) -> dict[str, DataFrame]:
    """Lazy DataFrames by table name, chosen by names or by a mask; others cost nothing.

    The checkpoint table is always among them when a mask chooses, since rows denormalise from it.
    Catalyst prunes the input for each table apart, so each table scans it: fan_out makes many in one pass.
    """
    chosen = tables_of(tables)
    return {name: build(cp) for name, build in BUILDERS.items() if name in chosen}


def _rows(name: str, wrap: Callable[[Column], Column] = lambda row: row) -> Column:
    """The rows of a table in a checkpoint's row, as an array of structs; null or empty without any. Needs what _prepared adds.

    wrap is applied where a row is made: an array that is transformed again is copied again.
    """
    at, tx = here(), F.col("transactions")
    some = lambda a: F.filter(a, lambda x: x.isNotNull())
    whole = lambda *fields: wrap(F.struct(*fields))
    if name == "checkpoints":
        return F.array(whole(*flatten.checkpoint_row()))
    if name == "transactions":
        return F.transform(F.filter(tx, lambda t: t["effects"].isNotNull()), lambda t: whole(*flatten.transaction_row(t, at)))
    if name in flatten.ITEMS:
        array, row = flatten.ITEMS[name]
        return F.flatten(some(F.transform(tx, lambda t: F.transform(array(t), lambda x, i: whole(*row(flatten.digest_of(t), i, x, at))))))
    if name == "packages":
        return F.transform("_packages", lambda o: whole(*flatten.package_row(o, at)))
    if name == "package_modules":
        return F.flatten(some(F.transform("_packages", lambda o: F.transform(F.map_entries(o["package"]["modules"]), lambda m: whole(*flatten.module_row(o, m["key"], m["value"], at))))))
    if name == "epoch_committees":
        return F.transform("summary.next_epoch_committee", lambda v, i: whole(*flatten.committee_row(i, v, F.col("summary.epoch"), at)))
    if name == "object_changes":
        return F.transform(F.flatten("_stated"), lambda x: whole(*state.change_row(x, at)))
    if name == "coin_balances":
        return F.flatten(F.transform(state.coins(F.flatten("_stated")), lambda c: F.transform(state.log_rows(c, at), wrap)))
    return F.transform(state.balance_lists(F.col("_stated"), at), wrap)


def _prepared(cp: DataFrame, chosen: set[str]) -> DataFrame:
    """cp with what several tables need, made once for each row: digests, package lists, states looked up."""
    if "checkpoints" in chosen:
        cp = flatten.with_digest(cp)
    if chosen & _PACKAGED:
        cp = cp.withColumn("_packages", flatten.package_list())
    if chosen & _STATED:
        cp = state.with_states(cp).withColumn("_stated", state.stated_lists()).drop("_states", "_marks")
    return cp


def tagged_rows(cp: DataFrame, tables: int | Iterable[str] | None = None) -> DataFrame:
    """(table, a struct column for each chosen table): the rows of all of them from one scan, each filling its own column."""
    chosen = [n for n in BUILDERS if n in tables_of(tables)]
    ready = _prepared(cp, set(chosen))
    kinds = ready.select(*(_rows(n).alias(n) for n in chosen)).schema
    types = {n: kinds[n].dataType.elementType for n in chosen}

    def widened(name: str) -> Column:
        return _rows(name, lambda r: F.struct(F.lit(name).alias("table"), *((r if n == name else F.lit(None)).cast(types[n]).alias(n) for n in chosen)))

    rows = F.flatten(F.filter(F.array(*(widened(n) for n in chosen)), lambda a: a.isNotNull()))
    return ready.select(F.explode(rows).alias("x")).select("x.*")


def fan_out(cp: DataFrame, path: str, tables: int | Iterable[str] | None = None, mode: str = "errorifexists", counts: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """Write the chosen tables below path, a folder table=<name> each, in one pass over cp; returns them as read back.

    Each task keeps a file open for each table, so nothing is sorted for the sake of the folders. counts, if
    given, gets the rows of each table, observed in the same job.
    """
    spark, setting = cp.sparkSession, "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting, "0")
    spark.conf.set(setting, str(max(int(before), len(BUILDERS) + 1)))
    try:
        rows = tagged_rows(cp, tables)
        names = [c for c in rows.columns if c != "table"]
        seen = Observation()
        rows = rows.observe(seen, *(F.count_if(F.col("table") == n).alias(n) for n in names)) if counts is not None else rows
        rows.write.mode(mode).options(compression="zstd", **_PAGES).partitionBy("table").parquet(path)
        if counts is not None:
            counts.update({n: seen.get[n] for n in names})
    finally:
        spark.conf.set(setting, before)
    return read_fan_out(cp, path, tables)


def read_fan_out(cp: DataFrame, path: str, tables: int | Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The tables that fan_out wrote from checkpoints of cp's schema; one without rows is empty."""
    spark: SparkSession = cp.sparkSession
    shape = tagged_rows(cp.limit(0), tables).schema
    whole = spark.read.schema(shape).parquet(path)
    return {n: whole.where(F.col("table") == n).select(f"{n}.*") for n in shape.names if n != "table"}
