"""Explodes: one flat table each from the nested checkpoint DataFrame `cp`.

Every row carries checkpoint_seq and timestamp_ms. All are narrow: no shuffle, and the nested columns
that a table does not need are pruned at the scan. What a row holds is said once, as Columns over a
transaction and an item of one of its arrays; the tables explode the arrays, and extract.tagged_rows
builds the rows of many tables inside the checkpoint's row.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules


class At(NamedTuple):
    """The checkpoint that a row belongs to."""

    seq: Column
    ts: Column

    def columns(self) -> list[Column]:
        return [self.seq.alias("checkpoint_seq"), self.ts.alias("timestamp_ms")]


def here() -> At:
    """The checkpoint of cp's own rows."""
    return At(F.col("sequence_number"), F.col("summary.timestamp_ms"))


def digest_of(t: Column) -> Column:
    return rules.first_text(t["effects"]["transaction_digest"], t["digest"])


def _transactions(cp: DataFrame) -> DataFrame:
    return cp.select(*here().columns(), F.explode("transactions").alias("t"))


def with_digest(cp: DataFrame) -> DataFrame:
    """cp with missing digests computed from the summary's bytes, and empty without those."""
    return rules.digest_fill(cp, "digest", "summary.raw").withColumn("digest", F.coalesce("digest", F.lit("")))


def checkpoint_row() -> list[Column]:
    s = F.col("summary")
    named = {"network_total_transactions": "total_network_transactions"} | {c: f"rolling_{c}" for c in ("computation_cost", "storage_cost", "storage_rebate", "non_refundable_storage_fee")}
    return [
        F.col("sequence_number"), s["epoch"].alias("epoch"), s["timestamp_ms"].alias("timestamp_ms"), F.col("digest"), s["previous_digest"].alias("previous_digest"),
        s["content_digest"].alias("content_digest"), *(s[c].alias(n) for c, n in named.items()),
    ]


def checkpoints(cp: DataFrame) -> DataFrame:
    """One row for each checkpoint; a missing digest is computed."""
    return with_digest(cp.select("sequence_number", "digest", "summary")).select(*checkpoint_row())


def transaction_row(t: Column, at: At) -> list[Column]:
    """A transaction with effects; the epoch is that of the effects."""
    e = t["effects"]
    failed = ~e["success"]
    aborted = failed & (rules.error_kind(e["error"]) == "MoveAbort")
    null = lambda name, kind="string": F.lit(None).cast(kind).alias(name)
    return [
        digest_of(t).alias("digest"), *at.columns(), e["executed_epoch"].alias("epoch"), t["position"].alias("position"), F.coalesce(t["sender"], F.lit("")).alias("sender"), F.coalesce(t["kind"], F.lit("")).alias("tx_kind"), e["success"].alias("success"),
        F.when(failed, rules.error_kind(e["error"])).alias("error_kind"), null("error_description"), F.when(failed, e["error_command"]).alias("error_command_index"),
        F.when(aborted, e["abort_code"]).alias("error_abort_code"), F.when(aborted, e["abort_module"]).alias("error_module"), F.when(aborted, e["abort_function"]).alias("error_function"),
        null("error_arg_idx", "bigint"), null("error_type_arg_idx", "bigint"), null("error_sub_kind"), null("error_current_size", "bigint"), null("error_max_size", "bigint"), null("error_coin_type"), null("error_denied_address"), null("error_object_id"),
        F.coalesce(t["gas_owner"], t["sender"], F.lit("")).alias("gas_owner"), F.coalesce(t["gas_price"], F.lit(0)).alias("gas_price"), F.coalesce(t["gas_budget"], F.lit(0)).alias("gas_budget"),
        *(e[c].alias(c) for c in ("computation_cost", "storage_cost", "storage_rebate", "non_refundable_storage_fee")), F.nullif(e["gas_object_id"], F.lit(rules.NO_OBJECT)).alias("gas_object_id"),
        e["events_digest"].alias("events_digest"), e["lamport_version"].alias("lamport_version"), F.size(F.coalesce(e["dependencies"], F.array())).alias("dependency_count"), F.size(F.coalesce(_calls(t), F.array())).alias("move_call_count"),
        F.lit("NONE").alias("expiration_kind"), null("expiration_epoch", "bigint"), null("expiration_min_epoch", "bigint"), null("expiration_max_epoch", "bigint"), null("expiration_min_ts_seconds", "bigint"), null("expiration_max_ts_seconds", "bigint"), null("expiration_chain"), null("expiration_nonce", "bigint"),
    ]


def transactions(cp: DataFrame) -> DataFrame:
    """One row for each transaction with effects."""
    return _transactions(cp).where("t.effects IS NOT NULL").select(*transaction_row(F.col("t"), At(F.col("checkpoint_seq"), F.col("timestamp_ms"))))


def _commands(t: Column) -> Column:
    """The commands of a kind that carries them; else null."""
    return F.when(rules.has_commands(t["kind"]), t["commands"])


def _calls(t: Column) -> Column:
    return F.filter(_commands(t), lambda c: c["kind"] == "MoveCall")


def _call_row(digest: Column, i: Column, c: Column, at: At) -> list[Column]:
    return [digest.alias("tx_digest"), i.alias("call_index"), *(c[x].alias(x) for x in ("package", "module", "function")), *at.columns()]


def _command_row(digest: Column, i: Column, c: Column, at: At) -> list[Column]:
    call = c["kind"] == "MoveCall"
    return [
        digest.alias("tx_digest"), i.alias("command_index"), c["kind"].alias("kind"), F.when(call | (c["kind"] == "Upgrade"), c["package"]).alias("package"), *(F.when(call, c[x]).alias(x) for x in ("module", "function")),
        F.when(call | (c["kind"] == "MakeMoveVec"), rules.type_arguments(c["type_arguments"])).alias("type_arguments"), rules.command_args(c).alias("args"), *at.columns(),
    ]


def _dependency_row(digest: Column, i: Column, d: Column, at: At) -> list[Column]:
    return [digest.alias("tx_digest"), d.alias("depends_on_digest"), *at.columns()]


def _events(t: Column) -> Column:
    """The canonical list, else the decoded one, where missing texts are empty."""
    blank = lambda v: F.coalesce(v, F.lit(""))
    return F.coalesce(t["events"], F.transform(t["fallback_events"], lambda e: F.struct(blank(e["package_id"]).alias("package_id"), blank(e["module"]).alias("module"), blank(e["event_type"]).alias("event_type"), blank(e["sender"]).alias("sender"), e["contents"].alias("contents"))))


def _event_row(digest: Column, i: Column, e: Column, at: At) -> list[Column]:
    return [digest.alias("tx_digest"), i.alias("event_seq"), *(e[c].alias(c) for c in ("package_id", "module", "event_type", "sender")), F.coalesce(rules.hex_of(e["contents"]), F.lit("")).alias("contents_hex"), *at.columns()]


def _signatures(t: Column) -> Column:
    """The signed envelope's list if it has any, else the other one."""
    signed = F.transform(t["signatures"], lambda b: F.struct(rules.first_byte(b).alias("scheme"), b.alias("bytes")))
    other = F.transform(t["fallback_signatures"], lambda s: F.struct(rules.first_byte(s["bytes"], -1).alias("first"), s["scheme"].alias("said"), s["bytes"].alias("bytes")))
    other = F.transform(other, lambda s: F.struct(F.when(s["first"] >= 0, s["first"]).otherwise(F.coalesce(s["said"], F.lit(255))).alias("scheme"), s["bytes"].alias("bytes")))
    return F.when(F.size(t["signatures"]) > 0, signed).otherwise(other)


def _signature_row(digest: Column, i: Column, s: Column, at: At) -> list[Column]:
    return [digest.alias("tx_digest"), i.alias("index"), s["scheme"].alias("scheme"), F.coalesce(rules.hex_of(s["bytes"]), F.lit("")).alias("signature_hex"), *at.columns()]


#: Tables with a row for each item of an array of a transaction: the array, and the row of (digest, place, item, checkpoint).
ITEMS: dict[str, tuple[Callable[[Column], Column], Callable[[Column, Column, Column, At], list[Column]]]] = {
    "move_calls": (_calls, _call_row), "commands": (_commands, _command_row), "dependencies": (lambda t: t["effects"]["dependencies"], _dependency_row), "events": (_events, _event_row), "transaction_signatures": (_signatures, _signature_row),
}


def _items(cp: DataFrame, name: str) -> DataFrame:
    array, row = ITEMS[name]
    each = _transactions(cp).select("checkpoint_seq", "timestamp_ms", digest_of(F.col("t")).alias("tx_digest"), F.posexplode(array(F.col("t"))).alias("i", "x"))
    return each.select(*row(F.col("tx_digest"), F.col("i"), F.col("x"), At(F.col("checkpoint_seq"), F.col("timestamp_ms"))))


def move_calls(cp: DataFrame) -> DataFrame:
    """One row for each move call; call_index counts move calls only."""
    return _items(cp, "move_calls")


def commands(cp: DataFrame) -> DataFrame:
    """One row for each command of any kind, with a summary of its arguments."""
    return _items(cp, "commands")


def dependencies(cp: DataFrame) -> DataFrame:
    return _items(cp, "dependencies")


def events(cp: DataFrame) -> DataFrame:
    """One row for each event."""
    return _items(cp, "events")


def transaction_signatures(cp: DataFrame) -> DataFrame:
    """One row for each signature."""
    return _items(cp, "transaction_signatures")


def package_list() -> Column:
    """Packages of a checkpoint's row, each (id, version) once, those of transactions first."""
    inner = F.flatten(F.filter(F.transform("transactions", lambda t: t["objects"]), lambda a: a.isNotNull()))
    both = F.flatten(F.filter(F.array(inner, F.col("objects")), lambda a: a.isNotNull()))
    found = F.filter(both, lambda o: o["package"].isNotNull())
    # maps cannot be compared, so keys are sorted with their places, and the first of each is taken
    key = lambda o, i: F.struct(o["object_id"].alias("id"), o["version"].alias("version"), i.alias("i"))

    def firsts(keys: Column) -> Column:
        new = lambda k, j: (j == 0) | ~(k["id"].eqNullSafe(F.get(keys, j - 1)["id"]) & k["version"].eqNullSafe(F.get(keys, j - 1)["version"]))
        return F.filter(keys, new)

    return rules.let(found, lambda f: F.transform(rules.let(F.sort_array(F.transform(f, key)), firsts), lambda k: F.get(f, k["i"])))


def package_row(o: Column, at: At) -> list[Column]:
    p = o["package"]
    return [o["object_id"].alias("package_id"), o["version"].alias("version"), p["original_id"].alias("original_id"), F.coalesce(F.size(p["modules"]), F.lit(0)).alias("module_count"), *at.columns()]


def module_row(o: Column, name: Column, code: Column, at: At) -> list[Column]:
    return [o["object_id"].alias("package_id"), o["version"].alias("version"), name.alias("module_name"), rules.hex_of(code).alias("bytecode_hex"), *at.columns()]


def _packages(cp: DataFrame) -> DataFrame:
    return cp.select(*here().columns(), F.explode(package_list()).alias("o"))


def packages(cp: DataFrame) -> DataFrame:
    return _packages(cp).select(*package_row(F.col("o"), At(F.col("checkpoint_seq"), F.col("timestamp_ms"))))


def package_modules(cp: DataFrame) -> DataFrame:
    each = _packages(cp).select("checkpoint_seq", "timestamp_ms", "o", F.explode("o.package.modules").alias("name", "code"))
    return each.select(*module_row(F.col("o"), F.col("name"), F.col("code"), At(F.col("checkpoint_seq"), F.col("timestamp_ms"))))


def committee_row(i: Column, v: Column, epoch: Column, at: At) -> list[Column]:
    return [(epoch + 1).alias("target_epoch"), i.alias("idx"), rules.hex_of(v["pubkey"]).alias("validator_pubkey_hex"), v["stake"].alias("stake"), *at.columns()]


def epoch_committees(cp: DataFrame) -> DataFrame:
    """The next epoch's validators, from the last checkpoint of an epoch."""
    ends = cp.where("summary.next_epoch_committee IS NOT NULL").select(*here().columns(), F.col("summary.epoch").alias("epoch"), F.posexplode("summary.next_epoch_committee").alias("i", "v"))
    return ends.select(*committee_row(F.col("i"), F.col("v"), F.col("epoch"), At(F.col("checkpoint_seq"), F.col("timestamp_ms"))))


def tx_array_counts(cp: DataFrame) -> DataFrame:
    t, none = F.col("t"), F.array()
    size = lambda a: F.size(F.coalesce(a, none))
    return _transactions(cp).select(digest_of(t).alias("tx_digest"), size(_commands(t)).alias("command_count"), size(_calls(t)).alias("move_call_count"), size(t["effects"]["dependencies"]).alias("dependency_count"), F.size(F.coalesce(t["events"], t["fallback_events"], none)).alias("event_count"))
