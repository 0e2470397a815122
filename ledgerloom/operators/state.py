"""Objects before and after a transaction: look-ups, changes, balances.

A checkpoint's row brings all object states that its transactions touch, so states are looked up
inside the row, in a sorted array that is made once and searched by halving: no shuffle, and a busy
checkpoint takes time in proportion to its changes. object_set and object_lookup are the same as tables
and a join, for states that come from elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from .flatten import At, digest_of, here

_OBJECT = ("version", "owner", "object_type", "previous_transaction", "coin_type", "balance")


def object_set(cp: DataFrame) -> DataFrame:
    """Object states by (checkpoint_seq, object_id, version), each once.

    States come from the checkpoint and from its transactions; a transaction's wins.
    """
    seq = F.col("sequence_number").alias("checkpoint_seq")
    top = cp.select(seq, F.explode("objects").alias("o"), F.lit(0).alias("rank"))
    inner = cp.select(seq, F.explode("transactions").alias("t")).select("checkpoint_seq", F.explode("t.objects").alias("o"), (F.col("t.position") + 1).alias("rank"))
    both = top.unionByName(inner).select("checkpoint_seq", F.col("o.object_id").alias("object_id"), *(F.col(f"o.{c}").alias(c) for c in _OBJECT), F.col("o.package").isNotNull().alias("is_package"), "rank")
    states = F.struct("rank", *_OBJECT, "is_package")
    kept = both.groupBy("checkpoint_seq", "object_id", F.col("version").alias("_v")).agg(F.max_by(states, "rank").alias("s"))
    return kept.select("checkpoint_seq", "object_id", *(F.col(f"s.{c}").alias(c) for c in _OBJECT), "s.is_package")


def _key(object_id: Column, version: Column) -> Column:
    """One text for both, null if either is: texts are compared faster than structs."""
    return F.concat(version.cast("string"), F.lit(":"), object_id)


def _states() -> Column:
    """Index of the object states of a row by _key: the last transaction's first, the checkpoint's last.

    Its entries say where a state stands, so sorting and writing them moves no states.
    """
    entry = lambda rank, tx: lambda o, i: F.struct(_key(o["object_id"], o["version"]).alias("k"), rank.alias("rank"), i.alias("i"), tx.alias("tx"))
    some = lambda a: F.filter(a, lambda e: e["k"].isNotNull())
    inner = F.transform(F.col("transactions"), lambda t, n: some(F.transform(t["objects"], entry(-t["position"], n))))
    top = some(F.transform(F.col("objects"), entry(F.lit((1 << 31) - 1), F.lit(-1))))
    return rules.indexed(F.flatten(F.filter(F.concat(F.coalesce(inner, F.array()), F.array(top)), lambda a: a.isNotNull())))


def _state(entry: Column) -> Column:
    """The state that an entry of the index stands for; null without an entry."""
    o = F.when(entry["tx"] < 0, F.get("objects", entry["i"])).otherwise(F.get(F.get("transactions", entry["tx"])["objects"], entry["i"]))
    return rules.let(o, lambda x: F.when(x.isNotNull(), F.struct(*(x[c].alias(c) for c in _OBJECT), x["package"].isNotNull().alias("is_package"))))


def with_states(cp: DataFrame) -> DataFrame:
    """cp with the indexes that stated_lists looks things up in: states of the row, lists of the effects of each transaction.

    They are columns of their own, so they are made once for each row.
    """
    marks = F.transform("transactions", lambda t: F.struct(rules.change_marks(t["effects"]).alias("marks"), rules.published_ids(t["effects"]).alias("published")))
    return cp.withColumns({"_states": _states(), "_marks": marks})


def stated_lists() -> Column:
    """For each transaction of a row of with_states the changed objects with their states before and after (null: not in the set).

    Things are found by halving: the time grows with the changes, times the bits of their number.
    """

    def change(t: Column, c: Column, m: Column) -> Column:
        e, oid = t["effects"], c["object_id"]
        at = lambda version: rules.let(rules.find(F.col("_states"), _key(oid, c[version])), _state)
        found = F.struct(at("input_version").alias("before"), at("output_version").alias("after"), rules.find(m["marks"], oid)["mark"].alias("mark"), rules.find(m["published"], oid).isNotNull().alias("published"))
        return rules.let(found, lambda x: F.struct(
            digest_of(t).alias("tx_digest"), t["position"].alias("position"), oid.alias("object_id"), rules.change_type(c, e["version"], x["mark"], x["published"], F.coalesce(x["after"]["is_package"], F.lit(False))).alias("change_type"),
            c["input_version"].alias("input_version"), c["input_digest"].alias("input_digest"), F.when(e["version"] == 2, c["input_owner"]).alias("input_owner"), c["output_version"].alias("output_version"), c["output_digest"].alias("output_digest"),
            F.when(x["mark"] < 3, c["output_owner"]).alias("output_owner"), F.coalesce(F.nullif(e["gas_object_id"], F.lit(rules.NO_OBJECT)) == oid, F.lit(False)).alias("is_gas_object"), x["before"].alias("before"), x["after"].alias("after"),
        ))

    def of(t: Column, i: Column) -> Column:
        some = F.filter(t["effects"]["changes"], lambda c: c["input_version"].isNotNull() | c["output_version"].isNotNull())
        return F.transform(some, lambda c: change(t, c, F.get("_marks", i)))

    return F.filter(F.transform("transactions", of), lambda a: a.isNotNull())


_STATED = ("tx_digest", "position", "object_id", "change_type", "input_version", "input_digest", "input_owner", "output_version", "output_digest", "output_owner", "is_gas_object", "before", "after")


def stated(cp: DataFrame) -> DataFrame:
    """One row for each changed object of each transaction, with its states before and after."""
    return _exploded(cp, F.flatten(stated_lists())).select("checkpoint_seq", "timestamp_ms", *(F.col(f"x.{c}").alias(c) for c in _STATED))


def changes(cp: DataFrame) -> DataFrame:
    """One row for each changed object of each transaction, with what the rules need."""
    return stated(cp).drop("before", "after")


def object_lookup(changed: DataFrame, objects: DataFrame) -> DataFrame:
    """changed plus the state at the output version, else at the input version.

    Both are brought together once, by checkpoint and object, and the few versions there are searched in place:
    tables that are dealt out by checkpoint are not dealt out again.
    """
    keys = ["checkpoint_seq", "object_id"]
    asked = F.struct(*changed.columns)
    known = F.struct(F.col("version").alias("k"), "object_type", "previous_transaction")
    kind = lambda df, c: df.select(c.alias("x")).schema["x"].dataType
    both = changed.select(*keys, asked.alias("c"), F.lit(None).cast(kind(objects, known)).alias("s"))
    both = both.unionByName(objects.where("version IS NOT NULL").select(*keys, F.lit(None).cast(kind(changed, asked)).alias("c"), known.alias("s")))
    each = both.groupBy(*keys).agg(F.collect_list("c").alias("c"), F.collect_list("s").alias("s"))
    # keys that are null meet nothing
    whole = F.col("checkpoint_seq").isNotNull() & F.col("object_id").isNotNull()
    each = each.where(F.size("c") > 0).withColumn("s", F.filter("s", lambda s: whole)).withColumn("s", rules.indexed(F.col("s"))).select("s", F.explode("c").alias("c"))
    out = each.select("c", F.coalesce(rules.find(F.col("s"), F.col("c.output_version")), rules.find(F.col("s"), F.col("c.input_version"))).alias("o"))
    return out.select(*(F.col(f"c.{c}").alias(c) for c in changed.columns), F.col("o.object_type").alias("object_type"), F.col("o.previous_transaction").alias("previous_transaction"))


def change_row(x: Column, at: At) -> list[Column]:
    state = F.coalesce(x["after"], x["before"])
    return [
        *(x[c].alias(c) for c in ("tx_digest", "object_id", "change_type")), state["object_type"].alias("object_type"), x["input_version"].alias("input_version"), x["input_digest"].alias("input_digest"), rules.owner_id(x["input_owner"]).alias("input_owner"), x["input_owner"]["kind"].alias("input_owner_kind"),
        x["output_version"].alias("output_version"), x["output_digest"].alias("output_digest"), rules.owner_id(x["output_owner"]).alias("output_owner"), x["output_owner"]["kind"].alias("output_owner_kind"), x["is_gas_object"].alias("is_gas_object"),
        F.coalesce(state["previous_transaction"], F.lit("")).alias("previous_transaction"), *at.columns(),
    ]


def _exploded(cp: DataFrame, rows: Column) -> DataFrame:
    return with_states(cp).select(*here().columns(), F.explode(rows).alias("x"))


_HERE = ("checkpoint_seq", "timestamp_ms")


def _at() -> At:
    return At(*(F.col(c) for c in _HERE))


def object_changes(cp: DataFrame) -> DataFrame:
    return _exploded(cp, F.flatten(stated_lists())).select(*change_row(F.col("x"), _at()))


def _coin(o: Column) -> Column:
    """The state of a coin that an address owns; null for anything else."""
    held = F.struct(o["owner"]["address"].alias("owner_id"), o["owner"]["kind"].alias("owner_kind"), o["coin_type"].alias("coin_type"), o["balance"].alias("balance"), o["version"].alias("version"))
    return F.when(o["owner"]["kind"].isin(*rules.ADDRESS_KINDS) & o["coin_type"].isNotNull(), held)


def coins(changed: Column) -> Column:
    """The coins among the changed objects of a transaction, with what they were and are (one may be null)."""
    both = F.transform(changed, lambda x: F.struct(*(x[c].alias(c) for c in ("tx_digest", "object_id", "position")), _coin(x["before"]).alias("before"), _coin(x["after"]).alias("after")))
    return F.filter(both, lambda x: x["before"].isNotNull() | x["after"].isNotNull())


def before_after(cp: DataFrame) -> DataFrame:
    """One row for each coin that a transaction touched, with struct columns before and after (either may be null)."""
    return _exploded(cp, coins(F.flatten(stated_lists()))).select("checkpoint_seq", "x.tx_digest", "x.object_id", "timestamp_ms", "x.position", "x.before", "x.after")


def touched_ids(before: DataFrame, after: DataFrame, key: str = "object_id") -> DataFrame:
    return before.select(key).union(after.select(key)).distinct()


def log_rows(coin: Column, at: At) -> Column:
    """Rows of the change log of a coin: what left an owner with its old values, what an owner now has with the new ones."""
    b, a = coin["before"], coin["after"]
    moved = ~(b["owner_id"].eqNullSafe(a["owner_id"]) & b["owner_kind"].eqNullSafe(a["owner_kind"]))
    same = ~moved & b["balance"].eqNullSafe(a["balance"]) & b["coin_type"].eqNullSafe(a["coin_type"])
    row = lambda gone, s: F.struct(coin["tx_digest"].alias("tx_digest"), coin["object_id"].alias("object_id"), F.lit(gone).alias("is_deleted"), *(s[c].alias(c) for c in ("owner_id", "owner_kind", "coin_type", "balance", "version")), *at.columns(), coin["position"].alias("position"))
    now = F.array(row(False, a))
    return F.when(a.isNull(), F.array(row(True, b))).when(b.isNull(), now).when(same, F.filter(now, lambda r: F.lit(False))).when(moved, F.array(row(True, b), row(False, a))).otherwise(now)


def coin_balances(cp: DataFrame) -> DataFrame:
    """Change log of coins."""
    each = _exploded(cp, coins(F.flatten(stated_lists())))
    return each.select(F.explode(log_rows(F.col("x"), _at())).alias("r")).select("r.*")


def net_rows(coin_list: Column, at: At) -> Column:
    """Net change for each address and coin type of one transaction, summed in the row: its coins are sorted by both, and each run is added up."""
    side = lambda x, s, v: F.when(x[s].isNotNull(), F.struct(x["tx_digest"].alias("tx_digest"), x[s]["owner_id"].alias("address"), x[s]["coin_type"].alias("coin_type"), v.cast("decimal(38,0)").alias("x")))
    sides = F.flatten(F.transform(coin_list, lambda x: F.filter(F.array(side(x, "after", x["after"]["balance"]), side(x, "before", -x["before"]["balance"])), lambda v: v.isNotNull())))

    def total(values: Column) -> Column:
        """An empty sum, or one out of range, is null."""
        known = F.filter(values, lambda v: v.isNotNull())
        return F.when(F.size(known) > 0, F.aggregate(known, F.lit(0).cast("decimal(38,0)"), lambda a, v: F.try_add(a, v)))

    def runs(s: Column) -> Column:
        same = lambda i: s[i - 1]["address"].eqNullSafe(s[i]["address"]) & s[i - 1]["coin_type"].eqNullSafe(s[i]["coin_type"])
        starts = F.when(F.size(s) > 0, F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | ~same(i)))
        run = lambda st, i, j: F.slice(s, i + 1, F.coalesce(F.get(st, j + 1), F.size(s)) - i)
        return rules.let(starts, lambda st: F.transform(st, lambda i, j: F.struct(s[i]["tx_digest"].alias("tx_digest"), s[i]["address"].alias("address"), s[i]["coin_type"].alias("coin_type"), total(F.transform(run(st, i, j), lambda v: v["x"])).alias("amount"), *at.columns())))

    rows = rules.let(F.sort_array(sides), runs)
    return F.filter(rows, lambda r: (r["amount"] != 0) | r["amount"].isNull())


def balance_lists(changed: Column, at: At) -> Column:
    return F.flatten(F.filter(F.transform(changed, lambda xs: net_rows(coins(xs), at)), lambda a: a.isNotNull()))


def balance_changes(cp: DataFrame) -> DataFrame:
    """Net change for each transaction, address and coin type; zeros go. Out-of-range sums are null, not wrong."""
    return _exploded(cp, balance_lists(stated_lists(), here())).select("x.*")


def published_packages(cp: DataFrame) -> DataFrame:
    """(tx_digest, object_id) of published packages: created ids that are packages (effects 1), the given list (effects 2)."""
    inner = F.transform("transactions", lambda t: t["objects"])
    ids = F.flatten(F.transform(F.filter(F.concat(F.coalesce(inner, F.array()), F.array(F.col("objects"))), lambda a: a.isNotNull()), lambda a: F.transform(F.filter(a, lambda o: o["package"].isNotNull()), lambda o: F.struct(o["object_id"].alias("k")))))

    def of(t: Column, index: Column) -> Column:
        made = F.filter(t["effects"]["created"], lambda i: rules.find(index, i).isNotNull())
        found = F.when(t["effects"]["version"] == 1, made).when(t["effects"]["version"] == 2, t["effects"]["published"])
        return F.transform(found, lambda i: F.struct(digest_of(t).alias("tx_digest"), i.alias("object_id")))

    rows = rules.let(rules.indexed(ids), lambda index: F.flatten(F.filter(F.transform(F.col("transactions"), lambda t: of(t, index)), lambda a: a.isNotNull())))
    return cp.select(F.explode(rows).alias("x")).select("x.*")


def holder_balances(log: DataFrame, k: int | None = None) -> DataFrame:
    """Holdings by owner and coin type from coin_balances: the last row of each object, where it is not deleted.

    max_by combines on the map side; a window would sort each object's history.
    """
    order = F.struct("checkpoint_seq", "position", (~F.col("is_deleted")).alias("live"))
    last = log.groupBy("object_id").agg(F.max_by(F.struct("owner_id", "coin_type", "balance", "is_deleted"), order).alias("s")).where("NOT s.is_deleted")
    out = last.groupBy(F.col("s.owner_id").alias("owner_id"), F.col("s.coin_type").alias("coin_type")).agg(F.sum("s.balance").alias("balance"), F.count("*").alias("coins"))
    return out if k is None else out.orderBy(F.desc("balance"), "owner_id", "coin_type").limit(k)
