"""Checkpoints and frames derived from the given tables, all in Spark.

Orders are transactions, ten to a checkpoint, fifty checkpoints to an epoch. Their lines are
commands and object states, events are events, conversations are signatures, suppliers are the
committee and packages, documents are frames. Only the parts asked for are built.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import rules

PARTS = ("commands", "dependencies", "events", "signatures", "objects", "packages", "committee")
#: A total order of lines; (l_orderkey, l_linenumber) repeats.
LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"

# every kind of transaction: eight of ten programmable, one system programmable, the last tenth of the others in turn
_OTHERS = " ".join(f"WHEN o_orderkey % 100 {'= ' + str(90 + k) if k < 8 else '>= 98'} THEN '{kind}'" for k, kind in enumerate(rules.TRANSACTION_KINDS[2:]))
_TX = """o_orderkey AS tx_no, CAST(o_orderkey AS STRING) AS digest, CAST(floor(o_orderkey / 10) AS BIGINT) AS checkpoint_seq,
  CAST(o_orderkey % 10 AS INT) AS position, CAST(floor(o_orderkey / 500) AS BIGINT) AS epoch,
  1704067200000 + CAST(floor(o_orderkey / 10) AS BIGINT) * 250 AS timestamp_ms, CAST(o_custkey AS STRING) AS sender,
  o_orderstatus <> 'F' AS success, o_orderpriority AS priority, o_orderkey % 100 < 90 AS programmable,
  CASE WHEN o_orderkey % 100 < 80 THEN 'ProgrammableTransaction' WHEN o_orderkey % 100 < 90 THEN 'ProgrammableSystemTransaction' """ + _OTHERS + " END AS tx_kind"
TX = f"SELECT {_TX} FROM {{orders}}"

_CMD = """CASE WHEN l_returnflag = 'R' THEN 'MoveCall' WHEN l_partkey % 10 < 6 THEN (CASE l_returnflag WHEN 'A' THEN 'TransferObjects' ELSE 'SplitCoins' END) WHEN l_partkey % 10 = 6 THEN 'MergeCoins' WHEN l_partkey % 10 = 7 THEN 'Publish' WHEN l_partkey % 10 = 8 THEN 'Upgrade' ELSE 'MakeMoveVec' END AS kind,
  concat('0x', CAST(l_suppkey AS STRING)) AS package, concat('m', CAST(l_partkey % 7 AS STRING)) AS module, concat('f', CAST(l_linenumber AS STRING)) AS function,
  l_linenumber AS n1, CAST(l_quantity AS INT) AS n2, CAST(l_partkey % 4 AS STRING) AS arg"""
CMD = f"""SELECT l_orderkey AS tx_no, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) - 1 AS INT) AS i,
  {_CMD} FROM {{lineitem}}"""

OBJ = f"""SELECT object_id, tx_no, alive, owner_kind, owner_id, coin_type, balance, tx_no + 1 AS version,
  lag(tx_no + 1) OVER (PARTITION BY object_id ORDER BY tx_no) AS prev_version, lag(alive) OVER (PARTITION BY object_id ORDER BY tx_no) AS prev_alive,
  lag(owner_kind) OVER (PARTITION BY object_id ORDER BY tx_no) AS prev_kind, lag(owner_id) OVER (PARTITION BY object_id ORDER BY tx_no) AS prev_owner,
  lag(balance) OVER (PARTITION BY object_id ORDER BY tx_no) AS prev_balance
FROM (SELECT CAST(l_partkey AS STRING) AS object_id, l_orderkey AS tx_no, l_returnflag <> 'R' AS alive,
    CASE WHEN l_linestatus = 'F' AND l_linenumber = 7 THEN 'Shared' WHEN l_linenumber = 6 THEN 'ConsensusAddressOwner' ELSE 'AddressOwner' END AS owner_kind,
    CAST(l_suppkey % 5 AS STRING) AS owner_id, concat('coin', CAST(l_partkey % 4 AS STRING)) AS coin_type, CAST(l_quantity AS BIGINT) AS balance,
    row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY {LINE_ORDER}) AS n
  FROM {{lineitem}}) WHERE n = 1"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A piece's SQL over parquet files."""
    import re

    names = {n: f"parquet.`{sf_dir}/{n}.parquet`" for n in re.findall(r"\{(\w+)\}", sql)}
    return spark.sql(re.sub(r"\{(\w+)\}", lambda m: names[m[1]], sql))


#: What a line's rows depend on, in the order of LINE_ORDER; lines alike in these are alike.
_LINE = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
_KINDS = ("AddressOwner", "Shared", "ConsensusAddressOwner")


def _dealt(rows: DataFrame, tx_no: str, n: int | None = None) -> DataFrame:
    """rows with their tx_no and checkpoint_seq, dealt out by the checkpoint: all that follows stays in its partition.

    n partitions, if given, stay as many; else AQE may join small ones.
    """
    rows = rows.withColumnRenamed(tx_no, "tx_no").withColumn("checkpoint_seq", F.floor(F.col("tx_no") / 10).cast("bigint"))
    return rows.repartition(n, "checkpoint_seq") if n else rows.repartition("checkpoint_seq")


def _joined(tx: DataFrame, rows: DataFrame) -> DataFrame:
    """tx left joined by tx_no with rows, of which each transaction has one at most.

    The join goes by the checkpoint, which both are dealt out by, and the transaction is a condition on its ten by
    ten pairs; as a second key it would deal out both sides anew.
    """
    own = rows.withColumnsRenamed({"checkpoint_seq": "_seq", "tx_no": "_no"})
    return tx.join(own, (F.col("checkpoint_seq") == F.col("_seq")) & (F.col("tx_no") - F.col("_no") == 0), "left").drop("_seq", "_no")


def _listed(rows: DataFrame, name: str, value, *order: str) -> DataFrame:
    """For each transaction an array of values in an order of columns."""
    listed = F.sort_array(F.collect_list(F.struct(F.struct(*order).alias("_o"), value.alias("v"))))
    return rows.groupBy("checkpoint_seq", "tx_no").agg(listed.alias("_a")).select("checkpoint_seq", "tx_no", F.transform("_a", lambda x: x["v"]).alias(name))


def _touched(spark: SparkSession, sf_dir: str, states: bool) -> DataFrame:
    """The rows of OBJ: a part that an order touches, and what the order before it left, dealt out once by part.

    Texts are told by numbers here, and made where checkpoints are. Without states the rows tell of the orders alone.
    """
    columns = _LINE if states else ("l_partkey",)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *columns).repartition("l_partkey")
    before = Window.partitionBy("l_partkey").orderBy("l_orderkey", *(c for c in columns if c != "l_partkey"))
    first = lines.withColumn("_k", F.lag(F.struct("l_orderkey")).over(before)).where("_k IS NULL OR NOT _k.l_orderkey <=> l_orderkey")
    old = Window.partitionBy("part").orderBy("tx_no")
    lag = lambda c: F.lag(c).over(old).alias(f"prev_{c}")
    if not states:
        return first.select(F.col("l_orderkey").alias("tx_no"), F.col("l_partkey").alias("part")).select("tx_no", lag("tx_no"))
    kind = F.when((F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 7), 1).when(F.col("l_linenumber") == 6, 2).otherwise(0).cast("tinyint")
    now = first.select(F.col("l_orderkey").alias("tx_no"), F.col("l_partkey").alias("part"), (F.col("l_returnflag") != "R").alias("alive"), kind.alias("kind"), (F.col("l_suppkey") % 5).cast("tinyint").alias("owner"), F.col("l_quantity").cast("bigint").alias("balance"))
    return now.select("*", *(lag(c) for c in ("tx_no", "alive", "kind", "owner", "balance")))


def nested_checkpoints(spark: SparkSession, sf_dir: str, parts: Iterable[str] = ()) -> DataFrame:
    """The nested checkpoint DataFrame with the parts named; other arrays are null.

    Flat rows are dealt out once by the checkpoint, and transactions and checkpoints are put together without
    another exchange, so no nested row is shuffled. The result is dealt out by sequence_number.
    """
    parts = set(parts)
    n = None
    if "committee" in parts:
        # a committee makes large rows of small ones after they are dealt out, which AQE cannot know
        n = min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(2 * spark.sparkContext.defaultParallelism, table(spark, sf_dir, "orders").count() // 50_000))
    orders = _dealt(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"), "o_orderkey", n)
    tx = spark.sql(f"SELECT {_TX} FROM {{orders}}".replace("CAST(floor(o_orderkey / 10) AS BIGINT) AS checkpoint_seq", "checkpoint_seq").replace("o_orderkey", "tx_no"), orders=orders)
    null = lambda kind: F.lit(None).cast(kind)
    from ..schemas import CHANGE, COMMAND, EVENT, OBJECT

    def attach(name: str, rows: DataFrame | None, kind: str) -> None:
        nonlocal tx
        tx = tx.withColumn(name, null(kind)) if rows is None else _joined(tx, rows)

    def cast(c, kind: str):
        return c.cast(kind)

    commands = None
    if "commands" in parts:
        call = F.col("kind") == "MoveCall"
        value = F.struct("kind", F.when(call | (F.col("kind") == "Upgrade"), F.col("package")).alias("package"), F.when(call, F.col("module")).alias("module"), F.when(call, F.col("function")).alias("function"), F.when(F.col("n1") % 2 == 1, F.array(F.concat(F.lit("T"), "arg"))).otherwise(F.array().cast("array<string>")).alias("type_arguments"), "n1", "n2")
        lines = _dealt(table(spark, sf_dir, "lineitem").select("l_orderkey", *_LINE), "l_orderkey", n)
        lines = spark.sql(f"SELECT checkpoint_seq, tx_no, {', '.join(_LINE)}, {_CMD} FROM {{lines}}", lines=lines)
        commands = _listed(lines, "commands", cast(value, COMMAND), *_LINE)
    attach("commands", commands, f"ARRAY<{COMMAND}>")
    events = None
    if "events" in parts:
        e = _dealt(table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 2).cast("bigint").alias("tx_no"), (F.col("event_id") % 2).alias("i"), "user_id", "event_type", "props"), "tx_no", n)
        value = F.struct(F.concat(F.lit("0x"), (F.col("user_id") % 100).cast("string")).alias("package_id"), F.lit("m").alias("module"), "event_type", F.col("user_id").cast("string").alias("sender"), F.col("props").cast("binary").alias("contents"))
        events = _listed(e, "events", cast(value, EVENT), "i")
    attach("events", events, f"ARRAY<{EVENT}>")
    signatures = None
    if "signatures" in parts:
        c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("b"))
        signatures = _listed(_dealt(c, "conv_id", n), "signatures", F.col("b"), "turn")
    attach("signatures", signatures, "ARRAY<BINARY>")
    touched = None
    if parts & {"objects", "dependencies"}:
        states = "objects" in parts
        depends = F.col("prev_tx_no").isNotNull()
        stated = F.coalesce(F.col("alive") | F.coalesce(F.col("prev_alive"), F.lit(False)), F.lit(False)) if states else F.lit(False)
        told = ("part", *(p + c for c in ("alive", "kind", "owner", "balance") for p in ("", "prev_")), "tx_no", "prev_tx_no") if states else ("prev_tx_no",)
        rows = _dealt(_touched(spark, sf_dir, states).where(stated | depends if "dependencies" in parts else stated), "tx_no", n)
        touched = rows.groupBy("checkpoint_seq", "tx_no").agg(F.collect_list(F.struct(*told)).alias("_o"))
        had = lambda o: F.coalesce(o["prev_alive"], F.lit(False))
        listed = []
    if "objects" in parts:
        name = lambda k: F.get(F.array(*map(F.lit, _KINDS)), k.cast("int"))
        owner = lambda o, p: F.struct(name(o[p + "kind"]).alias("kind"), F.when(o[p + "kind"] != 1, o[p + "owner"].cast("string")).alias("address"))
        change = lambda o: F.struct(
            o["part"].cast("string").alias("object_id"), F.when(had(o), o["prev_tx_no"] + 1).alias("input_version"), null("string").alias("input_digest"), F.when(had(o), owner(o, "prev_")).alias("input_owner"),
            F.when(o["alive"], o["tx_no"] + 1).alias("output_version"), null("string").alias("output_digest"), F.when(o["alive"], owner(o, "")).alias("output_owner"), F.lit("none").alias("id_operation"),
        )
        package = lambda o: F.when(o["part"] % 10 == 0, F.struct(o["part"].cast("string").alias("original_id"), F.create_map(F.lit("m"), F.lit("x").cast("binary")).alias("modules")))
        coin = lambda o: F.concat(F.lit("coin"), (o["part"] % 4).cast("string"))
        state = lambda o, p: F.struct(
            o["part"].cast("string").alias("object_id"), (o[p + "tx_no"] + 1).alias("version"), owner(o, p).alias("owner"), F.concat(F.lit("Coin<"), coin(o), F.lit(">")).alias("object_type"),
            o[p + "tx_no"].cast("string").alias("previous_transaction"), coin(o).alias("coin_type"), o[p + "balance"].cast("decimal(20,0)").alias("balance"), package(o).alias("package"),
        )
        both = lambda o: F.filter(F.array(F.when(o["alive"], cast(state(o, ""), OBJECT)), F.when(had(o), cast(state(o, "prev_"), OBJECT))), lambda x: x.isNotNull())
        ids = lambda when: F.transform(F.filter("_o", when), lambda o: o["part"].cast("string"))
        touches = F.filter("_o", lambda o: o["alive"] | had(o))
        some = lambda a: F.when(F.exists("_o", lambda o: o["alive"] | had(o)), a)
        listed += [
            some(F.transform(touches, lambda o: cast(change(o), CHANGE))).alias("changes"), some(F.flatten(F.transform(touches, both))).alias("objects"), some(ids(lambda o: o["alive"] & ~had(o) & o["prev_alive"].isNull())).alias("created"),
            some(ids(lambda o: o["alive"] & had(o))).alias("mutated"), some(ids(lambda o: o["alive"] & ~had(o) & o["prev_alive"].isNotNull())).alias("unwrapped"), some(ids(lambda o: ~o["alive"] & had(o))).alias("deleted"),
        ]
    if "dependencies" in parts:
        on = F.array_distinct(F.transform(F.filter("_o", lambda o: o["prev_tx_no"].isNotNull()), lambda o: o["prev_tx_no"]))
        listed.append(F.when(F.size(on) > 0, F.transform(F.sort_array(on), lambda x: x.cast("string"))).alias("dependencies"))
    if touched is not None:
        tx = _joined(tx, touched.select("checkpoint_seq", "tx_no", *listed))
    if "objects" not in parts:
        tx = tx.select("*", null(f"ARRAY<{CHANGE}>").alias("changes"), null(f"ARRAY<{OBJECT}>").alias("objects"), *(null("ARRAY<STRING>").alias(c) for c in ("created", "mutated", "unwrapped", "deleted")))
    if "dependencies" not in parts:
        tx = tx.withColumn("dependencies", null("ARRAY<STRING>"))
    if "packages" in parts:
        p = piece(spark, sf_dir, "SELECT DISTINCT l_suppkey, p_brand FROM {lineitem} JOIN {part} ON l_partkey = p_partkey")
        p = p.groupBy("l_suppkey").agg(F.map_from_entries(F.collect_list(F.struct("p_brand", F.col("p_brand").cast("binary").alias("b")))).alias("modules"))
        top = p.select(F.col("l_suppkey").alias("sequence_number"), F.array(cast(F.struct(F.concat(F.lit("0x"), F.col("l_suppkey").cast("string")).alias("object_id"), F.lit(1).cast("bigint").alias("version"), F.lit(None).cast("struct<kind:string,address:string>").alias("owner"), F.lit("package").alias("object_type"), F.lit("").alias("previous_transaction"), F.lit(None).cast("string").alias("coin_type"), F.lit(None).cast("decimal(20,0)").alias("balance"), F.struct(F.concat(F.lit("0x"), F.col("l_suppkey").cast("string")).alias("original_id"), "modules").alias("package")), OBJECT)).alias("top_objects"))
        top = top.repartition(n, "sequence_number") if n else top
    zero = F.lit(0).cast("decimal(20,0)")
    failed = ~F.col("success")
    aborted = failed & (F.col("tx_no") % 2 == 0)
    effects = F.struct(
        F.when(F.col("tx_no") % 4 == 0, 1).otherwise(2).alias("version"), F.col("digest").alias("transaction_digest"), "success", F.col("epoch").alias("executed_epoch"), F.when(aborted, F.concat(F.lit("MoveAbort(m, "), F.col("tx_no").cast("string"), F.lit(")"))).when(failed, "InsufficientGas").alias("error"),
        F.when(failed, F.lit(0)).alias("error_command"), F.when(aborted, (F.col("tx_no") % 7).cast("decimal(20,0)")).alias("abort_code"), F.when(aborted, F.lit("m")).alias("abort_module"), F.when(aborted, F.lit("f")).alias("abort_function"),
        (F.col("tx_no") % 1000).cast("decimal(20,0)").alias("computation_cost"), (F.col("tx_no") % 100).cast("decimal(20,0)").alias("storage_cost"), (F.col("tx_no") % 10).cast("decimal(20,0)").alias("storage_rebate"), zero.alias("non_refundable_storage_fee"),
        F.lit("0x" + "0" * 64).alias("gas_object_id"), F.lit(None).cast("string").alias("events_digest"), (F.col("tx_no") + 1).alias("lamport_version"), "dependencies", "created", "mutated", "unwrapped", "deleted",
        F.array().cast("array<string>").alias("unwrapped_then_deleted"), F.array().cast("array<string>").alias("wrapped"), F.array().cast("array<string>").alias("published"), "changes",
    )
    t = F.struct(
        "position", "digest", "sender", F.col("tx_kind").alias("kind"), F.lit(None).cast("string").alias("gas_owner"), F.lit(750).cast("decimal(20,0)").alias("gas_price"), F.lit(None).cast("decimal(20,0)").alias("gas_budget"),
        "commands", "signatures", F.lit(None).cast("array<struct<scheme:int,bytes:binary>>").alias("fallback_signatures"), effects.alias("effects"), "events", F.lit(None).cast(f"ARRAY<{EVENT}>").alias("fallback_events"), "objects",
    )
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("position", t.alias("t"))), lambda a, b: a["position"] - b["position"]), lambda x: x["t"])
    total = lambda c: F.sum(F.col("tx_no") % c).cast("decimal(20,0)")
    cp = tx.groupBy("checkpoint_seq").agg(F.first("epoch").alias("epoch"), F.first("timestamp_ms").alias("timestamp_ms"), ordered.alias("transactions"), F.max("tx_no").alias("last"), total(1000).alias("c1"), total(100).alias("c2"), total(10).alias("c3"))
    committee = F.lit(None).cast("array<struct<pubkey:binary,stake:decimal(20,0)>>")
    if "committee" in parts:
        s = table(spark, sf_dir, "supplier").agg(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", F.col("s_name").cast("binary").alias("pubkey"), F.round((F.col("s_acctbal") + 1000) * 100).cast("decimal(20,0)").alias("stake")))), lambda x: F.struct(x["pubkey"].alias("pubkey"), x["stake"].alias("stake"))).alias("c"))
        cp = cp.join(F.broadcast(s))  # one row: the committee of the fixture
        committee = F.when(F.col("checkpoint_seq") % 50 == 49, F.col("c"))
    summary = F.struct("epoch", "timestamp_ms", F.when(F.col("checkpoint_seq") > 0, F.concat(F.lit("cp"), (F.col("checkpoint_seq") - 1).cast("string"))).alias("previous_digest"), F.lit("").alias("content_digest"), (F.col("last") + 1).cast("decimal(20,0)").alias("network_total_transactions"), F.col("c1").alias("computation_cost"), F.col("c2").alias("storage_cost"), F.col("c3").alias("storage_rebate"), zero.alias("non_refundable_storage_fee"), F.concat(F.lit("summary"), F.col("checkpoint_seq").cast("string")).cast("binary").alias("raw"), committee.alias("next_epoch_committee"))
    out = cp.select(F.col("checkpoint_seq").alias("sequence_number"), F.when(F.col("checkpoint_seq") % 3 != 0, F.concat(F.lit("cp"), F.col("checkpoint_seq").cast("string"))).alias("digest"), summary.alias("summary"), F.lit(None).cast("struct<epoch:bigint,signature:binary,signers:array<int>>").alias("signature"), "transactions")
    if "packages" in parts:
        return out.join(top, "sequence_number", "left").withColumnRenamed("top_objects", "objects")
    return out.withColumn("objects", null(f"ARRAY<{OBJECT}>"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(epoch, seq, length, body): a frame for each document, a hundred to an epoch."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 100).cast("bigint").alias("epoch"), F.col("doc_id").alias("seq"), F.octet_length(body).cast("bigint").alias("length"), body.alias("body"))


def gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir).drop("body").where("seq % 97 NOT IN (5, 6, 7)")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir).groupBy("epoch").agg(F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.count("*").alias("count"), F.sum("length").cast("bigint").alias("zst_bytes"))


def committee(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one committee, named 0: all suppliers."""
    return table(spark, sf_dir, "supplier").select(F.lit(0).cast("bigint").alias("epoch"), F.col("s_suppkey").cast("int").alias("idx"), F.round((F.col("s_acctbal") + 1000) * 100).cast("bigint").alias("stake"))


def serves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """It serves every epoch of orders."""
    return piece(spark, sf_dir, TX).select("epoch").distinct().withColumn("committee", F.lit(0).cast("bigint"))


def signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signatures of all checkpoints, with a bitmap of signers each.

    A member i signs checkpoint seq if (7 i + seq) % 10 < 4 + seq % 5, which the last digit of seq decides, as
    numbers start at 0: ten bitmaps are made, and each checkpoint takes its own.
    """
    cp = piece(spark, sf_dir, TX).select(F.col("checkpoint_seq").alias("seq"), "epoch").distinct()
    digits = spark.range(10).select(F.col("id").alias("digit"))
    members = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int").alias("i"))
    signed = members.join(F.broadcast(digits), (F.col("i") * 7 + F.col("digit")) % 10 < 4 + F.col("digit") % 5)
    octets = signed.groupBy("digit", F.floor(F.col("i") / 8).cast("int").alias("at")).agg(F.bit_or(F.pow(F.lit(2), F.col("i") % 8).cast("int")).alias("b"))
    listed = octets.groupBy("digit").agg(F.sort_array(F.collect_list(F.struct("at", "b"))).alias("a"))
    # zero bytes between two entries come before the second one
    hexed = F.transform("a", lambda x, k: F.concat(F.repeat(F.lit("00"), x["at"] - F.coalesce(F.get("a", k - 1)["at"], F.lit(-1)) - 1), F.lpad(F.hex(x["b"]), 2, "0")))
    bitmaps = listed.select("digit", F.unhex(F.array_join(hexed, "")).alias("signers"))
    signed = cp.join(F.broadcast(bitmaps), F.col("seq") % 10 == F.col("digit"), "left")  # ten rows
    return signed.select("seq", "epoch", F.col("epoch").alias("sig_epoch"), F.coalesce("signers", F.lit(bytearray())).alias("signers"))
