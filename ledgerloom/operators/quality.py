"""Checks: signer quorum and parity of two sides."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import rules


def _places(bits: Column) -> Column:
    """The bits that are set in a bitmap, the lowest bit of the first byte first."""
    byte = lambda i: F.conv(F.hex(F.substring(bits, F.floor(i / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    each = F.when(F.octet_length(bits) > 0, F.sequence(F.lit(0), F.octet_length(bits) * 8 - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(each, lambda i: F.pmod(F.floor(byte(i) / F.pow(F.lit(2), i % 8)), F.lit(2)) == 1)


def signer_stake(signatures: DataFrame, committee: DataFrame, serves: DataFrame | None = None) -> DataFrame:
    """For each signature (seq, epoch, sig_epoch, signers) the signed and total stake and whether the quorum is met.

    signers is an array of places or a binary bitmap of them. A committee (epoch, idx, stake) becomes one
    row, its stakes a vector by place, and stakes are summed inside the row, so there is no row a signer.
    serves (epoch, committee) tells which committee serves an epoch, where one serves several: committee's
    epoch is its name then. Fails without signers, with a place that the committee lacks, or with another
    epoch's signature.

    Signers that are alike are held and summed once for each committee, and signatures are joined with the sums
    by the signers' SHA-256, so signers move once for each set of them, not once for each signature. All
    committees grow with time, so joins are left to AQE.
    """
    big = lambda c: c.cast("decimal(38,0)")
    bitmap = signatures.schema["signers"].dataType.typeName() == "binary"
    places = _places(F.col("signers")) if bitmap else F.array_distinct(F.filter(F.coalesce("signers", F.array()), lambda i: i.isNotNull()))
    digest = F.coalesce(F.sha2(F.col("signers") if bitmap else F.to_json("signers"), 256), F.lit("")).alias("_set")
    slim = signatures.select("seq", "epoch", "sig_epoch", digest)
    sets = signatures.select("signers").distinct().select(digest, places.alias("places"))
    asked = slim.select("epoch", "_set").distinct()
    if serves is None:
        asked = asked.withColumn("_name", F.col("epoch"))
    else:
        asked = asked.join(serves.select(F.col("epoch").alias("_of"), F.col("committee").alias("_name")), F.col("epoch") == F.col("_of"), "left").drop("_of")
    # places are dense in a committee, and then the vector's index is the place; else places are searched for
    one = committee.groupBy("epoch").agg(F.sort_array(F.collect_list(F.struct(F.col("idx").cast("int").alias("k"), big(F.col("stake")).alias("stake")))).alias("a"), F.coalesce(F.sum(big(F.col("stake"))), big(F.lit(0))).alias("total"))
    dense = (F.get("a", F.lit(0))["k"] == 0) & (F.get("a", F.size("a") - 1)["k"] == F.size("a") - 1)
    vector = one.select(F.col("epoch").alias("_epoch"), rules.indexed(F.col("a")).alias("index"), F.transform("a", lambda x: x["stake"]).alias("stakes"), dense.alias("dense"), "total")
    each = asked.select("_name", "_set").distinct().join(sets, "_set").join(vector, F.col("_name") == F.col("_epoch"), "left")
    stake = lambda i: F.when(F.col("dense"), F.when(i >= 0, F.get("stakes", i))).otherwise(rules.find(F.col("index"), i)["stake"])
    each = each.withColumn("held", F.transform("places", stake))
    signed = F.aggregate(F.filter("held", lambda v: v.isNotNull()), big(F.lit(0)), lambda a, v: (a + v).cast("decimal(38,0)"))
    each = each.select(F.col("_name").alias("_n"), F.col("_set").alias("_s"), F.size("places").cast("long").alias("signer_count"), F.size(F.filter("held", lambda v: v.isNull())).cast("long").alias("unknown_signers"), signed.alias("signed_stake"), F.coalesce("total", big(F.lit(0))).alias("total_stake"))
    told = asked.join(each, F.col("_name").eqNullSafe(F.col("_n")) & (F.col("_set") == F.col("_s"))).select(F.col("epoch").alias("_e"), F.col("_set").alias("_s"), "signer_count", "unknown_signers", "signed_stake", "total_stake")
    out = slim.join(told, F.col("epoch").eqNullSafe(F.col("_e")) & (F.col("_set") == F.col("_s")))
    fine = (F.col("signer_count") > 0) & (F.col("unknown_signers") == 0) & (F.col("epoch") == F.col("sig_epoch")) & rules.quorum_met(F.col("signed_stake"), F.col("total_stake"))
    return out.select("seq", "epoch", "signer_count", "unknown_signers", "signed_stake", "total_stake", (F.col("epoch") != F.col("sig_epoch")).alias("wrong_epoch"), fine.alias("passed"))


def range_digests(df: DataFrame, key: list[str], blocks: int) -> DataFrame:
    """(block, n, a, b): the rows of each block of keys as their number and two sums of hashes, whatever their order.

    A repeated row counts as often as it is there. Sums are decimals, so they neither wrap nor overflow.
    """
    rest = sorted(c for c in df.columns if c not in key)
    row = F.to_json(F.struct(*(F.col(c).alias(c) for c in [*key, *rest])), {"ignoreNullFields": "false"})
    h = lambda seed: F.sum(F.xxhash64(F.lit(seed), row).cast("decimal(38,0)"))
    return df.groupBy(_block(key, blocks).alias("block")).agg(F.count("*").alias("n"), h(1).alias("a"), h(2).alias("b"))


def _block(key: list[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*(F.col(k) for k in key)), F.lit(blocks)).cast("int")


def parity_diff(left: DataFrame, right: DataFrame, key: list[str], blocks: int = 4096) -> DataFrame:
    """(key, status, columns): rows on one side only, and rows whose columns differ, with their names.

    Both sides are first reduced to a digest for each of `blocks` blocks of keys, and only blocks that
    differ are read again, shuffled and compared: sides that agree move digests alone. Repeated keys count:
    a key with the same rows more often on one side is `only_left` or `only_right` as often as it is over;
    of keys with different rows the k-th of one side is compared with the k-th of the other.
    """
    rest = [c for c in left.columns if c not in key]
    right = right.select(*left.columns)
    l, r = range_digests(left, key, blocks), range_digests(right, key, blocks)
    two = l.join(r.select("block", *(F.col(c).alias(f"r{c}") for c in ("n", "a", "b"))), "block", "full_outer")
    apart = two.where(~(F.col("n").eqNullSafe(F.col("rn")) & F.col("a").eqNullSafe(F.col("ra")) & F.col("b").eqNullSafe(F.col("rb")))).select("block")
    apart = F.broadcast(apart)  # a number for each of `blocks` blocks at most
    whole = lambda df, sign: df.withColumn("_block", _block(key, blocks)).join(apart, F.col("_block") == F.col("block"), "left_semi").groupBy(*key, *rest).agg(F.count("*").alias("_n")).withColumn("_n", F.col("_n") * sign)
    # rows that are on both sides as often cancel; what is over stays with its number
    over = whole(left, 1).unionByName(whole(right, -1)).groupBy(*key, *rest).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    over = over.select("*", F.explode(F.sequence(F.lit(1), F.abs("_n"))).alias("_i"))
    side = lambda sign, name: over.where(F.col("_n") * sign > 0).select(*key, F.struct(*rest).alias(name), F.row_number().over(Window.partitionBy(*key).orderBy(*rest, "_i")).alias("_k"))
    on = lambda a, b: reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[k]) for k in [*key, "_k"]))
    a, b = side(1, "l").alias("a"), side(-1, "r").alias("b")
    both = a.join(b, on({k: F.col(f"a.{k}") for k in [*key, "_k"]}, {k: F.col(f"b.{k}") for k in [*key, "_k"]}), "full_outer")
    only_left, only_right = F.col("b._k").isNull(), F.col("a._k").isNull()
    differ = F.filter(F.array(*(F.when(~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")), F.lit(c)) for c in rest)), lambda c: c.isNotNull())
    status = F.when(only_left, "only_left").when(only_right, "only_right").otherwise("differs")
    return both.select(*(F.when(only_right, F.col(f"b.{k}")).otherwise(F.col(f"a.{k}")).alias(k) for k in key), status.alias("status"), F.when(status == "differs", F.array_join(differ, ",")).otherwise("").alias("columns"))
