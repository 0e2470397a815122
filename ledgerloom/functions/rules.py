"""Scalar rules that the operators share, as Column expressions."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Owners that are an address. Fixed values.
ADDRESS_KINDS = ("AddressOwner", "ConsensusAddressOwner")
#: Owner kinds that carry an id. Fixed values.
NAMED_KINDS = (*ADDRESS_KINDS, "ObjectOwner")
NO_OBJECT = "0x" + "0" * 64
#: Names of transaction kinds. Fixed values; the first two carry commands.
TRANSACTION_KINDS = (
    "ProgrammableTransaction", "ProgrammableSystemTransaction", "ChangeEpoch", "Genesis", "ConsensusCommitPrologue", "ConsensusCommitPrologueV2",
    "ConsensusCommitPrologueV3", "ConsensusCommitPrologueV4", "AuthenticatorStateUpdate", "EndOfEpochTransaction", "RandomnessStateUpdate",
)
PROGRAMMABLE = TRANSACTION_KINDS[:2]


def has_commands(kind: Column) -> Column:
    """Whether a transaction's kind carries commands; false for a missing kind."""
    return F.coalesce(kind.isin(*PROGRAMMABLE), F.lit(False))


def hex_of(value: Column) -> Column:
    return F.lower(F.hex(value))


def owner_id(owner: Column) -> Column:
    """Id of an owner; shared and immutable objects have a kind but no id."""
    return F.when(owner["kind"].isin(*NAMED_KINDS), owner["address"])


def error_kind(error: Column) -> Column:
    """The text before the first bracket or white space."""
    return F.regexp_extract(error, r"^([^({\s]*)", 1)


def first_text(*values: Column) -> Column:
    """The first that is neither null nor empty; else the empty text."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values), F.lit(""))


def first_byte(value: Column, default: int = 255) -> Column:
    """The first byte as a number; null and empty values give the default."""
    return F.coalesce(F.conv(F.nullif(F.substring(F.hex(value), 1, 2), F.lit("")), 16, 10).cast("int"), F.lit(default))


def type_arguments(args: Column) -> Column:
    """JSON-like text, null if there are none; quotes inside are left as they are."""
    return F.when(F.size(args) > 0, F.concat(F.lit('["'), F.array_join(args, '","'), F.lit('"]')))


def command_args(c: Column) -> Column:
    """The summary text of a command by its kind."""
    n1, n2 = c["n1"].cast("string"), c["n2"].cast("string")
    texts = {
        "MoveCall": F.concat(F.lit("arg_count="), n1), "TransferObjects": F.concat(F.lit("object_count="), n1), "SplitCoins": F.concat(F.lit("split_count="), n1),
        "MergeCoins": F.concat(F.lit("merge_count="), n1), "Publish": F.concat(F.lit("module_count="), n1, F.lit(",dep_count="), n2),
        "Upgrade": F.concat(F.lit("module_count="), n1, F.lit(",dep_count="), n2), "MakeMoveVec": F.concat(F.lit("item_count="), n1),
    }
    out = F.lit(None).cast("string")
    for kind, text in texts.items():
        out = F.when(c["kind"] == kind, text).otherwise(out)
    return out


def let(value: Column, use) -> Column:
    """use(value) with value made once for each row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def indexed(entries: Column) -> Column:
    """entries, an array of structs, sorted and with the steps of a search by halving: made once, for find."""
    steps = lambda a: F.transform(F.sequence(F.floor(F.log2(F.greatest(F.size(a), F.lit(1)))).cast("int"), F.lit(0), F.lit(-1)), lambda k: F.pow(F.lit(2), k).cast("int"))
    return let(F.sort_array(entries), lambda a: F.struct(a.alias("a"), steps(a).alias("steps")))


def find(index: Column, value: Column, key: str = "k") -> Column:
    """The first entry of an index whose key, its first field, is value; else null. As many looks as the number of entries has bits."""
    a = index["a"]

    def search(v: Column) -> Column:
        # an index beyond the end gives null, which is not less
        at = F.aggregate(index["steps"], F.lit(0), lambda at, step: F.when(F.get(a, at + step - 1)[key] < v, at + step).otherwise(at))
        return F.get(F.filter(F.array(F.get(a, at)), lambda x: x[key] == v), F.lit(0))  # a filter does not copy what it keeps

    return let(value, search)  # else a value that is computed would be so at every step


#: Lists of the effects in the order in which they tell how an object changed.
CHANGE_LISTS = (("created", "CREATED"), ("mutated", "MUTATED"), ("unwrapped", "UNWRAPPED"), ("deleted", "DELETED"), ("unwrapped_then_deleted", "DELETED"), ("wrapped", "WRAPPED"))


def change_marks(effects: Column) -> Column:
    """Index from an object's id to the first list of the effects that has it, a place in CHANGE_LISTS."""
    none = F.array().cast("array<string>")
    marked = lambda k: lambda i: F.struct(i.alias("k"), F.lit(k).alias("mark"))
    return indexed(F.concat(*(F.transform(F.coalesce(effects[name], none), marked(k)) for k, (name, _) in enumerate(CHANGE_LISTS))))


def published_ids(effects: Column) -> Column:
    return indexed(F.transform(F.coalesce(effects["published"], F.array().cast("array<string>")), lambda i: F.struct(i.alias("k"))))


def change_type(change: Column, version: Column, mark: Column, published: Column, is_package: Column) -> Column:
    """How an object changed: the effects' lists by priority, then the id operation, then the versions.

    mark is the object's place in CHANGE_LISTS. Effects of version 1 have no list of published packages:
    these are the created objects that are packages.
    """
    has_in, has_out = change["input_version"].isNotNull(), change["output_version"].isNotNull()
    out = F.when(F.when(version == 1, F.coalesce(mark == 0, F.lit(False)) & is_package).otherwise(published), "PACKAGE_WRITE")
    for k, (_, kind) in enumerate(CHANGE_LISTS):
        out = out.when(mark == k, kind)
    return (
        out.when(change["id_operation"] == "created", "CREATED").when(change["id_operation"] == "deleted", "DELETED")
        .when(has_in & has_out, "MUTATED").when(has_out, "CREATED").otherwise("DELETED")
    )


def quorum_met(signed: Column, total: Column) -> Column:
    """More than two thirds: 3 * signed >= 2 * total + 1."""
    return signed * 3 >= total * 2 + 1


def subject(prefix: str, table: Column) -> Column:
    """prefix.table, with dots at the end of the prefix taken off."""
    head = prefix.rstrip(".")
    return F.concat(F.lit(f"{head}." if head else ""), table)


#: Digits of base 58 in order. Fixed value.
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


_PAIRS = [a + b for a in BASE58 for b in BASE58]


def base58(data: bytes) -> str:
    """Digits are taken ten at a time from the long number, and by pairs from those."""
    n, out = int.from_bytes(data, "big"), []
    while n:
        n, ten = divmod(n, 58**10)
        for _ in range(5):
            ten, pair = divmod(ten, 3364)
            out.append(_PAIRS[pair])
    return "1" * (len(data) - len(data.lstrip(b"\0"))) + "".join(reversed(out)).lstrip("1")


def summary_digest(raw: bytes) -> str:
    """base58 of BLAKE2b-256 over the type name and the summary's bytes."""
    return base58(hashlib.blake2b(b"CheckpointSummary::" + raw, digest_size=32).digest())


def digest_fill(df: DataFrame, digest_col: str, bytes_col: str) -> DataFrame:
    """Compute digests that are null or empty, in one pass; of rows that have one, Python sees a null."""

    @F.pandas_udf("string")
    def computed(raw: pd.Series) -> pd.Series:
        return raw.map(lambda x: None if x is None else summary_digest(bytes(x)))

    missing = F.coalesce(F.col(digest_col), F.lit("")) == ""
    return df.withColumn(digest_col, F.when(missing, computed(F.when(missing, F.col(bytes_col)))).otherwise(F.col(digest_col)))
