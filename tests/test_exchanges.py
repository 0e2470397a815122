"""What plans exchange and what queries leave on disk: nested rows are not shuffled, files are compressed, nothing grows with pairs."""

import glob
import os
import re

from pyspark.sql import functions as F

from ledgerloom.operators import extract, flatten, quality, state
from ledgerloom.plans import queries as plans
from ledgerloom.sources import fixtures

SF = "/root/testdata/sf0.001"


def exchanges(df):
    """The keys of the exchanges of a plan, a reused one once."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return set(re.findall(r"Exchange (hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\)|RoundRobin\w*|SinglePartition)", text))


def kinds(df):
    return sorted({re.sub(r"#\d+L?|, \d+\)$|\)$", "", e) for e in exchanges(df)})


def test_object_lookup_exchanges_flat_rows_alone(spark):
    """lines by part, then rows by checkpoint; neither nested rows nor states are dealt out again."""
    assert set(kinds(plans.object_lookup(spark, SF))) == {"hashpartitioning(checkpoint_seq", "hashpartitioning(l_partkey"}


def test_object_lookup_keeps_rows_and_finds_the_better_version(spark):
    c = spark.createDataFrame([(1, "t", "a", 3, 4), (1, "u", "a", 3, 9), (1, "v", "b", None, 1), (2, "w", "a", 3, None), (None, "x", "a", 3, 4), (1, "y", None, 3, 4)], "checkpoint_seq long, tx_digest string, object_id string, input_version long, output_version long")
    o = spark.createDataFrame([(1, "a", 3, "old"), (1, "a", 4, "new"), (2, "a", 3, "other"), (1, None, 3, "none"), (None, "a", 4, "none"), (1, "b", None, "none")], "checkpoint_seq long, object_id string, version long, previous_transaction string")
    o = o.select("*", F.lit("k").alias("object_type"), F.lit(None).cast("struct<kind:string,address:string>").alias("owner"), F.lit("c").alias("coin_type"), F.lit(1).alias("balance"))
    got = {r["tx_digest"]: r["previous_transaction"] for r in state.object_lookup(c, o).collect()}
    assert got == {"t": "new", "u": "old", "v": None, "w": "other", "x": None, "y": None}


def test_state_queries_exchange_flat_rows_alone(spark):
    """nothing but lines by part and rows by checkpoint; F16 and F20 add one exchange of combined rows, by object."""
    flat = {"hashpartitioning(checkpoint_seq", "hashpartitioning(l_partkey"}
    for name in ("object_set", "object_changes", "coin_balances", "balance_changes"):
        assert set(kinds(plans.QUERIES[name](spark, SF))) == flat, name
    for name, more in (("touched_ids", {"hashpartitioning(object_id"}), ("holder_balances", {"hashpartitioning(object_id", "hashpartitioning(_groupingexpression, _groupingexpression"})):
        assert {re.sub(r"#\d+L?", "", k) for k in kinds(plans.QUERIES[name](spark, SF))} <= flat | more, name


def made(spark, tag, query):
    """Files of the folders that a query makes for a tag, below spark.checkpoint.dir."""
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = set(glob.glob(f"{base}/{tag}-*"))
    query(spark, SF).collect()
    return [f for d in set(glob.glob(f"{base}/{tag}-*")) - before for f in glob.glob(f"{d}/**/*", recursive=True)]


def test_streams_read_files_written_in_place(spark):
    """the nested input is written compressed where its rows are, in several files, and read in two batches."""
    for query in (plans.live_counts, plans.stream_extract):
        files = made(spark, "nested", query)
        parts = [f for f in files if f.endswith(".parquet")]
        assert len(parts) >= 2 and all(f.endswith(".zstd.parquet") for f in parts)
    batches = [f for f in made(spark, "extracted", plans.stream_extract) if re.search(r"/batch=\d+$", f)]
    assert len(batches) == 2


def test_running_holdings_reads_its_log_in_batches(spark):
    """the log is written compressed where its rows are."""
    parts = [f for f in made(spark, "log", plans.running_holdings) if f.endswith(".parquet")]
    assert len(parts) >= 3 and all(f.endswith(".zstd.parquet") for f in parts)


def test_line_sinks_compress(spark):
    """Lines of JSON take a twentieth of their length on disk."""
    for tag, query in (("append", plans.sink_append_file), ("wrapped", plans.sink_jsonl_wrapped), ("tagged", plans.sink_jsonl_tagged)):
        parts = [f for f in made(spark, tag, query) if re.search(r"/part-[^/]*$", f)]
        assert parts and all(f.endswith(".txt.gz") for f in parts), tag


def test_fan_out_compresses(spark):
    """tables written in one pass are zstd files."""
    parts = [f for f in made(spark, "tables", plans.extract_all_tables) if f.endswith(".parquet")]
    assert parts and all(f.endswith(".zstd.parquet") for f in parts)


def test_committee_that_serves_many_epochs(spark):
    """one committee for several epochs, and signers alike are summed once; the same as with a committee for each epoch."""
    members = spark.createDataFrame([(i, 10 + i) for i in range(20)], "idx int, stake long")
    epochs = spark.range(6).select(F.col("id").alias("epoch"))
    s = spark.range(60).select(F.col("id").alias("seq"), F.floor(F.col("id") / 10).alias("epoch"), F.floor(F.col("id") / 10).alias("sig_epoch"), F.when(F.col("id") % 7 != 0, F.array_repeat((F.col("id") % 3 * 9).cast("int"), 2)).alias("signers"))
    want = quality.signer_stake(s, epochs.crossJoin(members)).collect()
    got = quality.signer_stake(s, members.withColumn("epoch", F.lit(0)), epochs.withColumn("committee", F.lit(0))).collect()
    assert len(got) == 60 and sorted(got) == sorted(want)


def test_committees_are_made_by_all_tasks(spark):
    """AQE sees small rows before the committee is attached, and would put all of them into one task."""
    cp = fixtures.nested_checkpoints(spark, "/root/testdata/sf0.01", ["committee"])
    assert flatten.epoch_committees(cp).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_fan_out_holds_a_committee_in_a_dictionary(spark, tmp_path):
    """a committee's members come again in every epoch; one of more than a page's 20,000 rows made files of plain texts."""
    members = F.transform(F.sequence(F.lit(0), F.lit(29999)), lambda i: F.struct(F.sha2(i.cast("string"), 256).cast("binary").alias("pubkey"), i.cast("decimal(20,0)").alias("stake")))
    cp = fixtures.nested_checkpoints(spark, SF).limit(20).coalesce(1).withColumn("summary", F.col("summary").withField("next_epoch_committee", members))
    extract.fan_out(cp, str(tmp_path / "t"), ["epoch_committees"])
    assert sum(os.path.getsize(f) for f in glob.glob(f"{tmp_path}/t/*/*.parquet")) < 10 << 20
