"""Look-ups in busy rows, one-pass extraction, stakes, parity, manifests and feeds."""

import json
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerloom import schemas
from ledgerloom.operators import extract, quality, state
from ledgerloom.sources import archive, fixtures, records
from ledgerloom.streaming import feed, frame_log, streams

SF = "/root/testdata/sf0.001"


def busy(spark, n):
    """One checkpoint with one transaction that changes n objects, a third created, a third mutated, the rest in no list."""
    state_of = lambda version, balance: f"named_struct('object_id', concat('o', i), 'version', {version}, 'owner', named_struct('kind', 'AddressOwner', 'address', cast(i % 50 AS string)), 'object_type', 'Coin', 'previous_transaction', 'p', 'coin_type', 'c', 'balance', cast({balance} AS decimal(20,0)))"
    df = spark.range(1).selectExpr("id AS sequence_number", f"sequence(0, {n - 1}) AS q").selectExpr(
        "sequence_number", f"flatten(transform(q, i -> array({state_of(1, 'i')}, {state_of(2, 'i + 5')}))) AS objects", "transform(q, i -> named_struct('object_id', concat('o', i), 'input_version', 1L, 'output_version', 2L)) AS changes",
        "transform(filter(q, i -> i % 3 = 0), i -> concat('o', i)) AS created", "transform(filter(q, i -> i % 3 = 1), i -> concat('o', i)) AS mutated",
    )
    effects = "named_struct('version', 2, 'transaction_digest', 't', 'created', created, 'mutated', mutated, 'changes', changes)"
    j = df.selectExpr(f"to_json(named_struct('sequence_number', sequence_number, 'summary', named_struct('epoch', 0, 'timestamp_ms', 1), 'transactions', array(named_struct('position', 0, 'digest', 't', 'objects', objects, 'effects', {effects})))) AS j")
    return j.select(F.from_json("j", schemas.CHECKPOINT).alias("x")).select("x.*")


def test_busy_checkpoint(spark, tmp_path):
    """Four times the changes take about four times as long at most, and sums are made without a shuffle."""
    took = {}
    for n in (1000, 4000, 16000):
        path = str(tmp_path / str(n))
        busy(spark, n).write.parquet(path)
        cp = spark.read.parquet(path)
        for name in ("coin_balances", "balance_changes", "object_changes"):
            began = time.perf_counter()
            getattr(state, name)(cp).write.format("noop").mode("overwrite").save()
            took[name, n] = time.perf_counter() - began
        assert {r["change_type"]: r["n"] for r in state.object_changes(cp).groupBy("change_type").agg(F.count("*").alias("n")).collect()} == {"CREATED": (n + 2) // 3, "MUTATED": n - (n + 2) // 3}
        assert state.coin_balances(cp).count() == n
        net = state.balance_changes(cp)
        assert "Exchange" not in net._jdf.queryExecution().executedPlan().toString()
        assert {int(r["amount"]) for r in net.collect()} == {5 * n // 50}
    for name in ("coin_balances", "balance_changes", "object_changes"):
        assert took[name, 16000] < 4.5 * took[name, 4000] + 1


def test_balance_sums(spark):
    """Runs of one address and coin type, a missing balance, and a net of zero."""
    o = lambda i, v, who, coin, b: {"object_id": i, "version": v, "owner": {"kind": "AddressOwner", "address": who}, "coin_type": coin, "balance": b}
    objects = [o("a", 1, "x", "c", 10), o("a", 2, "x", "c", 4), o("b", 2, "x", "c", 7), o("c", 1, "y", "c", 5), o("c", 2, "z", "c", 5), o("d", 1, "x", "d", 3), o("d", 2, "x", "d", 3), o("e", 2, "w", "c", None)]
    changes = [{"object_id": i, "input_version": a, "output_version": b} for i, a, b in (("a", 1, 2), ("b", None, 2), ("c", 1, 2), ("d", 1, 2), ("e", None, 2))]
    tx = {"position": 0, "digest": "t", "objects": objects, "effects": {"version": 2, "transaction_digest": "t", "changes": changes}}
    line = json.dumps({"sequence_number": 1, "summary": {"epoch": 0, "timestamp_ms": 1}, "transactions": [tx, {"position": 1, "digest": "u"}]})
    cp = spark.createDataFrame([(line,)], "j string").select(F.from_json("j", schemas.CHECKPOINT).alias("x")).select("x.*")
    got = {(r["address"], r["coin_type"]): r["amount"] for r in state.balance_changes(cp).collect()}
    assert got == {("x", "c"): 1, ("y", "c"): -5, ("z", "c"): 5, ("w", "c"): None}


def test_fan_out_is_one_scan_and_the_same_tables(spark, tmp_path):
    path = str(tmp_path / "nested")
    fixtures.nested_checkpoints(spark, SF, fixtures.PARTS).write.parquet(path)
    cp = spark.read.parquet(path)
    plan = extract.tagged_rows(cp)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0")
    out = extract.fan_out(cp, str(tmp_path / "out"))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == before
    apart = extract.extract_tables(cp)
    assert set(out) == set(apart) == set(schemas.TABLES)
    for name, df in apart.items():
        assert out[name].columns == df.columns and [f.dataType for f in out[name].schema] == [f.dataType for f in df.schema], name
        assert rows(out[name]) == rows(df), name
    some = extract.fan_out(cp, str(tmp_path / "some"), ["events", "epoch_committees"])
    assert set(some) == {"events", "epoch_committees"} and some["events"].count() == apart["events"].count()
    assert all(df.count() == 0 for df in extract.fan_out(cp.where("sequence_number < 0"), str(tmp_path / "none")).values())


def test_commands_of_both_programmable_kinds(spark):
    from ledgerloom.operators import flatten

    tx = [{"position": k, "digest": kind, "kind": kind, "commands": [{"kind": "MoveCall", "package": "p", "n1": 1}, {"kind": "Upgrade", "package": "q", "n1": 1, "n2": 2}], "effects": {"version": 2, "success": True}} for k, kind in enumerate(("ProgrammableTransaction", "ProgrammableSystemTransaction", "Genesis"))]
    line = json.dumps({"sequence_number": 1, "summary": {"epoch": 0, "timestamp_ms": 1}, "transactions": tx})
    cp = spark.createDataFrame([(line,)], "j string").select(F.from_json("j", schemas.CHECKPOINT).alias("x")).select("x.*")
    assert flatten.move_calls(cp).count() == 2 and flatten.commands(cp).count() == 4
    assert {r["package"] for r in flatten.commands(cp).where("kind = 'Upgrade'").collect()} == {"q"}
    assert [r["move_call_count"] for r in flatten.transactions(cp).orderBy("position").collect()] == [1, 1, 0]


def test_signers_as_places_or_bitmap(spark):
    committee = spark.createDataFrame([(0, 0, 5), (0, 1, 3), (0, 2, 2), (1, 4, 1), (1, 9, 9)], "epoch long, idx int, stake long")
    cases = [(0, 0, 0, [0, 1]), (1, 0, 0, [0, 0, 2, None]), (2, 0, 0, []), (3, 0, 0, [0, 1, 7]), (4, 0, 1, [0, 1]), (5, 1, 1, [9]), (6, 1, 1, [0, 9]), (7, 5, 5, [0]), (8, 0, 0, None), (9, 0, 0, [-1, 0])]
    s = spark.createDataFrame(cases, "seq long, epoch long, sig_epoch long, signers array<int>")
    out = quality.signer_stake(s, committee)
    got = {r["seq"]: (r["signer_count"], r["unknown_signers"], int(r["signed_stake"]), int(r["total_stake"]), r["passed"]) for r in out.collect()}
    assert got == {0: (2, 0, 8, 10, True), 1: (2, 0, 7, 10, True), 2: (0, 0, 0, 10, False), 3: (3, 1, 8, 10, False), 4: (2, 0, 8, 10, False), 5: (1, 0, 9, 10, True), 6: (2, 1, 9, 10, False), 7: (1, 1, 0, 0, False), 8: (0, 0, 0, 10, False), 9: (2, 1, 5, 10, False)}
    bits = spark.createDataFrame([(0, 0, 0, bytearray([3])), (1, 1, 1, bytearray([16, 2])), (2, 0, 0, bytearray())], "seq long, epoch long, sig_epoch long, signers binary")
    got = {r["seq"]: (r["signer_count"], r["unknown_signers"], int(r["signed_stake"])) for r in quality.signer_stake(bits, committee).collect()}
    assert got == {0: (2, 0, 8), 1: (2, 0, 10), 2: (0, 0, 0)}


def test_one_layout_in_all_sinks(spark, tmp_path):
    cp = fixtures.nested_checkpoints(spark, SF, ["commands", "objects"]).where("sequence_number < 5")
    tables = extract.extract_tables(cp, ["transactions", "coin_balances"])
    want = {(r["table"], r["row_json"]) for r in records.union_records(tables).collect()}
    flat = lambda line: json.loads(line[0])
    as_json = lambda n, row: (n, json.dumps(row, separators=(",", ":"), ensure_ascii=False))
    records.sink_append_file(tables, str(tmp_path / "append"))
    for found in (records.wrapped(tables).collect(), spark.read.text(str(tmp_path / "append")).collect()):
        assert {as_json(flat(r)["table"], flat(r)["row"]) for r in found} == want
    assert {as_json(x.pop("_table"), x) for x in map(flat, records.tagged(tables).collect())} == want
    assert {(r["topic"].removeprefix("p."), r["value"]) for r in records.messages(tables, "p").collect()} == want
    records.sink_jsonl_single(tables, "coin_balances", str(tmp_path / "single"))
    assert {("coin_balances", r[0]) for r in spark.read.text(str(tmp_path / "single")).collect()} == {w for w in want if w[0] == "coin_balances"}


def test_parity_counts_repeats(spark):
    make = lambda data: spark.createDataFrame(data, "k long, v long, w string")
    diff = lambda a, b: rows(quality.parity_diff(make(a), make(b), ["k"]))
    assert diff([(1, 5, "a"), (1, 5, "a")], [(1, 5, "a")]) == [("", 1, "only_left")]
    assert diff([(1, 5, "a")], [(1, 5, "a")] * 3) == [("", 1, "only_right")] * 2
    assert diff([(1, 5, "a"), (1, 6, "a")], [(1, 6, "a"), (1, 7, "b")]) == [("v,w", 1, "differs")]
    assert diff([(None, 1, "a"), (2, None, None)], [(None, 1, "a"), (2, None, "x")]) == [("w", 2, "differs")]
    assert diff([(k, k, "a") for k in range(500)], [(k, k, "a") for k in reversed(range(500))]) == []
    assert diff([], []) == [] and diff([], [(1, 1, "a")]) == [("", 1, "only_right")]


def test_equal_sides_move_digests_alone(spark):
    same = spark.range(2000).selectExpr("id AS k", "repeat('x', 500) AS v")
    out = quality.parity_diff(same, same.orderBy(F.desc("k")), ["k"], blocks=16)
    assert out.count() == 0
    assert quality.range_digests(same, ["k"], 16).count() == 16


def test_manifest_versions(spark, tmp_path):
    row = lambda epoch, count, sha="x": (epoch, epoch * 10, epoch * 10 + 9, count, 5, sha)
    make = lambda *data: spark.createDataFrame(list(data), schemas.MANIFEST)
    store = archive.ManifestStore(spark, f"file://{tmp_path}/manifest")
    assert store.version() == 0 and store.read().count() == 0
    assert store.upsert(make(row(1, 1), row(2, 1))) == 1
    assert store.upsert(make(row(2, 7), row(2, 8), row(3, 1))) == 2
    assert [(r["epoch"], r["count"]) for r in store.read().orderBy("epoch").collect()] == [(1, 1), (2, 8), (3, 1)]
    assert [(r["epoch"], r["count"]) for r in store.read(1).orderBy("epoch").collect()] == [(1, 1), (2, 1)]
    # two writers from one version
    other = archive.ManifestStore(spark, f"file://{tmp_path}/manifest")
    assert store.upsert(make(row(4, 1)), base=2) == 3
    with pytest.raises(archive.ManifestConflict):
        other.upsert(make(row(4, 99)), base=2)
    assert other.upsert(make(row(5, 1))) == 4
    # a writer that dies after its snapshot
    store._stage(make(row(9, 9)))
    assert store.version() == 4 and {r["epoch"] for r in store.read().collect()} == {1, 2, 3, 4, 5}


def files(spark, path, *ranges, **more):
    for a, b in ranges:
        spark.range(a, b).selectExpr("id AS seq", "id * 2 AS v").orderBy(F.desc("seq")).coalesce(1).write.mode("append").parquet(path)


def batches(spark, path, cursor, got, **options):
    def keep(df, n):
        got[n] = [r["seq"] for r in df.select("seq", F.spark_partition_id().alias("p")).collect()]

    q = feed.ordered_source(spark, path, "seq bigint, v bigint", **options).writeStream.foreachBatch(keep).option("checkpointLocation", cursor).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def test_ordered_feed(spark, tmp_path):
    """Bounded batches in order from 0, a gap that is waited for, repeats, and restarts behind the last number."""
    path, cursor, got = str(tmp_path / "in"), str(tmp_path / "cursor"), {}
    files(spark, path, (10, 25), (0, 10), (40, 50))
    batches(spark, path, cursor, got, rows=8)
    assert sum((got[n] for n in sorted(got)), []) == list(range(25)) and max(map(len, got.values())) == 8
    files(spark, path, (20, 40), (0, 3))
    batches(spark, path, cursor, got, rows=8)
    assert sum((got[n] for n in sorted(got)), []) == list(range(50))
    batches(spark, path, cursor, got, rows=8)
    assert sum((got[n] for n in sorted(got)), []) == list(range(50))


def test_ordered_feed_with_gaps(spark, tmp_path):
    path, got = str(tmp_path / "in"), {}
    files(spark, path, (5, 10), (20, 30))
    batches(spark, path, str(tmp_path / "cursor"), got, start_seq=7, rows=100, dense=False)
    assert sum((got[n] for n in sorted(got)), []) == [7, 8, 9, *range(20, 30)]


def test_frontier_over_interleaved_files(spark, tmp_path):
    path = str(tmp_path / "in")
    for k in (0, 1):
        spark.range(0, 40).where(f"id % 2 = {k} AND id <> 31").selectExpr("id AS seq").coalesce(1).write.mode("append").parquet(path)
    r = feed._Reader(spark.read.parquet(path).schema, {"path": path, "rows": "1000"})
    assert r.latestOffset() == {"next": 31}


def test_live_gaps_after_each_batch(spark, tmp_path):
    import random

    rng, path = random.Random(1), str(tmp_path / "in")
    seqs = [s for s in range(3, 120) if s % 9 not in (0, 1)]
    rng.shuffle(seqs)
    parts = [seqs[k::6] + seqs[:2] for k in range(6)]
    out, cursor, so_far = str(tmp_path / "out"), str(tmp_path / "cursor"), set()
    for p in parts:
        spark.createDataFrame([(s, "a") for s in p] + [(7 * len(so_far), None)], "seq long, feed string").coalesce(1).write.mode("append").parquet(path)
        so_far |= set(p)
        streams.drain(streams.live_gaps(streams.live_source(spark, path, "seq bigint, feed string"), "feed"), out, cursor)
        now = spark.read.parquet(out).groupBy("gap_start", "gap_end").agg(F.sum(F.when(F.col("opened"), 1).otherwise(-1)).alias("n")).where("n <> 0").collect()
        assert all(r["n"] == 1 for r in now)
        missing = set(range(min(so_far), max(so_far))) - so_far
        assert {x for r in now for x in range(r["gap_start"], r["gap_end"] + 1)} == missing
        assert all(r["gap_start"] - 1 not in missing and r["gap_end"] + 1 not in missing for r in now)


def test_filters_reach_the_archive(spark, tmp_path, monkeypatch):
    import builtins

    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, IsNotNull, LessThan

    path = str(tmp_path / "a")
    frames = spark.range(400).selectExpr("id div 100 AS epoch", "id AS seq", "cast(repeat('x', 50 + id % 7) AS binary) AS body")
    archive.sink_epoch_files(archive.compressed(frames), path, 1 << 10)
    df = spark.read.format("epoch_archive").load(path)
    assert [r["seq"] for r in df.where("seq >= 150 AND seq < 153").orderBy("seq").collect()] == [150, 151, 152]
    assert df.where("epoch = 2").count() == 100 and df.where("epoch IN (1, 3) AND seq > 290").count() == 100
    assert df.where("seq IN (5, 399)").count() == 2 and df.where("seq > 10 AND seq < 10").count() == 0
    assert df.where("epoch <> 2").count() == 300 and df.where("seq % 50 = 0").count() == 8
    plan = df.where("seq >= 150 AND seq < 153")._jdf.queryExecution().optimizedPlan().toString()
    assert "seq" in plan and ">=" not in plan and "<" not in plan  # nothing but a null check is left to Spark

    opened, real = [], builtins.open
    monkeypatch.setattr(builtins, "open", lambda f, *a, **k: (opened.append(str(f)), real(f, *a, **k))[1])
    reader = archive._ArchiveReader({"path": path})
    kept = IsNotNull(("seq",))
    assert list(reader.pushFilters([kept, EqualTo(("epoch",), 1), GreaterThanOrEqual(("seq",), 150), LessThan(("seq",), 153), In(("epoch",), (1, 2))])) == [kept]
    runs = reader.partitions()
    assert {r.epoch for r in runs} == {1} and sum(r.b - r.a for r in runs) == 3
    assert [f.rsplit("/", 1)[1] for f in opened] == ["1.idx"]


def test_holdings_after_each_batch(spark, tmp_path):
    import random

    rng, path, out, cursor = random.Random(2), str(tmp_path / "log"), str(tmp_path / "out"), str(tmp_path / "cursor")
    shape = "object_id string, checkpoint_seq long, position int, is_deleted boolean, owner_id string, coin_type string, balance decimal(20,0)"
    used = set()
    for b in range(5):
        data = []
        for _ in range(30):
            r = (f"o{rng.randrange(12)}", rng.randrange(b * 5, b * 5 + 9), rng.randrange(3), rng.random() < 0.3, rng.choice("xyz"), rng.choice("cd"), Decimal(rng.randrange(50)))
            if r[:4] not in used:  # one row a change, as in a log; some come later than newer ones
                used.add(r[:4])
                data.append(r)
        spark.createDataFrame(data, shape).coalesce(1).write.mode("append").parquet(path)
        streams.running_holdings(spark.readStream.schema(shape).parquet(path), out, cursor, fold=2).awaitTermination()
        want = {(r["owner_id"], r["coin_type"]): (int(r["balance"]), r["coins"]) for r in state.holder_balances(spark.read.parquet(path)).collect()}
        assert {(r["owner_id"], r["coin_type"]): (int(r["balance"]), r["coins"]) for r in streams.holdings_now(spark, out).collect()} == want
        assert [int(r["balance"]) for r in streams.holdings_now(spark, out, 2).collect()] == sorted((v[0] for v in want.values()), reverse=True)[:2]


def _framed(spark, first, last):
    import zstandard

    z = zstandard.ZstdCompressor()
    return spark.createDataFrame([(s // 40, s, bytearray(z.compress(b"body %d" % s))) for s in range(first, last)], "epoch bigint, seq bigint, content binary")


def _bodies(df):
    return sorted((r["epoch"], r["seq"], bytes(r["body"])) for r in df.collect())


def test_frame_log_survives_kills(spark, tmp_path):
    """Killed before its commit a batch leaves parts that do not count; killed after it, the batch is run again and adds nothing."""
    source, out, cursor = (str(tmp_path / n) for n in ("in", "out", "cursor"))

    def run():
        stream = spark.readStream.schema("epoch bigint, seq bigint, content binary").option("maxFilesPerTrigger", 1).parquet(source)
        frame_log.sink_frame_log(stream, out, cursor, per_part=200).awaitTermination()

    def expected(n):
        return [(s // 40, s, b"body %d" % s) for s in range(n)]

    _framed(spark, 0, 60).coalesce(1).write.mode("append").parquet(source)
    run()
    assert _bodies(frame_log.logged_frames(spark, out)) == expected(60)
    _framed(spark, 60, 100).coalesce(1).write.mode("append").parquet(source)
    run()
    places = {(r.part, r.begin, r.rank) for r in frame_log.log_of(spark, out).collect()}
    log = tmp_path / "out" / "log"
    assert sorted(p.name for p in log.glob("*.json")) == ["0-feed-0.json", "1-feed-1.json"]

    def forget():  # what Spark knows of batch 1 having ended
        for name in ("1", ".1.crc"):
            (tmp_path / "cursor" / "commits" / name).unlink()

    forget()  # killed after the commit: Spark runs the batch again
    run()
    assert _bodies(frame_log.logged_frames(spark, out)) == expected(100)
    assert {(r.part, r.begin, r.rank) for r in frame_log.log_of(spark, out).collect()} == places
    orphans = len(list((tmp_path / "out" / "parts").glob("*.parquet")))

    forget()  # killed before it: parts are there, the log does not name them
    (log / "1-feed-1.json").unlink()
    assert _bodies(frame_log.logged_frames(spark, out)) == expected(60)
    run()
    assert len(list((tmp_path / "out" / "parts").glob("*.parquet"))) > orphans
    assert _bodies(frame_log.logged_frames(spark, out)) == expected(100)
    assert _bodies(frame_log.logged_frames(spark, out, 55, 63)) == expected(100)[55:64]


def test_frame_log_is_an_archive(spark, tmp_path):
    source, out, cursor, packed = (str(tmp_path / n) for n in ("in", "out", "cursor", "packed"))
    _framed(spark, 0, 130).repartition(3).write.parquet(source)
    stream = spark.readStream.schema("epoch bigint, seq bigint, content binary").option("maxFilesPerTrigger", 2).parquet(source)
    frame_log.sink_frame_log(stream, out, cursor, per_part=300).awaitTermination()
    frame_log.logged_parts(spark, out).write.partitionBy("epoch").parquet(packed)
    assert _bodies(archive.epoch_frames(spark, packed, 30, 90)) == [(s // 40, s, b"body %d" % s) for s in range(30, 91)]
    by_epoch = {}
    for r in archive.archive_index(spark, packed).collect():
        by_epoch.setdefault(r.epoch, []).append((r.offset, r.length))
    for found in by_epoch.values():  # frames stand one behind the other
        found.sort()
        assert [o for o, _ in found] == [sum(n for _, n in found[:k]) for k in range(len(found))]


def test_frame_log_refuses_nulls(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, None, bytearray(b"x"))], "epoch bigint, seq bigint, content binary").write.parquet(source)
    stream = spark.readStream.schema("epoch bigint, seq bigint, content binary").parquet(source)
    with pytest.raises(Exception, match="needs an epoch"):
        frame_log.sink_frame_log(stream, str(tmp_path / "out"), str(tmp_path / "cursor")).awaitTermination()
    assert not list((tmp_path / "out").glob("log/*.json"))
