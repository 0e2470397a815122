"""Edge cases of rules, ranges, archives, sinks and streams."""

import struct

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from ledgerloom import schemas
from ledgerloom.functions import rules
from ledgerloom.operators import extract, flatten, quality, ranges, state
from ledgerloom.session import scratch
from ledgerloom.sources import archive, records
from ledgerloom.streaming import streams

few = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
U64 = (1 << 64) - 1


def index_of(spark, data):
    return archive.parse_index(spark.createDataFrame([(1, bytearray(data))], "epoch long, content binary"), F.col("epoch"))


@few
@given(st.lists(st.tuples(st.integers(0, U64), st.integers(0, U64), st.integers(0, (1 << 32) - 1)), max_size=8))
def test_index_round_trip(spark, entries):
    got = [(int(r["seq"]), int(r["offset"]), r["length"]) for r in index_of(spark, archive.pack_index(entries)).collect()]
    assert got == entries


@pytest.mark.parametrize("size", [19, 21])
def test_index_of_wrong_size_raises(spark, size):
    with pytest.raises(Exception, match="multiple of 20"):
        index_of(spark, b"x" * size).collect()


def test_index_is_little_endian(spark):
    assert index_of(spark, struct.pack("<QQI", 1, 2, 3)).first()["offset"] == 2


@few
@given(st.sets(st.integers(0, 400), min_size=1, max_size=60))
def test_gap_islands(spark, seqs):
    f = spark.createDataFrame([(s // 100, s) for s in seqs], "epoch long, seq long")
    got = {x for r in ranges.gap_ranges(f).collect() for x in range(r["gap_start"], r["gap_end"] + 1)}
    assert got == set(range(min(seqs), max(seqs))) - seqs


def test_monotone_repeat_is_dropped(spark):
    f = spark.createDataFrame([(s, i) for i, s in enumerate([10, 11, 11, 12, 13])], "seq long, arrival int")
    assert rows(ranges.dedup_frames(f, "arrival")) == [(0, 10), (1, 11), (3, 12), (4, 13)]


def test_inverted_range_is_no_work(spark):
    m = spark.createDataFrame([(0, 0, 99), (1, 100, 199)], "epoch long, first_seq long, last_seq long")
    assert ranges.clip_epoch_ranges(m, 100, 50).count() == 0
    with pytest.raises(ValueError):
        ranges.epoch_range_select(m, m, epoch=1, from_=0, to=3)


def test_unknown_epoch_raises(spark):
    m = spark.createDataFrame([(0, 0, 99)], "epoch long, first_seq long, last_seq long")
    with pytest.raises(Exception, match="no epoch holds 100"):
        ranges.locate_epoch(spark.createDataFrame([(100,)], "seq long"), m).collect()


def test_located_in_buckets_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(ranges, "SMALL", 0)
    monkeypatch.setattr(ranges, "BUCKET", 7)
    m = spark.createDataFrame([(0, 0, 9), (1, 10, 30)], "epoch long, first_seq long, last_seq long")
    got = ranges.locate_epoch(spark.range(31).withColumnRenamed("id", "seq"), m)
    assert rows(got.select("epoch", "seq")) == sorted([(s // 10 if s < 10 else 1, s) for s in range(31)], key=str)


def test_first_n_asserts_density(spark):
    with pytest.raises(Exception, match="not dense"):
        ranges.first_n(spark.createDataFrame([(0, 1), (0, 3)], "epoch long, seq long"), 0, 2).collect()


@pytest.mark.parametrize("kind,address,want", [("AddressOwner", "0xa", "0xa"), ("ObjectOwner", "0xb", "0xb"), ("Shared", "0xc", None), ("Immutable", None, None), ("ConsensusAddressOwner", "0xd", "0xd"), (None, None, None)])
def test_owner(spark, kind, address, want):
    d = spark.createDataFrame([((kind, address),)], "o struct<kind:string,address:string>")
    assert d.select(rules.owner_id(F.col("o"))).first()[0] == want


@pytest.mark.parametrize("text,want", [("InsufficientGas", "InsufficientGas"), ("MoveAbort(x, 1)", "MoveAbort"), ("ObjectTooBig { object_size: 1 }", "ObjectTooBig"), ("A{b", "A"), ("", "")])
def test_error_kind(spark, text, want):
    assert spark.createDataFrame([(text,)], "e string").select(rules.error_kind(F.col("e"))).first()[0] == want


def test_digest_fill(spark):
    d = spark.createDataFrame([(1, None, bytearray(b"a")), (2, "", bytearray(b"a")), (3, "given", bytearray(b"a"))], "i int, digest string, raw binary")
    got = {r["i"]: r["digest"] for r in rules.digest_fill(d, "digest", "raw").collect()}
    assert got[1] == got[2] == rules.summary_digest(b"a") and got[3] == "given"


def test_base58():
    assert rules.base58(b"\0\0hello") == "11Cn8eVZg" and rules.base58(b"") == ""


def test_first_byte_and_subject(spark):
    d = spark.createDataFrame([(bytearray(b"\x03\x01"),), (bytearray(b""),), (None,)], "b binary")
    assert [r[0] for r in d.select(rules.first_byte(F.col("b"))).collect()] == [3, 255, 255]
    assert spark.range(1).select(rules.subject("a.b..", F.lit("t"))).first()[0] == "a.b.t"


CASES = [(None, None, []), (None, ("a", "AddressOwner", 5), [False]), (("a", "AddressOwner", 5), None, [True]), (("a", "AddressOwner", 5), ("a", "AddressOwner", 5), []), (("a", "AddressOwner", 5), ("b", "AddressOwner", 5), [False, True]), (("a", "AddressOwner", 5), ("a", "AddressOwner", 6), [False]), (("a", "Shared", 5), ("a", "AddressOwner", 5), [False])]


@pytest.mark.parametrize("before,after,want", CASES)
def test_coin_balance_cases(spark, before, after, want):
    def thing(s, v):
        return None if s is None else {"object_id": "o", "version": v, "owner": {"kind": s[1], "address": s[0]}, "coin_type": "c", "balance": s[2]}

    objects = [x for x in (thing(before, 1), thing(after, 2)) if x]
    change = {"object_id": "o", "input_version": 1 if before else None, "output_version": 2 if after else None, "id_operation": "none"}
    cp = nested(spark, [{"position": 0, "digest": "t", "effects": {"version": 2, "transaction_digest": "t", "success": True, "changes": [change]}, "objects": objects}])
    got = sorted(r["is_deleted"] for r in state.coin_balances(cp).collect())
    assert got == sorted(want)


def nested(spark, transactions, **more):
    import json

    row = {"sequence_number": 7, "summary": {"epoch": 1, "timestamp_ms": 9}, "transactions": transactions} | more
    schema = spark.createDataFrame([], schemas.CHECKPOINT).schema
    return spark.createDataFrame([(json.dumps(row),)], "j string").select(F.from_json("j", schema).alias("x")).select("x.*")


def test_transaction_without_effects_gives_no_row(spark):
    cp = nested(spark, [{"position": 0, "digest": "t", "kind": "ProgrammableTransaction", "commands": [{"kind": "SplitCoins", "n1": 2}, {"kind": "MoveCall", "package": "p", "n1": 1}]}])
    assert flatten.transactions(cp).count() == 0
    assert [(r["call_index"], r["tx_digest"]) for r in flatten.move_calls(cp).collect()] == [(0, "t")]
    assert [r["args"] for r in flatten.commands(cp).orderBy("command_index").collect()] == ["split_count=2", "arg_count=1"]


def test_events_fall_back_with_blanks(spark):
    cp = nested(spark, [{"position": 0, "digest": "t", "fallback_events": [{"module": "m"}]}])
    r = flatten.events(cp).first()
    assert (r["package_id"], r["module"], r["contents_hex"]) == ("", "m", "")


def test_signature_scheme_fallback(spark):
    cp = nested(spark, [{"position": 0, "digest": "t", "signatures": [], "fallback_signatures": [{"scheme": 2}, {"bytes": "BQ=="}, {}]}])
    assert [r["scheme"] for r in flatten.transaction_signatures(cp).orderBy("index").collect()] == [2, 5, 255]


def test_change_type_priority(spark):
    change = {"object_id": "o", "input_version": 1, "output_version": 2, "id_operation": "none"}
    for lists, want in (({"published": ["o"], "created": ["o"]}, "PACKAGE_WRITE"), ({"created": ["o"], "mutated": ["o"]}, "CREATED"), ({"unwrapped_then_deleted": ["o"]}, "DELETED"), ({"wrapped": ["o"]}, "WRAPPED"), ({}, "MUTATED")):
        cp = nested(spark, [{"position": 0, "digest": "t", "effects": {"version": 2, "transaction_digest": "t", "changes": [change]} | lists}])
        assert state.object_changes(cp).first()["change_type"] == want


def test_object_set_prefers_the_transaction(spark):
    o = lambda owner: {"object_id": "o", "version": 1, "owner": {"kind": "AddressOwner", "address": owner}}
    cp = nested(spark, [{"position": 0, "digest": "t", "objects": [o("inner")]}], objects=[o("outer")])
    assert [r["owner"]["address"] for r in state.object_set(cp).collect()] == ["inner"]


def test_quorum(spark):
    c = spark.createDataFrame([(1, i, 10) for i in range(4)], "epoch long, idx int, stake long")
    s = spark.createDataFrame([(1, 1, 1, [0, 1, 2]), (2, 1, 1, [0, 1]), (3, 1, 1, []), (4, 1, 1, [0, 1, 2, 9]), (5, 1, 2, [0, 1, 2, 3])], "seq long, epoch long, sig_epoch long, signers array<int>")
    got = {r["seq"]: r["passed"] for r in quality.signer_stake(s, c).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_masks_and_names():
    assert records.tables_of(1 << 0 | 1 << 22) == {"checkpoints", "transactions", "coin_balances"}
    assert records.tables_of(None) == set(schemas.TABLES) == set(extract.BUILDERS)
    with pytest.raises(ValueError):
        records.tables_of(["nothing"])


def test_single_table_is_untagged(spark):
    path = scratch(spark, "t")
    records.sink_jsonl_tagged({"a": spark.createDataFrame([(1, None)], "x int, y string")}, path)
    assert [r[0] for r in spark.read.text(path).collect()] == ['{"x":1,"y":null}']
    tables = {n: spark.createDataFrame([(1,)], "x int") for n in "ab"}
    assert {r[0] for r in records.tagged(tables).collect()} == {'{"_table":"a","x":1}', '{"_table":"b","x":1}'}
    assert {r[0] for r in records.wrapped(tables).collect()} == {'{"table":"a","row":{"x":1}}', '{"table":"b","row":{"x":1}}'}


def _varint(n):
    out = b""
    while True:
        out += bytes([n & 127 | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return out


def _field(n, data):
    return _varint(n << 3 | 2) + _varint(len(data)) + data


def test_decode_frames_and_dead_letters(spark):
    import zstandard

    z = zstandard.ZstdCompressor()
    sig = _varint(1 << 3) + _varint(300) + _field(2, b"s" * 48) + _field(3, b"bits")
    good = _varint(1 << 3) + _varint(42) + _field(3, _field(1, _field(2, b"sum"))) + _field(4, sig) + _field(9, b"other")
    short = _field(3, _field(1, _field(2, b"sum"))) + _field(4, _field(2, b"s" * 47) + _field(3, b"b"))
    frames = [(1, z.compress(good)), (2, b""), (3, bytes(4)), (4, bytes(range(256))), (5, z.compress(short)), (6, z.compress(good[:-3]))]
    ok, dead = archive.decode_frames(spark.createDataFrame([(a, bytearray(b)) for a, b in frames], "seq long, content binary"))
    assert [(r["frame_seq"], r["seq"], bytes(r["summary"]), r["sig_epoch"]) for r in ok.collect()] == [(1, 42, b"sum", 300)]
    assert {r["frame_seq"]: bool(r["error"]) for r in dead.collect()} == {2: True, 3: True, 4: True, 5: True, 6: True}


def test_frame_files(spark, tmp_path):
    (tmp_path / "12.binpb.zst").write_bytes(b"x" * 10)
    (tmp_path / "13.binpb.zst").write_bytes(b"x" * 9)
    got = archive.frame_files(spark, str(tmp_path)).select("seq", "length", "is_valid")
    assert sorted(map(tuple, got.collect())) == [(12, 10, True), (13, 9, False)]


def test_epoch_archive_source(spark, tmp_path):
    import zstandard

    z, data, entries = zstandard.ZstdCompressor(), b"", []
    for seq in range(100, 160):
        frame = z.compress(f"frame {seq}".encode())
        entries.append((seq, len(data), len(frame)))
        data += frame
    (tmp_path / "3.zst").write_bytes(data)
    (tmp_path / "3.idx").write_bytes(archive.pack_index(entries))
    spark.dataSource.register(archive.EpochArchive)
    df = spark.read.format("epoch_archive").option("from", 120).option("to", 139).option("runBytes", 100).load(str(tmp_path))
    assert sorted((r["seq"], bytes(r["body"])) for r in df.collect()) == [(s, f"frame {s}".encode()) for s in range(120, 140)]
    assert df.rdd.getNumPartitions() > 1


def _frames(spark, n=9000):
    body = F.concat(F.lit("frame "), F.col("id").cast("string")).cast("binary")
    return archive.compressed(spark.range(100, 100 + n).select(F.floor(F.col("id") / 5000).alias("epoch"), F.col("id").alias("seq"), body.alias("body")))


def test_offsets_over_blocks(spark):
    f = _frames(spark).select("epoch", "seq", "length")
    want, at = {}, {}
    for r in sorted(f.collect(), key=lambda r: r["seq"]):
        offset, rank = at.get(r["epoch"], (0, 0))
        want[r["seq"]] = (offset, rank)
        at[r["epoch"]] = (offset + r["length"], rank + 1)
    assert {r["seq"]: (r["offset"], r["rank"]) for r in ranges.frame_places(f).collect()} == want
    assert f.where("false").count() == ranges.frame_offsets(f.where("false")).count() == 0


@pytest.mark.parametrize("per_part", [1, 5000, 1 << 30])
def test_epoch_files_round_trip(spark, tmp_path, per_part):
    f, path = _frames(spark, 5200 if per_part > 1 else 40).cache(), str(tmp_path / "a")
    archive.sink_epoch_files(f, path, per_part)
    first, last = f.agg(F.min("seq"), F.max("seq")).first()
    got = spark.read.format("epoch_archive").option("runBytes", 4000).load(path).collect()
    assert sorted((r["seq"], bytes(r["body"])) for r in got) == [(s, f"frame {s}".encode()) for s in range(first, last + 1)]
    index = archive.parse_index(spark.read.format("binaryFile").load(f"{path}/0.idx"), F.lit(0)).orderBy("seq").collect()
    assert [int(r["offset"]) for r in index] == [sum(r["length"] for r in index[:k]) for k in range(len(index))]
    assert not [x for x in (tmp_path / "a").iterdir() if not x.name.endswith((".zst", ".idx"))]
    with pytest.raises(Exception, match="FileExistsError"):
        archive.sink_epoch_files(f, path, per_part)
    assert not [x for x in (tmp_path / "a").iterdir() if not x.name.endswith((".zst", ".idx"))]
    archive.sink_epoch_files(f.where("seq < 120"), path, per_part, "overwrite")
    assert spark.read.format("epoch_archive").load(path).where("epoch = 0").count() == 20
    f.unpersist()


def test_ranges_and_gaps_read_few_parts(spark, tmp_path):
    path = f"file://{tmp_path}/a"
    archive.sink_epoch_archive(_frames(spark), path, 5000)
    got = archive.epoch_frames(spark, path, 4990, 5010)
    assert sorted((r["epoch"], r["seq"], bytes(r["body"])) for r in got.collect()) == [(s // 5000, s, f"frame {s}".encode()) for s in range(4990, 5011)]
    plan = got._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "GreaterThanOrEqual(last_seq" in plan
    few = archive.frames_of(spark, path, spark.createDataFrame([(150,), (160,), (160,), (99999,)], "seq long"))
    assert sorted(r["seq"] for r in few.collect()) == [150, 160]
    assert "epoch#" in (plan := few._jdf.queryExecution().toString()) and "PartitionFilters: [isnotnull(epoch" in plan
    assert archive.frames_of(spark, path, spark.range(0).select(F.col("id").alias("seq"))).count() == 0


def test_frame_files_round_trip(spark, tmp_path):
    archive.write_frame_files(spark.createDataFrame([(7, bytearray(b"x" * 12)), (8, bytearray(b"y"))], "seq long, content binary"), f"file://{tmp_path}/f")
    assert sorted(tuple(r) for r in archive.frame_files(spark, f"{tmp_path}/f").select("seq", "length", "is_valid").collect()) == [(7, 12, True), (8, 1, False)]
    with pytest.raises(ValueError, match="mounted"):
        archive.local_path("s3a://bucket/x")


def test_live_stalls(spark, tmp_path):
    import time

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    put = lambda rows: spark.createDataFrame(rows, "feed string, seq long").coalesce(1).write.mode("append").json(src)
    put([("a", 1), ("a", 5), ("b", 2), (None, None)])
    stream = streams.live_stalls(streams.live_source(spark, src, "feed string, seq long", kind="json"), "feed", 3)
    q = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="500 milliseconds").start(out)
    told = lambda: [(r["feed"], r["seq"]) for r in spark.read.schema("feed string, seq long").parquet(out).collect()] if (tmp_path / "out" / "_spark_metadata").exists() else []
    try:
        end = time.time() + 60
        while len(told()) < 3 and time.time() < end:
            time.sleep(0.5)
        assert sorted(told(), key=str) == [("a", 5), ("b", 2), (None, None)]  # each once, without further input
        put([("a", 6)])
        while len(told()) < 4 and time.time() < end:
            time.sleep(0.5)
        assert ("a", 6) in told() and len(told()) == 4
    finally:
        q.stop()


def test_monotone_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    for part in ([10, 11, 11], [11, 12], [9, 13]):
        spark.createDataFrame([("f", s) for s in part], "feed string, seq long").coalesce(1).write.mode("append").json(src)
    stream = streams.live_source(spark, src, "feed string, seq long", kind="json")
    streams.drain(streams.monotone_dedup(stream, "feed"), str(tmp_path / "out"), str(tmp_path / "cp"))
    seqs = [r["seq"] for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(seqs) == sorted(set(seqs)) and 13 in seqs


def test_restart_goes_on_where_it_stood(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    for part in (range(0, 5), range(5, 9)):
        spark.createDataFrame([(s,) for s in part], "seq long").coalesce(1).write.mode("append").json(src)
        streams.drain(streams.live_source(spark, src, "seq long", start_seq=0, kind="json"), out, cp)
    assert sorted(r["seq"] for r in spark.read.parquet(out).collect()) == list(range(9))


def test_failing_sink_fails_the_query(spark, tmp_path):
    spark.createDataFrame([(1,)], "seq long").write.json(str(tmp_path / "in"))

    def fail(df, n):
        raise RuntimeError("no room")

    q = streams.custom_sink(streams.live_source(spark, str(tmp_path / "in"), "seq long", kind="json"), fail, str(tmp_path / "cp"))
    with pytest.raises(Exception, match="no room"):
        q.awaitTermination()


def test_states_are_looked_up_inside_the_row(spark, tmp_path):
    from ledgerloom.operators import state
    from ledgerloom.sources import fixtures

    path = str(tmp_path / "cp")
    fixtures.nested_checkpoints(spark, "/root/testdata/sf0.001", ["objects"]).write.parquet(path)
    cp = spark.read.parquet(path)
    for rows in (state.object_changes(cp), state.coin_balances(cp), state.before_after(cp), state.published_packages(cp)):
        assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


def test_record_layout(spark):
    import json

    from ledgerloom.operators.extract import extract_tables
    from ledgerloom.schemas import LAYOUT, NUMBERS, TABLES
    from ledgerloom.sources import fixtures, records

    assert set(LAYOUT) == set(TABLES)
    tables = extract_tables(fixtures.nested_checkpoints(spark, "/root/testdata/sf0.001", fixtures.PARTS), list(TABLES))
    flags = {"success", "is_gas_object", "is_deleted"}
    seen = set()
    for r in records.union_records({n: df.limit(5) for n, df in tables.items()}).collect():
        row = json.loads(r["row_json"])
        seen.add(r["table"])
        assert list(row) == LAYOUT[r["table"]].split()
        for k, v in row.items():
            assert v is None or isinstance(v, bool if k in flags else int if k in NUMBERS else str), (r["table"], k, v)
    assert seen >= set(TABLES) - {"packages", "package_modules"}
