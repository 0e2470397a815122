"""WARC archives with segmented records, written and read by Spark's own readers and writers.

Writing: a record's block is an HTTP response whose body is in chunked transfer framing. A block
longer than `segment` bytes is cut into a first record and continuation records that carry the
origin's identifier and a segment number; the last one carries the total length. Spark's text
writer puts the records into files, its line separator being the end of a WARC record, so tasks
may be retried and any file system will do. A file holds a bounded number of segments.

Reading: files are parsed record by record by Content-Length; continuation records are grouped by
origin, put in the order of their numbers, their lengths checked against the total, and the
chunked framing is decoded. A record whose segments are incomplete or broken has `error` set.

Defined results: a null payload is empty; a null page id is never a reason to revisit or to be
revisited; pages repeated with one id are all written and returned; of them those that carry the
largest id of their payload are all responses.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import set_aside, written

SEGMENT = 1 << 15
CHUNK = 1 << 12
#: Segments in a file at most: with SEGMENT and headers about 35 MB.
PER_FILE = 1000
#: Repeated digests, of 60 bytes each, that are sent to all executors; beyond, a join shuffles.
SMALL = 1 << 17
CRLF = "\r\n"
END = "\r\n\r\n"


def _raw(column: Column) -> Column:
    """Bytes as a string column, unchanged."""
    return column.cast("binary").cast("string")


def _chunked(payload: Column, size: int) -> Column:
    n = F.ceil(F.octet_length(payload) / F.lit(size)).cast("int")
    parts = F.transform(
        F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.concat(F.hex(F.least(F.lit(size), F.octet_length(payload) - i * size)), F.lit(CRLF), _raw(F.substring(payload, i * size + 1, size)), F.lit(CRLF)),
    )
    return F.concat(F.array_join(parts, ""), F.lit("0" + END))


def mark_revisits(pages: DataFrame, key: str, payload: str, least: int = 1000) -> DataFrame:
    """pages plus payload_digest (hex SHA-1), record_type and refers_to.

    Of rows with equal payloads of at least `least` bytes the largest key is the response and the
    others revisit it. Only digests that occur more than once are joined.
    """
    pages = set_aside(pages, "_body", "_share", "_digest", "_winner", "payload_digest", "record_type", "refers_to")
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.withColumn("_body", body).withColumn("payload_digest", F.sha1(F.col("_body")))
    share = F.when(F.col(key).isNotNull() & (F.octet_length("_body") >= least), F.col("payload_digest"))
    winners = pages.select(F.col(key), F.sha1(body).alias("_digest"), F.octet_length(body).alias("_n")).where(F.col(key).isNotNull() & (F.col("_n") >= least))
    winners = winners.groupBy("_digest").agg(F.max(key).alias("_winner"), F.count("*").alias("_copies")).where("_copies > 1").select("_digest", "_winner")
    winners = written(winners, "winners")
    if winners.count() <= SMALL:  # the payloads need not be shuffled then
        winners = F.broadcast(winners)
    rows = rows.withColumn("_share", share).join(winners, F.col("_share") == F.col("_digest"), "left")
    again = F.col("_winner").isNotNull() & (F.col("_winner") != F.col(key))
    return rows.withColumn("record_type", F.when(again, "revisit").otherwise("response")).withColumn("refers_to", F.when(again, F.col("_winner"))).drop("_share", "_digest", "_winner")


def write_warc(pages: DataFrame, path: str, key: str, url: str | None = None, payload: str = "html", segment: int = SEGMENT, chunk: int = CHUNK, per_file: int = PER_FILE, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write one record for each page; copies of a payload become revisit records. Other columns are not read; an empty table gives no records."""
    at = F.col(url).cast("string") if url else F.lit("")
    rows = mark_revisits(pages.select(F.col(key).alias("key"), at.alias("url"), F.col(payload).alias("payload")), "key", "payload")
    revisit = F.col("record_type") == "revisit"
    head = F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Transfer-Encoding: chunked{END}")
    block = F.when(revisit, head).otherwise(F.concat(head, _chunked(F.col("_body"), chunk))).cast("binary")
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20]", "%20")
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(":"), F.monotonically_increasing_id().cast("string"), F.lit(">"))
    rows = rows.select(name.alias("name"), "payload_digest", "record_type", "refers_to", uri.alias("uri"), block.alias("block"))
    n = F.greatest(F.lit(1), F.ceil(F.octet_length("block") / F.lit(segment)).cast("int"))
    cut = rows.withColumn("total", F.octet_length("block")).select("*", F.posexplode(F.sequence(F.lit(0), n - 1)).alias("i", "_at"), n.alias("n"))
    part = F.substring(F.col("block"), F.col("i") * segment + 1, segment)
    more, last = F.col("i") > 0, (F.col("i") > 0) & (F.col("i") == F.col("n") - 1)

    def field(label: str, value: Column, when: Column | None = None) -> Column:
        line = F.concat(F.lit(f"{label}: "), value.cast("string"), F.lit(CRLF))
        return line if when is None else F.when(when, line).otherwise("")

    this = F.when(more, F.concat(F.regexp_replace("name", ">$", ""), F.lit(":"), F.col("i") + 1, F.lit(">"))).otherwise(F.col("name"))
    record = F.concat(
        F.lit("WARC/1.1" + CRLF),
        field("WARC-Type", F.when(more, "continuation").otherwise(F.col("record_type"))),
        field("WARC-Record-ID", this),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", F.col("uri")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest")), ~more),
        field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), (F.col("record_type") == "revisit") & ~more),
        field("WARC-Refers-To-Page", F.coalesce(F.col("refers_to").cast("string"), F.lit("")), (F.col("record_type") == "revisit") & ~more),
        field("WARC-Segment-Number", F.col("i") + 1, F.col("n") > 1),
        field("WARC-Segment-Origin-ID", F.col("name"), more),
        field("WARC-Segment-Total-Length", F.col("total"), last),
        field("Content-Type", F.lit("application/http;msgtype=response"), ~more),
        field("Content-Length", F.octet_length(part)),
        F.lit(CRLF),
        _raw(part),
    )
    cut.select(record.alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", per_file).text(path)


_FIELD = re.compile(rb"^([A-Za-z-]+):[ \t]*(.*?)[ \t]*$", re.M)
RECORD = "record_id string, origin_id string, warc_type string, uri string, digest string, refers_to string, segment int, total long, block binary"


def records_of(data: bytes) -> Iterator[tuple]:
    """The WARC records of a file, in its order; a broken tail raises ValueError."""
    at = 0
    while at < len(data):
        split = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or split < 0:
            raise ValueError(f"no WARC record at byte {at}")
        head = {k.decode().lower(): v.strip().decode() for k, v in _FIELD.findall(data[at:split].replace(b"\r\n", b"\n"))}
        begin = split + 4
        end = begin + int(head["content-length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} has another length than it says")
        yield (
            head["warc-record-id"], head.get("warc-segment-origin-id", head["warc-record-id"]), head["warc-type"], head.get("warc-target-uri"),
            head.get("warc-payload-digest"), head.get("warc-refers-to-page"), int(head.get("warc-segment-number", 0)),
            int(head["warc-segment-total-length"]) if "warc-segment-total-length" in head else None, data[begin:end],
        )
        at = end + 4


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in RECORD.split(", ")]
    for batch in batches:
        for data in batch["content"]:
            yield pd.DataFrame(list(records_of(bytes(data))), columns=names).astype({"segment": "int32", "total": "Int64"})


def dechunked(body: bytes) -> bytes:
    """Decode chunked transfer framing; ValueError where it is broken."""
    out, at = [], 0
    while True:
        eol = body.find(b"\r\n", at)
        if eol < 0:
            raise ValueError("a chunk has no size")
        n = int(body[at:eol].split(b";")[0], 16)
        if n == 0:
            return b"".join(out)
        if body[eol + 2 + n : eol + 4 + n] != b"\r\n":
            raise ValueError("a chunk is cut off")
        out.append(body[eol + 2 : eol + 2 + n])
        at = eol + 4 + n


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        payload, errors = [], []
        for block, error in zip(batch["block"], batch["error"]):
            body = None
            if error is None:
                head, found, rest = bytes(block).partition(b"\r\n\r\n")
                try:
                    body = rest if not re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head.replace(b"\r\n", b"\n")) or not rest else dechunked(rest)
                    error = None if found else "no HTTP header"
                except ValueError as e:
                    error = str(e)
            payload.append(body)
            errors.append(error)
        yield batch.drop(columns=["block", "error"]).assign(payload=payload, error=errors)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row for each logical record: record_id, warc_type, uri, digest, refers_to, payload, error."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    segments = files.mapInPandas(_parse, RECORD)
    # a record without a segment number is whole; only the others are grouped and shuffled
    single = segments.where("segment = 0").select(F.col("record_id"), "warc_type", "uri", "digest", "refers_to", "block", F.lit(None).cast("string").alias("error"))
    joined = segments.where("segment <> 0").groupBy("origin_id").agg(
        F.array_sort(F.collect_list(F.struct("segment", "warc_type", "uri", "digest", "refers_to", "total", "block"))).alias("s")
    )
    first, n = F.col("s")[0], F.size("s")
    total = F.array_max(F.transform("s", lambda x: x.total))
    block = F.array_join(F.transform("s", lambda x: x.block.cast("string")), "").cast("binary")
    gap = F.exists(F.sequence(F.lit(1), n), lambda i: F.col("s")[i - 1].segment != i)
    error = F.when(gap, "segments are missing or repeated").when(total.isNull(), "no total length").when(total != F.octet_length("block"), "total length differs")
    whole = joined.select(F.col("origin_id").alias("record_id"), first.warc_type.alias("warc_type"), first.uri.alias("uri"), first.digest.alias("digest"), first.refers_to.alias("refers_to"), block.alias("block"), "s")
    whole = whole.withColumn("error", error).drop("s").unionByName(single)
    return whole.mapInPandas(_decode, "record_id string, warc_type string, uri string, digest string, refers_to string, payload binary, error string")


def resolve(records: DataFrame) -> DataFrame:
    """records with page_id, payload_bytes and payload_digest; a revisit takes them from its response.

    A record that failed to decode, or a payload that differs from its digest, raises an error.
    """
    rows = records.select(
        F.expr("try_cast(regexp_extract(record_id, '^<urn:page:(-?[0-9]*):', 1) AS bigint)").alias("page_id"),
        F.col("warc_type").alias("record_type"), F.regexp_replace("digest", "^sha1:", "").alias("said"),
        F.expr("try_cast(refers_to AS bigint)").alias("refers_to"), F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("found"), "error",
    )
    bad = F.col("error").isNotNull() | ((F.col("record_type") == "response") & (F.col("found") != F.col("said")))
    rows = rows.withColumn("payload_digest", F.when(bad, F.raise_error(F.concat(F.lit("broken record: "), F.coalesce("error", F.lit("digest differs"))))).otherwise(F.col("said")))
    rows = written(rows.drop("error"), "records")  # without payloads
    firsts = rows.where("record_type = 'response' AND page_id IS NOT NULL").groupBy(F.col("page_id").alias("_page"), F.col("found").alias("_digest")).agg(F.max("payload_bytes").alias("_bytes"))
    joined = rows.join(firsts, (F.col("refers_to") == F.col("_page")) & (F.col("said") == F.col("_digest")), "left")
    size = F.when(F.col("record_type") == "revisit", F.col("_bytes")).otherwise(F.col("payload_bytes"))
    return joined.select("page_id", size.alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
