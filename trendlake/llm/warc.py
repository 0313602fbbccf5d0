"""WARC archives: written with segments and revisits, read back by segment reassembly.

``write_archives`` turns pages into WARC/1.1 files. A response's HTTP message
uses chunked transfer framing; one longer than ``segment_bytes`` is split into
a first record and continuation records. ``read_archives`` groups the
continuations by the identifier of their origin, orders them by segment
number, verifies the total length and decodes the chunks.

Sizes are bounded: a record has at most ``segment_bytes`` of block, a file at
most ``file_records`` records, so no task holds more than some files, and
reassembly holds one message at a time. Only segmented messages are shuffled.

Defined cases: a NULL payload is empty; a NULL url leaves the header out, line
breaks in a url are percent-encoded; pages without id sort before all others
and come back without id; repeated rows (same id and payload) become records of
their own, each with its own row's url, one of them the response when the id is
the largest of its payload; an empty table gives no files and no rows; further columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from base64 import b32encode
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Workspace

CRLF = b"\r\n"
HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Stands for a missing url in the names of records.
NO_URL = "0" * 32
#: Digits of base 32, in the order of their values, as ``conv`` writes them and as RFC 4648 does.
CONV_DIGITS, BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORDS = (
    "record_id string, record_type string, payload_digest string, refers_to string, origin_id string, "
    "segment int, total_length long, block binary"
)
MESSAGES = "record_id string, record_type string, payload_bytes long, payload_digest string, refers_to string, problem string"


def base32_sha1(content: Column) -> Column:
    """SHA-1 of a binary column as 32 base32 digits: four groups of 40 bits, 8 digits each."""
    digest = F.sha1(content)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), CONV_DIGITS, BASE32_DIGITS)


def plan_records(pages: DataFrame, payload: str = "html", min_bytes: int = 0) -> DataFrame:
    """One row per record to write: who is a response, who revisits whom.

    Payloads are compared by digest in narrow rows; the contents are shuffled
    once, by page, so a payload that a third of all pages share is spread.
    """
    content = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    base = pages.select(
        F.col("page_id").isNotNull().alias("has_id"), F.coalesce("page_id", F.lit(0)).cast("long").alias("pid"),
        base32_sha1(content).alias("digest"), F.octet_length(content).alias("bytes"), "url", content.alias("content"),
        F.coalesce(F.md5(F.col("url").cast("binary")), F.lit(NO_URL)).alias("url_key"),
    )
    keys = ["has_id", "pid", "url_key"]
    best = base.groupBy("digest").agg(F.max(F.struct(*keys)).alias("best"))
    choice = base.select(*keys, "digest").distinct().join(best, "digest")
    rows = base.groupBy(*keys, "digest").agg(
        F.count("*").alias("copies"), F.min("bytes").cast("long").alias("bytes"), F.min("url").alias("url"),
        F.min("content").alias("content"),
    ).join(choice, [*keys, "digest"])
    leads = F.struct(*keys) == F.col("best")
    alone = F.col("bytes") < min_bytes

    def named(has_id: str, pid: str, url_key: str) -> Column:
        return F.concat(F.when(F.col(has_id), F.col(pid).cast("string")).otherwise("null"), F.lit(":"), F.col(url_key))

    name, target = named(*keys), named(*[f"best.{k}" for k in keys])
    copies = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    answers = alone | (leads & (F.col("copy") == 0))
    return copies.select(
        F.when(answers, "response").otherwise("revisit").alias("record_type"), name.alias("name"), "copy",
        F.when(~answers, target).alias("target"), "digest", "bytes", "url", F.when(answers, F.col("content")).alias("content"),
    )


def _chunked(content: bytes, size: int) -> bytes:
    parts = []
    for at in range(0, len(content), size):
        piece = content[at:at + size]
        parts += [b"%x" % len(piece), CRLF, piece, CRLF]
    return b"".join([*parts, b"0", CRLF, CRLF])


def _header(fields: list[tuple[str, object]]) -> bytes:
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields if v is not None) + CRLF


def _records(row, segment_bytes: int, chunk_bytes: int, date: str) -> Iterator[bytes]:
    """The records of one page, without the two line breaks that end a record."""
    own = f"<urn:page:{row.name_}:{row.copy_}>"
    url = None if row.url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row.url)
    common = [("WARC-Target-URI", url), ("WARC-Date", date), ("Content-Type", "application/http;msgtype=response")]
    if row.record_type == "revisit":
        block = HEAD + b"Content-Length: %d\r\n\r\n" % row.bytes
        yield _header([
            ("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common, ("WARC-Profile", PROFILE),
            ("WARC-Payload-Digest", f"sha1:{row.digest}"), ("WARC-Refers-To", f"<urn:page:{row.target}:0>"),
            ("Content-Length", len(block)),
        ]) + block
        return
    block = HEAD + b"Transfer-Encoding: chunked\r\n\r\n" + _chunked(bytes(row.content), chunk_bytes)
    parts = [block[at:at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    for i, part in enumerate(parts, 1):
        split, last = len(parts) > 1, i == len(parts)
        yield _header([
            ("WARC-Type", "response" if i == 1 else "continuation"),
            ("WARC-Record-ID", own if i == 1 else f"{own[:-1]}:{i}>"), *common,
            ("WARC-Payload-Digest", f"sha1:{row.digest}" if i == 1 else None),
            ("WARC-Segment-Origin-ID", own if i > 1 else None), ("WARC-Segment-Number", i if split else None),
            ("WARC-Segment-Total-Length", len(block) if split and last else None), ("Content-Length", len(part)),
        ]) + part


def write_archives(
    plan: DataFrame, folder: str, segment_bytes: int = 16 << 10, chunk_bytes: int = 4 << 10,
    file_records: int = 2_000, date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write the planned records as gzipped WARC files, one line break pair after each record."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.rename(columns={"name": "name_", "copy": "copy_"})
            out, held = [], 0
            for row in batch.itertuples(index=False):
                for record in _records(row, segment_bytes, chunk_bytes, date):
                    out.append(record)
                    held += len(record)
                if held > 4 << 20:
                    yield pd.DataFrame({"record": out})
                    out, held = [], 0
            yield pd.DataFrame({"record": out})

    records = plan.mapInPandas(build, "record binary").select(F.col("record").cast("string").alias("value"))
    records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", file_records).text(folder)


def _parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8").split("\r\n") if stop >= 0 else [""]
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length = int(fields["content-length"])
        yield fields, data[stop + 4:stop + 4 + length]
        at = stop + 4 + length + 4


def decode_message(block: bytes) -> tuple[bytes | None, int, str | None]:
    """Payload, its length, and what is wrong with an HTTP message."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None, 0, "no end of the HTTP header"
    fields = dict((k.strip().lower(), v.strip().lower()) for k, _, v in (x.partition(b":") for x in head.split(CRLF)[1:]))
    if fields.get(b"transfer-encoding") != b"chunked":
        return body, int(fields.get(b"content-length", len(body))), None
    parts, at = [], 0
    while True:
        end = body.find(CRLF, at)
        if end < 0:
            return None, 0, "chunks end early"
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            payload = b"".join(parts)
            return payload, len(payload), None
        parts.append(body[end + 2:end + 2 + size])
        if len(parts[-1]) < size or body[end + 2 + size:end + 4 + size] != CRLF:
            return None, 0, "a chunk is cut off"
        at = end + 4 + size


def _split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in RECORDS.split(", ")]
    for batch in batches:
        for content in batch["content"]:
            content = bytes(content)
            rows = []
            for f, block in _parse(gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content):
                number = f.get("warc-segment-number")
                total = f.get("warc-segment-total-length")
                rows.append((
                    f["warc-record-id"], f["warc-type"], (f.get("warc-payload-digest") or "").removeprefix("sha1:") or None,
                    f.get("warc-refers-to"), f.get("warc-segment-origin-id") or (f["warc-record-id"] if number else None),
                    int(number or 0), int(total) if total else None, block,
                ))
            yield pd.DataFrame(rows, columns=names).astype({"total_length": "Int64"})


def _message(record_id, kind, digest, refers_to, block: bytes, problem: str | None, with_payload: bool) -> tuple:
    payload, length, found = decode_message(block) if problem is None else (None, 0, problem)
    own = digest
    if kind != "revisit" and payload is not None:
        own = b32encode(hashlib.sha1(payload).digest()).decode()
        if digest is not None and digest != own:
            found = "the payload differs from its digest"
    row = (record_id, kind, length, own, refers_to, found)
    return (*row, payload if kind != "revisit" else None) if with_payload else row


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """One row per message of the archives below ``folder``; ``problem`` says what is wrong with it, else NULL.

    The record types are response and revisit; a revisit's length and digest
    come from its headers. ``with_payload`` adds the decoded payload.
    """
    schema = MESSAGES + (", payload binary" if with_payload else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([
                _message(r.record_id, r.record_type, r.payload_digest, r.refers_to, bytes(r.block), None, with_payload)
                for r in b.itertuples(index=False)
            ], columns=names)

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for origin, pieces in zip(b["origin_id"], b["pieces"]):
                pieces = sorted(pieces, key=lambda p: p["segment"])
                block = b"".join(bytes(p["block"]) for p in pieces)
                total = pieces[-1]["total_length"]
                gaps = [p["segment"] for p in pieces] != list(range(1, len(pieces) + 1))
                problem = "a segment is missing or repeated" if gaps or total is None else None
                if problem is None and total != len(block):
                    problem = f"{len(block)} bytes where {total} are declared"
                lead = pieces[0]
                rows.append(_message(origin, lead["record_type"], lead["payload_digest"], lead["refers_to"], block, problem, with_payload))
            yield pd.DataFrame(rows, columns=names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    records = files.select("content").mapInPandas(_split, RECORDS)
    parts = records.where("origin_id is not null").groupBy("origin_id").agg(
        F.collect_list(F.struct("segment", "record_type", "payload_digest", "refers_to", "total_length", "block")).alias("pieces")
    )
    return records.where("origin_id is null").mapInPandas(whole, schema).unionByName(parts.mapInPandas(joined, schema))


def _page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+|null):[0-9a-f]{32}:\d+>$", 1).try_cast("long")


def archive_round_trip(pages: DataFrame, min_bytes: int = 0, **sizes) -> DataFrame:
    """Write all pages, read the archives back, and return what was read, one row per page."""
    work = Workspace(pages.sparkSession, "warc")
    write_archives(plan_records(pages, min_bytes=min_bytes), work.folder("archives"), **sizes)
    read = read_archives(pages.sparkSession, work.folder("archives"))
    sound = F.when(F.col("problem").isNull(), F.col("record_type")).otherwise(F.raise_error(F.col("problem")).cast("string"))
    return read.select(
        _page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
        sound.alias("record_type"), _page_of(F.col("refers_to")).alias("refers_to"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


_DIGITS = " || ".join(
    f"list_aggregate(list_transform(range(8), lambda j: substr('{BASE32_DIGITS}', 1 + "
    f"((('0x' || substr(digest, {1 + 10 * i}, 10))::BIGINT >> (35 - 5 * j)) & 31)::INT, 1)), 'string_agg', '')"
    for i in range(4)
)
OP7_SQL = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS digest,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS best
  FROM pages
)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes, {_DIGITS} AS payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = best THEN NULL ELSE best END AS refers_to
FROM p
"""
