"""WARC archives: written with segments and chunked framing, read back and put together.

Writing makes one record per page. A block longer than ``SEGMENT_BYTES`` goes on in
continuation records, which may lie in other archives; no archive holds more than
``RECORDS_PER_ARCHIVE`` of them, so that a task never has more than one bounded
archive in memory. Reading finds records by their declared lengths, groups
continuation records by the id of their origin, orders them by segment number,
compares numbers and total length, takes the chunked transfer framing off and
compares the payload's digest.

Pages with equal payloads of at least ``LEAST_BYTES`` are stored once: the largest
page id is the response, the others refer to it. Null html is an empty payload. A
repeated row of the largest id is a response again. Rows without an id revisit the
response, or are responses where no row of the group has an id.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from stratalake.llm.common import in_slices, read, utf8_bytes
from stratalake.session import scratch_path

SEGMENT_BYTES = 32 * 1024
CHUNK_BYTES = 4 * 1024
RECORDS_PER_ARCHIVE = 500
LEAST_BYTES = 1000
SALTS = 32
END = "\r\n\r\n"
PAGES_AT_ONCE = 200
RECORD = pa.schema(
    [
        ("record_id", pa.string()),
        ("origin_id", pa.string()),
        ("segment", pa.int64()),
        ("total_length", pa.int64()),
        ("record_type", pa.string()),
        ("page_id", pa.int64()),
        ("refers_to", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("block", pa.binary()),
    ]
)
PAGE = pa.schema(
    [
        ("page_id", pa.int64()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
        ("problem", pa.string()),
    ]
)


FOUND = pa.schema([*RECORD, *[f for f in PAGE if f.name not in RECORD.names]])


def chunked(payload: bytes) -> bytes:
    """HTTP/1.1 chunked framing."""
    parts = [payload[i : i + CHUNK_BYTES] for i in range(0, len(payload), CHUNK_BYTES)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    parts, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if size < 0 or line + 2 + size > len(body):
            raise ValueError("a chunk does not fit")
        if not size:
            return b"".join(parts)
        parts.append(body[line + 2 : line + 2 + size])
        at = line + 2 + size + 2


def _record(fields: dict[str, object], block: bytes) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in fields.items() if v is not None], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def _url(url: str | None) -> str | None:
    return None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def records_of(page: dict, record_id: str) -> Iterator[bytes]:
    """The records of one page, without the empty lines that end them."""
    payload = (page["html"] or "").encode()
    fields = {
        "WARC-Type": page["record_type"],
        "WARC-Record-ID": record_id,
        "WARC-Date": "2000-01-01T00:00:00Z",
        "WARC-Target-URI": _url(page["url"]),
        "WARC-Payload-Digest": f"sha1:{page['payload_digest']}",
        "Content-Type": "application/http; msgtype=response",
        "Page-ID": page["page_id"],
        "Payload-Length": len(payload),
    }
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if page["record_type"] == "revisit":
        fields |= {
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            "Refers-To-Page-ID": page["refers_to"],
        }
        yield _record(fields, head)
        return
    block = head + chunked(payload)
    pieces = [block[i : i + SEGMENT_BYTES] for i in range(0, len(block), SEGMENT_BYTES)]
    if len(pieces) == 1:
        yield _record(fields, block)
        return
    yield _record(fields | {"WARC-Segment-Number": 1}, pieces[0])
    for number, piece in enumerate(pieces[1:], 2):
        yield _record(
            {
                "WARC-Type": "continuation",
                "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{record_id}#{number}')}>",
                "WARC-Date": fields["WARC-Date"],
                "WARC-Segment-Origin-ID": record_id,
                "WARC-Segment-Number": number,
                "WARC-Segment-Total-Length": len(block) if number == len(pieces) else None,
            },
            piece,
        )


def _make_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, n = TaskContext.get().partitionId(), 0
    for batch in in_slices(batches, PAGES_AT_ONCE):
        made = []
        for page in batch.to_pylist():
            n += 1
            # Unique among the files of this run, as each task's output is taken once.
            made += records_of(page, f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{task}/{n}')}>")
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["value"])


def with_roles(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with digest, record type and the page that a revisit refers to."""
    html = F.coalesce("html", F.lit(""))
    sized = pages.select("page_id", "url", html.alias("html"), F.sha1(html).alias("payload_digest"))
    large = sized.filter(utf8_bytes(F.col("html")) >= LEAST_BYTES).select("page_id", "payload_digest")
    groups = large.groupBy("payload_digest").agg(F.max("page_id").alias("_largest"), F.count(F.lit(1)).alias("_n"))
    # One row per repeated payload, in copies, so that a frequent payload is dealt to many tasks.
    repeated = (
        groups.filter("_n > 1 AND _largest IS NOT NULL")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        .select(F.col("payload_digest").alias("_digest"), "_salt", "_largest")
    )
    salted = sized.withColumn("_pick", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    same = (F.col("payload_digest") == F.col("_digest")) & (F.col("_pick") == F.col("_salt"))
    revisit = F.col("_largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_largest"))
    return salted.join(repeated, same, "left").select(
        "page_id",
        "url",
        "html",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_largest")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, path: str) -> None:
    """Gzipped WARC files; the line end that Spark writes is the end of a record."""
    records = with_roles(pages).mapInArrow(_make_records, "value binary")
    conf, setting = pages.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(setting)
    conf.set(setting, str(PAGES_AT_ONCE))  # pages can be large
    try:
        records.select(F.col("value").cast("string")).write.option("lineSep", END).option("compression", "gzip").option(
            "maxRecordsPerFile", RECORDS_PER_ARCHIVE
        ).text(path)
    finally:
        conf.set(setting, before)


PAGE_RECORDS = ("response", "revisit", "continuation")


class Fields(dict):
    """Header fields by name in any case; None for those that are missing."""

    def __missing__(self, name: str) -> str | None:
        return self.get(name.lower())


def _fields(head: bytes) -> dict[str, str]:
    """Header lines by name; lines without a colon are none."""
    lines = [line.partition(":") for line in head.decode(errors="replace").split("\r\n")]
    return {name.strip().lower(): value.strip() for name, colon, value in lines if colon}


def parse_archive(data: bytes) -> Iterator[dict]:
    """The records that hold pages; others are passed over. What follows a header without a length is not read."""
    at = 0
    while (head_end := data.find(b"\r\n\r\n", at)) >= 0:
        fields = Fields(_fields(data[at:head_end]))
        start = head_end + 4
        if not (fields["Content-Length"] or "").isdigit():
            return
        end = start + int(fields["Content-Length"])
        at = end + len(END)
        if fields["WARC-Type"] not in PAGE_RECORDS:
            continue
        origin = fields["WARC-Segment-Origin-ID"]
        number = lambda name: int(fields[name]) if (fields[name] or "").isdigit() else None  # noqa: B023, E731
        yield {
            "record_id": fields["WARC-Record-ID"],
            "origin_id": origin or (fields["WARC-Record-ID"] if fields["WARC-Segment-Number"] else None),
            "segment": number("WARC-Segment-Number"),
            "total_length": number("WARC-Segment-Total-Length"),
            "record_type": fields["WARC-Type"],
            "page_id": number("Page-ID"),
            "refers_to": number("Refers-To-Page-ID"),
            "payload_digest": (fields["WARC-Payload-Digest"] or "").removeprefix("sha1:") or None,
            "payload_bytes": number("Payload-Length"),
            "block": data[start:end],
        }


def _pages_and_segments(payloads: bool):
    """Reads archives: a page for each record that is whole, the record itself for each that is segmented."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for record in parse_archive(gzip.decompress(content.as_py())):
                    rows.append(record if record["origin_id"] else page_of([record], payloads))
                yield pa.RecordBatch.from_pylist(rows, FOUND)

    return run


def page_of(records: list[dict], payloads: bool = True) -> dict:
    """One page from the records of its origin, in any order; ``problem`` says what does not fit."""
    records = sorted(records, key=lambda r: r["segment"] or 1)
    first, last, problem = records[0], records[-1], None
    block = b"".join(r["block"] for r in records)
    if first["segment"] is not None:
        if [r["segment"] for r in records] != list(range(1, len(records) + 1)) or last["total_length"] is None:
            problem = "segments missing"
        elif len(block) != last["total_length"]:
            problem = "total length"
    page = {k: first[k] for k in ("page_id", "record_type", "refers_to", "payload_digest", "payload_bytes")}
    page |= {"payload": None, "problem": problem}
    if first["record_type"] == "revisit":
        return page
    # What a record says of its payload counts only where the payload was read.
    payload = None if problem else payload_of(block)
    if payload is None:
        return page | {"payload_digest": None, "payload_bytes": None, "problem": problem or "framing"}
    digest = hashlib.sha1(payload).hexdigest()
    # Others write digests in base 32.
    if first["payload_digest"] not in (None, digest, base64.b32encode(bytes.fromhex(digest)).decode()):
        page["problem"] = "digest"
    return page | {"payload": payload if payloads else None, "payload_bytes": len(payload), "payload_digest": digest}


def payload_of(block: bytes) -> bytes | None:
    """What follows the header of an HTTP response, chunks joined where it says so; None if it does not fit."""
    head, end, body = block.partition(b"\r\n\r\n")
    if not end:
        return None
    if "chunked" not in (_fields(head).get("transfer-encoding") or "").lower():
        return body
    try:
        return unchunked(body)
    except (ValueError, IndexError):
        return None


def _joined_pages(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in batch.column("records"):
                yield pa.RecordBatch.from_pylist([page_of(rows.as_py(), payloads)], PAGE)

    return run


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row per page, with its payload if asked for; what is segmented, and only that, is shuffled."""
    files = spark.read.format("binaryFile").load(path).select("content")
    found = files.mapInArrow(_pages_and_segments(payloads), from_arrow_schema(FOUND))
    whole = found.filter("origin_id IS NULL").select(*PAGE.names)
    parts = (
        found.filter("origin_id IS NOT NULL")
        .groupBy("origin_id")
        .agg(F.collect_list(F.struct(*RECORD.names)).alias("records"))
        .select("records")
    )
    return whole.unionByName(parts.mapInArrow(_joined_pages(payloads), from_arrow_schema(PAGE)))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written to archives and read back."""
    path = scratch_path(spark, "archives")
    write_archives(read(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem"]
    return read_archives(spark, path, payloads=False).select(*columns)


OP6_SQL = """
WITH sized AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), grouped AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS largest FROM sized
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN largest END AS refers_to,
       CAST(NULL AS VARCHAR) AS problem
FROM grouped
"""
