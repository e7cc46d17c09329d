"""WARC archives: pages out and in, with segments, chunked framing and revisits.

Writing: a page is one ``response`` record, or a ``revisit`` of the page that holds
the same payload.  Blocks above ``SEGMENT`` bytes are cut into a first record and
``continuation`` records.  Records are rows of Spark's text sink, whose line
separator is the record separator of the format, so archives land wherever Spark
writes; each holds a bounded number of records.

Reading: archives are parsed in tasks.  Segments are grouped by the id of the
record they continue, ordered by number, checked against the stated total length
and joined; only segmented records are shuffled.  Chunked framing is decoded and
the payload digest verified.

Defined cases: a null html is an empty payload.  A null url has no target URI.  A
null ``page_id`` is written without the field and read as null; it becomes the
response of its group only if no page of the group has an id.  Rows that repeat id
and payload share a record id; they are all responses or all revisits, and a
segmented one of them is read back once.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm.common import kept, record_batch, slices

#: Payloads from this size on are written once.
REVISIT_FROM = 1000
SEGMENT = 1 << 16
CHUNK = 1 << 13
RECORDS_PER_FILE = 1000
DATE = "2020-01-01T00:00:00Z"
END = b"\r\n\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
PARSED = (
    "record_id string, record_type string, page_id long, payload_digest string, refers_record string, "
    "origin_id string, segment long, total_length long, block binary"
)
_KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, _KINDS[k]) for n, k in (x.split() for x in ddl.split(", "))])


def record_id(page_id: int | None, digest: str, segment: int = 1) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page_id}/{digest}/{segment}')}>"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = (payload[i : i + size] for i in range(0, len(payload), size))
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2


def payload_of(block: bytes) -> bytes:
    """The HTTP body of a response block, without its chunk framing."""
    head, _, body = block.partition(END)
    return dechunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head.replace(b"\r", b"")) else body


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    shown = [f"{k}: {v}" for k, v in fields if v is not None]
    return "\r\n".join(["WARC/1.1", *shown, f"Content-Length: {len(block)}"]).encode() + END + block


def page_records(page_id: int | None, url: str | None, payload: bytes, digest: str, top: int | None) -> list[bytes]:
    """``top``: the page to revisit, or null for a response."""
    target = url and re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    fields = [
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Page-Id", page_id),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if top is not None:
        more = [("WARC-Type", "revisit"), ("WARC-Refers-To", record_id(top, digest)), ("WARC-Profile", IDENTICAL)]
        return [_record(more + fields, HTTP + b"\r\n")]
    block = HTTP + b"Transfer-Encoding: chunked" + END + chunked(payload)
    if len(block) <= SEGMENT:
        return [_record([("WARC-Type", "response"), *fields], block)]
    parts = [block[i : i + SEGMENT] for i in range(0, len(block), SEGMENT)]
    out = [_record([("WARC-Type", "response"), *fields, ("WARC-Segment-Number", 1)], parts[0])]
    for i, part in enumerate(parts[1:], 2):
        out.append(
            _record(
                [
                    ("WARC-Type", "continuation"),
                    ("WARC-Record-ID", record_id(page_id, digest, i)),
                    ("WARC-Date", DATE),
                    ("WARC-Segment-Origin-ID", record_id(page_id, digest)),
                    ("WARC-Segment-Number", i),
                    ("WARC-Segment-Total-Length", len(block) if i == len(parts) else None),
                ],
                part,
            )
        )
    return out


def write_archives(pages: DataFrame, path: str) -> None:
    """Writes ``page_id, url, html`` as WARC records under ``path``, compressed."""
    plain = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= REVISIT_FROM
    tops = plain.filter(large).groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("n"))
    shared = tops.filter("n > 1 AND top IS NOT NULL").select("digest", "top")
    is_top = F.col("page_id").eqNullSafe(F.col("top"))
    planned = plain.join(shared, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(~is_top, F.col("top")).alias("top")
    )
    schema = pa.schema([("value", pa.binary())])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 100):
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            yield record_batch([[r for row in rows for r in page_records(*row)]], schema)

    lines = planned.mapInArrow(records, "value binary").select(F.col("value").cast("string"))
    lines.write.option("lineSep", END.decode()).option("maxRecordsPerFile", RECORDS_PER_FILE).text(
        path, compression="gzip"
    )


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of an archive."""
    whole = []
    while content:  # gzip members, one after the other
        if not content.startswith(b"\x1f\x8b"):
            whole.append(content)
            break
        member = zlib.decompressobj(31)
        whole.append(member.decompress(content))
        content = member.unused_data
    data, at = b"".join(whole), 0
    while at < len(data):
        end = data.index(END, at)
        lines = data[at:end].decode().split("\r\n")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(fields["content-length"])
        start = end + len(END)
        yield fields, data[start : start + size]
        at = start + size + len(END)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, segments apart."""
    schema = _schema(PARSED)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda x: None if x is None else int(x)
        for batch in slices(batches, 1):
            out, size = [], 0
            for f, block in parse(batch.column(0)[0].as_py()):
                digest = f.get("warc-payload-digest")
                out.append(
                    (
                        f["warc-record-id"],
                        f["warc-type"],
                        number(f.get("warc-page-id")),
                        digest and digest.removeprefix("sha1:"),
                        f.get("warc-refers-to"),
                        f.get("warc-segment-origin-id"),
                        number(f.get("warc-segment-number")),
                        number(f.get("warc-segment-total-length")),
                        block,
                    )
                )
                size += len(block)
                if size > 1 << 22:
                    yield record_batch(list(zip(*out, strict=True)), schema)
                    out, size = [], 0
            if out:
                yield record_batch(list(zip(*out, strict=True)), schema)

    files = spark.read.format("binaryFile").load(path).filter(F.col("length") > 0).select("content")
    return files.mapInArrow(rows, PARSED)


def reassembled(records: DataFrame) -> DataFrame:
    """One row per logical record: segments in order, ``complete`` if none is missing."""
    same = ["record_id", "record_type", "page_id", "payload_digest", "refers_record"]
    piece = F.struct("segment", "block")
    whole = records.filter("segment IS NULL").select(*same, F.array(piece).alias("parts"), F.lit(None).cast("long").alias("total"))
    first = lambda c: F.max(F.when(F.col("origin_id").isNull(), F.col(c))).alias(c)
    cut = (
        records.filter("segment IS NOT NULL")
        .withColumn("origin", F.coalesce("origin_id", "record_id"))
        .groupBy("origin")
        .agg(*(first(c) for c in same), F.sort_array(F.collect_set(piece)).alias("parts"), F.max("total_length").alias("total"))
        .select(*same, "parts", "total")
    )
    ddl = "record_id string, record_type string, page_id long, payload_digest string, refers_record string, complete boolean, payload binary"
    schema = _schema(ddl)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 100):
            out = []
            for *head, parts, total in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                block = b"".join(p["block"] for p in parts)
                numbers = [p["segment"] for p in parts]
                complete = numbers == [None] or (numbers == list(range(1, len(numbers) + 1)) and total == len(block))
                payload = payload_of(block) if complete and head[1] == "response" else None
                if payload is not None and hashlib.sha1(payload).hexdigest() != head[3]:
                    complete = False
                out.append((*head, complete, payload))
            yield record_batch(list(zip(*out, strict=True)), schema)

    return whole.union(cut).mapInArrow(join, ddl)


def page_payloads(logical: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, complete`` of each page; a revisit's
    size is that of the response it names."""
    rows = kept(
        logical.select(
            "record_id",
            "record_type",
            "page_id",
            "payload_digest",
            "refers_record",
            "complete",
            F.octet_length("payload").cast("long").alias("payload_bytes"),
        )
    )
    responses = rows.filter("record_type = 'response'")
    named = responses.dropDuplicates(["record_id"]).select(
        F.col("record_id").alias("refers_record"),
        F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("bytes"),
        F.col("complete").alias("found"),
    )
    revisits = rows.filter("record_type = 'revisit'").drop("payload_bytes").join(named, "refers_record", "left")
    shown = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "complete"]
    return responses.withColumn("refers_to", F.lit(None).cast("long")).select(*shown).union(
        revisits.withColumn("complete", F.coalesce("found", F.lit(False)))
        .withColumnRenamed("bytes", "payload_bytes")
        .select(*shown)
    )
