"""WARC archives as chunked record tables.

A payload is written as records of bounded size: the first has the record's own
header, each further chunk is a continuation record with its segment number. So no
step handles more than a chunk of an oversized payload once it has left its row.
Reading splits the archives at the version line into one row per record; what a
record was cut into comes together as rows of record and chunk number, sorted, and a
running SHA-1 goes from chunk to chunk.

No chunk holds the version mark (a payload that does is cut inside it), so the split
is exact for archives written here.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstrata.llm.common import slices
from inkstrata.session import materialize

CHUNK_BYTES = 64 << 10
# A compressed file is read by one task.
RECORDS_PER_FILE = 10_000
SMALL_REVISITS = 1_000_000
_FLUSH_BYTES = 4 << 20

# Fixed values of the format.
_MARK = b"WARC/1.1"
_END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunks(payload: memoryview, size: int) -> Iterator[memoryview]:
    """``payload`` in chunks of at most ``size`` bytes, whole characters, none with the mark in it."""
    at, end = 0, len(payload)
    while True:
        stop = min(at + size, end)
        while stop < end and payload[stop] & 0xC0 == 0x80:
            stop -= 1
        mark = bytes(payload[at:stop]).find(_MARK)
        if mark >= 0:
            stop = at + mark + 5
        yield payload[at:stop]
        at = stop
        if at >= end:
            return


def _line(text: str) -> str:
    """A header value: control characters and the mark's slash as percent escapes."""
    return "".join(c if " " <= c != "\x7f" else f"%{ord(c):02X}" for c in text).replace("WARC/1.1", "WARC%2F1.1")


def _exact(text: str) -> str:
    """A header value that :func:`unquote` gives back as it was."""
    return _line(text.replace("%", "%25"))


def records(number: int, page: str | None, url: str | None, payload: memoryview, digest: str, refers_to: str | None, date: str, size: int) -> Iterator[str]:
    """The records of one page, without the blank lines after them."""

    def record(fields: list[tuple[str, str]], data: memoryview) -> str:
        lines = [f"{name}: {value}" for name, value in [*fields, ("Content-Length", str(len(data)))]]
        return "\r\n".join(["WARC/1.1", *lines]) + _END + str(data, "utf-8")

    own = f"<urn:page:{_line(page or '')}:{digest}>"
    about = [("WARC-Date", date), ("X-Record-Number", str(number))]
    named = [("WARC-Target-URI", _line(url))] if url is not None else []
    shared = [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload)))]
    shared += [("X-Page-Id", _exact(page))] if page is not None else []
    if refers_to is not None:
        other = [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<urn:page:{_line(refers_to)}:{digest}>"), ("X-Refers-To-Page", _exact(refers_to))]
        yield record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *about, *named, *shared, *other], payload[:0])
        return
    first = [("WARC-Type", "response"), ("WARC-Record-ID", own), *about, *named, *shared, ("Content-Type", "text/html; charset=utf-8")]
    parts = chunks(payload, size)
    part, done = next(parts), 0
    if len(part) == len(payload):
        yield record(first, part)
        return
    yield record([*first, ("WARC-Segment-Number", "1")], part)
    for segment, part_ in enumerate(parts, 2):
        done = done or len(part)
        done += len(part_)
        more = [("WARC-Segment-Total-Length", str(len(payload)))] if done == len(payload) else []
        fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]}:{segment}>"), ("WARC-Segment-Origin-ID", own)]
        yield record([*fields, *about, ("WARC-Segment-Number", str(segment)), *more], part_)


def write_archives(pages: DataFrame, path: str, least: int = 0, chunk: int = CHUNK_BYTES, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write ``pages`` (``page_id, url, html``) as gzip-compressed WARC files below ``path``.

    The payload is ``html`` in UTF-8, a null one empty. Of pages with equal payloads of
    at least ``least`` bytes the one with the smallest ``page_id`` is a response, the
    others are revisits of it; all rows of that id are responses, and so are rows
    without an id. A null ``url`` leaves its header out. ``date`` stands for the unknown
    time of capture.
    """
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    own = own.withColumn("digest", F.sha1("payload"))
    sizes = materialize(own.select("page_id", "digest", F.octet_length("payload").alias("size")), "digests")
    firsts = sizes.where(F.col("size") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = sizes.join(firsts, "digest").where("page_id > first").select("page_id", "digest", "first").distinct()
    later = materialize(later, "revisits")
    few = later.count() <= SMALL_REVISITS
    rows = own.join(F.broadcast(later) if few else later, ["page_id", "digest"], "left")
    rows = rows.select(
        F.monotonically_increasing_id().alias("number"),
        F.col("page_id").cast("string"),
        "url",
        F.col("payload").cast("binary"),
        "digest",
        F.col("first").cast("string"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for batch in slices(batches):
            numbers, ids, urls, _, digests, others = (c.to_pylist() if i != 3 else None for i, c in enumerate(batch.columns))
            for row in range(batch.num_rows):
                payload = memoryview(batch.column(3)[row].as_buffer())
                name = base32(bytes.fromhex(digests[row]))
                for record in records(numbers[row], ids[row], urls[row], payload, name, others[row], date, chunk):
                    out.append(record)
                    held += len(record)
                    if held >= _FLUSH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
                        out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    made = rows.mapInArrow(run, "value string")
    made.write.option("lineSep", _END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


_RECORD = "record string, page_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, chunk_no int, data binary"
_KINDS = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.binary()]
_NAMES = ["record", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "chunk_no", "data"]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)], names=_NAMES)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per record: whole ones are checked here and lose their data, parts keep it."""
    for batch in slices(batches):
        rows = []
        for value in batch.column(0).to_pylist():
            head, _, body = value.partition(b"\r\n\r\n")
            if not head:
                continue
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n"))
            size = int(fields["Content-Length"])
            if len(body) < size:
                raise ValueError(f"record {fields['WARC-Record-ID']} is cut short: its payload holds the record mark")
            body = body[:size]
            segment = int(fields.get("WARC-Segment-Number", 0))
            whole = fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"]) + "#" + fields.get("X-Record-Number", "")
            digest = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None
            kind = fields["WARC-Type"]
            length = int(fields["X-Payload-Length"]) if "X-Payload-Length" in fields else None
            if not segment and kind != "revisit":
                found, length = base32(hashlib.sha1(body).digest()), len(body)
                if digest not in (None, found):
                    raise ValueError(f"digest of {whole} does not match its payload")
                digest = found
            page, other = (unquote(fields[name]) if name in fields else None for name in ("X-Page-Id", "X-Refers-To-Page"))
            rows.append((whole, page, length, digest, kind, other, segment, body if segment else None))
        if rows:
            yield _batch(rows)


def _join_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by record and chunk number; one row leaves for each record."""
    head, running, size, at = None, None, 0, 0

    def done() -> tuple:
        if size != head[2] or base32(running.digest()) != head[3]:
            raise ValueError(f"chunks of {head[0]} do not make up its payload")
        return (*head[:6], 0, None)

    for batch in batches:
        rows = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if head is not None and row[0] != head[0]:
                rows.append(done())
                head = None
            if not row[6]:
                rows.append(row)
                continue
            if row[6] == 1:
                head, running, size, at = row, hashlib.sha1(), 0, 0
            if head is None or row[6] != at + 1:
                raise ValueError(f"chunk {at + 1} of {row[0]} is missing")
            running.update(row[7])
            size, at = size + len(row[7]), row[6]
        yield _batch(rows)
    if head is not None:
        yield _batch([done()])


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunked record table of the archives below ``path``.

    ``record, page_id, payload_bytes, payload_digest, record_type, refers_to, chunk_no,
    data``; whole records have chunk number 0 and, once checked, no data.
    """
    lines = spark.read.option("lineSep", _MARK.decode() + "\r\n").text(path)
    return lines.select(F.col("value").cast("binary")).mapInArrow(_parse, _RECORD)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of each record, digests checked.

    Revisits carry the size and digest of the payload they refer to.
    """
    rows = read_chunks(spark, path)
    together = rows.repartition("record").sortWithinPartitions("record", "chunk_no")
    whole = together.mapInArrow(_join_chunks, _RECORD)
    return whole.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def sql() -> str:
    bits = "array_to_string(list_transform(string_split(sha1(html), ''), lambda c: lpad(bin(CAST(instr('0123456789abcdef', c) - 1 AS UTINYINT)), 4, '0')), '')"
    letter = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(list_sum([CAST(substr(bits, 5 * i + j, 1) AS INT) * (1 << (5 - j)) FOR j IN range(1, 6)]) AS BIGINT), 1)"
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
b AS (SELECT page_id, strlen(html) AS payload_bytes, {bits} AS bits, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, array_to_string([{letter} FOR i IN range(0, 32)], '') AS payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM b"""
