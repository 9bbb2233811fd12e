"""WARC archives: written with revisit records, read by a salvaging reader.

Archives are part files that Spark's text writer commits, so any store works and
a lost executor leaves nothing half written. Every record is a gzip member of its
own. The reader checks each record (member checksum, version line, lengths, end
mark, payload digest); where a check fails it looks for the next place at which a
whole record stands, goes on there and logs the bytes between as a gap.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A member's input; its length then fits in three bytes and the member ends with a zero byte.
MEMBER_BYTES = 8 << 20
_END = b"\r\n\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
RECORDS = (
    "archive string, kind string, offset bigint, length bigint, record_id string, record_type string, "
    "target_uri string, refers_to string, payload_digest string, payload_bytes bigint, payload binary"
)


def record(page_id, url, refers_to, digest: str, length: int, payload: bytes, date: str) -> bytes:
    """One record: a response, or a revisit of ``refers_to`` without the payload."""
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(length)),
    ]
    if url is not None:
        head.append(("WARC-Target-URI", _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is not None:
        head.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        head.append(("WARC-Refers-To", f"<urn:page:{refers_to}>"))
    block = _HTTP + (payload if refers_to is None else b"")
    head.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + _END


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 100,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """One record per row, in archives under ``path``.

    Of rows with equal payloads of ``least_bytes`` or more, those with the
    smallest id are responses and the others revisit it; smaller payloads are
    all responses. A null html is an empty payload, a null url leaves its header
    out, a null id gives an empty record id and never is the one revisited if
    another has an id. Repeated rows give repeated records. Other columns are not
    read; empty input writes no record. Only digests are grouped; the join that
    tells a page its response may be split by Spark where one payload is hot.
    """
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html")
    ).withColumns({"digest": F.sha2("html", 256), "bytes": F.octet_length("html").cast("long")})
    copies = rows.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    copies = copies.where("n > 1 and first is not null").select("digest", "first")
    refers = F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    tagged = rows.join(copies, "digest", "left").select("id", "url", refers.alias("refers"), "digest", "bytes", "html")

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page, url, refers_to, digest, length, html in zip(*(c.to_pylist() for c in batch.columns)):
                raw = record(page, url, refers_to, digest, length, html.encode(), date)
                for at in range(0, len(raw), MEMBER_BYTES):
                    out.append(gzip.compress(raw[at : at + MEMBER_BYTES], 6, mtime=0)[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    # The separator is the zero byte every member ends with.
    tagged.mapInArrow(members, "member binary").select(F.col("member").cast("string")).write.option("lineSep", "\0").text(path)


def _member(data: bytes, at: int) -> tuple[bytes, int]:
    """The content of the gzip member at ``at`` and where it ends."""
    stream, parts, step = zlib.decompressobj(31), [], 8 << 10
    while not stream.eof:
        chunk = data[at : at + step]
        if not chunk:
            raise ValueError("cut off")
        parts.append(stream.decompress(chunk))
        at += len(chunk)
        step = min(4 * step, 1 << 20)
    return b"".join(parts), at - len(stream.unused_data)


def _headers(raw: bytes, at: int) -> tuple[dict[str, str], int]:
    """Headers of the record at ``at``, and where its block starts."""
    end = raw.find(_END, at)
    if end < 0 or not re.match(rb"WARC/1\.[01]\r\n", raw[at : at + 10]):
        raise ValueError("no version line or no end of headers")
    lines = raw[at:end].decode("utf-8").split("\r\n")[1:]
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    if not _is_number(fields.get("content-length", "")):
        raise ValueError("no length")
    if not _is_number(fields.get("x-payload-length", "0")):
        raise ValueError("no number")
    return fields, end + len(_END)


def _is_number(text: str) -> bool:
    """Up to 18 digits of ASCII, which a long holds."""
    return bool(re.fullmatch("[0-9]{1,18}", text))


def _begins_record(data: bytes, at: int) -> bool:
    """Whether a gzip member begins with a version line, from its first bytes."""
    try:
        return zlib.decompressobj(31).decompress(data[at : at + 256], 7).startswith(b"WARC/1.")
    except zlib.error:
        return False


def _record_at(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers and payload of the whole, checked record at ``at``, and where it ends."""
    if data.startswith(b"WARC/", at):
        fields, block = _headers(data, at)
        end = block + int(fields["content-length"])
        body, tail, after = data[block:end], data[end : end + len(_END)], end + len(_END)
    elif not _begins_record(data, at):
        raise ValueError("no record")
    else:
        raw, after = _member(data, at)
        fields, block = _headers(raw, 0)
        end, parts, held = block + int(fields["content-length"]), [raw], len(raw)
        while held < end + len(_END):
            more, after = _member(data, after)
            parts.append(more)
            held += len(more)
        raw = b"".join(parts) if len(parts) > 1 else raw
        body, tail = raw[block:end], raw[end:]
    if tail != _END:
        raise ValueError("no end mark")
    payload = body
    if fields.get("content-type", "").startswith("application/http"):
        payload = body.partition(_END)[2]
    declared = fields.get("warc-payload-digest", "")
    if fields.get("warc-type") != "revisit" and declared.startswith("sha256:"):
        if hashlib.sha256(payload).hexdigest() != declared[7:]:
            raise ValueError("wrong digest")
    return fields, payload, after


def salvage(data: bytes) -> Iterator[tuple[int, int, dict[str, str] | None, bytes]]:
    """Start, end, headers and payload of every whole record; headers are None for a gap."""
    at = lost = 0
    while at < len(data):
        found = _START.search(data, at)
        if not found:
            break
        try:
            fields, payload, after = _record_at(data, found.start())
        except (ValueError, zlib.error):
            at = found.start() + 1
            continue
        if found.start() > lost:
            yield lost, found.start(), None, b""
        yield found.start(), after, fields, payload
        at = lost = after
    if lost < len(data):
        yield lost, len(data), None, b""


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record (``kind`` record) and per quarantined stretch of bytes (``kind`` gap).

    ``payload`` is what the record holds; digest and length are those of the full
    payload, checked for responses, declared for revisits. Empty archives give no
    rows; a file that holds no whole record is one gap. A file is read whole by
    its task, so archives should stay well below an executor's memory (a cell of
    Spark's file reader ends at 2 GB).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, data in zip(batch.column(0), batch.column(1)):
                rows, held = [], 0
                for start, end, head, payload in salvage(data.as_buffer().to_pybytes()):
                    h = head or {}
                    digest = h.get("warc-payload-digest", "").removeprefix("sha256:") or (head and hashlib.sha256(payload).hexdigest())
                    length = int(h.get("x-payload-length", len(payload))) if h.get("warc-type") == "revisit" else len(payload)
                    rows.append(
                        (archive.as_py(), "gap" if head is None else "record", start, end - start, h.get("warc-record-id"),
                         h.get("warc-type"), h.get("warc-target-uri"), h.get("warc-refers-to"), digest, head and length, head and payload)
                    )
                    held += len(payload)
                    if held > 8 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, RECORDS)


_KINDS = [pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split(" ")[0] for x in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _KINDS)], names=names)
