"""WARC archives written with an index, and read back by byte ranges.

Writing comes with the index: for each record its archive, offset, length, URL and
digest. Each record is a gzip member of its own, so a byte range is all it takes to
read one. Reading sorts the index rows of the wanted records by archive and offset,
joins neighbouring ranges into one read, and never scans an archive.

A task writes archives of its own under names no other attempt uses, and the index
rows it returns name them. Archives of failed attempts are named by no index row.
"""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placecount.llm import store
from placecount.session import durable, shared_dir

ARCHIVE_BYTES = 128 << 20
READ_BYTES = 8 << 20
GAP_BYTES = 64 << 10
RANGE_BYTES = 16 << 20
MIN_REVISIT_BYTES = 0

# What WARC 1.1 prescribes.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
# Record ids of pages hold the page's id in their lower half.
_PAGE = 0x7061676500004000

_INDEX = "page_id long, url string, digest string, record_type string, archive string, offset long, length long"
_RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    number = uuid.uuid4() if page_id is None else uuid.UUID(int=(_PAGE << 64) | (page_id & (2**64 - 1)))
    return f"<urn:uuid:{number}>"


def _page_of(record_id: str) -> int | None:
    number = uuid.UUID(record_id.strip("<>").rpartition(":")[2]).int
    if number >> 64 != _PAGE:
        return None
    low = number & (2**64 - 1)
    return low - (1 << 64) if low >> 63 else low


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record; a revisit has the HTTP headers of the payload, but not the payload."""
    revisit = refers_to is not None
    block = (_HTTP % len(payload)).encode() + (b"" if revisit else payload)
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _record_id(page_id),
        "WARC-Date": date,
        # Control characters and spaces could end the header line; the reader undoes this.
        "WARC-Target-URI": None if url is None else quote(url, safe="!#$&'()*+,/:;=?@[]~"),
        "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}",
        "WARC-Profile": _PROFILE if revisit else None,
        "WARC-Refers-To": _record_id(refers_to) if revisit else None,
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """A record's fields. A response whose payload contradicts its digest is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length:"))
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    url = fields.get("WARC-Target-URI")
    refers = fields.get("WARC-Refers-To")
    return {
        "page_id": _page_of(fields["WARC-Record-ID"]),
        "url": None if url is None else unquote(url),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": None if refers is None else _page_of(refers),
        "payload": payload if kind == "response" else None,
    }


def write_archives(
    pages: DataFrame,
    folder: str,
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Archives of ``pages`` (page_id, url, html) below ``folder``; returns the index.

    Of the pages with equal payloads of at least ``min_revisit_bytes`` the one with
    the largest id is a response and the others are revisits of it. Null html is an
    empty payload. A null id is below all others; rows that share the largest id are
    all responses, and so are the rows of a group without any id. Other columns are
    left out.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("sha1"))
    shared = (
        pages.select("page_id", F.sha1(html.cast("binary")).alias("same"), F.octet_length(html).alias("bytes"))
        .where(F.col("bytes") >= min_revisit_bytes)
        .groupBy("same")
        .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    revisits = F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))
    planned = rows.join(shared, F.col("sha1") == F.col("same"), "left").select(
        "page_id", "url", "html", revisits.alias("refers_to")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, archive, offset = None, None, 0
        try:
            for batch in batches:
                index = []
                columns = [batch.column(c) for c in ("page_id", "url", "html", "refers_to")]
                for row in zip(*columns):
                    page_id, url, text, refers_to = (cell.as_py() for cell in row)
                    payload = text.encode()
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = packer.compress(record(page_id, url, payload, refers_to, date)) + packer.flush()
                    if out is None or offset >= archive_bytes:
                        if out is not None:
                            out.close()
                        archive, offset = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                        out = store.create(archive)
                    out.write(member)
                    kind = "response" if refers_to is None else "revisit"
                    index.append((page_id, url, base32_sha1(payload), kind, archive, offset, len(member)))
                    offset += len(member)
                yield _batch(index, _INDEX)
        finally:
            if out is not None:
                out.close()

    return durable(planned.mapInArrow(write, _INDEX))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [part.split() for part in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(values), kinds[kind]) for values, (_, kind) in zip(columns, fields)],
        names=[name for name, _ in fields],
    )


def joined_ranges(rows: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Groups of neighbouring (archive, offset, length) rows, to be read at once."""
    archive, group = None, []
    for name, offset, length in rows:
        end = group[-1][0] + group[-1][1] if group else 0
        near = name == archive and offset - end <= GAP_BYTES and offset + length - group[0][0] <= READ_BYTES
        if group and not near:
            yield archive, group
            group = []
        archive = name
        group.append((offset, length))
    if group:
        yield archive, group


def read_records(index: DataFrame, payload: bool = False) -> DataFrame:
    """The records that the index rows point to, with their payload if asked for."""
    schema = _RECORD + ", payload binary" * payload
    names = [part.split()[0] for part in schema.split(", ")]
    # Tasks by the bytes to be read, which the few bytes of index rows do not tell.
    total = index.agg(F.sum("length")).first()[0] or 0
    ranges = (
        index.select("archive", "offset", "length", F.floor(F.col("offset") / RANGE_BYTES).alias("part"))
        .repartition(max(1, math.ceil(total / RANGE_BYTES)), "archive", "part")
        .sortWithinPartitions("archive", "offset")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            row
            for batch in batches
            for row in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")))
        )
        name, file, found = None, None, []
        try:
            for archive, group in joined_ranges(rows):
                if archive != name:
                    if file is not None:
                        file.close()
                    name, file = archive, store.open_ranges(archive)
                start = group[0][0]
                data = memoryview(file.read_at(group[-1][0] + group[-1][1] - start, start))
                for offset, length in group:
                    fields = parse(zlib.decompress(data[offset - start : offset - start + length], 31))
                    found.append(tuple(fields[c] for c in names))
                    if len(found) == 500:
                        yield _batch(found, schema)
                        found = []
            yield _batch(found, schema)
        finally:
            if file is not None:
                file.close()

    return ranges.mapInArrow(read, schema)


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write all pages, then read every record back through the index."""
    return read_records(write_archives(pages, shared_dir(pages.sparkSession)))
