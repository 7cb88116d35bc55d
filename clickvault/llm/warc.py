"""WARC archives with revisit records for repeated payloads.

Only headers (page_id, payload length, digest) are shuffled by digest: an
aggregate that combines on the map side finds the response of each payload,
and headers of other records with that payload become revisits. Each task then
writes its pages to gzip archives, one member per record, with fresh headers.

Of records with equal payloads of at least ``min_bytes`` bytes, the one with
the largest page_id is the response and the others revisit it; shorter payloads
are all responses. Rows that repeat the response's page_id and payload are
responses too. A null page_id revisits like any other but is never referred to;
null html is an empty payload, a null url is left out of the record. Extra
columns are ignored. No pages: no archives.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.llm.common import Scratch, attempt_name, open_fs, partitions_for

MIN_BYTES = 1000
ARCHIVE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URL = re.compile(r"[\x00-\x20\x7f]")


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(record: str) -> int | None:
    n = record[len("<urn:x-page:") : -1]
    return int(n) if n else None


def record(page_id, url, payload: bytes, refers_to=None, revisit=False, date=DATE) -> bytes:
    """One WARC record, not compressed."""
    sha = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + _URL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += [f"WARC-Payload-Digest: sha1:{sha}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(f) -> dict[str, str]:
    out = {}
    while (line := f.readline().rstrip(b"\r\n")):
        k, _, v = line.decode().partition(": ")
        out[k.lower()] = v
    return out


def read_records(stream):
    """(WARC headers, HTTP headers, payload) of every record of a gzip archive."""
    with gzip.GzipFile(fileobj=stream) as f:
        while line := f.readline():
            if not line.startswith(b"WARC/1."):
                raise ValueError(f"not a WARC record: {line[:40]!r}")
            head = _headers(f)
            block = f.read(int(head["content-length"]))
            if f.read(4) != b"\r\n\r\n":
                raise ValueError("a record does not end where it says")
            if head["warc-type"] == "warcinfo":
                continue
            http, _, payload = block.partition(b"\r\n\r\n")
            fields = dict(x.lower().split(": ", 1) for x in http.decode().split("\r\n")[1:])
            yield head, fields, payload


def revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, digest, refers_to) of the records that revisit another."""
    heads = pages.select("page_id", "digest").where(F.octet_length("html") >= min_bytes)
    first = (heads.groupBy("digest").agg(F.max("page_id").alias("refers_to"),
                                         F.count(F.lit(1)).alias("_n"))
             .where("_n > 1 and refers_to is not null").drop("_n"))
    return (heads.join(first, "digest")
            .where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
            .select("page_id", "digest", "refers_to").distinct())


def _prepared(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"), html.alias("html"),
                        F.sha1(html).alias("digest"))


def _write(root: str, archive_bytes: int):
    info = b"software: clickvault\r\nformat: WARC File Format 1.1\r\n"
    opening = gzip.compress(
        b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x-page:info>\r\nWARC-Date: "
        + DATE.encode() + b"\r\nContent-Type: application/warc-fields\r\nContent-Length: "
        + str(len(info)).encode() + b"\r\n\r\n" + info + b"\r\n\r\n", 4, mtime=0)

    def run(batches):
        fs, base = open_fs(root)
        fs.create_dir(base, recursive=True)
        out, name, n, size = None, None, 0, 0

        def done():
            out.close()
            return pa.RecordBatch.from_pydict(
                {"file": [name], "records": pa.array([n], pa.int64()),
                 "bytes": pa.array([size], pa.int64())})

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in
                    ("page_id", "url", "html", "refers_to", "revisit")]
            for page_id, url, html, refers_to, revisit in zip(*cols):
                if out is None:
                    name, n, size = attempt_name("pages", ".warc.gz"), 0, len(opening)
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    out.write(opening)
                member = gzip.compress(record(page_id, url, html, refers_to, revisit), 4, mtime=0)
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= archive_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return run


def write_archives(pages: DataFrame, root: str, min_bytes: int = MIN_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``root``; the manifest, not yet materialised."""
    p = _prepared(pages)
    r = revisits(p, min_bytes).select(
        F.col("page_id").alias("_p"), F.col("digest").alias("_d"), "refers_to")
    rows = p.join(r, p["page_id"].eqNullSafe(r["_p"]) & (p["digest"] == r["_d"]), "left")
    return rows.select("page_id", "url", "html", "refers_to",
                       F.col("refers_to").isNotNull().alias("revisit")).mapInArrow(
        _write(root, archive_bytes), "file string, records long, bytes long")


def _read(root: str):
    def run(batches):
        fs, base = open_fs(root)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows = []
                with fs.open_input_stream(f"{base}/{name}", compression=None) as f:
                    for head, http, payload in read_records(f):
                        digest = base64.b32decode(head["warc-payload-digest"].split(":")[1])
                        kind = head["warc-type"]
                        if kind == "response" and hashlib.sha1(payload).digest() != digest:
                            raise ValueError(f"payload of {head['warc-record-id']} is damaged")
                        refers = head.get("warc-refers-to")
                        rows.append((page_of(head["warc-record-id"]), int(http["content-length"]),
                                     digest.hex(), kind, page_of(refers) if refers else None,
                                     head.get("warc-target-uri")))
                cols = list(zip(*rows)) or [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (
                        pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(),
                        pa.string()))],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type",
                           "refers_to", "url"])

    return run


def read_archives(manifest: DataFrame, root: str) -> DataFrame:
    """One row per record of the manifest's archives."""
    return manifest.select("file").repartition(
        max(1, partitions_for(manifest.sparkSession))).mapInArrow(
        _read(root), "page_id long, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long, url string")


def write_and_read(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    sc = Scratch(pages.sparkSession, "warc")
    root = sc.uri("archives")
    manifest = sc.write(write_archives(pages, root, min_bytes), "manifest")
    return sc.finish(read_archives(manifest, root))
