"""Dictionary-compressed web archives, written and read by Spark.

Every page becomes one WARC/1.1 record, compressed as a Zstandard frame of
its own with a dictionary built from a bounded sample of the records.  A file
starts with a skippable frame (0x184D2A5D) that embeds the dictionary, then
come the record frames, so any file can be read alone and any record
decompressed alone.

Files are written by Spark's own text writer (its committer makes a lost
executor's half-written file disappear): a row is the bytes of a frame, and
the line separator is itself an empty skippable frame, which Zstandard
readers pass over.  A task begins a new file, dictionary first, after
``FILE_PACKS`` packs of about ``PACK_BYTES``, so no file outgrows a reader.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes the one with
the smallest page_id holds the payload; the others are ``revisit`` records
that refer to it.

Defined results: a null html counts as empty; smaller and unique payloads are
all responses; rows repeated with the smallest page_id are all responses; a
null page_id is never the smallest unless the whole group has none (then all
are responses); control characters in a url are percent-encoded; an empty
table writes no record.  Extra columns are passed by.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staging_path
from .common import column, slices, task

MIN_REVISIT = 100
SAMPLE_RECORDS = 600
SAMPLE_BYTES = 8192
DICTIONARY_BYTES = 64 << 10
LEVEL = 6
#: Compressed bytes of a pack of records, about, and packs of a file.
PACK_BYTES = 2 << 20
FILE_PACKS = 16
DATE = "2024-01-01T00:00:00Z"

_DICTIONARY_MAGIC = 0x184D2A5D
_SKIPPABLE = range(0x184D2A50, 0x184D2A60)
#: An empty skippable frame, in ASCII: what the text writer puts after every frame.
_SEPARATOR = struct.pack("<II", 0x184D2A50, 0).decode("ascii")
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; with ``refers_to`` a revisit without its payload."""
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    block = _HTTP % len(payload)
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Refers-To: {record_id(refers_to, digest)}", f"WARC-Profile: {_PROFILE}",
                 f"X-Refers-To-Page: {refers_to}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields of one record; the payload's length and digest are those found
    in the block (for a revisit those its headers state)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    h = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(h["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = h["WARC-Payload-Digest"].removeprefix("sha256:")
    length = int(re.search(rb"Content-Length: (\d+)", http).group(1))
    if h["WARC-Type"] == "response":
        if hashlib.sha256(payload).hexdigest() != stated or len(payload) != length:
            raise ValueError(f"payload of {h['WARC-Record-ID']} does not match its digest")
    number = {k: int(h[k]) if k in h else None for k in ("X-Page-Id", "X-Refers-To-Page")}
    return {"page_id": number["X-Page-Id"], "url": h.get("WARC-Target-URI"), "payload_bytes": length,
            "payload_digest": stated, "record_type": h["WARC-Type"], "refers_to": number["X-Refers-To-Page"],
            "payload": payload if h["WARC-Type"] == "response" else None}


def frames(data: memoryview) -> Iterator[bytes]:
    """The records of one archive file, decompressed one by one."""
    reader, at = None, 0
    while at < len(data):
        magic, = struct.unpack_from("<I", data, at)
        if magic in _SKIPPABLE:
            size, = struct.unpack_from("<I", data, at + 4)
            if magic == _DICTIONARY_MAGIC:
                reader = zstandard.ZstdDecompressor(
                    dict_data=zstandard.ZstdCompressionDict(bytes(data[at + 8: at + 8 + size])))
            at += 8 + size
            continue
        one, out = (reader or zstandard.ZstdDecompressor()).decompressobj(), []
        while not one.eof:
            if at >= len(data):
                raise ValueError("archive ends inside a frame")
            piece = data[at: at + 4096]
            out.append(one.decompress(piece))
            at += len(piece)
        at -= len(one.unused_data)
        yield b"".join(out)


# ---------------------------------------------------------------- Spark

def digested(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, payload_digest, first_id): ``first_id`` is the
    page that holds the payload, where a smaller one does."""
    html = F.coalesce(column(pages, "html").cast("string"), F.lit(""))
    rows = pages.select(column(pages, "page_id").cast("long").alias("page_id"), column(pages, "url").alias("url"),
                        html.alias("html"), F.sha2(html, 256).alias("payload_digest"))
    shared = rows.where(F.octet_length("html") >= MIN_REVISIT).groupBy("payload_digest").agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = F.coalesce(F.col("page_id") > F.col("first_id"), F.col("first_id").isNotNull())
    return rows.join(shared, "payload_digest", "left").select(
        "page_id", "url", "html", "payload_digest", F.when(later, F.col("first_id")).alias("first_id"))


def dictionary(pages: DataFrame) -> bytes:
    """A Zstandard dictionary from a bounded sample: the first
    ``SAMPLE_BYTES`` of the ``SAMPLE_RECORDS`` records of least hash."""
    html = F.coalesce(column(pages, "html").cast("string"), F.lit(""))
    id_, url = column(pages, "page_id").cast("long"), column(pages, "url")
    rows = pages.select(id_.alias("page_id"), url.alias("url"), F.substring(html, 1, SAMPLE_BYTES).alias("part"),
                        F.xxhash64(id_, url).alias("h"))
    # the hashes alone first: the tasks send the driver no text that is not in the sample
    last = rows.select("h").orderBy("h").limit(SAMPLE_RECORDS).agg(F.max("h")).first()[0]
    got = rows.where(F.col("h") <= F.lit(last)).orderBy("h", "page_id", "part").limit(SAMPLE_RECORDS).collect()
    samples = [record(r.page_id, r.url, p, hashlib.sha256(p).hexdigest(), None) for r in got
               for p in [r.part.encode()[:SAMPLE_BYTES]]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:            # too little to learn from: the records themselves are the dictionary
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _encode(shared: bytes):
    """Records as packs of about ``PACK_BYTES`` compressed; every
    ``FILE_PACKS``-th pack of a task, which begins a file, leads with the
    dictionary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = struct.pack("<II", _DICTIONARY_MAGIC, len(shared)) + shared if shared else b""
        make = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True,
                                        dict_data=zstandard.ZstdCompressionDict(shared) if shared else None)
        packs, held, size = 0, [lead], 0

        def pack() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["frame"])

        for b in slices(batches, "html"):
            for page_id, url, html, digest, first in zip(*(c.to_pylist() for c in b.columns)):
                held.append(make.compress(record(page_id, url, html.encode(), digest, first)))
                size += len(held[-1])
                if size >= PACK_BYTES:
                    yield pack()
                    packs += 1
                    held, size = [lead if packs % FILE_PACKS == 0 else b""], 0
        if size:
            yield pack()
    return run


def write_archives(pages: DataFrame, path: str) -> None:
    """Write ``pages`` (page_id, url, html) as archive files under ``path``,
    each of at most ``FILE_PACKS`` packs and with the dictionary in front,
    whatever the session says about files; a task without rows writes no
    record."""
    shared = dictionary(pages)
    digested(pages).mapInArrow(task(_encode(shared)), "frame binary").select(F.col("frame").cast("string")).write.option(
        "lineSep", _SEPARATOR).option("maxRecordsPerFile", FILE_PACKS).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archive files under ``path``."""
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
              ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows):
            return pa.RecordBatch.from_pylist(rows, schema=pa.schema(fields))
        for b in batches:
            for content in b.column(0):
                rows, held = [], 0
                for raw in frames(memoryview(content.as_buffer())):
                    rows.append(parse(raw))
                    held += len(raw)
                    if held > 4 << 20:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(
        task(run), "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back."""
    path = staging_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def oracle_sql() -> str:
    return f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first_id FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= {MIN_REVISIT} AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {MIN_REVISIT} AND page_id > first_id THEN first_id END AS refers_to
FROM f"""
