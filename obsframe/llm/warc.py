"""WARC archives: one gzip member per record, written by tasks and read back record by record."""

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.workspace import materialize, new_path

CHUNK = 64 << 10
ARCHIVE_BYTES = 64 << 20
REVISIT_FROM = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_TARGET = "urn:none"
DATE = "1970-01-01T00:00:00Z"


class WarcError(ValueError):
    """An archive that cannot be read as written."""


# Records.

def record_id(key: int | None) -> str:
    return f"<urn:record:{'' if key is None else key}>"


def key_of(record: str) -> int | None:
    key = record.strip("<>").rpartition(":")[2]
    return int(key) if key else None


def target(url: str | None) -> str:
    """A header value: no blanks, no line breaks, nothing but ASCII."""
    return quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else NO_TARGET


def digest(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def encode_record(
    record: str, url: str | None, payload: bytes, payload_digest: str, payload_bytes: int, refers_to: str | None,
) -> bytes:
    """A response, or a revisit with the HTTP headers alone where ``refers_to`` is given; as one gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    headers = {
        "WARC-Type": "revisit" if refers_to else "response",
        "WARC-Record-ID": record,
        "WARC-Date": DATE,
        "WARC-Target-URI": target(url),
        "WARC-Payload-Digest": payload_digest,
        "WARC-Block-Digest": digest(block),
        **({"WARC-Refers-To": refers_to, "WARC-Profile": PROFILE} if refers_to else {}),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 6, mtime=0)


# Reading.

def members(stream: BinaryIO) -> Iterator[Iterator[bytes]]:
    """The gzip members of a stream, each as pieces of decompressed bytes, read and inflated bit by bit.

    A member is to be read to its end before the next one is asked for.
    """
    left = stream.read(CHUNK)

    def pieces() -> Iterator[bytes]:
        nonlocal left
        inflate = zlib.decompressobj(zlib.MAX_WBITS | 16)
        while True:
            if not left:
                raise WarcError("the archive ends within a record")
            try:
                piece = inflate.decompress(left, CHUNK)
            except zlib.error as error:
                raise WarcError(f"not a gzip member: {error}") from error
            left = inflate.unconsumed_tail
            if inflate.eof:
                left = inflate.unused_data or stream.read(CHUNK)
                if piece:
                    yield piece
                return
            left = left or stream.read(CHUNK)
            if piece:
                yield piece

    while left:
        yield pieces()


class Framed:
    """Lines and counted bytes of one member's pieces."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held = pieces, bytearray()

    def fill(self) -> bool:
        piece = next(self.pieces, None)
        self.held += piece or b""
        return piece is not None

    def line(self) -> bytes:
        while (end := self.held.find(b"\r\n")) < 0:
            if not self.fill():
                raise WarcError("a header without end")
        found = bytes(self.held[:end])
        del self.held[: end + 2]
        return found

    def body(self, length: int) -> Iterator[bytes]:
        while length:
            if not self.held and not self.fill():
                raise WarcError("a block shorter than its Content-Length")
            piece = bytes(self.held[:length])
            del self.held[: len(piece)]
            length -= len(piece)
            yield piece

    def finish(self) -> None:
        while self.fill():
            pass
        if self.held != b"\r\n\r\n":
            raise WarcError("a block longer than its Content-Length")


def read_headers(framed: Framed) -> dict[str, str]:
    headers = {}
    while line := framed.line():
        name, colon, value = line.decode().partition(":")
        if not colon:
            raise WarcError(f"no header: {name[:80]}")
        headers[name.strip().lower()] = value.strip()
    return headers


def read_record(pieces: Iterator[bytes], with_payload: bool = True) -> tuple[dict[str, str], int, bytes | None]:
    """(headers, bytes of the full payload, payload) of a record; raises if a length or a digest is not kept.

    A revisit has no payload of its own (None), its length comes from the HTTP headers.
    """
    framed = Framed(pieces)
    if framed.line() != b"WARC/1.1":
        raise WarcError("no WARC record")
    headers = read_headers(framed)
    revisit = headers["warc-type"] == "revisit"
    block, payload, kept, length, http, seen = hashlib.sha256(), hashlib.sha256(), [], 0, b"", False
    for piece in framed.body(int(headers["content-length"])):
        block.update(piece)
        if not seen:
            http, seen, piece = (http + piece).partition(b"\r\n\r\n")
            if not seen:
                continue
            if revisit and piece:
                raise WarcError("a revisit with a payload")
        payload.update(piece)
        length += len(piece)
        if with_payload:
            kept.append(piece)
    framed.finish()
    if not seen:
        raise WarcError("no HTTP headers")
    said = int(dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])[b"Content-Length"])
    if "sha256:" + block.hexdigest() != headers["warc-block-digest"]:
        raise WarcError(f"block digest of {headers['warc-record-id']}")
    if not revisit and (said != length or "sha256:" + payload.hexdigest() != headers["warc-payload-digest"]):
        raise WarcError(f"payload of {headers['warc-record-id']}")
    return headers, said, None if revisit or not with_payload else b"".join(kept)


# Spark.

def plan_records(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """(key, url, payload, payload_digest, payload_bytes, refers_to), a row per page.

    Of the pages with one payload of at least 100 bytes the one with the smallest key is stored, the others refer to
    it. A NULL body is an empty payload. Pages with a NULL key refer to others and are not referred to; rows that
    repeat the smallest key are all stored. Other columns of ``pages`` are not looked at.
    """
    payload = F.coalesce(F.col(body), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), payload.alias("payload")).select(
        "*", F.sha2("payload", 256).alias("sha"), F.octet_length("payload").cast("bigint").alias("payload_bytes"),
    )
    first = rows.where(F.col("payload_bytes") >= REVISIT_FROM).groupBy("sha").agg(
        F.min("key").alias("first"), F.count("*").alias("pages")
    ).where(F.col("pages") > 1).select("sha", "first")
    # Only payloads that repeat have a row to meet; a hot one is split by adaptive execution.
    joined = rows.join(first, "sha", "left")
    return joined.select(
        "key", "url", "payload", F.concat(F.lit("sha256:"), "sha").alias("payload_digest"), "payload_bytes",
        F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
    )


def write_archives(records: DataFrame, folder: str, most_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write planned records below ``folder``: (path, records, bytes) per archive.

    A task writes archives of about ``most_bytes`` under names of its own, so one that is tried again after a lost
    executor leaves whole files only in the table returned, which is what to read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        out, path, count, size = None, "", 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path, count, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{root}/{path}", compression=None)
                refers = None if row["refers_to"] is None else record_id(row["refers_to"])
                member = encode_record(
                    record_id(row["key"]), row["url"], row["payload"], row["payload_digest"], row["payload_bytes"], refers,
                )
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= most_bytes:
                    out.close()
                    out = None
                    yield archive(path, count, size)
        if out is not None:
            out.close()
            yield archive(path, count, size)

    def archive(path: str, count: int, size: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"path": [f"{folder}/{path}"], "records": [count], "bytes": [size]})

    return materialize(records.mapInArrow(run, "path string, records bigint, bytes bigint"), "archives")


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """(key, url, record_type, refers_to, payload_digest, payload_bytes, payload) of every record, in archive order.

    A record is read as a stream and checked by its lengths and digests; the first that fails, or an archive that
    does not hold as many records as were written, fails the job. ``payload`` of a revisit is NULL.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = fs.FileSystem.from_uri(row["path"])
                with system.open_input_stream(path, compression=None) as stream:
                    found, held, count = [], 0, 0
                    for member in members(stream):
                        headers, length, payload = read_record(member, with_payload)
                        count += 1
                        found.append(row_of(headers, length, payload))
                        held += len(payload or b"") + 500
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(found, schema)
                            found, held = [], 0
                    if count != row["records"]:
                        raise WarcError(f"{row['path']} has {count} records of {row['records']}")
                    yield pa.RecordBatch.from_pylist(found, schema)

    def row_of(headers: dict[str, str], length: int, payload: bytes | None) -> dict:
        refers = headers.get("warc-refers-to")
        url = headers["warc-target-uri"]
        return {
            "key": key_of(headers["warc-record-id"]), "url": None if url == NO_TARGET else url,
            "record_type": headers["warc-type"], "refers_to": None if refers is None else key_of(refers),
            "payload_digest": headers["warc-payload-digest"].removeprefix("sha256:"), "payload_bytes": length,
            "payload": payload,
        }

    schema = pa.schema([
        ("key", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
    ])
    spread = archives.select("path", "records").repartition(max(1, archives.count()))
    return spread.mapInArrow(
        run, "key bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, payload binary"
    )


def archive_pages(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Write an archive record per page, below the folder all executors share, and read the archives back.

    The columns are those of :func:`read_archives`; a URL comes back as it is stored, with blanks, control characters
    and what is not ASCII percent-encoded.
    """
    spark = pages.sparkSession
    # With its scheme, so that tasks open what Spark means by the path.
    folder = spark._jvm.org.apache.hadoop.fs.Path(new_path(spark, "warc"))
    folder = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()
    archives = write_archives(plan_records(pages, key, url, body), folder)
    return read_archives(archives).withColumnRenamed("key", key)
