"""WARC archives of pages, written and read as tables of chunks.

``write`` turns every page into a record: a ``response`` with its payload, or, for pages whose
payload of at least ``MIN_SHARED`` bytes equals that of a page with a larger key, a
``revisit`` that refers to the response and has no payload. A page reaches its task as rows
(record, chunk number, bytes) of at most ``CHUNK_BYTES``, in order, and ``read`` gives the same
kind of rows back with the length and SHA-1 of the payload so far, carried from chunk to
chunk: neither side ever holds a record whole outside the row of the page it comes from, and
a record's last row has its totals, so nothing is gathered or shuffled to get them.

Archives are gzip files with one member a record, of about ``FILE_BYTES``, in a folder that all
executors share, through pyarrow's file systems. A task names its files after itself and a
random id and returns them as rows; the table of these rows, the manifest, is written by
Spark's own commit. Files of a task that was lost or repeated are in no manifest and are not
read. Both a response and a revisit carry the HTTP head of the page, so ``Content-Length``
there, and ``WARC-Payload-Digest``, tell the whole payload's size and digest.

Equal payloads are found by SHA-256 and length; only groups of two or more are joined to the
pages. Of the rows that share the largest key of a group each is a response. A null payload is
empty. A null key is written as an empty name and read back as null; it is smaller than other
keys. A null URL leaves its header out; line breaks and other controls in a URL are
percent-encoded. Repeated rows are records of their own. Other columns are left out, whatever
their names. An empty table gives an empty manifest and no records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from gzip import GzipFile
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagpulse.llm.shared import settle

CHUNK_BYTES = 1 << 18
FILE_BYTES = 1 << 28
#: Equal payloads of fewer bytes are stored each time.
MIN_SHARED = 1000
#: Read rows with their payloads leave a task in batches of about this many bytes.
BATCH_BYTES = 1 << 22

RESPONSE, REVISIT = "response", "revisit"
#: Fixed values of the format: the version line, the profile of revisits, and the name of
#: records here.
VERSION = "WARC/1.1"
SAME_DIGEST = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAME = "urn:record:"

MANIFEST = "path string, records bigint, bytes bigint"
CHUNKS = (
    "key string, record_type string, refers_to string, url string, chunk bigint, last boolean, "
    "payload_bytes bigint, payload_digest string, payload_so_far bigint, data binary"
)


def _records(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """Pages with the digests of their payloads, the record type and what revisits refer to."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), body.alias("body"))
    rows = rows.withColumn("size", F.octet_length("body"))
    large = F.col("size") >= MIN_SHARED
    # Small payloads match nothing, so they are spread over all tasks.
    alone = F.concat(F.lit("-"), F.xxhash64("id", "url").cast("string"))
    rows = rows.withColumn("same", F.when(large, F.sha2("body", 256)).otherwise(alone))
    heads = rows.where(large).groupBy("same").agg(F.max("id").alias("head"), F.count("*").alias("n"))
    # Written, so that its size is known: where few payloads repeat, pages are not shuffled.
    heads = settle(heads.where("n > 1").select("same", "head"), "warc-heads")
    again = F.col("head").isNotNull() & ~F.col("id").eqNullSafe(F.col("head"))
    return rows.join(heads, "same", "left").select(
        F.col("id").cast("string").alias("key"),
        "url",
        F.when(again, F.lit(REVISIT)).otherwise(F.lit(RESPONSE)).alias("record_type"),
        F.when(again, F.col("head").cast("string")).alias("refers_to"),
        again.alias("again"),
        "size",
        F.sha1("body").alias("digest"),
        "body",
    )


def _chunked(records: DataFrame) -> DataFrame:
    """A row for each chunk of a record's payload, in order; one for records without."""
    stored = F.when(F.col("again"), F.lit(0)).otherwise(F.col("size"))
    last = F.greatest(F.ceil(stored / F.lit(CHUNK_BYTES)).cast("int"), F.lit(1)) - 1
    return records.withColumn("chunk", F.explode(F.sequence(F.lit(0), last))).select(
        "key",
        "url",
        "record_type",
        "refers_to",
        "size",
        "digest",
        "chunk",
        (F.col("chunk") == last).alias("last"),
        F.when(~F.col("again"), F.substring("body", F.col("chunk") * CHUNK_BYTES + 1, F.lit(CHUNK_BYTES))).alias("data"),
    )


def _name(key: str | None) -> str:
    return "" if key is None else "k" + quote(key, safe="")


def _key(name: str) -> str | None:
    return unquote(name[1:]) if name else None


def _base32(digest: str) -> str:
    return base64.b32encode(bytes.fromhex(digest)).decode()


def _hex(digest: str) -> str:
    return base64.b32decode(digest).hex()


def _head(row: dict) -> bytes:
    """The record's header, and the HTTP head its block starts with."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['size']}\r\n\r\n"
    ).encode()
    again = row["record_type"] == REVISIT
    lines = [VERSION, f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{NAME}{_name(row['key'])}>"]
    if row["url"] is not None:
        spelled = "".join(c if c > " " and c != "\x7f" else quote(c) for c in row["url"])
        lines.append(f"WARC-Target-URI: {spelled}")
    lines += [
        # The pages have no time of capture; a fixed one keeps archives alike.
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{_base32(row['digest'])}",
        "Content-Type: application/http;msgtype=response",
    ]
    if again:
        lines += [f"WARC-Profile: {SAME_DIGEST}", f"WARC-Refers-To: <{NAME}{_name(row['refers_to'])}>"]
    lines.append(f"Content-Length: {len(http) + (0 if again else row['size'])}")
    return "\r\n".join([*lines, "", ""]).encode() + http


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class _Archives:
    """The files that one task writes, one after the other."""

    def __init__(self, folder: str, stem: str):
        self.folder, self.stem = folder, stem
        self.done: list[tuple[str, int, int]] = []
        self.out, self.path, self.records, self.bytes = None, "", 0, 0

    def start(self, head: bytes) -> None:
        if self.out is None:
            self.path = f"{self.folder}/{self.stem}-{len(self.done):05d}.warc.gz"
            system, at = _opened(self.path)
            self.out, self.records, self.bytes = system.open_output_stream(at, compression=None), 0, 0
        # One gzip member a record, so that any record can be read from its offset on.
        self.member = zlib.compressobj(1, zlib.DEFLATED, 31)
        self.put(head)

    def put(self, data: bytes) -> None:
        packed = self.member.compress(data)
        self.out.write(packed)
        self.bytes += len(packed)

    def end(self) -> None:
        packed = self.member.compress(b"\r\n\r\n") + self.member.flush()
        self.out.write(packed)
        self.bytes, self.records = self.bytes + len(packed), self.records + 1
        if self.bytes >= FILE_BYTES:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.path, self.records, self.bytes))
            self.out = None


def write(
    pages: DataFrame, folder: str, *, key: str = "page_id", url: str = "url", payload: str = "html"
) -> DataFrame:
    """Write archives of ``pages`` to ``folder``, which all executors share; returns the
    manifest (path, records, bytes), written as a table."""
    spark = pages.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = _Archives(folder, f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}")
        for batch in batches:
            data = batch.column("data")
            for i, row in enumerate(batch.drop_columns("data").to_pylist()):
                if row["chunk"] == 0:
                    archives.start(_head(row))
                if (piece := data[i].as_py()) is not None:
                    archives.put(piece)
                if row["last"]:
                    archives.end()
        archives.close()
        columns = list(zip(*archives.done, strict=True)) or [(), (), ()]
        types = (pa.string(), pa.int64(), pa.int64())
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["path", "records", "bytes"])

    chunks = _chunked(_records(pages, key, url, payload))
    return settle(chunks.mapInArrow(written, MANIFEST), "warc-manifest")


def _lines(stream: GzipFile) -> dict[str, str]:
    """Header fields up to the blank line; the first line is under the empty name."""
    fields, first = {}, True
    while (line := stream.readline().rstrip(b"\r\n")):
        name, _, value = (b"", b"", line) if first else line.partition(b":")
        fields[name.decode().lower()], first = value.strip(b" ").decode(), False
    return fields


def _named(field: str) -> str | None:
    return _key(field.removeprefix(f"<{NAME}").removesuffix(">"))


def _chunks_of(stream: GzipFile) -> Iterator[dict]:
    """The chunks of an archive's records, in order."""
    while True:
        header = _lines(stream)
        if not header:
            return
        if header[""] != VERSION:
            raise ValueError(f"no record of {VERSION} where one should start: {header['']!r}")
        left = int(header["content-length"])
        begins = stream.tell()
        http = _lines(stream)
        left -= stream.tell() - begins
        row = {
            "key": _named(header["warc-record-id"]),
            "record_type": header["warc-type"],
            "refers_to": _named(header["warc-refers-to"]) if "warc-refers-to" in header else None,
            "url": header.get("warc-target-uri"),
            "payload_bytes": int(http["content-length"]),
            "chunk": 0,
        }
        declared = _hex(header["warc-payload-digest"].removeprefix("sha1:"))
        if row["record_type"] == REVISIT:
            yield row | {"last": True, "payload_digest": declared, "payload_so_far": 0, "data": b""}
        else:
            sha1, so_far = hashlib.sha1(), 0
            while True:
                data = stream.read(min(left - so_far, CHUNK_BYTES))
                sha1.update(data)
                so_far += len(data)
                last = so_far >= left
                if not data and not last:
                    raise ValueError(f"record {row['key']} ends early")
                digest = sha1.hexdigest()
                if last and (digest, so_far) != (declared, row["payload_bytes"]):
                    raise ValueError(f"record {row['key']} has another payload than it declares")
                yield row | {"last": last, "payload_digest": digest, "payload_so_far": so_far, "data": data}
                row["chunk"] += 1
                if last:
                    break
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {row['key']} does not end where it should")


def read(manifest: DataFrame, *, data: bool = True) -> DataFrame:
    """The chunks of all records in the manifest's archives: ``key``, ``record_type``,
    ``refers_to`` (key of the response), ``url``, ``chunk`` (from 0), ``last``,
    ``payload_bytes`` (whole), ``payload_digest`` (of a response, up to this chunk; of a
    revisit, declared), ``payload_so_far``, ``data`` (null where ``data`` is false). A payload
    that differs from what its record declares fails the job."""
    names = StructType.fromDDL(CHUNKS).names

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, at = _opened(path)
                with system.open_input_stream(at, compression=None, buffer_size=1 << 20) as raw, GzipFile(fileobj=raw) as stream:
                    rows, held = [], 0
                    for row in _chunks_of(stream):
                        held += len(row["data"]) + 200
                        rows.append(row if data else row | {"data": None})
                        if held >= BATCH_BYTES:
                            yield _batch(rows, names)
                            rows, held = [], 0
                    yield _batch(rows, names)

    # About a file a task: they are of like size, and a task holds a few chunks only.
    files = manifest.select("path").repartitionByRange(max(manifest.count(), 1), "path")
    return files.mapInArrow(found, CHUNKS)


def _batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    types = {"chunk": pa.int64(), "last": pa.bool_(), "payload_bytes": pa.int64(), "payload_so_far": pa.int64(), "data": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], types.get(n, pa.string())) for n in names], names)


def records(chunks: DataFrame) -> DataFrame:
    """A row a record: its last chunk, whose digest and length are those of the payload."""
    return chunks.where("last").drop("chunk", "last", "payload_so_far", "data")
