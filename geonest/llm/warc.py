"""WARC (9): a writer with a Zstandard dictionary in every archive.

Each task writes its records to archives in a folder that all executors
share. An archive begins with a skippable frame that holds a dictionary
built from its own first records; each record then is a frame of its own.
The manifest that the writer returns lists the finished archives, so a task
that runs again just leaves an unlisted file behind.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geonest.llm.common import pick, text_bytes, write_table
from geonest.session import new_scratch_dir

#: Magic number of the skippable frame that holds the dictionary.
DICTIONARY_FRAME = 0x184D2A5D
DICTIONARY_BYTES = 32 * 1024
#: Records that the dictionary is built from: the archive's first ones, up to this size.
SAMPLE_BYTES = 1024 * 1024
#: Size at which a task begins another archive.
ARCHIVE_BYTES = 1 << 30
LEVEL = 3
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

MANIFEST = "archive string, records bigint, bytes bigint"
RECORDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One WARC/1.1 record; a revisit holds the HTTP header but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = f"{page_id}/{digest}/{int(revisit)}"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>",
        f"WARC-Date: {date}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " and c != "%" and c != "\x7f" else "".join(f"%{x:02X}" for x in c.encode()) for c in url))
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if revisit:
        head.append(f"WARC-Profile: {PROFILE}")
        if refers_to is not None:
            head.append(f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{refers_to}/{digest}/0')}>")
            head.append(f"Refers-To-Page-ID: {refers_to}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary for records like ``samples``; where these are too few to
    train one, their plain content serves."""
    try:
        return zstandard.train_dictionary(size, samples, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class ArchiveWriter:
    """One archive: the dictionary's frame, then a frame per record."""

    def __init__(self, folder: str, samples: list[bytes], level: int):
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        self.out = fs.open_output_stream(f"{root}/{self.path.rpartition('/')[2]}", compression=None)
        dictionary = build_dictionary(samples)
        self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
        self.bytes, self.records = 8 + len(dictionary), 0
        self.zstd = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True)

    def write(self, record: bytes) -> None:
        frame = self.zstd.compress(record)
        self.out.write(frame)
        self.bytes, self.records = self.bytes + len(frame), self.records + 1

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.path, self.records, self.bytes


def _write(folder: str, level: int, sample_bytes: int, archive_bytes: int):
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        for b in batches:
            for i in range(b.num_rows):
                page_id, url, payload, digest, first = (b.column(k)[i].as_py() for k in range(5))
                revisit = first is not None and first != page_id
                yield record_bytes(page_id, url, payload, base64.b32encode(bytes.fromhex(digest)).decode(), first if revisit else None, revisit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, writer, done = [], 0, None, []
        for record in records(batches):
            if writer is None:
                held.append(record)
                size += len(record)
                if size < sample_bytes:
                    continue
                writer = ArchiveWriter(folder, held, level)
                for x in held:
                    writer.write(x)
                held, size = [], 0
            else:
                writer.write(record)
            if writer.bytes >= archive_bytes:
                done.append(writer.close())
                writer = None
        if held:
            writer = ArchiveWriter(folder, held, level)
            for x in held:
                writer.write(x)
        if writer is not None:
            done.append(writer.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["archive", "records", "bytes"])

    return run


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, level: int = LEVEL, sample_bytes: int = SAMPLE_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archive every row of ``pages`` (``page_id``, ``url``, ``html``) under
    ``folder``, a path or URI that all executors reach; returns the written
    manifest (``archive``, ``records``, ``bytes``).

    The payload is the html in UTF-8 (null: empty). Of rows with equal
    payloads of at least ``min_revisit_bytes``, those with the smallest
    page_id are responses and the others revisit it; a smaller payload is
    always a response. Defined cases: rows that repeat the smallest id are
    all responses; rows without an id revisit the smallest id, or are
    responses if none has one; an empty table writes no archive.

    The smallest id is found by a partial aggregation over (digest, size),
    so copies that make up a third of all pages meet as a few rows a task;
    the join back to the pages is one that Spark splits by skewed keys.
    """
    p = pick(pages, page_id="page_id:bigint", url="url:string", html="html:string").withColumn("html", text_bytes("html"))
    p = p.select("*", F.sha1("html").alias("digest"), F.length("html").alias("size"))
    first = write_table(
        p.select("page_id", "digest", "size")
        .where(F.col("size") >= min_revisit_bytes)
        .groupBy("digest", "size")
        .agg(F.min("page_id").alias("first_id")),
        "payloads",
    )
    todo = p.join(first.hint("merge"), ["digest", "size"], "left").select("page_id", "url", "html", "digest", "first_id")
    return write_table(todo.mapInArrow(_write(folder, level, sample_bytes, archive_bytes), MANIFEST), "warc-manifest")


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of an open archive."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive does not begin with a dictionary frame")
    dictionary = zstandard.ZstdCompressionDict(stream.read(size))
    data = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(stream, read_across_frames=True)
    buffer = b""
    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            more = data.read(1 << 16)
            if not more:
                if buffer:
                    raise ValueError("the archive ends within a record")
                return
            buffer += more
        lines = buffer[:end].decode().split("\r\n")
        head = dict(x.split(": ", 1) for x in lines[1:])
        need = end + 4 + int(head["Content-Length"]) + 4
        parts, have = [buffer], len(buffer)
        while have < need:
            more = data.read(max(1 << 16, need - have))
            if not more:
                raise ValueError("the archive ends within a record")
            parts.append(more)
            have += len(more)
        buffer = b"".join(parts)
        yield head, buffer[end + 4:need - 4]
        buffer = buffer[need:]


def _read(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for archive in b.column(0).to_pylist():
                fs, path = pafs.FileSystem.from_uri(archive)
                rows = []
                with fs.open_input_stream(path, compression=None) as stream:
                    for head, block in read_records(stream):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                        size = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
                        if head["WARC-Type"] == "response":
                            digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
                            if digest != head["WARC-Payload-Digest"].removeprefix("sha1:"):
                                raise ValueError(f"{archive}: a payload does not match its digest")
                        number = lambda k, h=head: int(h[k]) if k in h else None
                        rows.append((number("Page-ID"), head.get("WARC-Target-URI"), size, digest, head["WARC-Type"], number("Refers-To-Page-ID"), payload if with_payload else None))
                        if len(rows) == 256:
                            yield _record_batch(rows)
                            rows = []
                if rows:
                    yield _record_batch(rows)

    return run


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the archives that ``manifest`` lists; ``payload`` is
    null for revisits (as for all without ``with_payload``), whose size and
    digest are those of the payload they refer to. Response payloads are
    hashed again and must match their digest."""
    n = max(1, manifest.count())
    paths = manifest.select("archive").repartition(n, "archive")
    return paths.mapInArrow(_read(with_payload), RECORDS)


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0) -> DataFrame:
    """Write all pages, read the archives back; one row per page."""
    folder = folder or new_scratch_dir(spark, "warc")
    return read_archives(write_archives(pages, folder, min_revisit_bytes), with_payload=False)
