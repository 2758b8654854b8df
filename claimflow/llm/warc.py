"""Web archives in Zstandard frames: writer and reader.

An archive begins with a skippable frame that holds its dictionary; every record is a frame of its own, so a
record can be read by its offset. Equal payloads are stored once: the record of the smallest page is the response,
the others are revisits that refer to it.

Each task writes its archives under names of its own into the shared folder and returns a list of them. Only the lists
of tasks that succeeded are kept, so what a lost or repeated task left behind is never read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import new_path, save

DICTIONARY_FRAME = 0x184D2A5D  # of the skippable frames the one that holds a dictionary
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
ZSTD_FRAME = 0xFD2FB528
DICTIONARY_BYTES = 32 * 1024
SAMPLE_BYTES = 1 << 20  # of an archive's first records, to train its dictionary on
ARCHIVE_BYTES = 64 << 20  # an archive is closed beyond this
LEAST_REVISIT = 0  # payloads of fewer bytes are always stored
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVES = "path string, records long, bytes long"
RECORDS = "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, url string, payload binary"


class ArchiveError(ValueError):
    """An archive that breaks its format."""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def _page_of(record_id: str | None) -> int | None:
    return int(record_id[10:-1]) if record_id and record_id.startswith("<urn:page:") else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One record: headers, the response's own headers, and the payload unless it is a revisit."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {date}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        f"WARC-Block-Digest: sha1:{payload_digest(block)}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        # control characters and blanks would break a header line
        lines.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(0x21, 0x7F))))}")
    if revisit:
        lines += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or where there is too little to train on, the samples' own bytes."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def frames_of(records: list[bytes], dictionary: bytes | None) -> Iterator[bytes]:
    """The skippable frame with the dictionary, if any, then one frame for each record."""
    loaded = None
    if dictionary:
        packed = zstandard.ZstdCompressor(level=9).compress(dictionary)
        yield struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed
        loaded = zstandard.ZstdCompressionDict(dictionary)
    compressor = zstandard.ZstdCompressor(level=3, dict_data=loaded, write_checksum=True, write_content_size=True)
    for r in records:
        yield compressor.compress(r)


def _exactly(stream, n: int) -> bytes:
    out = stream.read(n)
    if len(out) != n:
        raise ArchiveError(f"cut off: {len(out)} of {n} bytes")
    return out


def read_frames(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The content of every frame of an archive, decoded one by one with the dictionary that leads it."""
    loaded, held, first = None, b"", True
    while True:
        held += stream.read(8 - len(held)) if len(held) < 8 else b""
        if not held:
            return
        if len(held) < 8:
            held += _exactly(stream, 8 - len(held))
        magic, size = struct.unpack("<II", held[:8])
        if magic in SKIPPABLE:
            body = held[8 : 8 + size]
            held = held[8 + size :]
            if len(body) < size:
                body += _exactly(stream, size - len(body))
            if magic == DICTIONARY_FRAME:
                if not first:
                    raise ArchiveError("a dictionary must lead its archive")
                if body[:4] == struct.pack("<I", ZSTD_FRAME):
                    body = zstandard.ZstdDecompressor().decompress(body)
                loaded = zstandard.ZstdCompressionDict(body)
            first = False
            continue
        if magic != ZSTD_FRAME:
            raise ArchiveError(f"no frame begins with {magic:#x}")
        first = False
        decoder, parts = zstandard.ZstdDecompressor(dict_data=loaded).decompressobj(), []
        while not decoder.eof:
            held = held or stream.read(chunk)
            if not held:
                raise ArchiveError("the last frame is cut off")
            try:
                parts.append(decoder.decompress(held))
            except zstandard.ZstdError as e:
                raise ArchiveError(f"a frame can't be decoded: {e}") from e
            held = decoder.unused_data if decoder.eof else b""
        yield b"".join(parts)


def parse_record(content: bytes) -> dict:
    """Headers, checked, and payload of one record; a revisit's payload is None and its length what it stood for."""
    head, found, rest = content.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not found or not lines[0].startswith("WARC/1."):
        raise ArchiveError(f"no record begins with {lines[0][:20]!r}")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ArchiveError(f"no header: {line[:40]!r}")
        headers[name.strip().lower()] = value.strip()
    for needed in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if needed not in headers:
            raise ArchiveError(f"no {needed}")
    if headers["warc-type"] == "warcinfo":
        return {"headers": headers, "type": "warcinfo"}
    n = int(headers["content-length"])
    block, tail = rest[:n], rest[n:]
    if len(block) != n or tail != b"\r\n\r\n":
        raise ArchiveError(f"content-length is {n}, {len(rest) - 4} bytes are there")
    if headers.get("warc-block-digest", "sha1:" + payload_digest(block)) != "sha1:" + payload_digest(block):
        raise ArchiveError("the block differs from its digest")
    http, found, payload = block.partition(b"\r\n\r\n")
    if not found:
        raise ArchiveError("the block has no headers of its own")
    stated = [line.split(b":")[1] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if headers["warc-type"] == "response":
        if stated and int(stated[0]) != len(payload) or digest != payload_digest(payload):
            raise ArchiveError("the payload differs from its length or digest")
    elif headers["warc-type"] == "revisit":
        if payload or not stated or "warc-refers-to" not in headers:
            raise ArchiveError("a revisit has a length, a reference and no payload")
    size = len(payload) if headers["warc-type"] == "response" else int(stated[0])
    return {
        "headers": headers,
        "type": headers["warc-type"],
        "payload": payload if headers["warc-type"] == "response" else None,
        "payload_bytes": size,
        "payload_digest": digest,
    }


def _write(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        info = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {date}\r\n"
        info = info.encode() + b"Content-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
        done: list[tuple[str, int, int]] = []
        out, compress, waiting, waiting_bytes = None, None, [], 0

        def begin():
            nonlocal out, compress, waiting, waiting_bytes
            name = f"{uuid.uuid4().hex}.warc.zst"
            out = files.open_output_stream(f"{root}/{name}", compression=None)
            dictionary = _dictionary(waiting)
            frames = frames_of([info, *waiting], dictionary)
            size = sum(out.write(f) for f in frames)
            compress = zstandard.ZstdCompressor(
                level=3, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True
            )
            done.append((f"{folder}/{name}", len(waiting), size))
            waiting, waiting_bytes = [], 0

        for batch in batches:
            for page_id, url, html, first, revisit in zip(*(c for c in batch.columns), strict=True):
                payload = (html.as_py() or "").encode("utf-8", "surrogatepass")
                r = record(page_id.as_py(), url.as_py(), payload, first.as_py(), revisit.as_py(), date)
                if out is None:
                    waiting.append(r)
                    waiting_bytes += len(r)
                    if waiting_bytes >= SAMPLE_BYTES:
                        begin()
                    continue
                path, n, size = done[-1]
                done[-1] = (path, n + 1, size + out.write(compress.compress(r)))
                if done[-1][2] >= ARCHIVE_BYTES:
                    out.close()
                    out = None
        if waiting:
            begin()
        if out is not None:
            out.close()
        columns = list(zip(*done, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
            names=["path", "records", "bytes"],
        )

    return write


def write_archives(
    pages: DataFrame,
    least_revisit: int = LEAST_REVISIT,
    folder: str | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Write a record per row of `pages` and return the list of archives (path, records, bytes).

    The payload is the html in UTF-8, null as empty. Of rows with one payload of at least `least_revisit` bytes those
    with the smallest page_id are responses, the rest revisits. A null page_id counts as larger than any; rows of one
    payload without any page_id are responses. An empty table writes no archive with records.
    """
    spark = pages.sparkSession
    folder = folder or new_path(spark, "archives")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html")
    ).withColumn("__sha", F.sha2("html", 256))
    keys = rows.where(F.octet_length("html") >= least_revisit).select("page_id", "__sha")
    first = keys.groupBy("__sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    copied = save(first.where((F.col("n") > 1) & F.col("first").isNotNull()).select("__sha", "first"), "archive-copies")
    # read from files on both sides: adaptive execution splits a payload that very many pages share
    joined = rows.join(copied, "__sha", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    ready = joined.select("page_id", "url", "html", "first", revisit.alias("revisit"))
    return save(ready.mapInArrow(_write(folder), ARCHIVES), "archive-list")


def archives_in(spark, folder: str) -> DataFrame:
    """Archives of a folder, for archives that others wrote."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return listed.select("path", F.lit(None).cast("long").alias("records"), F.col("length").alias("bytes"))


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of archives (column path): page_id, record_type, payload_bytes, payload_digest, refers_to, url, payload.

    Frames are decoded one by one. Headers, lengths and digests are checked; an archive that breaks its format, or
    holds another number of records than the list says, fails the job. payload is null for revisits, and throughout
    if `payloads` is false.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("page_id", pa.int64()),
                ("record_type", pa.string()),
                ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()),
                ("refers_to", pa.int64()),
                ("url", pa.string()),
                ("payload", pa.binary()),
            ]
        )
        for batch in batches:
            for path, stated in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                files, at = pafs.FileSystem.from_uri(path)
                held, size, n = [], 0, 0
                with files.open_input_stream(at, compression=None) as stream:
                    for content in read_frames(stream):
                        r = parse_record(content)
                        if r["type"] not in ("response", "revisit"):
                            continue
                        n += 1
                        h = r["headers"]
                        body = r["payload"] if payloads else None
                        size += len(body or b"")
                        held.append(
                            (
                                _page_of(h["warc-record-id"]),
                                r["type"],
                                r["payload_bytes"],
                                r["payload_digest"],
                                _page_of(h.get("warc-refers-to")),
                                h.get("warc-target-uri"),
                                body,
                            )
                        )
                        if len(held) >= 4096 or size >= 16 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
                if stated is not None and stated != n:
                    raise ArchiveError(f"{path} holds {n} records, not {stated}")

    listed = archives.select("path", "records")
    return listed.repartition(max(1, listed.count())).mapInArrow(read, RECORDS)
