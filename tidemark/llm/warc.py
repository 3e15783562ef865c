"""WARC archives in Zstandard frames, written and read back.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the
dictionary of all its other frames, itself compressed; each record is one frame
of its own. The reader loads the dictionary, decodes frame by frame in bounded
chunks, and checks the version line, the mandatory headers, every length and
the block and payload digests.

Records with equal payloads of at least ``least_bytes`` bytes: the one with the
largest page id is a response, the others are revisits that name it and carry
the HTTP head alone. The head's Content-Length is the full payload's.

Each writer task rolls to a new archive after ``archive_bytes`` and names its
archives by task attempt; only archives that a finished attempt reports are
read, so a lost executor or a second attempt can't duplicate records.

Defined results: null html is the empty payload; a null url is written as
about:blank; a very long page is one record, up to ``MOST_RECORD_BYTES``, beyond
which reading is an error; null page ids rank lowest and come back null; rows
that repeat a page id and payload are of the same type; an empty table gives an
empty result; only the three named columns are read, whatever the others' names.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlparse

import pyarrow as pa
import pyarrow.fs
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import modest_batches, scratch, stored

DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
VERSION, BREAK = b"WARC/1.1", b"\r\n"
MANDATORY = ("warc-record-id", "warc-date", "warc-type", "content-length")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:tidemark:page:"
CHUNK = 1 << 16
#: A record longer than this is refused, so that no frame can grow without bound in a task's memory.
MOST_RECORD_BYTES = 1 << 28
SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 200, 2 << 20, 16 << 10


class WarcError(ValueError):
    """The archive breaks the format; the message says where."""


@dataclass
class Record:
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    urn = lambda x: f"<{URN}{'' if x is None else x}>"
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": urn(page_id),
        "WARC-Date": date,
        "WARC-Target-URI": quote(url, safe="/:?#[]@!$&'()*+,;=%~") if url else "about:blank",
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    if revisit:
        headers |= {"WARC-Profile": PROFILE, "WARC-Refers-To": urn(refers_to)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items()).encode()
    return VERSION + BREAK + lines + BREAK + block + BREAK * 2


def dictionary(samples: list[bytes]) -> bytes:
    """Trained from the samples; where they are too few, their own bytes."""
    try:
        return zstd.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstd.ZstdError:
        return (b"".join(samples) or VERSION)[:DICTIONARY_BYTES].ljust(16, b"\0")


def opening(content: bytes) -> bytes:
    """The skippable frame with the dictionary."""
    packed = zstd.ZstdCompressor().compress(content)
    return struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed


def frames(data: bytes, most: int | None = None) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each frame after the dictionary's. A frame that holds more than ``most`` bytes is an error before it is held whole."""
    if len(data) < 8:
        raise WarcError(f"archive of {len(data)} bytes has no dictionary frame")
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_MAGIC:
        raise WarcError(f"first frame has magic {magic:#x}")
    held = data[8 : 8 + size]
    if len(held) != size:
        raise WarcError("dictionary frame is cut off")
    if held[:4] == struct.pack("<I", FRAME_MAGIC):
        held = zstd.ZstdDecompressor().decompress(held)
    decoder = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(held))
    view, at = memoryview(data), 8 + size
    while at < len(data):
        one, start, out, held = decoder.decompressobj(), at, [], 0
        try:
            while not one.eof and at < len(data):
                out.append(one.decompress(view[at : at + CHUNK]))
                held += len(out[-1])
                if most is not None and held > most:
                    raise WarcError(f"frame at {start} holds more than {most} bytes")
                at += min(CHUNK, len(data) - at)
        except zstd.ZstdError as e:
            raise WarcError(f"frame at {start}: {e}") from e
        if not one.eof:
            raise WarcError(f"frame at {start} is cut off")
        at -= len(one.unused_data)
        yield start, b"".join(out)


def _headers(lines: bytes, at: int) -> dict[str, str]:
    out = {}
    for line in lines.split(BREAK):
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon or not name or name != name.strip():
            raise WarcError(f"frame at {at}: bad header {line[:60]!r}")
        out[name.lower()] = value.strip()
    return out


def parse(content: bytes, at: int = 0) -> Record:
    """The single record of a frame, with all checks."""
    version, _, rest = content.partition(BREAK)
    if version not in (b"WARC/1.0", VERSION):
        raise WarcError(f"frame at {at}: version {version[:20]!r}")
    lines, gap, rest = rest.partition(BREAK * 2)
    headers = _headers(lines, at)
    if missing := [k for k in MANDATORY if k not in headers]:
        raise WarcError(f"frame at {at}: without {', '.join(missing)}")
    if not headers["content-length"].isdigit():
        raise WarcError(f"frame at {at}: length {headers['content-length']!r}")
    length = int(headers["content-length"])
    if not gap or len(rest) != length + 4 or rest[length:] != BREAK * 2:
        raise WarcError(f"frame at {at}: block of {len(rest) - 4} bytes, header says {length}")
    block = rest[:length]
    if (said := headers.get("warc-block-digest")) and said != f"sha1:{digest(block)}":
        raise WarcError(f"frame at {at}: block digest differs")
    head, gap, payload = block.partition(BREAK * 2)
    if not gap:
        raise WarcError(f"frame at {at}: HTTP head is cut off")
    http = _headers(head.partition(BREAK)[2], at)
    if headers["warc-type"] == "response":
        if http.get("content-length") != str(len(payload)):
            raise WarcError(f"frame at {at}: payload of {len(payload)} bytes, HTTP head says {http.get('content-length')}")
        if headers.get("warc-payload-digest") != f"sha1:{digest(payload)}":
            raise WarcError(f"frame at {at}: payload digest differs")
    return Record(headers, http, payload)


def read_archive(data: bytes, most: int | None = MOST_RECORD_BYTES) -> Iterator[Record]:
    for at, content in frames(data, most):
        yield parse(content, at)


def put(path: str, data: bytes) -> None:
    """Write a file where all executors see it."""
    at = urlparse(path)
    if at.scheme in ("", "file"):
        os.makedirs(os.path.dirname(at.path), exist_ok=True)
        with open(at.path, "wb") as f:
            f.write(data)
        return
    fs, name = pa.fs.FileSystem.from_uri(path)
    with fs.open_output_stream(name) as f:
        f.write(data)


def _writer(folder: str, archive_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        stem = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        waiting, held, pressed, lead = [], 0, None, b""
        parts, size, made, records = [], 0, [], 0

        def close() -> None:
            nonlocal parts, size, records
            name = f"{stem}-{len(made):05d}.warc.zst"
            put(f"{folder}/{name}", lead + b"".join(parts))
            made.append((name, records))
            parts, size, records = [], 0, 0

        def begin() -> None:
            nonlocal pressed, lead, waiting
            content = dictionary(waiting)
            pressed = zstd.ZstdCompressor(level=3, dict_data=zstd.ZstdCompressionDict(content), write_checksum=True)
            lead = opening(content)
            for x in waiting:
                add(x)
            waiting = []

        def add(x: bytes) -> None:
            nonlocal size, records
            parts.append(pressed.compress(x))
            size += len(parts[-1])
            records += 1
            if size >= archive_bytes:
                close()

        for batch in batches:
            for page, url, html, keep, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x = record(page, url, html.encode(), keep, revisit, date)
                if pressed is not None:
                    add(x)
                    continue
                waiting.append(x)
                held += len(x)
                if len(waiting) >= SAMPLES or held >= SAMPLE_BYTES:
                    begin()
        if waiting:
            begin()
        if parts:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in made], pa.string()), pa.array([n for _, n in made], pa.int64())], names=["name", "records"])

    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, archive_bytes: int = 8 << 20, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write all rows as records under ``folder``; return the archives of finished attempts: name, records."""
    modest_batches(pages.sparkSession)
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"), html.alias("html"), F.unhex(F.sha2(html, 256)).alias("same"))
    holders = rows.where(F.octet_length("html") >= least_bytes).groupBy("same").agg(F.max("page").alias("keep"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select("same", "keep")
    joined = rows.join(holders, "same", "left")
    revisit = F.coalesce(F.col("keep").isNotNull() & ~F.col("page").eqNullSafe(F.col("keep")), F.lit(False))
    return stored(joined.select("page", "url", "html", "keep", revisit.alias("revisit")).mapInArrow(_writer(folder, archive_bytes, date), "name string, records long"), "warc-manifest")


#: Records are handed on in slices of about so many bytes of payload.
SLICE_BYTES = 4 << 20


def _reader(payloads: bool):
    fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
    page = lambda x: int(x) if (x := x.removeprefix(f"<{URN}").removesuffix(">")) else None

    def batch_of(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=list(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out, held = [], 0
                for r in read_archive(content.as_py()):
                    refers = r.headers.get("warc-refers-to")
                    out.append((page(r.headers["warc-record-id"]), int(r.http["content-length"]), r.headers["warc-payload-digest"].removeprefix("sha1:"), r.headers["warc-type"], page(refers) if refers else None, r.headers.get("warc-target-uri"), r.payload if payloads else None))
                    held += len(r.payload) + 256
                    if held >= SLICE_BYTES:
                        yield batch_of(out)
                        out, held = [], 0
                if out:
                    yield batch_of(out)

    return run


READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame | None = None, payloads: bool = True) -> DataFrame:
    """One row for each record of the archives under ``folder``, or of those that ``manifest`` names; without ``payloads`` these are checked and let go."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    if manifest is not None:
        files = files.withColumn("name", F.element_at(F.split("path", "/"), -1)).join(manifest, "name", "left_semi")
    return files.select("content").mapInArrow(_reader(payloads), READ_SCHEMA)


def warc_round_trip(spark: SparkSession, pages: DataFrame, payloads: bool = True, **options) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back."""
    folder = scratch(spark, "warc")
    manifest = write_archives(pages, folder, **options)
    if manifest.isEmpty():
        return spark.createDataFrame([], READ_SCHEMA)
    return read_archives(spark, folder, manifest, payloads)
