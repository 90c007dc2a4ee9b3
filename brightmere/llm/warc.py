"""WARC archives as seekable Zstandard bundles, written and read by Spark.

A bundle is one file: independent Zstandard frames of about 256 KiB of records each and, as its
last frame, a skippable one with the seek table (compressed and decompressed size of each frame)
that ends with the number of frames and the magic number of seekable files. A reader finds any
frame from the footer alone. The index maps record identifiers to (file, frame, offset in the
frame, length).

Files go through Spark's text writer, so that they reach any file system that Spark reaches and
are committed whole: a row is a bundle without the last four bytes of its footer, and the magic
number itself is the line separator, which Latin-1 encodes byte by byte.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightmere.llm.common import chunks
from brightmere.session import scratch

# Fixed values of the seekable format
SKIPPABLE = 0x184D2A5E
SEEKABLE = b"\xb1\xea\x92\x8f"

FRAME = 256 << 10  # bytes of records after which a frame ends
BUNDLE = 8 << 20  # compressed bytes after which a bundle ends
REVISIT_FROM = 100  # payload bytes from which equal payloads are stored once
DATE = "1970-01-01T00:00:00Z"  # pages have no time of capture

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(kind: str, page: int | None, url: str | None, payload: bytes, digest: str, refers: int | None) -> bytes:
    """One WARC record. Line ends in a URL would end a header, so they are percent-encoded."""
    uri = (url or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers}>"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}", "", ""]
    return "\r\n".join(head).encode() + payload + b"\r\n\r\n"


def parse(frame: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, length, headers and payload of each record of a frame."""
    at = 0
    while at < len(frame):
        end = frame.index(b"\r\n\r\n", at)
        lines = frame[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        size = int(head["Content-Length"])
        yield at, end + 4 + size + 4 - at, head, frame[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def footer(frames: list[tuple[int, int]]) -> bytes:
    """The seek table of frames (compressed, decompressed size), whole."""
    table = b"".join(struct.pack("<II", *x) for x in frames) + struct.pack("<IB", len(frames), 0) + SEEKABLE
    return struct.pack("<II", SKIPPABLE, len(table)) + table


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """Offset, compressed and decompressed size of each frame, from the end of a bundle."""
    if bundle[-4:] != SEEKABLE:
        raise ValueError("not a seekable bundle")
    n, flags = struct.unpack("<IB", bundle[-9:-4])
    width = 12 if flags & 0x80 else 8
    at, found = 0, []
    for i in range(n):
        low = len(bundle) - 9 - width * (n - i)
        small, large = struct.unpack("<II", bundle[low : low + 8])
        found.append((at, small, large))
        at += small
    return found


def frame_of(bundle: bytes, number: int) -> bytes:
    """The records of one frame, without touching the others."""
    at, small, large = seek_table(bundle)[number]
    return zstandard.ZstdDecompressor().decompress(bundle[at : at + small], max_output_size=large)


def write(pages: DataFrame, path: str | None = None, frame: int = FRAME, bundle: int = BUNDLE) -> str:
    """Write a record for each row of ``pages`` (page_id, url, html) and return the folder.

    Of records with equal payloads of 100 bytes or more, those with the smallest page_id are
    responses and the others revisit it; smaller payloads are always responses. Null html is
    empty; a null page_id is never referred to; rows that repeat the smallest page_id are all
    stored whole; no rows give a folder without bundles. Payloads travel once, by page; what
    finds equal ones is their digest.
    """
    path = path or scratch(pages.sparkSession, "warc")
    html = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint"), "url", html.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = rows.where(F.length("payload") >= REVISIT_FROM)
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    # digests that occur once stay where they are: only the repeated ones have a partner
    rows = rows.join(firsts.drop("n"), "digest", "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    rows = rows.select("page_id", "url", "payload", "digest", refers.alias("refers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=3).compress
        part, number, frames, data, held = TaskContext.get().partitionId(), 0, [], [], bytearray()

        def close() -> None:
            data.append(compress(bytes(held)))
            frames.append((len(data[-1]), len(held)))
            held.clear()

        def ended() -> pa.RecordBatch:
            whole = b"".join(data) + footer(frames)
            frames.clear()
            data.clear()
            return pa.RecordBatch.from_arrays([pa.array([whole[:-4]], pa.binary())], ["bundle"])

        for batch in chunks(batches, "payload"):
            for page, url, payload, digest, first in zip(*(c.to_pylist() for c in batch.columns)):
                kind = "response" if first is None else "revisit"
                made = record(kind, page, url, b"" if first is not None else payload, digest, first)
                if held and len(held) + len(made) > frame:
                    close()
                    if sum(x for x, _ in frames) >= bundle:
                        yield ended()
                        number += 1
                held.extend(made)
        if held:
            close()
        if frames:
            yield ended()

    bundles = rows.mapInArrow(run, "bundle binary").select(F.col("bundle").cast("string").alias("value"))
    (
        bundles.write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1")
        .option("lineSep", SEEKABLE.decode("latin-1")).text(path)
    )
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """The index and payload of each record: file, frame, position, size, page_id, url,
    record_type, refers_to, stated (digest in the header), payload. A task holds one bundle and
    one of its frames."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, bundle in zip(batch.column(0).to_pylist(), batch.column(1)):
                bundle = bundle.as_py()
                for number in range(len(seek_table(bundle))):
                    rows = []
                    for at, size, head, payload in parse(frame_of(bundle, number)):
                        page = head["WARC-Record-ID"][len("<urn:page:") : -1]
                        first = head.get("WARC-Refers-To", "<urn:page:>")[len("<urn:page:") : -1]
                        uri = head["WARC-Target-URI"].replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
                        rows.append((
                            file, number, at, size, int(page) if page else None, uri, head["WARC-Type"],
                            int(first) if first else None, head["WARC-Payload-Digest"].removeprefix("sha256:"), payload,
                        ))
                    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(),
                             pa.int64(), pa.string(), pa.binary()]
                    names = ["file", "frame", "position", "size", "page_id", "url", "record_type", "refers_to",
                             "stated", "payload"]
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(
        run,
        "file string, frame int, position bigint, size bigint, page_id bigint, url string, record_type string, "
        "refers_to bigint, stated string, payload binary",
    )


def fetch(spark: SparkSession, file: str, frame: int, position: int, size: int) -> bytes:
    """One record by its place in the index; decompresses one frame."""
    bundle = bytes(spark.read.format("binaryFile").load(file).first()["content"])
    return frame_of(bundle, frame)[position : position + size]


def records(read_back: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each record, from what
    was read back: a response's from its payload, a revisit's from the response it refers to."""
    own = read_back.select(
        "page_id", "record_type", "refers_to", "stated", F.length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
    )
    wanted = own.where("record_type = 'revisit'").groupBy("refers_to", "stated").agg(F.count("*").alias("n"))
    told = own.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("stated"), "payload_bytes", "payload_digest"
    )
    told = told.join(wanted.drop("n"), ["refers_to", "stated"]).distinct()
    kept = own.where("record_type = 'response'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
    again = own.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to", "stated").join(
        told, ["refers_to", "stated"], "left"
    )
    return kept.unionByName(again.select(*kept.columns))


def digest(payload: bytes) -> str:
    return hashlib.sha256(payload).hexdigest()
