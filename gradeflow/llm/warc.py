"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames. Records are grouped until a frame
holds about a megabyte, frames until the bundle is large; a skippable frame at the end,
the seek table, lists every frame's compressed and plain size. The index maps a
record's identifier to bundle, frame, and its offset in the frame's plain bytes, so one
record costs one short read.

Records with equal payloads of some size are written once as a response; the others are
revisits that name it. Who is the response is decided on digests alone; page bodies are
shuffled once, by page, and a hot payload's rows meet nowhere.

Every task writes bundles of its own under fresh names and returns their index; only
bundles in the stored index count, so a task that is run again does no harm. Bundles go
where the folder's file system lets pyarrow write (local or shared mount, HDFS, S3).

A null html is an empty payload; a null url an empty header. Pages without page_id are
written and returned, but no revisit names them. Rows that repeat a page (same page_id
and payload) have the same type. Other columns are not written.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeflow.llm.common import cells, stored, utf8
from gradeflow.sources.scratch import scratch_path

FRAME = 1 << 20
BUNDLE = 64 << 20
SMALL = 1000
#: Frames that a task reads back.
FRAMES = 16
DATE = "2024-01-01T00:00:00Z"
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

INDEX = "page_id long, bundle string, frame int, frame_offset long, length long"
PAGES = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


# -- records ------------------------------------------------------------------------


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC 1.1 record; the block of a revisit has no payload."""
    revisit = refers_to is not None
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http.encode() + (b"" if revisit else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {url.translate(BREAKS)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [
            f"WARC-Refers-To: <urn:page:{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


#: A header is one line.
BREAKS = {10: "%0A", 13: "%0D"}


def fields(raw: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in raw.decode().split("\r\n")[1:])


def records(frame: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, headers and block of every record of a frame."""
    at = 0
    while at < len(frame):
        body = frame.index(b"\r\n\r\n", at) + 4
        head = fields(frame[at : body - 4])
        size = int(head["Content-Length"])
        yield at, head, frame[body : body + size]
        at = body + size + 4


def page_number(urn: str | None) -> int | None:
    return int(urn[len("<urn:page:") : -1]) if urn and urn != "<urn:page:>" else None


def parsed(head: dict[str, str], block: bytes, payloads: bool = True) -> dict:
    """A page as the archive tells it; the digest is taken anew from the payload of a response."""
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = head["WARC-Type"] == "revisit"
    return {
        "page_id": page_number(head["WARC-Record-ID"]),
        "url": head["WARC-Target-URI"],
        "payload": payload if payloads and not revisit else None,
        "payload_bytes": int(fields(http)["Content-Length"]) if revisit else len(payload),
        "payload_digest": head["WARC-Payload-Digest"][5:] if revisit else hashlib.sha1(payload).hexdigest(),
        "record_type": head["WARC-Type"],
        "refers_to": page_number(head.get("WARC-Refers-To")),
    }


# -- bundles ------------------------------------------------------------------------


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The skippable frame at the end of a bundle."""
    body = b"".join(struct.pack("<II", *x) for x in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def frame_at(file: pa.NativeFile, number: int) -> bytes:
    """One frame's plain bytes, found through the seek table."""
    size = file.size()
    n, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
    if magic != SEEKABLE:
        raise ValueError("not a seekable bundle")
    table = struct.unpack(f"<{2 * n}I", file.read_at(8 * n, size - 9 - 8 * n))
    start = sum(table[0 : 2 * number : 2])
    return zstandard.ZstdDecompressor().decompress(
        file.read_at(table[2 * number], start), max_output_size=table[2 * number + 1]
    )


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class Bundles:
    """Writes records into bundles of one task."""

    def __init__(self, folder: str) -> None:
        self.folder, self.file = folder, None
        self.packer = zstandard.ZstdCompressor(level=3)
        self.frame, self.waiting, self.done = bytearray(), [], []

    def open(self) -> None:
        self.name = f"{self.folder}/{uuid.uuid4().hex}.warc.zst"
        system, path = opened(self.name)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.file, self.sizes, self.written = system.open_output_stream(path, compression=None), [], 0

    def add(self, page_id: int | None, raw: bytes) -> None:
        if self.file is None:
            self.open()
        self.waiting.append((page_id, self.name, len(self.sizes), len(self.frame), len(raw)))
        self.frame += raw
        if len(self.frame) >= FRAME:
            self.flush()
        if self.written >= BUNDLE:
            self.close()

    def flush(self) -> None:
        packed = self.packer.compress(bytes(self.frame))
        self.file.write(packed)
        self.sizes.append((len(packed), len(self.frame)))
        self.written += len(packed)
        self.frame.clear()

    def close(self) -> None:
        if self.file is not None:
            if self.frame:
                self.flush()
            self.file.write(seek_table(self.sizes))
            self.file.close()
            self.file = None
            self.done += self.waiting
            self.waiting = []

    def rows(self) -> pa.RecordBatch:
        out, self.done = self.done, []
        columns = zip(*out, strict=True) if out else [[]] * 5
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64())
        names = ["page_id", "bundle", "frame", "frame_offset", "length"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


# -- tables -------------------------------------------------------------------------


def decided(pages: DataFrame, small: int = SMALL) -> DataFrame:
    """page_id, digest and refers_to of the pages that are revisits."""
    payload = utf8("html")
    digests = stored(
        pages.where("page_id IS NOT NULL")
        .select(F.col("page_id").cast("long").alias("page_id"), F.unhex(F.sha1(payload)).alias("digest"), F.length(payload).alias("n"))
        .where(F.col("n") >= small)
        .drop("n"),
        "digests",
    )
    largest = digests.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
    shared = stored(largest.where("n > 1").drop("n"), "responses")
    return digests.join(shared, "digest").where("page_id <> refers_to").distinct()


def written(pages: DataFrame, folder: str, small: int = SMALL) -> DataFrame:
    """INDEX of the bundles that hold a record for every row of ``pages``."""
    body = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        utf8("html").alias("payload"),
        F.sha1(utf8("html")).alias("digest"),
    )
    known = decided(pages, small).select("page_id", F.lower(F.hex("digest")).alias("digest"), "refers_to")
    rows = body.join(known, ["page_id", "digest"], "left").select("page_id", "url", "payload", "digest", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundles = Bundles(folder)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                for row in zip(*(cells(part, c) for c in ("page_id", "url", "payload", "digest", "refers_to")), strict=True):
                    bundles.add(row[0], record(*row))
            yield bundles.rows()
        bundles.close()
        yield bundles.rows()

    return stored(rows.mapInArrow(run, INDEX), "warc-index")


def read_back(index: DataFrame, payloads: bool = True) -> DataFrame:
    """PAGES: every record of the frames in an index, read through the seek tables.

    Without ``payloads`` the bodies are read and digested but not returned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle, frame in zip(cells(batch, "bundle"), cells(batch, "frame"), strict=True):
                system, path = opened(bundle)
                with system.open_input_file(path) as file:
                    plain = frame_at(file, frame)
                rows = [parsed(head, block, payloads) for _, head, block in records(plain)]
                yield pa.RecordBatch.from_pylist(rows, schema=PAGES_SCHEMA)

    frames = index.select("bundle", "frame").distinct()
    tasks = -(-frames.count() // FRAMES) or 1  # names are tiny: by their size one task would get all
    return frames.repartitionByRange(tasks, "bundle", "frame").mapInArrow(run, PAGES)


PAGES_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def lookup(index: DataFrame, page_id: int) -> list[dict]:
    """The records of one page, each by one read of its frame."""
    found = []
    for row in index.where(F.col("page_id") == page_id).collect():
        system, path = opened(row.bundle)
        with system.open_input_file(path) as file:
            plain = frame_at(file, row.frame)
        _, head, block = next(records(plain[row.frame_offset : row.frame_offset + row.length]))
        found.append(parsed(head, block))
    return found


def archived(pages: DataFrame, payloads: bool = True) -> DataFrame:
    """``pages`` written to a new folder of bundles and read back."""
    return read_back(written(pages, scratch_path(pages.sparkSession, "warc")), payloads)
