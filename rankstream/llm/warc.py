"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each of some records, closed by a skippable frame
that holds the seek table (compressed and decompressed size of every frame, then the number of frames
and a magic number), in the public seekable format: any Zstandard reader decompresses the whole, and
a reader with the table decompresses one frame. An index table maps each record to bundle, frame, and
offset and length inside the decompressed frame.

Records with the same payload of at least ``least_bytes`` bytes are stored once: the one with the
largest page id is a response, the others are revisits that name it. Payloads are compared by their
SHA-1 digest and length. Only digests and ids meet in the search for the response; the pages join the
list of revisits by (page id, digest), which spreads evenly even if most pages are copies.

Bundles are written by tasks into a folder that all executors share, under names that carry the task
attempt, and only the index of committed tasks counts: leftovers of lost executors are never read.

Defined results: null html is an empty payload; a null page id is the smallest; rows that repeat the
largest page id of a payload are all responses; a null url has no target header. An empty table gives
an empty index.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankstream import schemas
from rankstream.llm.common import checkpoint, settle
from rankstream.session import fresh_folder

# Fixed values of the formats.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 16 << 20
LEVEL = 3
MOST_TASKS = 100_000  # that read archives back
DATE = "1970-01-01T00:00:00Z"

INDEX = schemas.struct(
    record_id=schemas.LONG, bundle=schemas.STRING, frame=schemas.LONG, offset=schemas.LONG,
    length=schemas.LONG,
)
RECORD = schemas.struct(
    page_id=schemas.LONG, url=schemas.STRING, record_type=schemas.STRING,
    payload_bytes=schemas.LONG, payload_digest=schemas.STRING, refers_to=schemas.LONG,
)


def filesystem(path: str):
    """The file system of a Hadoop path, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def _clean(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in value)


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE
) -> bytes:
    """One WARC record; a revisit, which names ``refers_to``, leaves the payload out."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    revisit = refers_to is not None
    block = _HTTP if revisit else _HTTP + payload
    headers = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Length: {len(payload)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        headers.append(f"WARC-Target-URI: {_clean(url)}")
    if revisit:
        headers += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, payload) of each record of a decompressed frame; a revisit has no payload."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        start, length = end + 4, int(headers["Content-Length"])
        block = data[start : start + length]
        yield headers, block[block.index(b"\r\n\r\n") + 4 :]
        at = start + length + 4


class Bundle:
    """A bundle being written to an open stream."""

    def __init__(self, stream):
        import zstandard

        self.stream, self.frames, self.pending, self.size, self.written = stream, [], [], 0, 0
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)

    def add(self, record: bytes) -> tuple[int, int, int]:
        """Frame, offset and length of the record; frames close once they are large enough."""
        place = len(self.frames), self.size, len(record)
        self.pending.append(record)
        self.size += len(record)
        if self.size >= FRAME_BYTES:
            self.close_frame()
        return place

    def close_frame(self) -> None:
        if self.pending:
            packed = self.compressor.compress(b"".join(self.pending))
            self.stream.write(packed)
            self.frames.append((len(packed), self.size))
            self.written += len(packed)
            self.pending, self.size = [], 0

    def close(self) -> None:
        self.close_frame()
        self.stream.write(seek_table(self.frames))
        self.stream.close()


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", *f) for f in frames)
    footer = struct.pack("<IBI", len(frames), 0, _SEEKABLE)
    return struct.pack("<II", _SKIPPABLE, len(entries) + len(footer)) + entries + footer


def frame_starts(tail: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed, decompressed) of each frame; ``tail`` ends the bundle."""
    count, descriptor, magic = struct.unpack("<IBI", tail[-9:])
    if magic != _SEEKABLE or descriptor:
        raise ValueError("no seek table")
    sizes = struct.iter_unpack("<II", tail[-9 - 8 * count : -9])
    found, at = [], 0
    for compressed, plain in sizes:
        found.append((at, compressed, plain))
        at += compressed
    return found


def read_seek_table(stream) -> list[tuple[int, int, int]]:
    """:func:`frame_starts` of an open bundle, of which only the end is read."""
    size = stream.size()
    stream.seek(size - 9)
    count = struct.unpack("<IBI", stream.read(9))[0]
    stream.seek(size - 9 - 8 * count)
    return frame_starts(stream.read(9 + 8 * count))


def read_record(bundle: str, frame: int, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record of a bundle, by decompressing its frame alone."""
    import zstandard

    system, path = filesystem(bundle)
    with system.open_input_file(path) as stream:
        start, compressed, plain = read_seek_table(stream)[frame]
        stream.seek(start)
        data = zstandard.ZstdDecompressor().decompress(stream.read(compressed), max_output_size=plain)
    return next(parse_records(data[offset : offset + length]))


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, digest, refers_to) of the records that repeat another's payload."""
    content = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    size = F.octet_length(content)
    digests = pages.filter(size >= least_bytes).select(
        "page_id", F.concat_ws("-", F.sha1(content), size).alias("digest")
    )
    digests = settle(digests, "digests")
    best = digests.groupBy("digest").agg(F.max("page_id").alias("refers_to"),
                                         F.count(F.lit(1)).alias("n"))
    shared = best.filter("n > 1 and refers_to is not null").drop("n")
    return (
        digests.join(shared, "digest")
        .filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .distinct()
    )


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Writes all pages (page_id, url, html) into bundles under ``folder``; returns the index."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    copies = settle(revisits(pages, least_bytes), "revisits")
    content = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    keyed = pages.withColumn("digest", F.concat_ws("-", F.sha1(content), F.octet_length(content)))
    copies = copies.select(F.col("page_id").alias("copy"), F.col("digest").alias("copied"), "refers_to")
    marked = keyed.join(
        copies,
        F.col("page_id").eqNullSafe(F.col("copy")) & (F.col("digest") == F.col("copied")), "left",
    ).select("page_id", "url", "html", "refers_to")
    filesystem(folder)[0].create_dir(filesystem(folder)[1], recursive=True)

    def write(batches):
        system, root = filesystem(folder)
        context = TaskContext.get()
        attempt = f"{context.partitionId():06d}-{context.taskAttemptId()}"
        bundle, name, number = None, None, 0
        for batch in batches:
            rows, columns = [], [batch.column(i) for i in range(4)]
            for i in range(batch.num_rows):
                page, url, html, refers = (c[i].as_py() for c in columns)
                if bundle is None:
                    name = f"{attempt}-{number:04d}.warc.zst"
                    bundle = Bundle(system.open_output_stream(f"{root}/{name}", compression=None))
                    number += 1
                place = bundle.add(record_bytes(page, url, (html or "").encode(), refers))
                rows.append((page, name, *place))
                if bundle.written >= BUNDLE_BYTES:
                    bundle.close()
                    bundle = None
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string() if f == "bundle" else pa.int64())
                 for c, f in zip(columns, INDEX.fieldNames())],
                names=INDEX.fieldNames(),
            )
        if bundle is not None:
            bundle.close()

    return settle(marked.mapInArrow(write, INDEX), "index")


def read_archives(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """One row per record of the bundles that the index names, parsed from the files."""
    live = checkpoint(index.select("bundle").distinct())
    bundles = max(1, min(live.count(), MOST_TASKS))

    def read(batches):
        import zstandard

        system, root = filesystem(folder)
        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_file(f"{root}/{name}") as stream:
                    for start, compressed, plain in read_seek_table(stream):
                        stream.seek(start)
                        frame = reader.decompress(stream.read(compressed), max_output_size=plain)
                        rows = [_row(*record) for record in parse_records(frame)]
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    # names travel, archives are opened where they are parsed, a frame at a time
    return live.repartition(bundles, "bundle").mapInArrow(read, RECORD)


_ARROW = pa.schema(
    [(f.name, pa.int64() if f.dataType == schemas.LONG else pa.string()) for f in RECORD.fields]
)


def _page(urn: str | None) -> int | None:
    digits = urn.removeprefix("<urn:page:").removesuffix(">") if urn else ""
    return int(digits) if digits else None


def _row(headers: dict[str, str], payload: bytes) -> dict:
    """What a record says; a response's size and digest are those of the payload as read."""
    response = headers["WARC-Type"] == "response"
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return {
        "page_id": _page(headers["WARC-Record-ID"]),
        "url": headers.get("WARC-Target-URI"),
        "record_type": headers["WARC-Type"],
        "payload_bytes": len(payload) if response else int(headers["WARC-Payload-Length"]),
        "payload_digest": digest if response else headers["WARC-Payload-Digest"].removeprefix("sha1:"),
        "refers_to": _page(headers.get("WARC-Refers-To")),
    }


def archive_folder(spark: SparkSession) -> str:
    return fresh_folder(spark, f"llm-warc-{uuid.uuid4().hex[:8]}")
