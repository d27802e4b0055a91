"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent frames; a seek table in a skippable frame at the end of each bundle lists the sizes
of its frames, and an index maps every record id to its bundle, frame and offset inside the frame. One record is read
by decompressing one frame. Of records with equal payloads the one with the largest page id is stored as a response,
the others are revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import rows_of, text_of
from packetloom.session import settle, shared_path

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
#: A task reads so many frames of one bundle at a time.
FRAMES_A_READ = 32

#: Fixed values of the seekable format: magic of a skippable frame, magic at the end of the seek table.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
#: Fixed values of WARC 1.1.
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

INDEX = "record_id string, bundle string, frame int, offset long, length long"
RECORD = (
    "record_id string, page_id long, url string, record_type string, payload_digest string, payload_bytes long,"
    " refers_to long, payload binary"
)
INDEX_SCHEMA = pa.schema(
    {"record_id": pa.string(), "bundle": pa.string(), "frame": pa.int32(), "offset": pa.int64(), "length": pa.int64()}
)
RECORD_SCHEMA = pa.schema(
    {
        "record_id": pa.string(),
        "page_id": pa.int64(),
        "url": pa.string(),
        "record_type": pa.string(),
        "payload_digest": pa.string(),
        "payload_bytes": pa.int64(),
        "refers_to": pa.int64(),
        "payload": pa.binary(),
    }
)


def bare_digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1 without a prefix."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_urn(row: int) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page-row:{row}')}"


def header_value(value: str) -> str:
    """A header is one line: control characters, which no valid address holds, are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def encode_record(fields: dict[str, str | None], block: bytes) -> bytes:
    head = "".join(f"{k}: {header_value(v)}\r\n" for k, v in fields.items() if v is not None)
    return VERSION + head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def decode_records(frame: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, headers and block of each record of a decompressed frame."""
    at = 0
    while at < len(frame):
        if not frame.startswith(VERSION, at):
            raise ValueError(f"no WARC record at offset {at} of a frame")
        end = frame.index(b"\r\n\r\n", at)
        lines = frame[at + len(VERSION) : end].decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines)
        start = end + 4
        stop = start + int(fields["Content-Length"])
        if frame[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at offset {at} of a frame does not end where its length says")
        yield at, fields, frame[start:stop]
        at = stop + 4


def page_record(row: dict, date: str) -> tuple[str, bytes]:
    """Record id and bytes of a page row with row, page_id, url, html, first_row, first_page."""
    payload = (row["html"] or "").encode()
    urn = record_urn(row["row"])
    revisit = row["first_row"] != row["row"]
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<{urn}>",
        "WARC-Date": date,
        "WARC-Target-URI": row["url"],
        "Content-Type": "application/http;msgtype=response",
        "WARC-Payload-Digest": f"sha1:{bare_digest(payload)}",
        "X-Page-Id": None if row["page_id"] is None else str(row["page_id"]),
        "X-Payload-Length": str(len(payload)),
    }
    if revisit:
        fields |= {
            "WARC-Profile": REVISIT_PROFILE,
            "WARC-Refers-To": f"<{record_urn(row['first_row'])}>",
            "X-Refers-To-Page-Id": None if row["first_page"] is None else str(row["first_page"]),
        }
    return urn, encode_record(fields, HTTP_HEAD if revisit else HTTP_HEAD + payload)


#: Rows of one payload from which on it is broadcast.
HOT_PAYLOAD = 100_000


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """Skippable frame with compressed and decompressed size of every frame."""
    body = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(file) -> list[tuple[int, int]]:
    """Offset and compressed size of every frame of an open bundle."""
    end = file.size()
    file.seek(end - 9)
    count, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("the bundle has no seek table")
    file.seek(end - 9 - 8 * count)
    entries = struct.iter_unpack("<II", file.read(8 * count))
    found, at = [], 0
    for packed, _ in entries:
        found.append((at, packed))
        at += packed
    return found


class Bundle:
    """Collects records into frames and writes the file when it is closed."""

    def __init__(self, frame_bytes: int) -> None:
        self.frame_bytes, self.packer = frame_bytes, zstandard.ZstdCompressor(level=3)
        self.out, self.frame, self.sizes = io.BytesIO(), bytearray(), []

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame and offset of the record."""
        place = len(self.sizes), len(self.frame)
        self.frame += record
        if len(self.frame) >= self.frame_bytes:
            self.end_frame()
        return place

    def end_frame(self) -> None:
        if self.frame:
            packed = self.packer.compress(bytes(self.frame))
            self.sizes.append((len(packed), len(self.frame)))
            self.out.write(packed)
            self.frame = bytearray()

    def save(self, uri: str) -> None:
        """Write under another name, then rename: a reader or a second attempt never sees half a file."""
        self.end_frame()
        files, path = pafs.FileSystem.from_uri(uri)
        files.create_dir(path.rsplit("/", 1)[0], recursive=True)
        part = f"{path}.{uuid.uuid4().hex}.part"
        with files.open_output_stream(part) as sink:
            sink.write(self.out.getvalue())
            sink.write(seek_table(self.sizes))
        files.move(part, path)


def with_references(pages: DataFrame, hot: int = HOT_PAYLOAD) -> DataFrame:
    """row, page_id, url, html of every page, with the row and page id of the response of its payload.

    The number of a row settles ties of page ids and names its record. Payloads that only one row has need no reference.
    Rows of the others meet theirs without their pages: payloads of ``hot`` rows and more, of which there are at most as many
    as that goes into the table, are broadcast, so no task gets more rows of one payload. Pages move once, by row.
    """
    numbered = pages.withColumn("row", F.monotonically_increasing_id())
    narrow = settle(numbered.select("row", "page_id", F.unhex(F.sha1(text_of("html").cast("binary"))).alias("payload")), "warc-payloads")
    first = narrow.groupBy("payload").agg(F.max(F.struct("page_id", "row")).alias("first"), F.count(F.lit(1)).alias("n"))
    first = settle(first.filter("n > 1").select("payload", "n", F.col("first.row").alias("first_row"), F.col("first.page_id").alias("first_page")), "warc-copies")
    frequent, rare = first.filter(F.col("n") >= hot).drop("n"), first.filter(F.col("n") < hot).drop("n")
    marked = narrow.join(F.broadcast(frequent), "payload", "left")
    known = marked.filter("first_row IS NOT NULL")
    found = known.unionByName(marked.filter("first_row IS NULL").drop("first_row", "first_page").join(rare, "payload"))
    joined = numbered.join(found.select("row", "first_row", "first_page"), "row", "left")
    alone = F.col("first_row").isNull()
    return joined.select(
        "row", "page_id", "url", "html", F.coalesce("first_row", "row").alias("first_row"),
        F.when(alone, F.col("page_id")).otherwise(F.col("first_page")).alias("first_page"),
    )


def write_bundles(
    pages: DataFrame,
    path: str,
    date: str = "2024-01-01T00:00:00Z",
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    stored: bool = False,
) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) below ``path``; give the index back, stored beside them.

    A null html is an empty payload, a null url has no target header, a null page id is smaller than any other. Rows
    that repeat a page become records of their own. File names follow from partition and number, so a task that runs
    again replaces its files by equal ones. An empty table writes no bundle and an empty index.

    Rows are numbered twice and must get the same numbers: ``stored`` says that ``pages`` is read from files as they are;
    anything else is written to the shared folder first.
    """
    pages = pages.select("page_id", "url", "html")
    pages = pages if stored else settle(pages, "warc-pages")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, rows = TaskContext.get().partitionId(), 0, []
        bundle, name = Bundle(frame_bytes), ""

        def index() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema=INDEX_SCHEMA)

        for batch in rows_of(batches):
            for row in batch.to_pylist():
                name = f"{path}/bundle-{part:06d}-{number:04d}.warc.zst"
                urn, record = page_record(row, date)
                frame, offset = bundle.add(record)
                rows.append({"record_id": urn, "bundle": name, "frame": frame, "offset": offset, "length": len(record)})
                if bundle.out.tell() >= bundle_bytes:
                    bundle.save(name)
                    yield index()
                    bundle, number, rows = Bundle(frame_bytes), number + 1, []
        if rows:
            bundle.save(name)
            yield index()

    # the order within a partition is fixed, so that a second attempt writes the same bytes
    ordered = with_references(pages).sortWithinPartitions("row")
    ordered.mapInArrow(write, INDEX).write.parquet(f"{path}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{path}/index")


def parse_record(fields: dict[str, str], block: bytes) -> dict:
    payload = block[block.index(b"\r\n\r\n") + 4 :]
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and digest != bare_digest(payload):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} does not have its digest")
    page, refers = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page-Id")
    return {
        "record_id": fields["WARC-Record-ID"][1:-1],
        "page_id": None if page is None else int(page),
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "payload_digest": digest,
        "payload_bytes": int(fields["X-Payload-Length"]) if revisit else len(payload),
        "refers_to": None if refers is None else int(refers),
        "payload": None if revisit else payload,
    }


def read_frames(bundle: str, frames: list[int]) -> Iterator[tuple[int, int, dict]]:
    """Frame, offset and content of the records of some frames of a bundle."""
    files, path = pafs.FileSystem.from_uri(bundle)
    unpack = zstandard.ZstdDecompressor()
    with files.open_input_file(path) as file:
        table = read_seek_table(file)
        for number in frames:
            offset, packed = table[number]
            file.seek(offset)
            for at, fields, block in decode_records(unpack.decompress(file.read(packed))):
                yield number, at, parse_record(fields, block)


def read_bundles(index: DataFrame) -> DataFrame:
    """All records of the bundles an index names; work is dealt out by runs of frames, not by files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in batch.to_pylist():
                rows = [r for _, _, r in read_frames(run["bundle"], sorted(run["frames"]))]
                yield pa.RecordBatch.from_pylist(rows, schema=RECORD_SCHEMA)

    runs = index.groupBy("bundle", F.expr(f"frame div {FRAMES_A_READ}").alias("run")).agg(F.collect_set("frame").alias("frames"))
    return runs.select("bundle", "frames").mapInArrow(read, RECORD)


def lookup(index: DataFrame, record_ids: DataFrame) -> DataFrame:
    """The records of ``record_ids`` (record_id): one frame each is read, at the place the index names."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for want in batch.to_pylist():
                found = [r for _, at, r in read_frames(want["bundle"], [want["frame"]]) if at == want["offset"]]
                yield pa.RecordBatch.from_pylist(found, schema=RECORD_SCHEMA)

    return index.join(record_ids.select("record_id").distinct(), "record_id").mapInArrow(fetch, RECORD)


def archive(pages: DataFrame, stored: bool = False) -> DataFrame:
    """Write ``pages`` to bundles in the shared folder and read them back."""
    return read_bundles(write_bundles(pages, shared_path(pages.sparkSession, "warc"), stored=stored))
