"""Packet captures to packet rows, many captures a task or many tasks a capture.

Small files are ``binaryFile`` rows that go through ``mapInPandas``. Record borders are found with one pass over the record
headers; the header fields of all packets are then read as numpy arrays.

A large capture is cut into byte ranges. A range does not know where its first record begins, so it looks for the first
place from which a chain of plausible record headers leads to its end, and tells where that chain leaves it. The
ranges of a file agree when each begins where the chain of the one before has left; the first one begins behind the
file header, so agreement makes all of them right. A range that was misled, by a payload that looks like records, is read
again from where the one before has left. Ranges travel by their borders, and packets are decoded in a second pass.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as SparkWindow
from pyspark.sql import functions as F

from packetloom.schemas import CAPTURED_PACKET
from packetloom.session import settle

# Fixed values of the capture and packet formats.
MAGIC = {
    b"\xd4\xc3\xb2\xa1": ("<", 1e-6),
    b"\xa1\xb2\xc3\xd4": (">", 1e-6),
    b"\x4d\x3c\xb2\xa1": ("<", 1e-9),
    b"\xa1\xb2\x3c\x4d": (">", 1e-9),
}
GLOBAL_HEADER, RECORD_HEADER = 24, 16
LINK_ETHERNET, LINK_RAW, LINK_RAW_OLD, LINK_SLL = 1, 101, 12, 113
LINK_OFFSET = {LINK_ETHERNET: 14, LINK_RAW: 0, LINK_RAW_OLD: 0, LINK_SLL: 16}
ETHERTYPE_IP, ETHERTYPE_VLAN = 0x0800, 0x8100
TCP, UDP, ICMP = 6, 17, 1
TCP_FLAG_LETTERS = "FSRPAUEC"  # bit 0 upwards
# Fixed values of the block format.
SECTION = b"\x0a\x0d\x0d\x0a"
BLOCK_INTERFACE, BLOCK_SIMPLE, BLOCK_PACKET = 1, 3, 6
LEAST_BLOCK = {BLOCK_INTERFACE: 20, BLOCK_SIMPLE: 16, BLOCK_PACKET: 32}
OPTION_RESOLUTION = 9
UNKNOWN_FORMAT, UNKNOWN_LINK, CUT_OFF = "unknown format", "unknown link type", "cut off"
BATCH = 20_000
GROUP_BYTES = 32 * 1024 * 1024


@dataclass(frozen=True)
class Found:
    """Packets of a capture: place, captured length, number, link type and time of each; ``problem`` names what was lost."""

    at: np.ndarray
    time: np.ndarray
    problem: str | None

    @classmethod
    def of(cls, rows: list[tuple[int, int, int, int, float]], problems: list[str]) -> Found:
        table = np.array([r[:4] for r in rows], dtype=np.int64).reshape(-1, 4)
        return cls(table, np.array([r[4] for r in rows], dtype=float), ", ".join(dict.fromkeys(problems)) or None)


def _classic(content: bytes) -> Found:
    """Complete records of a capture with one header for the file."""
    endian, unit = MAGIC[content[:4]]
    (link,) = struct.unpack_from(endian + "I", content, 20)
    if link not in LINK_OFFSET:
        return Found.of([], [UNKNOWN_LINK])
    header = struct.Struct(endian + "III")
    rows, problems = [], []
    at, end = GLOBAL_HEADER, len(content)
    while at < end:
        if at + RECORD_HEADER > end:
            problems.append(CUT_OFF)
            break
        seconds, fraction, captured = header.unpack_from(content, at)
        at += RECORD_HEADER
        if at + captured > end:
            problems.append(CUT_OFF)
            break
        rows.append((at, captured, len(rows), link, seconds + fraction * unit))
        at += captured
    return Found.of(rows, problems)


def _ticks_per_second(options: bytes, endian: str) -> int:
    """As the options of an interface say; a million without the option."""
    at = 0
    while at + 4 <= len(options):
        code, size = struct.unpack_from(endian + "HH", options, at)
        if code == 0:
            break
        if code == OPTION_RESOLUTION and size == 1 and at + 4 < len(options):
            value = options[at + 4]
            return 1 << (value & 127) if value & 128 else 10**value
        at += 4 + (size + 3) // 4 * 4
    return 1_000_000


def _blocks(content: bytes) -> Found:
    """Packets of a capture in blocks: sections in either byte order, several interfaces, times in their own units."""
    rows, problems, interfaces, endian = [], [], [], "<"
    at, end, number = 0, len(content), 0
    while at < end:
        if at + 12 > end:
            problems.append(CUT_OFF)
            break
        if content[at : at + 4] == SECTION:
            endian = "<" if content[at + 8 : at + 12] == b"\x4d\x3c\x2b\x1a" else ">"
            interfaces = []
        kind, size = struct.unpack_from(endian + "II", content, at)
        if size < 12 or at + size > end:
            problems.append(CUT_OFF)
            break
        body = at + 8
        if kind == BLOCK_INTERFACE and size >= LEAST_BLOCK[kind]:
            (link,) = struct.unpack_from(endian + "H", content, body)
            interfaces.append((link, _ticks_per_second(content[body + 8 : at + size - 4], endian)))
        elif size < LEAST_BLOCK.get(kind, 0):
            problems.append(CUT_OFF)
            number += kind != BLOCK_INTERFACE
        elif kind in (BLOCK_PACKET, BLOCK_SIMPLE):
            if kind == BLOCK_PACKET:
                interface, high, low, captured = struct.unpack_from(endian + "IIII", content, body)
                data, ticks = body + 20, high << 32 | low
            else:
                # a simple block has no time and was taken at the first interface
                interface, captured, data, ticks = 0, size - 16, body + 4, 0
                captured = min(captured, struct.unpack_from(endian + "I", content, body)[0])
            if interface < len(interfaces) and interfaces[interface][0] in LINK_OFFSET and data + captured <= at + size:
                link, per_second = interfaces[interface]
                rows.append((data, captured, number, link, ticks // per_second + ticks % per_second / per_second))
            else:
                problems.append(UNKNOWN_LINK)
            number += 1
        at += size
    return Found.of(rows, problems)


def index(content: bytes) -> Found:
    """Where the packets of a capture are."""
    if content[:4] == SECTION:
        return _blocks(content)
    if len(content) >= GLOBAL_HEADER and content[:4] in MAGIC:
        return _classic(content)
    return Found.of([], [UNKNOWN_FORMAT])


def _u16(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Big-endian 16-bit numbers; positions behind the end of the data are read at its end and masked by the caller."""
    at = np.minimum(at, len(data) - 2)
    return data[at].astype(np.int32) << 8 | data[at + 1]


def _addresses(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Dotted addresses; every distinct address is formatted once."""
    packed = np.zeros(len(at), dtype=np.uint32)
    for i in range(4):
        packed = packed << np.uint32(8) | data[at + i]
    distinct, position = np.unique(packed, return_inverse=True)
    texts = np.array([f"{a >> 24}.{a >> 16 & 255}.{a >> 8 & 255}.{a & 255}" for a in distinct.tolist()], dtype=object)
    return texts[position] if len(at) else np.array([], dtype=object)


def _flag_text(bits: int) -> str:
    return "".join(letter for i, letter in enumerate(TCP_FLAG_LETTERS) if bits >> i & 1)


FLAG_TEXT = [_flag_text(bits) for bits in range(256)]


def decode(paths: Sequence[str], contents: Sequence[bytes], label: int) -> Iterator[pd.DataFrame]:
    """Packet rows of some captures. Packets without an IPv4 header are left out; ``length`` is the captured length.

    The header fields of all captures are read together as arrays, so many small captures cost no more than one big one.
    """
    parts, names, base = [], [], 0
    for path, content in zip(paths, contents):
        found = index(content)
        if len(found.at):
            whole = np.empty((len(found.at), 5), dtype=np.int64)
            whole[:, :4] = found.at
            whole[:, 0] += base
            whole[:, 4] = len(names)
            parts.append((whole, found.time))
            names.append(path)
        base += len(content)
    if not parts:
        return
    data = np.frombuffer(contents[0] if len(contents) == 1 else b"".join(contents), dtype=np.uint8)
    table = np.concatenate([p[0] for p in parts])
    times = np.concatenate([p[1] for p in parts])
    known = np.array(names, dtype=object)
    for first in range(0, len(table), BATCH):
        part = slice(first, first + BATCH)
        yield _decode_records(data, table[part], times[part], known, label)


def _decode_records(data: np.ndarray, table: np.ndarray, time: np.ndarray, names: np.ndarray, label: int) -> pd.DataFrame:
    start, length, number, link, owner = table.T
    end = start + length
    offset = np.zeros(len(start), dtype=np.int64)
    for kind, size in LINK_OFFSET.items():
        offset[link == kind] = size
    ether = link == LINK_ETHERNET
    kind = _u16(data, start + 12)
    tagged = ether & (kind == ETHERTYPE_VLAN)
    ip = start + offset + np.where(tagged, 4, 0)
    carried = np.where(tagged, _u16(data, start + 16), kind)
    is_ip = np.where(ether, carried == ETHERTYPE_IP, True)
    is_ip &= np.where(link == LINK_SLL, _u16(data, start + 14) == ETHERTYPE_IP, True)
    is_ip &= ip + 20 <= end
    is_ip &= (data[np.minimum(ip, len(data) - 1)] >> 4) == 4
    length, time, number, owner, ip, end = (x[is_ip] for x in (length, time, number, owner, ip, end))
    protocol = data[ip + 9]
    transport = ip + (data[ip] & 15).astype(np.int64) * 4
    fragment = (_u16(data, ip + 6) & 0x1FFF) != 0
    tcp = (protocol == TCP) & ~fragment & (transport + 14 <= end)
    udp = (protocol == UDP) & ~fragment & (transport + 8 <= end)
    icmp = (protocol == ICMP) & ~fragment
    has_ports = tcp | udp
    ports = np.where(has_ports, transport, ip)
    name = np.where(tcp, "TCP", np.where(udp, "UDP", np.where(icmp, "ICMP", protocol.astype(str))))
    bits = data[np.where(tcp, transport + 13, ip)]
    return pd.DataFrame(
        {
            "path": names[owner],
            "packet_no": number,
            "timestamp": time,
            "src_ip": _addresses(data, ip + 12),
            "dst_ip": _addresses(data, ip + 16),
            "protocol": name,
            "src_port": np.where(has_ports, _u16(data, ports), 0).astype(np.int32),
            "dst_port": np.where(has_ports, _u16(data, ports + 2), 0).astype(np.int32),
            "length": length.astype(np.int32),
            "flags": [FLAG_TEXT[b] if t else None for b, t in zip(bits, tcp)],
            "ttl": data[ip + 8].astype(np.int32),
            "label": np.full(len(ip), label, dtype=np.int32),
        }
    )


def _groups(batch: pd.DataFrame) -> Iterator[tuple[list[str], list[bytes]]]:
    """Captures of a batch in groups of bounded size; a bigger capture is a group of its own."""
    paths: list[str] = []
    contents: list[bytes] = []
    size = 0
    for path, content in zip(batch["path"], batch["content"]):
        if contents and size + len(content) > GROUP_BYTES:
            yield paths, contents
            paths, contents, size = [], [], 0
        paths.append(path)
        contents.append(bytes(content))
        size += len(content)
    if contents:
        yield paths, contents


def decode_captures(files: DataFrame, label: int = 0) -> DataFrame:
    """Rows ``(path, content)`` to packet rows; every file gets the same label."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for paths, contents in _groups(batch):
                yield from decode(paths, contents, label)

    return files.select("path", "content").mapInPandas(run, CAPTURED_PACKET)


def capture_report(files: DataFrame) -> DataFrame:
    """Rows ``(path, content)`` to ``(path, packets, problem)``: what could be read of every file, and what was lost."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [index(bytes(content)) for content in batch["content"]]
            yield pd.DataFrame({"path": batch["path"], "packets": [len(f.at) for f in found], "problem": [f.problem for f in found]})

    return files.select("path", "content").mapInPandas(run, "path string, packets bigint, problem string")


#: Bytes of a range; files of more than one range are cut.
RANGE_BYTES = 128 * 1024 * 1024
#: Longest packet that a chain of headers may have, and longest time in seconds between records of one file.
MOST_CAPTURED, MOST_SECONDS = 1 << 18, 10 * 366 * 86_400
RANGE = "path string, range int, low bigint, high bigint, size bigint"
CHAIN = f"{RANGE}, head binary, entry bigint, left bigint, packets bigint, problem string"


class Window:
    """Bytes of a file from ``low`` on, read as far as they are needed."""

    def __init__(self, path: str, size: int, chunk: int = 1 << 20):
        from pyarrow import fs

        files, name = fs.FileSystem.from_uri(path)
        self.file, self.size, self.chunk = files.open_input_file(name), size, chunk
        self.start, self.held = 0, b""

    def read(self, at: int, count: int) -> bytes:
        """At most ``count`` bytes from ``at`` on; fewer at the end of the file."""
        if at < self.start or at + count > self.start + len(self.held):
            self.file.seek(at)
            self.start, self.held = at, self.file.read(min(max(count, self.chunk), self.size - at)) if at < self.size else b""
        return self.held[at - self.start : at - self.start + count]


def _plausible(header: tuple[int, int, int, int], most_fraction: int, near: int | None) -> bool:
    seconds, fraction, captured, whole = header
    if fraction >= most_fraction or captured > MOST_CAPTURED or whole < captured:
        return False
    return near is None or abs(seconds - near) <= MOST_SECONDS


def follow(window: Window, head: bytes, at: int, high: int) -> tuple[int, int, str | None]:
    """Where the chain of records from ``at`` leaves the range, how many begin in it, and what is wrong with the last one."""
    header = struct.Struct(MAGIC[head[:4]][0] + "III")
    packets = 0
    while at < high:
        found = window.read(at, RECORD_HEADER)
        if len(found) < RECORD_HEADER:
            return window.size, packets, CUT_OFF
        captured = header.unpack_from(found)[2]
        if at + RECORD_HEADER + captured > window.size:
            return window.size, packets, CUT_OFF
        at += RECORD_HEADER + captured
        packets += 1
    return at, packets, None


def resynchronise(window: Window, head: bytes, low: int, high: int) -> int | None:
    """The first place in the range from which plausible headers lead to its end; None where no record begins in it."""
    endian, unit = MAGIC[head[:4]]
    header, most_fraction = struct.Struct(endian + "IIII"), round(1 / unit)
    first = window.read(GLOBAL_HEADER, RECORD_HEADER)
    near = header.unpack(first)[0] if len(first) == RECORD_HEADER else None
    for begin in range(low, high):
        at = begin
        while at < high:
            found = window.read(at, RECORD_HEADER)
            if len(found) < RECORD_HEADER or not _plausible(header.unpack(found), most_fraction, near):
                break
            at += RECORD_HEADER + header.unpack(found)[2]
        if at >= high and at <= window.size:
            return begin
    return None


def _chain(rows: pd.DataFrame, known: bool) -> pd.DataFrame:
    """Entry, exit and packets of every range; ``known`` says that the entry is given."""
    out = []
    for row in rows.itertuples(index=False):
        window = Window(row.path, row.size)
        head = window.read(0, GLOBAL_HEADER)
        base = (row.path, row.range, row.low, row.high, row.size, head)
        if len(head) < GLOBAL_HEADER or head[:4] not in MAGIC:
            out.append((*base, None, None, 0, UNKNOWN_FORMAT))
            continue
        if struct.unpack_from(MAGIC[head[:4]][0] + "I", head, 20)[0] not in LINK_OFFSET:
            out.append((*base, None, None, 0, UNKNOWN_LINK))
            continue
        if known:
            entry = int(row.entry)
        elif row.range == 0:
            entry = GLOBAL_HEADER
        else:
            entry = resynchronise(window, head, row.low, row.high)
        if entry is None or entry >= row.high:
            out.append((*base, None, None, 0, None))
        else:
            out.append((*base, entry, *follow(window, head, entry, row.high)))
    names = ["path", "range", "low", "high", "size", "head", "entry", "left", "packets", "problem"]
    table = pd.DataFrame(out, columns=names)
    return table.astype({"entry": "Int64", "left": "Int64"})


def _runner(known: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield _chain(batch, known)

    return run


def capture_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Ranges of the captures ``(path, length)`` with one file header, each with its first record and what follows.

    Ranges that disagree with the one before are read again until none is left; without misleading payloads there are none.
    """
    ranges = files.withColumn("range", F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / range_bytes).cast("int"))))
    low = F.col("range").cast("bigint") * range_bytes
    ranges = ranges.select("path", "range", low.alias("low"), F.least(low + range_bytes, "length").alias("high"), F.col("length").alias("size"))
    spread = ranges.repartition("path", "range")
    found = settle(spread.mapInPandas(_runner(False), CHAIN), "ranges")
    while True:
        # the chain of all ranges before leaves at the last known exit; one row per range
        before = SparkWindow.partitionBy("path").orderBy("range").rowsBetween(SparkWindow.unboundedPreceding, -1)
        expected = F.coalesce(F.max("left").over(before), F.lit(GLOBAL_HEADER).cast("bigint"))
        judged = found.withColumn("expected", expected)
        fits = F.when(F.col("expected") >= F.col("high"), F.col("entry").isNull()).otherwise(F.col("entry").eqNullSafe(F.col("expected")))
        wrong = judged.where(F.col("problem").isNull() | (F.col("problem") == CUT_OFF)).where(~fits)
        # the first wrong range of a file gets its right entry, later ones very likely do
        wrong = settle(wrong.drop("entry").withColumnRenamed("expected", "entry"), "misled")
        if wrong.isEmpty():
            return found
        mended = wrong.select("path", "range", "low", "high", "size", "entry").repartition("path", "range").mapInPandas(_runner(True), CHAIN)
        found = settle(found.join(wrong.select("path", "range"), ["path", "range"], "left_anti").unionByName(mended), "ranges")


def decode_ranges(ranges: DataFrame, label: int = 0) -> DataFrame:
    """Packet rows of the ranges of ``capture_ranges``; packets are numbered over the whole file."""
    before = SparkWindow.partitionBy("path").orderBy("range").rowsBetween(SparkWindow.unboundedPreceding, -1)
    numbered = ranges.withColumn("first_number", F.coalesce(F.sum("packets").over(before), F.lit(0)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                window = Window(row.path, row.size)
                at, end, number = int(row.entry), int(row.left), int(row.first_number)
                while at < end:
                    # whole records of at most GROUP_BYTES behind a file header are a capture of their own
                    piece = bytes(row.head) + window.read(at, min(GROUP_BYTES, end - at))
                    found = index(piece)
                    if not len(found.at):
                        break
                    for part in decode([row.path], [piece], label):
                        yield part.assign(packet_no=part["packet_no"] + number)
                    number += len(found.at)
                    at += int(found.at[-1][0] + found.at[-1][1]) - GLOBAL_HEADER

    wanted = numbered.where("entry IS NOT NULL").select("path", "size", "head", "entry", "left", "first_number")
    return wanted.repartition("path", "entry").mapInPandas(run, CAPTURED_PACKET)


def capture_files(spark: SparkSession, folder: str, pattern: str = "*.pcap*") -> DataFrame:
    """Files of both capture formats below a folder as rows ``(path, content, length)``; a content that is not used is not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)


def read_captures(
    spark: SparkSession, folder: str, label: int = 0, pattern: str = "*.pcap*", range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Decode all captures below a folder; ``capture_report`` tells what cannot be read.

    Captures with one file header of more than ``range_bytes`` are cut into ranges, of any size; their folder must be one
    that ``pyarrow.fs`` reaches. Captures in blocks, whose sections and interfaces may change on the way, and small ones
    are one task each and at most 2 GB.
    """
    files = capture_files(spark, folder, pattern)
    large = F.col("length") > range_bytes
    whole = decode_captures(files.where(~large), label)
    paths = files.where(large).select("path", "length")
    if not paths.isEmpty():
        ranges = capture_ranges(paths, range_bytes)
        in_blocks = ranges.where(F.col("problem") == UNKNOWN_FORMAT).select("path").distinct()
        blocks = files.where(large).join(F.broadcast(in_blocks), "path", "left_semi")
        whole = whole.unionByName(decode_ranges(ranges, label)).unionByName(decode_captures(blocks, label))
    return whole.withColumn("ts", F.timestamp_micros(F.round(F.col("timestamp") * 1e6).cast("bigint")))
