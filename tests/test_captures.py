import struct

from packetloom.sources import captures


def ethernet(ip, kind=0x0800, vlan=False):
    tag = struct.pack(">HH", 0x8100, 5) if vlan else b""
    return bytes(12) + tag + struct.pack(">H", kind) + ip


def ipv4(protocol, payload, src=(10, 0, 0, 1), dst=(192, 168, 1, 2), ttl=64, options=b"", fragment=0):
    words = (20 + len(options)) // 4
    head = struct.pack(">BBHHHBBH", 0x40 | words, 0, 20 + len(options) + len(payload), 0, fragment, ttl, protocol, 0)
    return head + bytes(src) + bytes(dst) + options + payload


def tcp(sport, dport, flags):
    return struct.pack(">HHIIBBHHH", sport, dport, 0, 0, 0x50, flags, 0, 0, 0)


def udp(sport, dport):
    return struct.pack(">HHHH", sport, dport, 8, 0)


def capture(packets, magic=b"\xd4\xc3\xb2\xa1", endian="<", link=1):
    out = magic + struct.pack(endian + "HHiIII", 2, 4, 0, 0, 65535, link)
    for seconds, fraction, data in packets:
        out += struct.pack(endian + "IIII", seconds, fraction, len(data), len(data)) + data
    return out


def rows(content, label=0):
    return [r for part in captures.decode(["f"], [content], label) for r in part.to_dict("records")]


def test_mixed_capture():
    content = capture(
        [
            (1, 500_000, ethernet(ipv4(6, tcp(1000, 80, 0x12)))),
            (2, 0, ethernet(b"\0" * 40, kind=0x86DD)),
            (3, 0, ethernet(ipv4(17, udp(53, 5353)), vlan=True)),
            (4, 0, ethernet(ipv4(1, b"\x08\0\0\0"), kind=0x0800)),
            (5, 0, ethernet(ipv4(47, b"abcd", ttl=3))),
            (6, 0, ethernet(ipv4(6, tcp(7, 8, 0x01), options=b"\0" * 8))),
            (7, 0, ethernet(ipv4(6, tcp(7, 8, 0x02), fragment=5))),
        ]
    )
    got = rows(content, label=1)
    assert [(r["packet_no"], r["protocol"], r["src_port"], r["dst_port"], r["flags"]) for r in got] == [
        (0, "TCP", 1000, 80, "SA"),
        (2, "UDP", 53, 5353, None),
        (3, "ICMP", 0, 0, None),
        (4, "47", 0, 0, None),
        (5, "TCP", 7, 8, "F"),
        (6, "6", 0, 0, None),
    ]
    assert got[0]["timestamp"] == 1.5 and got[0]["length"] == 54 and got[0]["label"] == 1
    assert (got[0]["src_ip"], got[0]["dst_ip"], got[3]["ttl"]) == ("10.0.0.1", "192.168.1.2", 3)


def test_byte_orders_units_and_links():
    packet = ipv4(6, tcp(1, 2, 0x04))
    big = capture([(9, 250_000_000, packet)], b"\xa1\xb2\x3c\x4d", ">", link=101)
    assert rows(big)[0]["timestamp"] == 9.25 and rows(big)[0]["flags"] == "R"
    cooked = capture([(9, 0, bytes(14) + b"\x08\0" + packet)], link=113)
    assert rows(cooked)[0]["dst_port"] == 2


def test_damaged_captures():
    whole = capture([(1, 0, ethernet(ipv4(6, tcp(1, 2, 2)))), (2, 0, ethernet(ipv4(6, tcp(3, 4, 2))))])
    assert len(rows(whole[:-5])) == 1
    assert rows(whole[:30]) == [] and rows(b"") == [] and rows(b"not a capture") == []
    assert rows(capture([(1, 0, b"\x01")])) == []
    assert rows(capture([(1, 0, ethernet(ipv4(6, b"\0\x01")))]))[0]["protocol"] == "6"


def test_read_folder(spark, tmp_path):
    for i in range(3):
        packets = [(1_704_067_200 + j, 0, ethernet(ipv4(6, tcp(i, 80, 0x02)))) for j in range(50)]
        (tmp_path / f"c{i}.pcap").write_bytes(capture(packets))
    (tmp_path / "notes.txt").write_text("x")
    df = captures.read_captures(spark, str(tmp_path), label=1)
    assert df.count() == 150
    first = df.orderBy("path", "packet_no").first()
    assert (first["flags"], first["label"], str(first["ts"])) == ("S", 1, "2024-01-01 00:00:00")


def test_many_captures_are_decoded_together():
    one = capture([(1, 0, ethernet(ipv4(6, tcp(1, 2, 2))))])
    other = capture([(9, 250_000_000, ipv4(17, udp(5, 6)))], b"\xa1\xb2\x3c\x4d", ">", link=101)
    parts = list(captures.decode(["a", "junk", "b", "a2"], [one, b"junk", other, one], 0))
    got = [(r["path"], r["timestamp"], r["dst_port"]) for p in parts for r in p.to_dict("records")]
    assert got == [("a", 1.0, 2), ("b", 9.25, 6), ("a2", 1.0, 2)]


def block(kind, body, endian="<"):
    body += b"\0" * (-len(body) % 4)
    size = struct.pack(endian + "I", len(body) + 12)
    return struct.pack(endian + "I", kind) + size + body + size


def section(endian="<"):
    return block(0x0A0D0D0A, struct.pack(endian + "IHHq", 0x1A2B3C4D, 1, 0, -1), endian)


def interface(link=1, endian="<", options=b""):
    return block(1, struct.pack(endian + "HHI", link, 0, 65535) + options, endian)


def packet(ticks, data, number=0, endian="<"):
    return block(6, struct.pack(endian + "IIIII", number, ticks >> 32, ticks & 0xFFFFFFFF, len(data), len(data)) + data, endian)


def test_block_capture():
    frame = ethernet(ipv4(17, udp(53, 5353)))
    nano = struct.pack("<HHB3xHH", 9, 1, 9, 0, 0)
    content = section() + interface() + interface(link=101, options=nano) + block(5, b"statistics")
    content += packet(1_700_000_000_123_456, frame) + packet(1_700_000_000_000_000_100, ipv4(6, tcp(1, 2, 0x02)), 1)
    content += block(3, struct.pack("<I", len(frame)) + frame)
    content += section(">") + interface(endian=">") + packet(2_000_000, frame, endian=">")
    got = rows(content)
    assert [(r["packet_no"], r["protocol"], r["src_port"]) for r in got] == [(0, "UDP", 53), (1, "TCP", 1), (2, "UDP", 53), (3, "UDP", 53)]
    assert [round(r["timestamp"], 6) for r in got] == [1_700_000_000.123456, 1_700_000_000.0, 0.0, 2.0]
    assert captures.index(content).problem is None


def test_report_counts_what_cannot_be_read(spark, tmp_path):
    frame = ethernet(ipv4(6, tcp(1, 2, 0x02)))
    good = capture([(1, 0, frame), (2, 0, frame)])
    files = {
        "a.pcap": good,
        "b.pcap": good[:-3],
        "c.pcapng": section() + interface() + packet(5, frame) + packet(6, frame)[:-8],
        "d.pcap": capture([(1, 0, frame)], link=147),
        "e.pcap": b"no capture",
        "f.pcapng": section() + interface(link=147) + packet(5, frame),
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    found = captures.capture_report(captures.capture_files(spark, str(tmp_path)))
    got = {r["path"].rsplit("/", 1)[1]: (r["packets"], r["problem"]) for r in found.collect()}
    assert got == {
        "a.pcap": (2, None), "b.pcap": (1, "cut off"), "c.pcapng": (1, "cut off"), "d.pcap": (0, "unknown link type"),
        "e.pcap": (0, "unknown format"), "f.pcapng": (0, "unknown link type"),
    }
    assert captures.read_captures(spark, str(tmp_path)).count() == 4


def test_blocks_shorter_than_their_header_are_named():
    frame = ethernet(ipv4(6, tcp(1, 2, 0x02)))
    start = section() + interface()
    for damaged in (block(6, b"\0" * 8), block(3, b""), block(6, b""), block(1, b"\0" * 4)):
        found = captures.index(start + damaged + packet(5, frame))
        assert len(found.at) == 1 and found.problem == "cut off"
    cut_option = interface(options=struct.pack("<HH", 9, 1))
    assert len(captures.index(section() + cut_option + packet(5, frame)).at) == 1


def test_no_cut_of_a_capture_ends_the_scan():
    frame = ethernet(ipv4(17, udp(53, 5353)))
    nano = struct.pack("<HHB3xHH", 9, 1, 9, 0, 0)
    blocks = section() + interface(options=nano) + packet(5, frame) + block(3, struct.pack("<I", len(frame)) + frame)
    for whole in (blocks, capture([(1, 0, frame), (2, 0, frame)])):
        for end in range(len(whole)):
            captures.index(whole[:end])
            for at in range(0, end, 7):
                captures.index(whole[:at] + b"\xff" + whole[at + 1 : end])


def long_capture(n, endian="<", magic=b"\xd4\xc3\xb2\xa1", decoy=False):
    """Packets of several sizes; a decoy carries something that looks like records of its own."""
    out = []
    for i in range(n):
        payload = bytes([i % 251]) * (i * 37 % 150)
        if decoy and i % 3 == 0:
            payload = b"".join(struct.pack(endian + "IIII", 1_700_000_000, 5, 20, 20) + bytes(20) for _ in range(6))
        out.append((1_700_000_000 + i, i, ethernet(ipv4(17, udp(i, 53) + payload))))
    return capture(out, magic, endian)


def test_ranges_of_any_size_give_all_packets(spark, tmp_path):
    cases = {"a.pcap": long_capture(60), "b.pcap": long_capture(60, ">", b"\xa1\xb2\xc3\xd4"), "c.pcap": long_capture(60, decoy=True)}
    for name, content in cases.items():
        (tmp_path / name).write_bytes(content)
    whole = captures.read_captures(spark, str(tmp_path)).toPandas().sort_values(["path", "packet_no"]).reset_index(drop=True)
    assert len(whole) == 180
    for size in (150, 700, 4096):
        cut = captures.read_captures(spark, str(tmp_path), range_bytes=size).toPandas().sort_values(["path", "packet_no"])
        assert cut.reset_index(drop=True).equals(whole), size


def test_a_cut_at_every_offset_is_resynchronised(tmp_path):
    content = long_capture(12)
    path = tmp_path / "a.pcap"
    path.write_bytes(content)
    found = captures.index(content)
    starts = (found.at[:, 0] - captures.RECORD_HEADER).tolist()
    window = captures.Window(f"file://{path}", len(content))
    for low in range(captures.GLOBAL_HEADER, len(content)):
        wanted = next((s for s in starts if s >= low), None)
        assert captures.resynchronise(window, content[:24], low, len(content)) == wanted, low


def test_large_captures_that_are_damaged_or_in_blocks(spark, tmp_path):
    frame = ethernet(ipv4(6, tcp(1, 2, 0x02)))
    (tmp_path / "cut.pcap").write_bytes(long_capture(40)[:-9])
    (tmp_path / "blocks.pcapng").write_bytes(section() + interface() + b"".join(packet(i, frame) for i in range(30)))
    (tmp_path / "junk.pcap").write_bytes(b"no capture" * 100)
    got = captures.read_captures(spark, str(tmp_path), range_bytes=200).groupBy("path").count().collect()
    assert {r["path"].rsplit("/", 1)[1]: r["count"] for r in got} == {"cut.pcap": 39, "blocks.pcapng": 30}
