"""Packet decoding against frames packed in plain Python."""

import struct

import pytest
from pyspark.sql import functions as F

from alarmloom.operators import packets
from alarmloom.sources.kafka import byte_values

FIELDS = [
    ("second_frag", 1),
    ("first_frag", 1),
    ("module_code", 4),
    ("source_code", 4),
    ("reserve1", 20),
    ("type", 2),
    ("pkt_number", 24),
    ("sn_device", 2),
    ("sn_produc", 4),
    ("sn_batch", 2),
    ("sn_number", 32),
    ("policy_match", 1),
    ("policy_id", 14),
    ("source_port", 7),
    ("time_stamp", 42),
    ("flow_index", 32),
    ("sequence_number", 16),
    ("reserve2", 16),
]
TEXT = {"reserve1", "sn_number", "time_stamp", "reserve2"}


def header(**values):
    bits = "".join(format(values.get(name, 0), f"0{width}b") for name, width in FIELDS)
    assert len(bits) == 224
    return int(bits, 2).to_bytes(28, "big")


def frame(protocol, transport, options=b""):
    ethernet = bytes.fromhex("0a0b0c0d0eff" "010203040506" "0800")
    ip = struct.pack(
        ">BBHHHBBH4s4s", 0x40 | (5 + len(options) // 4), 0, 0, 0, 0, 64, protocol, 0,
        bytes([10, 0, 0, 200]), bytes([255, 1, 0, 3]),
    )
    return ethernet + ip + options + transport


def udp(source, dest, payload):
    return struct.pack(">HHHH", source, dest, 8 + len(payload), 0) + payload


def tcp(source, dest, payload, words=5):
    fixed = struct.pack(">HHIIBBHHH", source, dest, 1, 2, words << 4, 0, 0, 0, 0)
    return fixed + b"\x01" * ((words - 5) * 4) + payload


def rows(messages, records, operator=packets.decode_packets):
    found = operator(byte_values(messages([(0, i, 1, r) for i, r in enumerate(records)], "p")))
    return {r.offset: r for r in found.collect()}


@pytest.mark.parametrize("fill", ["zero", "one", "mixed"])
def test_header_round_trip(messages, fill):
    values = {
        name: {"zero": 0, "one": 2**width - 1, "mixed": (0x5A5A5A5A5A5A >> 3) % 2**width}[fill]
        for name, width in FIELDS
    }
    row = rows(messages, [header(**values)], packets.decode_header)[0]
    for name, width in FIELDS:
        expected = format(values[name], f"0{width}b") if name in TEXT else values[name]
        assert row[name] == expected, name


@pytest.mark.parametrize("name, width", FIELDS)
def test_each_header_field_alone(messages, name, width):
    row = rows(messages, [header(**{name: 2**width - 1})], packets.decode_header)[0]
    for other, other_width in FIELDS:
        value = 2**width - 1 if other == name else 0
        assert row[other] == (format(value, f"0{other_width}b") if other in TEXT else value)


def test_flows(messages):
    records = [
        header() + frame(17, udp(53, 65535, b"dns")),
        header() + frame(6, tcp(443, 1, b"tls")),
        header() + frame(6, tcp(443, 1, b"tls", words=8), options=b"\x01" * 4),
        header() + frame(1, b"\x08\x00\x12\x34" + b"echo"),
        header() + frame(50, b"\x00" * 8),
        header() + frame(17, b"\x00\x01"),  # no room for the ports
        header() + frame(17, udp(1, 2, b""))[:20],
        header()[:20],
        b"",
        header() + frame(17, udp(7, 8, b"options"), options=b"\x01" * 40),
    ]
    found = rows(messages, records)
    assert found.keys() == {0, 1, 2, 3, 9}
    first = found[0]
    assert (first.destMac, first.srcMac) == ("0a:0b:0c:0d:0e:ff", "01:02:03:04:05:06")
    assert (first.ethType, first.srcIp, first.destIp) == ("0x0800", "10.0.0.200", "255.1.0.3")
    flows = {k: (r.protocol, r.srcPort, r.destPort, bytes(r.packetData)) for k, r in found.items()}
    assert flows == {
        0: ("UDP", 53, 65535, b"dns"),
        1: ("TCP", 443, 1, b"tls"),
        2: ("TCP", 443, 1, b"tls"),
        3: ("ICMP", None, None, b"echo"),
        9: ("UDP", 7, 8, b"options"),
    }


def test_counts_agree_with_the_decoder(messages):
    short_header = bytearray(header() + frame(17, udp(1, 2, b"x")))
    short_header[28 + 14] = 0x44
    records = [
        header() + frame(17, udp(53, 1, b"dns")),
        header() + frame(1, b""),
        header() + frame(17, b"\x00\x01"),
        bytes(short_header),
        header() + frame(50, b"\x00" * 8),
        header()[:20],
        None,
    ]
    found = byte_values(messages([(0, i, 1, r) for i, r in enumerate(records)], "p"))
    counts = {r.outcome: r["count"] for r in packets.dropped_packets(found).collect()}
    assert counts == {"decoded": 2, "transport": 1, "ip_header": 1, "protocol": 1, "short": 2}
    assert packets.decode_flow(found).count() == 2


def test_large_payload_is_kept_whole(messages):
    payload = bytes(range(256)) * 5
    found = rows(messages, [header() + frame(17, udp(1, 2, payload))])
    assert bytes(found[0].packetData) == payload


def test_packet_keys(messages):
    record = header(sn_number=0xFFC00001, sequence_number=3)
    found = byte_values(messages([(0, 0, 1, record)], "p")).select(
        packets.packet_key(F.col("value")).alias("a"),
        packets.packet_key(F.col("value"), "serial_seq").alias("b"),
    )
    assert list(found.first()) == ["1" * 10, format(0xFFC00001, "032b") + format(3, "016b")]


def test_decoding_does_not_shuffle_and_a_hot_key_can_be_salted(spark, messages):
    records = byte_values(messages([(0, i, 1, header(sequence_number=i)) for i in range(50)], "p"))
    plan = packets.decode_packets(records)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    plain = packets.keyed_packets(records, 8, salts=1)
    salted = packets.keyed_packets(records, 8, salts=8)
    used = [
        f.select(F.spark_partition_id().alias("p")).distinct().count() for f in (plain, salted)
    ]
    assert used[0] == 1 and used[1] > 1
    assert salted.count() == 50
