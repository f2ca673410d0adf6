"""Bit-packed packet records: 28-byte header, Ethernet, IPv4. Built-in expressions only, no shuffle."""

from pyspark.sql import Column, DataFrame, functions as F

from alarmloom.functions.bits import bit_text, bits, ipv4_text, mac_text, unsigned, unsigned_at

# Sizes in bytes, and the protocol numbers that are decoded.
HEADER_BYTES = 28
ETHERNET_BYTES = 14
IP_BYTES = 20
PROTOCOLS = {17: "UDP", 6: "TCP", 1: "ICMP"}
UDP_HEADER_BYTES = 8
ICMP_HEADER_BYTES = 4

HEADER_FIELDS = """
second_frag first_frag module_code source_code reserve1 type pkt_number sn_device sn_produc
sn_batch sn_number policy_match policy_id source_port time_stamp flow_index sequence_number reserve2
""".split()


def decode_header(records: DataFrame) -> DataFrame:
    """The 18 header fields of every record that is at least as long as the header.

    Bit strings of the source format (device number, time stamp, reserved bits) are kept as text;
    everything else is BIGINT, so a set top bit is no overflow.
    """
    words = (
        records.filter(F.length("value") >= HEADER_BYTES)
        .withColumn("head", F.hex(F.substring("value", 1, HEADER_BYTES)))
        .withColumns(
            {
                "w0": unsigned(F.col("head"), 0, 4),
                "w1": unsigned(F.col("head"), 4, 4),
                "w2": unsigned(F.col("head"), 8, 4),
                "w3": unsigned(F.col("head"), 12, 4),
                "stamp": unsigned(F.col("head"), 14, 6),
            }
        )
    )
    w0, w1, w3, head = F.col("w0"), F.col("w1"), F.col("w3"), F.col("head")
    fields = {
        "second_frag": bits(w0, 31, 1),
        "first_frag": bits(w0, 30, 1),
        "module_code": bits(w0, 26, 4),
        "source_code": bits(w0, 22, 4),
        "reserve1": bit_text(bits(w0, 2, 20), 20),
        "type": bits(w0, 0, 2),
        "pkt_number": bits(w1, 8, 24),
        "sn_device": bits(w1, 6, 2),
        "sn_produc": bits(w1, 2, 4),
        "sn_batch": bits(w1, 0, 2),
        "sn_number": bit_text(F.col("w2"), 32),
        "policy_match": bits(w3, 31, 1),
        "policy_id": bits(w3, 17, 14),
        "source_port": bits(w3, 10, 7),
        "time_stamp": bit_text(bits(F.col("stamp"), 0, 42), 42),
        "flow_index": unsigned(head, 20, 4),
        "sequence_number": unsigned(head, 24, 2),
        "reserve2": bit_text(unsigned(head, 26, 2), 16),
    }
    return words.select(
        *records.columns, *[expression.alias(name) for name, expression in fields.items()]
    )


FLOW_START = HEADER_BYTES + ETHERNET_BYTES


def _framed(records: DataFrame) -> DataFrame:
    """Adds what the drop rule and the decoder read from the front of a frame."""
    # Up to the ports: the longest IPv4 header is 60 bytes, the TCP header adds at least 20.
    longest = FLOW_START + 60 + 20
    return (
        records.withColumn("frame_bytes", F.coalesce(F.length("value"), F.lit(0)))
        .withColumn("head", F.hex(F.substring("value", 1, longest)))
        .withColumn("protocol_number", unsigned(F.col("head"), FLOW_START + 9, 1))
        .withColumn("ip_bytes", bits(unsigned(F.col("head"), FLOW_START, 1), 0, 4) * 4)
    )


def _drop_reason() -> Column:
    """Why a framed record is not decoded, NULL if it is; the only place that knows the rule."""
    number = F.col("protocol_number")
    ports = F.when(number != 1, F.lit(4)).otherwise(F.lit(0))
    return (
        F.when(F.col("frame_bytes") < FLOW_START + IP_BYTES, F.lit("short"))
        .when(~number.isin(list(PROTOCOLS)), F.lit("protocol"))
        .when(F.col("ip_bytes") < IP_BYTES, F.lit("ip_header"))
        .when(F.col("frame_bytes") < F.lit(FLOW_START) + F.col("ip_bytes") + ports, F.lit("transport"))
    )


def decode_flow(records: DataFrame) -> DataFrame:
    """Addresses, ports, protocol and payload of the decodable frames; the others are dropped.

    Dropped are frames of another protocol and frames too short for what their headers announce.
    """
    start = FLOW_START
    decoded = _framed(records).filter(_drop_reason().isNull())
    head = F.col("head")
    transport = F.lit(start) + F.col("ip_bytes")
    number = F.col("protocol_number")
    has_ports = number != 1
    # TCP says how long its own header is; UDP and ICMP headers are of fixed length.
    tcp_bytes = F.when(
        F.col("frame_bytes") > transport + 12,
        bits(unsigned_at(head, transport + 12, 1), 4, 4) * 4,
    ).otherwise(20)
    transport_bytes = (
        F.when(number == 6, tcp_bytes)
        .when(number == 17, F.lit(UDP_HEADER_BYTES))
        .otherwise(ICMP_HEADER_BYTES)
    )
    name = F.when(number == 17, "UDP").when(number == 6, "TCP").otherwise("ICMP")
    payload_at = (transport + transport_bytes).cast("int")
    return decoded.select(
        *records.columns,
        mac_text(head, HEADER_BYTES).alias("destMac"),
        mac_text(head, HEADER_BYTES + 6).alias("srcMac"),
        F.concat(F.lit("0x"), F.lower(F.substring("head", (HEADER_BYTES + 12) * 2 + 1, 4))).alias(
            "ethType"
        ),
        name.alias("protocol"),
        ipv4_text(head, start + 12).alias("srcIp"),
        ipv4_text(head, start + 16).alias("destIp"),
        F.when(has_ports, unsigned_at(head, transport, 2)).alias("srcPort"),
        F.when(has_ports, unsigned_at(head, transport + 2, 2)).alias("destPort"),
        F.substring(F.col("value"), payload_at + 1, F.col("frame_bytes")).alias("packetData"),
    )


def decode_packets(records: DataFrame) -> DataFrame:
    """Header fields and flow of every decodable frame."""
    return decode_flow(decode_header(records))


def dropped_packets(records: DataFrame) -> DataFrame:
    """Counts of the frames that `decode_flow` keeps and drops, by reason."""
    outcome = F.coalesce(_drop_reason(), F.lit("decoded"))
    return _framed(records).groupBy(outcome.alias("outcome")).count()


def packet_key(value: Column, key: str = "reference") -> Column:
    """Bit-string key of a packet.

    `reference`: the first 10 bits of the device number. `serial_seq`: what the key was meant to
    be, the 32 bits of the device number followed by the 16 bits of the packet sequence number.
    """
    if key == "reference":
        return bit_text(F.shiftright(unsigned(F.hex(F.substring(value, 9, 2)), 0, 2), 6), 10)
    if key == "serial_seq":
        serial = bit_text(unsigned(F.hex(F.substring(value, 9, 4)), 0, 4), 32)
        return F.concat(serial, bit_text(unsigned(F.hex(F.substring(value, 25, 2)), 0, 2), 16))
    raise ValueError(f"unknown packet key: {key}")


def keyed_packets(
    records: DataFrame, partitions: int, key: str = "reference", salts: int = 16
) -> DataFrame:
    """Records hash-distributed by packet key, a key over up to `salts` partitions.

    Decoding does not need this. With `salts=1` a key stays whole.
    """
    keyed = records.withColumn("packet_key", packet_key(F.col("value"), key))
    by = ["packet_key"]
    if salts > 1:
        by.append(F.pmod(F.xxhash64("value"), F.lit(salts)))
    return keyed.repartition(partitions, *by)
