"""Device-shaped inputs derived from the `events` table.

Each function reads the whole table and encodes it the way the devices would send it, so that the
operators really parse, explode and decode. The rules are simple functions of `event_id`, which
lets SQL state the expected result directly from `events`.

The encoded records are written to the shared folder once per application, like the dump of a
topic, and the queries scan those files.
"""

import functools

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from alarmloom.schemas import ALARM_LIST_KEY, BACKFILL_COLUMNS
from alarmloom.session import new_folder
from alarmloom.sources.files import text_lines

EVENTS_PER_MESSAGE = 4
EVENT_BYTES = 4 << 20

_dumps: dict[tuple, str] = {}


def _version(spark: SparkSession, sf_dir: str) -> tuple:
    """The table's path with its length and time, so that a changed table is encoded anew."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.getContentSummary(path)
    return sf_dir, found.getLength(), files.getFileStatus(path).getModificationTime()


def _dumped(format: str = "parquet"):
    """Write what the function encodes on the first call, read it back on every call."""

    def decorate(encode):
        @functools.wraps(encode)
        def read(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
            application = spark.sparkContext.applicationId
            key = (application, *_version(spark, sf_dir), encode.__name__, *sorted(options.items()))
            if key not in _dumps:
                path = new_folder(spark, encode.__name__)
                encode(spark, sf_dir, **options).write.format(format).save(path)
                _dumps[key] = path
            if format == "text":
                return text_lines(spark, _dumps[key])
            return spark.read.parquet(_dumps[key])

        return read

    return decorate


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table for encoding; stored in fewer splits than there are cores, or in splits of more than
    EVENT_BYTES, it is spread out, because encoded records are many times as long."""
    events = read_events(spark, sf_dir)
    length = _version(spark, sf_dir)[1]
    parts = max(spark.sparkContext.defaultParallelism, -(-length // EVENT_BYTES))
    return events if events.rdd.getNumPartitions() >= parts else events.repartition(parts)


def _remainder(divisor: int, of: str = "event_id") -> Column:
    return F.col(of) % divisor


def _frame(df: DataFrame, topic: str, value: Column, row: Column, ts: Column) -> DataFrame:
    """Kafka layout; `row` numbers the records, three partitions."""
    return df.select(
        F.lit(None).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (row % 3).cast("int").alias("partition"),
        F.call_function("div", row, F.lit(3)).alias("offset"),
        ts.alias("timestamp"),
    )


@_dumped()
def alarm_messages(
    spark: SparkSession, sf_dir: str, mixed_codes: bool = False, broken: bool = False
) -> DataFrame:
    """Alarm documents, four events per message (`event_id div 4`), message time = latest event.

    `mixed_codes`: some codes are written as strings or decimals, which do not count as codes.
    `broken`: five of every fifty messages are truncated, lack the list, are empty, are null, or
    have an empty list; one is a message behind a message, one has text behind it; one in fifty has
    an alarm without a type code.
    """
    number = F.expr("element_at(array(4, 5, 6, 7, 10), cast(event_id % 5 as int) + 1)")
    module = number.cast("string")
    kind = F.expr("cast((event_id div 5) % 17 as string)")
    if mixed_codes:
        kind = _mixed(kind, _remainder(7))
        module = _mixed(module, _remainder(11))
    events = _events(spark, sf_dir).select(
        "ts",
        "user_id",
        "event_id",
        F.expr("event_id div 4").alias("msg_id"),
        _remainder(EVENTS_PER_MESSAGE).alias("pos"),
        module.alias("module"),
        kind.alias("kind"),
    )
    body = F.struct(
        F.format_string("02-00-00-00-%02x-%02x", _remainder(256), _remainder(251)).alias("srcMac"),
        F.lit("02-00-00-00-00-01").alias("destMac"),
        F.when(
            _remainder(8) != 5, F.concat(F.lit("10.0.0."), F.col("user_id") % 256)
        ).alias("srcIp"),
        F.concat(F.lit("10.1.0."), _remainder(256)).alias("destIp"),
        ((F.col("user_id") * 7 + F.col("event_id")) % 65536 - 32768).alias("srcPort"),
        (_remainder(1000) + 1).alias("destPort"),
        _remainder(3).alias("protocolType"),
        (F.lit(0) - F.col("event_id")).alias("byteNumber"),
        F.lit(1).alias("verifyMessageBodyType"),
        F.when(_remainder(9) == 2, F.concat(F.lit("zone'"), _remainder(4))).alias("zoneTag"),
        F.when(_remainder(17) == 4, F.lit("9")).alias("disposetime"),
    )
    no_kind = F.lit(broken) & (_remainder(50, "msg_id") == 44) & (F.col("pos") == 0)
    alarm = F.concat(
        F.regexp_replace(F.to_json(body), "}$", ""),
        F.when(no_kind, F.lit("")).otherwise(F.concat(F.lit(',"verifyTypeId":'), F.col("kind"))),
        F.lit(',"verifyFunctionModuleCode":'),
        F.col("module"),
        F.lit("}"),
    )
    packed = (
        events.select("msg_id", "ts", F.struct("pos", alarm.alias("alarm")).alias("entry"))
        .groupBy("msg_id")
        .agg(F.max("ts").alias("ts"), F.array_sort(F.collect_list("entry")).alias("entries"))
    )
    header = F.struct(
        F.lit("V3.2.1").alias("messageProtocolVersion"),
        F.lit(61).alias("messageDeviceTypeId"),
        F.lit(62).alias("messageProductId"),
        F.when(_remainder(13, "msg_id") == 6, F.lit("core 'A'"))
        .otherwise(F.concat(F.lit("C"), F.col("msg_id") % 50))
        .alias("messageDeviceDescribe"),
        F.lit("V-12.-7").alias("messageEmbeddedSoftwareVersion"),
        F.concat(F.lit("DEV"), F.col("msg_id") % 50).alias("messageDeviceSerialId"),
        (F.col("msg_id") % 256).alias("messagePackageId"),
        F.lit(3120).alias("messageLoadLength"),
        F.size("entries").alias("messageNumber"),
        F.lit(0).alias("messageSplitSerialId"),
        F.lit(0).alias("verifyCode"),
        F.when(_remainder(7, "msg_id") == 3, F.lit("7")).alias("disposetime"),
    )
    opening = F.concat(
        F.regexp_replace(F.to_json(header), "}$", ""),
        F.when(_remainder(11, "msg_id") == 4, F.lit(',"reserved":null')).otherwise(
            F.lit(',"reserved":0')
        ),
    )
    trailer = F.when(_remainder(5, "msg_id") == 0, F.lit("}")).otherwise(
        F.lit(',"tempVerifyCode":0,"messageSplit":false}')
    )
    entries = F.array_join(F.transform("entries", lambda e: e["alarm"]), ",")
    value = F.concat(opening, F.lit(f',"{ALARM_LIST_KEY}":['), entries, F.lit("]"), trailer)
    if broken:
        case = _remainder(50, "msg_id")
        value = (
            F.when(case == 49, F.substring(value, F.lit(1), F.length(value) - 20))
            .when(case == 48, F.concat(opening, trailer))
            .when(case == 47, F.lit(""))
            .when(case == 46, F.lit(None).cast("string"))
            .when(case == 45, F.concat(opening, F.lit(f',"{ALARM_LIST_KEY}":[]'), trailer))
            .when(case == 43, F.concat(value, value))
            .when(case == 42, F.concat(value, F.lit(" end")))
            .otherwise(value)
        )
    return _frame(packed, "da_warning", value, F.col("msg_id"), F.col("ts"))


def _mixed(code: Column, remainder: Column) -> Column:
    quoted = F.concat(F.lit('"'), code, F.lit('"'))
    return (
        F.when(remainder == 3, quoted)
        .when(remainder == 5, F.concat(code, F.lit(".0")))
        .otherwise(code)
    )


@_dumped()
def vendor_lines(
    spark: SparkSession, sf_dir: str, plain_brackets: bool = False, trailing: bool = False
) -> DataFrame:
    """Vendor alerts: one third bracketed, some with an absent or null key, one in fifty truncated.

    With `plain_brackets` the unbracketed records write [10.2.0.7] for a text as well. With
    `trailing` one in fifty goes on behind its object, with a second object or with other text.
    """
    return _flat_lines(
        spark,
        sf_dir,
        plain_brackets=plain_brackets,
        trailing=trailing,
        topic="ah_warning",
        bracketed_keys={"srcAddress": F.concat(F.lit("10.2.0."), F.col("user_id") % 256)},
        keys={
            "deviceId": F.col("user_id").cast("string"),
            "eventId": F.col("event_id").cast("string"),
            "direction": F.concat(F.lit('"it'), F.lit("'"), F.lit('s"')),
            "date": F.concat(F.lit('"'), F.lit("d"), F.col("event_id"), F.lit('"')),
        },
        optional_key="name",
        optional_value=F.concat(F.lit('"'), F.col("event_type"), F.lit('"')),
    )


@_dumped()
def metadata_lines(spark: SparkSession, sf_dir: str, trailing: bool = False) -> DataFrame:
    """Traffic metadata, same rules; plain records carry double backslashes in `uri`."""
    return _flat_lines(
        spark,
        sf_dir,
        trailing=trailing,
        topic="ah_metadata",
        bracketed_keys={
            "sip": F.concat(F.lit("10.3.0."), F.col("user_id") % 256),
            "file_list": F.concat(F.lit("{"), F.col("event_id"), F.lit(".exe}")),
        },
        keys={
            "device_id": F.col("user_id").cast("string"),
            "sess_id": F.concat(F.lit('"'), F.col("event_id"), F.lit('"')),
            "uri": F.concat(F.lit('"/up\\\\'), F.col("event_id") % 7, F.lit('"')),
            "content_length ": F.lit("1375"),
        },
        optional_key="method",
        optional_value=F.concat(F.lit('"'), F.col("event_type"), F.lit('"')),
    )


def _flat_lines(
    spark, sf_dir, topic, bracketed_keys, keys, optional_key, optional_value, trailing,
    plain_brackets=False,
):
    events = _events(spark, sf_dir)
    bracketed = _remainder(3) == 0

    def member(key, value):
        return F.concat(F.lit(f'"{key}":'), value)

    # Inside brackets the sender writes [10.2.0.7] where JSON wants "10.2.0.7".
    odd = [
        member(
            key,
            F.when(bracketed | F.lit(plain_brackets), F.concat(F.lit("["), value, F.lit("]"))).otherwise(
                F.concat(F.lit('"'), value, F.lit('"'))
            ),
        )
        for key, value in bracketed_keys.items()
    ]
    optional = (
        F.when(_remainder(10) == 7, F.lit(""))
        .when(_remainder(10) == 8, F.lit(f',"{optional_key}":null'))
        .otherwise(F.concat(F.lit(","), member(optional_key, optional_value)))
    )
    plain = [member(key, value) for key, value in keys.items()]
    members = F.concat(F.concat_ws(",", *plain, *odd), optional)
    document = F.concat(F.lit("{"), members, F.lit("}"))
    document = F.when(
        _remainder(50) == 49, F.substring(document, F.lit(1), F.length(document) - 12)
    ).otherwise(document)
    if trailing:
        more = F.when(_remainder(100) == 48, F.lit(',{"k":1}')).otherwise(F.lit(" end"))
        document = F.when(_remainder(50) == 48, F.concat(document, more)).otherwise(document)
    value = F.when(bracketed, F.concat(F.lit("["), document, F.lit("]\n"))).otherwise(document)
    return _frame(events, topic, value, F.col("event_id"), F.col("ts"))


@_dumped("text")
def backfill_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV lines: column i is `event_id + i`; some are one field short, some end in an empty one."""
    width = len(BACKFILL_COLUMNS)
    fields = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: (F.col("event_id") + i).cast("string"))
    short = F.array_join(F.slice(fields, 1, width - 1), ",")
    line = (
        F.when(_remainder(20) == 19, short)
        .when(_remainder(20) == 18, F.concat(short, F.lit(",")))
        .otherwise(F.array_join(fields, ","))
    )
    return _events(spark, sf_dir).select(line.alias("value"))


@_dumped()
def packet_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary frames: 28-byte header, Ethernet, IPv4 (UDP, TCP, ICMP or protocol 50), payload.

    One IPv4 header in three carries option bytes, 4 or the full 40; of forty frames one is cut
    inside the header, one inside the ports, and one states too short an IPv4 header.
    """
    eid = F.col("event_id")

    def shifted(value, bits):
        return F.shiftleft(value, bits)

    def hexed(value, size):
        return F.lpad(F.hex(value), size * 2, "0")

    word1 = (
        shifted(eid % 2, 31)
        .bitwiseOR(shifted(F.expr("(event_id div 2) % 2"), 30))
        .bitwiseOR(shifted(eid % 16, 26))
        .bitwiseOR(shifted(eid * 3 % 16, 22))
        .bitwiseOR(eid % 4)
    )
    word2 = (
        shifted(eid % 16777216, 8)
        .bitwiseOR(shifted(eid % 4, 6))
        .bitwiseOR(shifted(eid % 16, 2))
        .bitwiseOR(eid * 7 % 4)
    )
    # policy_match 1 bit, policy_id 14, source_port 7, then the first 10 of 42 time bits
    word4 = (
        shifted(eid % 2, 31)
        .bitwiseOR(shifted(eid % 16384, 17))
        .bitwiseOR(shifted(eid % 128, 10))
        .bitwiseOR(F.shiftright(eid, 32).bitwiseAND(F.lit(1023)))
    )
    header = [
        hexed(word1, 4),
        hexed(word2, 4),
        hexed(eid * 429496 % 4294967296, 4),
        hexed(word4, 4),
        hexed(eid.bitwiseAND(F.lit(4294967295)), 4),
        hexed(F.lit(4294967295) - eid, 4),
        hexed(eid % 65536, 2),
        F.lit("0000"),
    ]
    ethernet = [
        F.lit("0A00000000"),
        hexed(eid % 256, 1),
        F.lit("0C00000000"),
        hexed(F.col("user_id") % 256, 1),
        F.lit("0800"),
    ]
    options = (
        F.when(eid % 60 == 36, F.lit("01" * 40))
        .when(eid % 3 == 0, F.lit("01010101"))
        .otherwise(F.lit(""))
    )
    version_and_length = (
        F.when(eid % 40 == 21, F.lit("44"))
        .when(eid % 60 == 36, F.lit("4F"))
        .when(eid % 3 == 0, F.lit("46"))
        .otherwise(F.lit("45"))
    )
    protocol = F.expr("element_at(array(17, 6, 1, 50), cast(event_id % 4 as int) + 1)")
    ports = F.concat(hexed(F.col("user_id") % 65536, 2), hexed(eid * 5 % 65536, 2))
    transport = (
        F.when(eid % 4 == 0, F.concat(ports, F.lit("000C0000")))
        .when(eid % 4 == 1, F.concat(ports, F.lit("00000001000000025010FFFF00000000")))
        .when(eid % 4 == 2, F.lit("0800000000010001"))
        .otherwise(F.lit("0000000000000000"))
    )
    ip = [
        version_and_length,
        F.lit("00"),
        hexed((F.length(F.concat(options, transport)) / 2 + 24).cast("bigint"), 2),
        F.lit("0000000040"),
        hexed(protocol, 1),
        F.lit("0000"),
        F.lit("0A0000"),
        hexed(F.col("user_id") % 256, 1),
        F.lit("0A0100"),
        hexed(eid % 256, 1),
        options,
    ]
    frame = F.concat(*header, *ethernet, *ip, transport, hexed(eid % 4294967296, 4))
    # Two hex digits a byte; the IPv4 header ends 62 bytes behind the start, without its options.
    in_ports = F.concat(*header, *ethernet, *ip, F.substring(transport, 1, 4))
    frame = (
        F.when(eid % 40 == 8, F.substring(frame, 1, 40))
        .when(eid % 40 == 12, in_ports)
        .otherwise(frame)
    )
    return _frame(
        _events(spark, sf_dir), "packdata", F.unhex(frame), F.col("event_id"), F.col("ts")
    )


@_dumped()
def usage_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small nested documents with numbers written as strings, two entries each."""
    value = F.concat(
        F.lit('{"userId":"'),
        F.col("user_id"),
        F.lit('","day":"'),
        F.date_format("ts", "yyyy-MM-dd"),
        F.lit('","data":[{"package":"com.'),
        F.col("event_type"),
        F.lit('","activetime":"'),
        F.col("event_id"),
        F.lit('"},{"package":"com.idle","activetime":"'),
        F.col("event_id") * 2,
        F.lit('"}]}'),
    )
    return _frame(_events(spark, sf_dir), "da_trace", value, F.col("event_id"), F.col("ts"))


@_dumped()
def wifi_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = F.struct(
        F.col("event_type").alias("eventType"),
        F.unix_millis("ts").alias("time"),
        F.col("user_id").alias("deviceId"),
        F.concat(F.lit("net"), _remainder(20)).alias("ssid"),
        F.format_string("02:00:00:00:00:%02x", _remainder(256)).alias("mac"),
        F.when(_remainder(4) != 3, F.lit("WPA2")).alias("encryption"),
        F.concat(F.lit("term"), F.col("user_id") % 10).alias("terminalSsid"),
        F.format_string("04:00:00:00:00:%02x", F.col("user_id") % 256).alias("terminalMac"),
        (_remainder(13) + 1).alias("channel"),
        F.lit("phone").alias("primaryClassification"),
        F.lit("android").alias("secondaryClassification"),
        (F.lit(0) - _remainder(90)).alias("power"),
        _remainder(100).alias("distance"),
        F.concat(F.lit("site"), _remainder(6)).alias("monitoringSite"),
        F.lit("wifi").alias("indexName"),
        F.col("event_id").alias("upside"),
        (F.col("event_id") * 2).alias("down"),
        _remainder(3600).alias("duration"),
    )
    return _frame(
        _events(spark, sf_dir), "wifi", F.to_json(probe), F.col("event_id"), F.col("ts")
    )


def flush_message(messages: DataFrame, seconds: int) -> DataFrame:
    """One alarm two windows after the last message.

    On a stream it moves the watermark past every window of the messages. Its own window stays
    open, so in append mode it is never part of the output.
    """
    value = f'{{"{ALARM_LIST_KEY}":[{{"verifyFunctionModuleCode":6,"verifyTypeId":1}}]}}'
    later = F.timestamp_seconds(F.unix_seconds(F.max("timestamp")) + 2 * seconds)
    return messages.agg(later.alias("timestamp")).select(
        F.lit(None).cast("binary").alias("key"),
        F.lit(value).cast("binary").alias("value"),
        F.lit("flush").alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("offset"),
        "timestamp",
    )
