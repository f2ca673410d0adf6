"""The catalog's queries in SQL, straight from the test tables.

None of this parses a message: the expected rows are computed from `events` by the rules that the
input adapters follow, so the two sides share no code path.
"""

from alarmloom.schemas import (
    BACKFILL_COLUMNS,
    BODY_KEYS,
    HEADER_KEYS,
    METADATA_COLUMNS,
    TRAILER_KEYS,
    VENDOR_COLUMNS,
)

WINDOW = 3600

NUMBERED = """
numbered AS (
  SELECT event_id, user_id, event_id // 4 AS msg_id, CAST(event_id % 4 AS INTEGER) AS pos,
         max(epoch_us(ts)) OVER (PARTITION BY event_id // 4) AS us,
         count(*) OVER (PARTITION BY event_id // 4) AS in_message,
         CAST([4, 5, 6, 7, 10][event_id % 5 + 1] AS INTEGER) AS module,
         CAST((event_id // 5) % 17 AS INTEGER) AS kind
  FROM events
),
alarm AS (
  SELECT *,
         CAST(msg_id % 3 AS INTEGER) AS part, msg_id // 3 AS off,
         md5(concat_ws('|', 'da_warning', msg_id % 3, msg_id // 3, pos)) AS uuid,
         CAST(us // 1000 AS VARCHAR) AS date,
         strftime(make_timestamp(us), '%Y-%m-%d %H:%M:%S') AS currenttime,
         'DEV' || (msg_id % 50) AS serial,
         CASE WHEN event_id % 8 <> 5 THEN '10.0.0.' || (user_id % 256) END AS src,
         '10.1.0.' || (event_id % 256) AS dst,
         us // 1000000 // 3600 * 3600 AS win
  FROM numbered
)
"""

# Fixed values: (module, type) -> labels; `%S`, `%D`, `%N` stand for source, destination and serial number.
SHARED = """
 (6, 0, '标签校验错误告警'), (6, 1, '标签目的地址未在白名单告警'), (6, 2, '非法访问跳变地址告警'),
 (6, 5, '变形会话异常结束告警'), (6, 7, '变形会话异常结束告警'), (6, 8, '变形会话'),
 (4, 0, '非法访问告警'), (4, 1, '隐身ARP告警'),
 (5, 9, 'TCP会话超时告警'), (5, 10, 'UDP会话超时告警'), (5, 11, 'ICMP会话超时告警'),
 (5, 12, 'TCP会话长连接告警'), (5, 13, '5.5.2 UDP会话长连接告警'), (5, 14, 'ARP广播告警'),
 (5, 15, '回应ARP广播告警')
"""

GEN1 = """
 (5, 0, '扫描未伪装端口告警', '端口扫描事件'), (5, 1, '攻击会话开始告警', '攻击会话建立事件'),
 (5, 2, '攻击会话正常结束告警', '攻击会话结束事件'), (5, 3, '攻击会话异常结束告警', 'IP扫描事件'),
 (5, 4, '回应主机主动向外发包告警', '基于TCP/UDP的横向探测事件'),
 (5, 5, 'ICMP报文攻击告警', 'IP扫描事件'), (5, 6, '扫描未伪装端口告警', '基于ICMP的横向探测事件'),
 (5, 7, '回应ICMP包告警', '端口扫描事件'),
 (5, 8, '回应主机主动向外发送ICMP包告警', '回攻击会话持续事件')
"""

GEN2 = """
 (5, 0, '网络扫描事件', '端口扫描事件', '%S 扫描未伪装的%D服务端口'),
 (5, 1, '攻陷回应主机事件', '攻击会话建立事件', '%S与%D伪装IP建立了TCP/UDP攻击会话'),
 (5, 2, '攻陷回应主机事件', '攻击会话结束事件', '%S与%D伪装IP的TCP攻击会话结束'),
 (5, 3, '网络扫描事件', 'IP扫描事件', '%S与%D伪装IP的TCP攻击会话结束'),
 (5, 4, '跳板攻击事件', '基于tcp/udp的横向探测事件', '%N主动发动TCP/UDP请求'),
 (5, 5, '网络扫描事件', 'IP扫描事件', '%S对%D伪装地址进行PING攻击'),
 (5, 6, '跳板攻击事件', '基于ICMP的横向探测事件', '%N回应主机主动发送ICMP请求'),
 (5, 7, '网络扫描事件', '端口扫描事件', '%S与%D伪装IP的TCP/UDP/ICMP攻击会话超时'),
 (5, 8, '攻陷回应主机事件', '回攻击会话持续事件', '%S与%D伪装IP的TCP/UDP会话未结束'),
 (10, 2, '网络扫描事件', 'IP扫描事件', '%S对%D伪装地址进行ARP请求'),
 (10, 3, '跳板攻击事件', '基于ARP的横向探测事件', '%N回应主机主动发送ARP请求'),
 (10, 4, '10', 'IP冲突', '%D伪装IP与网内其他IP冲突')
"""


def _classified(generation: int, module: str = "module", kind: str = "kind") -> str:
    """`c`: alarms with labels, description and route. `module` and `kind` may be NULL codes."""
    other = f"""CASE WHEN {module} IN (5, 6, 4{', 10' if generation == 2 else ''}) THEN {module} ELSE -1 END"""
    if generation == 2:
        labels = f"""
labels(m, k, module_label, type_label, template) AS (
  SELECT m, k, NULL, l, NULL FROM (VALUES {SHARED}) s(m, k, l)
  UNION ALL SELECT * FROM (VALUES {GEN2}) g
  UNION ALL SELECT * FROM (VALUES (-1, 1, '安全标签', '安全标签告警', NULL), (-1, 2, '安全标签', '标签错误告警', NULL)) o
)"""
        module_label = (
            "coalesce(labels.module_label, CASE m WHEN 6 THEN '网络变形' WHEN 4 THEN '网络隐身' "
            "WHEN -1 THEN '安全标签' ELSE CAST(m AS VARCHAR) END)"
        )
        description = (
            "replace(replace(replace(template, '%S', coalesce(src, 'null')), '%D', dst), '%N', serial)"
        )
        route = "CASE m WHEN 6 THEN 'transformation' WHEN 5 THEN 'camouflage' WHEN 10 THEN 'camouflage' ELSE 'label' END"
    else:
        labels = f"""
labels(m, k, type_label, template) AS (
  SELECT m, k, l, NULL FROM (VALUES {SHARED}) s(m, k, l)
  UNION ALL SELECT * FROM (VALUES {GEN1}) g
  UNION ALL SELECT * FROM (VALUES (-1, 1, '安全标签告警', NULL), (-1, 2, '标签错误告警', NULL)) o
)"""
        module_label = (
            "CASE m WHEN 6 THEN '网络变形' WHEN 4 THEN '网络隐身' WHEN 5 THEN '网络伪装' "
            "ELSE '安全标签' END"
        )
        description = "template" if generation == 1 else "CAST(NULL AS VARCHAR)"
        camouflage = "camouflage" if generation == 1 else "label"
        route = f"CASE m WHEN 6 THEN 'transformation' WHEN 5 THEN '{camouflage}' ELSE 'label' END"
    type_label = "coalesce(labels.type_label, '模拟')"
    if generation == 0:
        type_label = f"CASE WHEN m = 5 AND {kind} = 6 THEN '模拟' ELSE {type_label} END"
    return f"""
WITH {NUMBERED},
coded AS (SELECT *, {module} AS module_code, {kind} AS type_code, {other} AS mk FROM alarm),
{labels},
c AS (
  SELECT coded.*, {module_label} AS module_label, {type_label} AS type_label,
         {description} AS incidentdescription, {route} AS route
  FROM (SELECT *, mk AS m_ FROM coded) coded
  LEFT JOIN labels ON labels.m = coded.m_ AND labels.k = coded.type_code
)
""".replace("CASE m ", "CASE coded.m_ ").replace("CAST(m AS", "CAST(coded.m_ AS").replace(
        "WHEN m = 5", "WHEN coded.m_ = 5"
    )


def _classify(generation, module="module", kind="kind"):
    return (
        _classified(generation, module, kind)
        + "SELECT uuid, module_code, type_code, module_label, type_label, incidentdescription, route FROM c"
    )


def _route_counts(generation):
    return (
        _classified(generation)
        + "SELECT route, type_label, count(*) AS n FROM c GROUP BY route, type_label"
    )


def _merged(generation):
    """`d`: rows of the merged routes with the first id, last date and count of their group."""
    return (
        _classified(generation)
        + """,
d AS (
  SELECT *, first_value(uuid) OVER w AS pid, last_value(date) OVER w AS last_date,
         count(*) OVER w AS size
  FROM c WHERE route <> 'label'
  WINDOW w AS (PARTITION BY route, type_label, win ORDER BY us, part, off, pos
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
)
"""
    )


def _merge_detail(generation):
    return _merged(generation) + "SELECT uuid, pid, route, type_label, win, date FROM d"


def _merge_summary(generation):
    return (
        _merged(generation)
        + "SELECT route, type_label, win, uuid, pid, last_date AS date, currenttime, size "
        "FROM d WHERE uuid = pid"
    )


HEADER_VALUES = {
    "messageProtocolVersion": "'V3.2.1'",
    "messageDeviceTypeId": "'61'",
    "messageProductId": "'62'",
    "messageDeviceDescribe": "CASE WHEN msg_id % 13 = 6 THEN 'core ''A''' ELSE 'C' || (msg_id % 50) END",
    "messageEmbeddedSoftwareVersion": "'V-12.-7'",
    "messageChipVersion": "'-1'",
    "messageDeviceSerialId": "serial",
    "messagePackageId": "CAST(msg_id % 256 AS VARCHAR)",
    "messageLoadLength": "'3120'",
    "messageNumber": "CAST(in_message AS VARCHAR)",
    "messageSplitSerialId": "'0'",
    "verifyCode": "'0'",
    "reserved": "CASE WHEN msg_id % 11 = 4 THEN 'null' ELSE '0' END",
}
TRAILER_VALUES = {
    "tempVerifyCode": "CASE WHEN msg_id % 5 = 0 THEN '-1' ELSE '0' END",
    "messageSplit": "CASE WHEN msg_id % 5 = 0 THEN '-1' ELSE 'false' END",
}
BODY_VALUES = {
    "srcMac": "printf('02-00-00-00-%02x-%02x', event_id % 256, event_id % 251)",
    "destMac": "'02-00-00-00-00-01'",
    "srcIp": "src",
    "destIp": "dst",
    "srcPort": "CAST((user_id * 7 + event_id) % 65536 - 32768 AS VARCHAR)",
    "destPort": "CAST(event_id % 1000 + 1 AS VARCHAR)",
    "protocolType": "CAST(event_id % 3 AS VARCHAR)",
    "byteNumber": "CAST(-event_id AS VARCHAR)",
    "verifyMessageBodyType": "'1'",
}


def _layout(ids, links, classified=True, header=None):
    body = dict(BODY_VALUES)
    if classified:
        body |= {
            "verifyFunctionModuleCode": "module_label",
            "verifyTypeId": "type_label",
            "incidentdescription": "incidentdescription",
        }
    else:
        body |= {
            "verifyFunctionModuleCode": "CAST(module AS VARCHAR)",
            "verifyTypeId": "CAST(kind AS VARCHAR)",
        }
    header = HEADER_VALUES | (header or {})
    columns = {
        **ids,
        **{key: header[key] for key in HEADER_KEYS},
        **links,
        **{key: body.get(key, "CAST(NULL AS VARCHAR)") for key in BODY_KEYS},
        **{key: TRAILER_VALUES[key] for key in TRAILER_KEYS},
        "zoneTag": "CASE WHEN event_id % 9 = 2 THEN 'zone''' || (event_id % 4) END",
    }
    return ", ".join(f'{value} AS "{name}"' for name, value in columns.items())


IDS = {"uuid": "uuid", "date": "date", "currenttime": "currenttime"}
SUMMARY_IDS = {"uuid": "uuid", "date": "last_date", "currenttime": "currenttime"}
DISPOSED = "CASE WHEN msg_id % 7 = 3 THEN '7' ELSE '1' END"
IMMEDIATE_LINKS = {"size": "'1'", "disposetime": DISPOSED, "event_level": "'0'"}


def _links(generation, found, ids=None):
    """What a layout of this generation has of the ids and links of the last."""
    ids = IDS if ids is None else ids
    if generation == 0:
        ids = {k: v for k, v in ids.items() if k != "currenttime"}
    if generation < 2:
        found = {k: v for k, v in found.items() if k not in ("disposetime", "event_level")}
    return ids, found


def _warning_table(generation):
    none = "CAST(NULL AS VARCHAR)"
    immediate = _layout(*_links(generation, {"pid": none, **IMMEDIATE_LINKS}))
    merged = {"pid": "pid", "size": "CAST(size AS VARCHAR)", "disposetime": none, "event_level": "'0'"}
    summary = _layout(*_links(generation, merged, SUMMARY_IDS))
    return (
        _merged(generation)
        + f"SELECT {immediate} FROM c WHERE route = 'label' "
        + f"UNION ALL SELECT {summary} FROM d WHERE uuid = pid"
    )


def _detail_table(generation):
    layout = _layout(*_links(generation, {"pid": "pid", "event_level": "'0'"}))
    first = "bus_twarning_local" if generation == 0 else "bus_twarning"
    table = f"CASE route WHEN 'transformation' THEN '{first}' ELSE 'bus_cwarning' END"
    return _merged(generation) + f'SELECT {layout}, {table} AS "table" FROM d'


def _report():
    ids = {"messageUuid": "md5(concat_ws('|', 'da_warning', part, off))", "messageTime": "us"}
    layout = _layout(ids, {}, classified=False, header={"reserved": "'-1'"})
    return f"WITH {NUMBERED} SELECT {layout} FROM alarm"


# --- Vendor alerts, metadata, schema-less ---------------------------------------------------------


def _stamps(topic, when):
    return {
        "uuid": f"CASE WHEN {when} THEN md5(concat_ws('|', '{topic}', event_id % 3, event_id // 3)) END",
        "date": f"CASE WHEN {when} THEN CAST(epoch_us(ts) // 1000 AS VARCHAR) END",
        "currenttime": f"CASE WHEN {when} THEN strftime(make_timestamp(epoch_us(ts)), '%Y-%m-%d %H:%M:%S') END",
    }


OPTIONAL = "CASE event_id % 10 WHEN 7 THEN NULL WHEN 8 THEN 'null' ELSE event_type END"
NOT_TRUNCATED = "event_id % 50 <> 49"


def _fixed(columns, values):
    listed = ", ".join(f"coalesce({values.get(c, 'NULL')}, '-1') AS \"{c}\"" for c in columns)
    return f"SELECT {listed} FROM events WHERE {NOT_TRUNCATED}"


def _vendor():
    stamps = _stamps("ah_warning", "event_id % 3 <> 0")
    stamps["date"] = f"coalesce({stamps['date']}, 'd' || event_id)"
    return _fixed(
        VENDOR_COLUMNS,
        {
            **stamps,
            "srcAddress": "'10.2.0.' || (user_id % 256)",
            "deviceId": "CAST(user_id AS VARCHAR)",
            "eventId": "CAST(event_id AS VARCHAR)",
            "direction": "'it''s'",
            "name": OPTIONAL,
        },
    )


# Plain records lose both backslashes; in bracketed ones the JSON escape stands for one.
URI = "CASE WHEN event_id % 3 = 0 THEN '/up\\' ELSE '/up' END || (event_id % 7)"


def _metadata():
    return _fixed(
        METADATA_COLUMNS,
        {
            **_stamps("ah_metadata", "true"),
            "sip": "'10.3.0.' || (user_id % 256)",
            "file_list": "'{' || event_id || '.exe}'",
            "device_id": "CAST(user_id AS VARCHAR)",
            "sess_id": "CAST(event_id AS VARCHAR)",
            "uri": URI,
            "method": OPTIONAL,
        },
    )


def _schemaless_vendor():
    return f"""
SELECT md5(concat_ws('|', 'ah_warning', event_id % 3, event_id // 3)) AS uuid,
       CAST(user_id AS VARCHAR) AS "deviceId", CAST(event_id AS VARCHAR) AS "eventId",
       'it|s' AS direction, 'd' || event_id AS date, '10.2.0.' || (user_id % 256) AS "srcAddress",
       {OPTIONAL} AS name, CAST(0 AS INTEGER) AS extras
FROM events WHERE {NOT_TRUNCATED}"""


def _schemaless_metadata():
    uri = "'/up\\' || (event_id % 7)"
    return f"""
SELECT md5(concat_ws('|', 'ah_metadata', event_id % 3, event_id // 3)) AS uuid,
       CAST(user_id AS VARCHAR) AS device_id, CAST(event_id AS VARCHAR) AS sess_id, {uri} AS uri,
       '1375' AS content_length_key, '10.3.0.' || (user_id % 256) AS sip,
       '{{' || event_id || '.exe}}' AS file_list, {OPTIONAL} AS method,
       CAST(0 AS INTEGER) AS extras
FROM events WHERE {NOT_TRUNCATED}"""


REJECTS = f"""
WITH {NUMBERED},
message AS (SELECT DISTINCT msg_id FROM alarm),
found AS (
  SELECT 'da_warning' AS topic, 'malformed' AS reject_reason FROM message WHERE msg_id % 50 = 49
  UNION ALL SELECT 'da_warning', 'no_alarm_list' FROM message WHERE msg_id % 50 = 48
  UNION ALL SELECT 'da_warning', 'missing_code' FROM alarm WHERE msg_id % 50 = 44 AND pos = 0
  UNION ALL SELECT 'da_warning', 'trailing_text' FROM message WHERE msg_id % 50 IN (42, 43)
  UNION ALL SELECT 'ah_warning', 'malformed' FROM events WHERE event_id % 50 = 49
  UNION ALL SELECT 'ah_warning', 'trailing_text' FROM events WHERE event_id % 50 = 48
  UNION ALL SELECT 'ah_metadata', 'trailing_text' FROM events WHERE event_id % 50 = 48
  UNION ALL SELECT 'ah_metadata', 'malformed' FROM events WHERE event_id % 50 = 49
  UNION ALL SELECT 'backfill', 'too_few_fields' FROM events WHERE event_id % 20 = 19
)
SELECT topic, reject_reason, count(*) AS n FROM found GROUP BY topic, reject_reason
"""

TYPED_RECORDS = f"""
WITH {NUMBERED},
message AS (SELECT DISTINCT msg_id FROM alarm)
SELECT CASE WHEN msg_id % 50 IN (46, 47, 49) THEN 'malformed'
            WHEN msg_id % 50 IN (42, 43) THEN 'trailing_text' ELSE 'read' END AS outcome,
       count(*) AS n
FROM message GROUP BY 1
"""

# --- Packets --------------------------------------------------------------------------------------

PLACE = "CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS \"offset\""
PACKET = "events WHERE event_id % 40 <> 8"


def _bits(value, width):
    return f"lpad(bin({value}), {width}, '0')"


PACKET_HEADER = f"""
SELECT {PLACE},
       event_id % 2 AS second_frag, (event_id // 2) % 2 AS first_frag,
       event_id % 16 AS module_code, event_id * 3 % 16 AS source_code,
       repeat('0', 20) AS reserve1, event_id % 4 AS type, event_id % 16777216 AS pkt_number,
       event_id % 4 AS sn_device, event_id % 16 AS sn_produc, event_id * 7 % 4 AS sn_batch,
       {_bits('event_id * 429496 % 4294967296', 32)} AS sn_number,
       event_id % 2 AS policy_match, event_id % 16384 AS policy_id, event_id % 128 AS source_port,
       {_bits('event_id', 42)} AS time_stamp, 4294967295 - event_id AS flow_index,
       event_id % 65536 AS sequence_number, repeat('0', 16) AS reserve2
FROM {PACKET}
"""

FLOW = f"""
flow AS (
  SELECT *, {PLACE},
         CASE event_id % 4 WHEN 0 THEN 'UDP' WHEN 1 THEN 'TCP' WHEN 2 THEN 'ICMP' END AS protocol,
         '10.0.0.' || (user_id % 256) AS src_ip, '10.1.0.' || (event_id % 256) AS dst_ip,
         CASE WHEN event_id % 4 < 2 THEN user_id % 65536 END AS src_port,
         CASE WHEN event_id % 4 < 2 THEN event_id * 5 % 65536 END AS dst_port
  FROM {PACKET} AND event_id % 4 <> 3 AND event_id % 40 NOT IN (12, 21)
)
"""

PACKET_FLOW = f"""
WITH {FLOW}
SELECT partition, "offset",
       printf('0a:00:00:00:00:%02x', event_id % 256) AS "destMac",
       printf('0c:00:00:00:00:%02x', user_id % 256) AS "srcMac", '0x0800' AS "ethType",
       protocol, src_ip AS "srcIp", dst_ip AS "destIp", src_port AS "srcPort", dst_port AS "destPort",
       CASE WHEN protocol = 'ICMP' THEN '00010001' ELSE '' END
         || printf('%08X', event_id % 4294967296) AS "packetData"
FROM flow
"""

PACKET_FILES = f"""
WITH {FLOW}
SELECT partition, "offset", 4294967295 - event_id AS flow_index, protocol, src_ip AS "srcIp",
       dst_ip AS "destIp", src_port AS "srcPort", dst_port AS "destPort"
FROM flow
"""

PACKET_DROPPED = """
SELECT CASE WHEN event_id % 40 = 8 THEN 'short' WHEN event_id % 4 = 3 THEN 'protocol'
            WHEN event_id % 40 = 21 THEN 'ip_header' WHEN event_id % 40 = 12 THEN 'transport'
            ELSE 'decoded' END AS outcome, count(*) AS n
FROM events GROUP BY 1
"""

# A cut record has 20 bytes: the device number is there, the sequence number is not.
SERIAL = _bits("event_id * 429496 % 4294967296", 32)
PACKET_KEY = f"""
SELECT {PLACE}, substr({SERIAL}, 1, 10) AS packet_key,
       CASE WHEN event_id % 40 <> 8 THEN {SERIAL} || {_bits('event_id % 65536', 16)} END AS serial_seq
FROM events
"""

# --- CSV, Wi-Fi, nested tables, text ----------------------------------------------------------------

BACKFILL = (
    "SELECT "
    + ", ".join(
        f'CAST(event_id + {i} AS VARCHAR) AS "{name}"'
        for i, name in enumerate(BACKFILL_COLUMNS[:-1])
    )
    + f""", CASE WHEN event_id % 20 = 18 THEN '' ELSE CAST(event_id + {len(BACKFILL_COLUMNS) - 1}
    AS VARCHAR) END AS "{BACKFILL_COLUMNS[-1]}" FROM events WHERE event_id % 20 <> 19"""
)

WIFI = """
SELECT md5(concat_ws('|', 'wifi', event_id % 3, event_id // 3)) AS uuid, event_type,
       CAST(epoch_us(ts) // 1000 AS VARCHAR) AS time_sta,
       strftime(make_timestamp(epoch_us(ts)), '%Y-%m-%d %H:%M:%S') AS time_date,
       CAST(user_id AS VARCHAR) AS device_id, 'net' || (event_id % 20) AS ssid,
       printf('02:00:00:00:00:%02x', event_id % 256) AS mac,
       CASE WHEN event_id % 4 <> 3 THEN 'WPA2' END AS encryption,
       'term' || (user_id % 10) AS terminal_ssid,
       printf('04:00:00:00:00:%02x', user_id % 256) AS terminal_mac,
       CAST(event_id % 13 + 1 AS VARCHAR) AS channel, 'phone' AS primary_classification,
       'android' AS secondary_classification, CAST(-(event_id % 90) AS VARCHAR) AS power,
       CAST(event_id % 100 AS VARCHAR) AS distance, 'site' || (event_id % 6) AS monitoring_site,
       'wifi' AS index_name, CAST(event_id AS VARCHAR) AS upside,
       CAST(event_id * 2 AS VARCHAR) AS down, CAST(event_id % 3600 AS VARCHAR) AS duration
FROM events
"""

NESTED_TABLE = f"""
WITH {NUMBERED}
SELECT serial AS "messageDeviceSerialId", CAST(in_message AS VARCHAR) AS "messageNumber",
       CASE WHEN msg_id % 11 <> 4 THEN '0' END AS reserved,
       CASE WHEN msg_id % 5 <> 0 THEN '0' END AS "tempVerifyCode",
       CASE WHEN msg_id % 5 <> 0 THEN 'false' END AS "messageSplit",
       {', '.join(f'{BODY_VALUES[k]} AS "{k}"' for k in BODY_VALUES)},
       CAST(NULL AS VARCHAR) AS "packageNumber", CAST(NULL AS VARCHAR) AS "loadLength",
       CAST(kind AS VARCHAR) AS "verifyTypeId", CAST(module AS VARCHAR) AS "verifyFunctionModuleCode"
FROM alarm
"""

USAGE = """
usage AS (
  SELECT user_id AS "userId", strftime(ts, '%Y-%m-%d') AS day, 'com.' || event_type AS package,
         event_id AS activetime FROM events
  UNION ALL
  SELECT user_id, strftime(ts, '%Y-%m-%d'), 'com.idle', event_id * 2 FROM events
)
"""

NESTED_FIELDS = f"""
WITH {USAGE}
SELECT CAST(0 AS INTEGER) AS position, CAST("userId" AS VARCHAR) AS field FROM usage
UNION ALL SELECT 1, day FROM usage
UNION ALL SELECT 2, package FROM usage
UNION ALL SELECT 3, CAST(activetime AS VARCHAR) FROM usage
"""

DASHED = f"""
WITH i AS (SELECT event_id, md5(concat_ws('|', 'da_trace', event_id % 3, event_id // 3)) AS h FROM events)
SELECT {PLACE}, concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), substr(h, 13, 4), substr(h, 17, 4),
       substr(h, 21, 12)) AS uuid
FROM i
"""

EXPLODE = f"""
WITH {NUMBERED}
SELECT uuid, date, currenttime, '0' AS event_level, pos, serial AS "messageDeviceSerialId",
       {HEADER_VALUES['messageDeviceDescribe']} AS "messageDeviceDescribe",
       {HEADER_VALUES['messageNumber']} AS "messageNumber", {HEADER_VALUES['reserved']} AS reserved,
       CASE WHEN msg_id % 5 <> 0 THEN '0' END AS "tempVerifyCode",
       CAST(module AS VARCHAR) AS module, CAST(kind AS VARCHAR) AS kind, src AS "srcIp",
       {BODY_VALUES['srcPort']} AS "srcPort"
FROM alarm
"""

ROUTE_MESSAGES = f"""
WITH {NUMBERED}
SELECT part AS partition, off AS "offset", pos,
       CASE module WHEN 6 THEN 'transformation' ELSE 'camouflage_and_label' END AS route
FROM alarm
"""

WINDOW_SIZES = (
    _classified(2)
    + """,
sized AS (
  SELECT seconds, route, type_label, us // 1000000 // seconds AS w, count(*) AS n
  FROM c, (VALUES (20), (120), (3600)) s(seconds) WHERE route <> 'label'
  GROUP BY ALL
)
SELECT seconds, count(*) AS summaries, CAST(sum(n) AS BIGINT) AS details, max(n) AS largest
FROM sized GROUP BY seconds
"""
)

DOCUMENT_LINES = "SELECT unnest(string_split(text, chr(10))) AS {} FROM documents"

ORACLES: dict[str, str] = {
    "explode_alarms": EXPLODE,
    "classify_gen0": _classify(0),
    "classify_gen1": _classify(1),
    "classify_gen2": _classify(2),
    "strict_code_match": _classify(
        1,
        "CASE WHEN event_id % 11 NOT IN (3, 5) THEN module END",
        "CASE WHEN event_id % 7 NOT IN (3, 5) THEN kind END",
    ),
    "route_counts_gen0": _route_counts(0),
    "route_counts_gen1": _route_counts(1),
    "route_counts_gen2": _route_counts(2),
    "route_messages": ROUTE_MESSAGES,
    "merge_detail_gen0": _merge_detail(0),
    "merge_detail": _merge_detail(1),
    "merge_detail_gen2": _merge_detail(2),
    "merge_detail_salted": _merge_detail(2),
    "merge_summary_gen0": _merge_summary(0),
    "merge_summary": _merge_summary(1),
    "merge_summary_gen2": _merge_summary(2),
    "merge_summary_stream": _merge_summary(2),
    "merge_detail_stream": _merge_detail(2),
    "merge_by_window_size": WINDOW_SIZES,
    "immediate_alarms": _classified(2)
    + f"SELECT {_layout(IDS, IMMEDIATE_LINKS)} FROM c WHERE route = 'label'",
    "report_rows": _report(),
    "warning_table_rows": _warning_table(2),
    "warning_table_rows_gen1": _warning_table(1),
    "warning_table_rows_gen0": _warning_table(0),
    "detail_table_rows": _detail_table(2),
    "detail_table_rows_gen1": _detail_table(1),
    "detail_table_rows_gen0": _detail_table(0),
    "vendor_alert_rows": _vendor(),
    "metadata_rows": _metadata(),
    "schemaless_rows": _schemaless_vendor(),
    "schemaless_metadata_rows": _schemaless_metadata(),
    "vendor_table_rows": _vendor(),
    "metadata_table_rows": _metadata(),
    "schemaless_table_rows": _schemaless_vendor(),
    "schemaless_metadata_table_rows": _schemaless_metadata(),
    "vendor_table_compacted": _vendor(),
    "backfill_table_rows": BACKFILL,
    "report_table_rows": _report(),
    "typed_record_counts": TYPED_RECORDS,
    "reject_counts": REJECTS,
    "packet_header": PACKET_HEADER,
    "packet_flow": PACKET_FLOW,
    "packet_dropped": PACKET_DROPPED,
    "packet_key": PACKET_KEY,
    "packet_files": PACKET_FILES,
    "csv_backfill": BACKFILL,
    "wifi_rows": WIFI,
    "nested_table": NESTED_TABLE,
    "nested_typed": f'WITH {USAGE} SELECT "userId", day, package, activetime FROM usage',
    "nested_fields": NESTED_FIELDS,
    "count_by_id_stream": "SELECT user_id, count(*) AS n FROM events GROUP BY user_id",
    "count_by_id_changelog": "SELECT user_id, count(*) AS n, CAST(1 AS BIGINT) AS balance "
    "FROM events GROUP BY user_id",
    "admitted_batches": "SELECT n AS messages, CAST(ceil(n / 1000) AS BIGINT) AS batches, "
    "least(n, 1000) AS largest FROM (SELECT count(DISTINCT event_id // 4) AS n FROM events)",
    "dashed_id_format": DASHED,
    "text_copy": DOCUMENT_LINES.format("value"),
    "text_copy_stream": DOCUMENT_LINES.format("value"),
    "raw_line_table": DOCUMENT_LINES.format("size"),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
