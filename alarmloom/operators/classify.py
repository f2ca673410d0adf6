"""Codes to labels, descriptions and routes, by a join to a fixed dimension.

The dimension has one row for every (known module or other) x (type 0..15 or other), at most 85 rows
per generation, so it is always broadcast and every alarm finds exactly one row.
"""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from alarmloom.functions import documents
from alarmloom.operators.alarms import with_codes
from alarmloom.schemas import DESCRIPTION_KEY, MODULE_KEY

TRANSFORMATION = "transformation"
CAMOUFLAGE = "camouflage"
LABEL = "label"
REJECTED = "rejected"

# --- Fixed values: labels and descriptions ------------------------------------------------------
# In descriptions {src}, {dst} and {serial} stand for the alarm's source and destination address
# and the device serial number.

OTHER_TYPE_LABEL = "模拟"

TRANSFORMATION_MODULE_LABEL = "网络变形"
TRANSFORMATION_TYPES = {
    0: "标签校验错误告警",
    1: "标签目的地址未在白名单告警",
    2: "非法访问跳变地址告警",
    5: "变形会话异常结束告警",
    7: "变形会话异常结束告警",
    8: "变形会话",
}

STEALTH_MODULE_LABEL = "网络隐身"
STEALTH_TYPES = {0: "非法访问告警", 1: "隐身ARP告警"}

OTHER_MODULE_LABEL = "安全标签"
OTHER_MODULE_TYPES = {1: "安全标签告警", 2: "标签错误告警"}

CAMOUFLAGE_MODULE_LABEL = "网络伪装"
# type: (label, description)
CAMOUFLAGE_TYPES_FIRST = {
    0: ("扫描未伪装端口告警", "端口扫描事件"),
    1: ("攻击会话开始告警", "攻击会话建立事件"),
    2: ("攻击会话正常结束告警", "攻击会话结束事件"),
    3: ("攻击会话异常结束告警", "IP扫描事件"),
    4: ("回应主机主动向外发包告警", "基于TCP/UDP的横向探测事件"),
    5: ("ICMP报文攻击告警", "IP扫描事件"),
    6: ("扫描未伪装端口告警", "基于ICMP的横向探测事件"),
    7: ("回应ICMP包告警", "端口扫描事件"),
    8: ("回应主机主动向外发送ICMP包告警", "回攻击会话持续事件"),
}
# type: (module label, label, description)
CAMOUFLAGE_TYPES_SECOND = {
    0: ("网络扫描事件", "端口扫描事件", "{src} 扫描未伪装的{dst}服务端口"),
    1: ("攻陷回应主机事件", "攻击会话建立事件", "{src}与{dst}伪装IP建立了TCP/UDP攻击会话"),
    2: ("攻陷回应主机事件", "攻击会话结束事件", "{src}与{dst}伪装IP的TCP攻击会话结束"),
    3: ("网络扫描事件", "IP扫描事件", "{src}与{dst}伪装IP的TCP攻击会话结束"),
    4: ("跳板攻击事件", "基于tcp/udp的横向探测事件", "{serial}主动发动TCP/UDP请求"),
    5: ("网络扫描事件", "IP扫描事件", "{src}对{dst}伪装地址进行PING攻击"),
    6: ("跳板攻击事件", "基于ICMP的横向探测事件", "{serial}回应主机主动发送ICMP请求"),
    7: ("网络扫描事件", "端口扫描事件", "{src}与{dst}伪装IP的TCP/UDP/ICMP攻击会话超时"),
    8: ("攻陷回应主机事件", "回攻击会话持续事件", "{src}与{dst}伪装IP的TCP/UDP会话未结束"),
}
CAMOUFLAGE_TYPES_SHARED = {
    9: "TCP会话超时告警",
    10: "UDP会话超时告警",
    11: "ICMP会话超时告警",
    12: "TCP会话长连接告警",
    13: "5.5.2 UDP会话长连接告警",
    14: "ARP广播告警",
    15: "回应ARP广播告警",
}
ADDRESS_TYPES = {
    2: ("网络扫描事件", "IP扫描事件", "{src}对{dst}伪装地址进行ARP请求"),
    3: ("跳板攻击事件", "基于ARP的横向探测事件", "{serial}回应主机主动发送ARP请求"),
    4: (None, "IP冲突", "{dst}伪装IP与网内其他IP冲突"),
}

# --- Dimension ----------------------------------------------------------------------------------

OTHER = -1
TYPE_KEYS = [*range(16), OTHER]
_COLUMNS = ["code_key", "dim_module_label", "type_label", "template", "route"]


def _first_camouflage(generation, kind):
    label, description = CAMOUFLAGE_TYPES_FIRST.get(
        kind, (CAMOUFLAGE_TYPES_SHARED.get(kind, OTHER_TYPE_LABEL), None)
    )
    if generation == 0:
        return CAMOUFLAGE_MODULE_LABEL, OTHER_TYPE_LABEL if kind == 6 else label, None
    return CAMOUFLAGE_MODULE_LABEL, label, description


def _second_camouflage(kind):
    shared = CAMOUFLAGE_TYPES_SHARED.get(kind, OTHER_TYPE_LABEL)
    return CAMOUFLAGE_TYPES_SECOND.get(kind, (None, shared, None))


def dimension_rows(generation: int) -> list[dict]:
    """A module label of None means: keep the code as it is."""
    modules = {
        6: (TRANSFORMATION, lambda t: (TRANSFORMATION_MODULE_LABEL, TRANSFORMATION_TYPES.get(t))),
        4: (LABEL, lambda t: (STEALTH_MODULE_LABEL, STEALTH_TYPES.get(t))),
        OTHER: (LABEL, lambda t: (OTHER_MODULE_LABEL, OTHER_MODULE_TYPES.get(t))),
    }
    if generation == 2:
        modules[5] = (CAMOUFLAGE, _second_camouflage)
        modules[10] = (CAMOUFLAGE, lambda t: ADDRESS_TYPES.get(t, (None, None, None)))
    else:
        # The oldest job has no third stream: what is not a transformation goes to label.
        route = LABEL if generation == 0 else CAMOUFLAGE
        modules[5] = (route, lambda t: _first_camouflage(generation, t))
    rows = []
    for module, (route, labels) in modules.items():
        for kind in TYPE_KEYS:
            module_label, type_label, *template = labels(kind)
            rows.append(
                {
                    "module_key": module,
                    "type_key": kind,
                    "dim_module_label": module_label,
                    "type_label": type_label or OTHER_TYPE_LABEL,
                    "template": template[0] if template else None,
                    "route": route,
                }
            )
    return rows


def label_count(generation: int) -> int:
    """How many (route, type label) pairs can occur: the bound on merge keys per window."""
    return len({(r["route"], r["type_label"]) for r in dimension_rows(generation)})


def _code_key(module, kind):
    return module * 100 + kind


def _dimension(spark: SparkSession, rows: list[dict]) -> DataFrame:
    # As format_string patterns: a missing argument prints as the word null, and text inside an
    # argument is never taken for a placeholder.
    def pattern(template):
        if template is None:
            return None
        for place, argument in (("{src}", "%1$s"), ("{dst}", "%2$s"), ("{serial}", "%3$s")):
            template = template.replace(place, argument)
        return template

    table = pa.table(
        {
            "code_key": pa.array(
                [_code_key(r["module_key"], r["type_key"]) for r in rows], pa.int32()
            ),
            **{
                name: pa.array([r[name] for r in rows], pa.string())
                for name in ("dim_module_label", "type_label", "route")
            },
            "template": pa.array([pattern(r["template"]) for r in rows], pa.string()),
        }
    )
    return spark.createDataFrame(table).select(*_COLUMNS)


def classify(alarms: DataFrame, generation: int = 2) -> DataFrame:
    """Add `module_label`, `type_label`, `incidentdescription` and `route`."""
    rows = dimension_rows(generation)
    known_modules = sorted({r["module_key"] for r in rows} - {OTHER})
    module_key = F.when(F.col("module_code").isin(known_modules), F.col("module_code")).otherwise(
        OTHER
    )
    type_key = F.when(F.col("type_code").between(0, 15), F.col("type_code")).otherwise(OTHER)
    # Known to be never null: else Spark filters on the join key, and so walks every alarm once more.
    code_key = F.coalesce(_code_key(module_key, type_key), F.lit(_code_key(OTHER, OTHER)))
    coded = with_codes(alarms).withColumn("code_key", code_key)
    dimension = F.broadcast(_dimension(alarms.sparkSession, rows))
    alarm = F.col("alarm")
    description = F.call_function(
        "format_string",
        F.col("template"),
        documents.field_text(alarm, "srcIp"),
        documents.field_text(alarm, "destIp"),
        F.col("messageDeviceSerialId"),
    )
    return (
        coded.join(dimension, "code_key")
        .withColumns(
            {
                "module_label": F.coalesce(
                    F.col("dim_module_label"), documents.field_text(alarm, MODULE_KEY)
                ),
                DESCRIPTION_KEY: F.when(F.col("template").isNotNull(), description),
            }
        )
        .drop("code_key", "dim_module_label", "template")
    )


def route_rejects(classified: DataFrame) -> DataFrame:
    """Give rows with a `reject_reason` a route of their own."""
    bad = F.col("reject_reason").isNotNull()
    return classified.withColumn("route", F.when(bad, F.lit(REJECTED)).otherwise(F.col("route")))


def route_messages(alarms: DataFrame) -> DataFrame:
    """Two-way route of plain alarms: module 6 against everything else."""
    return with_codes(alarms).withColumn(
        "route",
        F.when(F.col("module_code") == 6, F.lit(TRANSFORMATION)).otherwise(
            F.lit(f"{CAMOUFLAGE}_and_{LABEL}")
        ),
    )
