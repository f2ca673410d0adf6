"""Explode, classify and route on literal alarms."""

import json

import pytest
from pyspark.sql import functions as F

from alarmloom.operators import alarms as al
from alarmloom.operators import classify, project, records
from alarmloom.plans import jobs
from alarmloom.sources.kafka import text_values


def document(alarms, **header):
    return json.dumps({"messageDeviceSerialId": "S1", **header, "basicMessageBasicList": alarms})


def alarm(module, kind, **body):
    return {"verifyFunctionModuleCode": module, "verifyTypeId": kind, **body}


def classified(messages, alarms, generation, **header):
    frame = messages([(0, 7, 10, document(alarms, **header))])
    rows = jobs.classified_alarms(frame, generation).orderBy("pos").collect()
    return [(r.module_label, r.type_label, r.incidentdescription, r.route) for r in rows]


def test_explode_repeats_the_header_and_numbers_the_alarms(messages):
    frame = messages(
        [
            (1, 5, 100, document([alarm(6, 1), alarm(5, 2)], reserved=0, verifyCode=None)),
            (1, 6, 100, document([])),
        ]
    )
    parsed = records.parse_alarm_messages(text_values(frame, True))
    rows = al.explode_alarms(parsed, 2).orderBy("pos").collect()
    assert [(r.pos, r.reserved, r.verifyCode, r.tempVerifyCode) for r in rows] == [
        (0, "0", "null", None),
        (1, "0", "null", None),
    ]
    assert [r.date for r in rows] == ["100000", "100000"]
    assert rows[0].currenttime == "1970-01-01 00:01:40"
    assert rows[0].uuid != rows[1].uuid
    assert {r.event_level for r in rows} == {"0"}
    again = al.explode_alarms(parsed, 1).orderBy("pos").collect()
    assert [r.uuid for r in again] == [r.uuid for r in rows]
    assert {r.event_level for r in again} == {None}


def test_second_generation_labels_and_templates(messages):
    body = {"srcIp": "1.1.1.1", "destIp": "2.2.2.2"}
    found = classified(
        messages,
        [
            alarm(5, 0, **body),
            alarm(5, 4, **body),
            alarm(5, 3, destIp="2.2.2.2"),
            alarm(5, 9, **body),
            alarm(5, 99, **body),
            alarm(10, 2, **body),
            alarm(10, 4, **body),
            alarm(10, 5, **body),
            alarm(6, 8),
            alarm(4, 0),
            alarm(7, 2),
        ],
        2,
    )
    assert found == [
        ("网络扫描事件", "端口扫描事件", "1.1.1.1 扫描未伪装的2.2.2.2服务端口", "camouflage"),
        ("跳板攻击事件", "基于tcp/udp的横向探测事件", "S1主动发动TCP/UDP请求", "camouflage"),
        ("网络扫描事件", "IP扫描事件", "null与2.2.2.2伪装IP的TCP攻击会话结束", "camouflage"),
        ("5", "TCP会话超时告警", None, "camouflage"),
        ("5", "模拟", None, "camouflage"),
        ("网络扫描事件", "IP扫描事件", "1.1.1.1对2.2.2.2伪装地址进行ARP请求", "camouflage"),
        ("10", "IP冲突", "2.2.2.2伪装IP与网内其他IP冲突", "camouflage"),
        ("10", "模拟", None, "camouflage"),
        ("网络变形", "变形会话", None, "transformation"),
        ("网络隐身", "非法访问告警", None, "label"),
        ("安全标签", "标签错误告警", None, "label"),
    ]


def test_placeholders_inside_values_stay_as_they_are(messages):
    found = classified(messages, [alarm(5, 5, srcIp="%2$s{dst}", destIp="d")], 2)
    assert found[0][2] == "%2$s{dst}对d伪装地址进行PING攻击"


def test_first_generations(messages):
    alarms = [alarm(5, 6), alarm(5, 1), alarm(5, 15), alarm(10, 2), alarm(6, 3)]
    assert classified(messages, alarms, 1) == [
        ("网络伪装", "扫描未伪装端口告警", "基于ICMP的横向探测事件", "camouflage"),
        ("网络伪装", "攻击会话开始告警", "攻击会话建立事件", "camouflage"),
        ("网络伪装", "回应ARP广播告警", None, "camouflage"),
        ("安全标签", "标签错误告警", None, "label"),
        ("网络变形", "模拟", None, "transformation"),
    ]
    assert classified(messages, alarms, 0) == [
        ("网络伪装", "模拟", None, "label"),
        ("网络伪装", "攻击会话开始告警", None, "label"),
        ("网络伪装", "回应ARP广播告警", None, "label"),
        ("安全标签", "标签错误告警", None, "label"),
        ("网络变形", "模拟", None, "transformation"),
    ]


def test_codes_of_another_json_type_fall_to_the_default(messages):
    alarms = [alarm("6", 1), alarm(6.0, 1), alarm(6, "1"), alarm(5, 1.0)]
    assert [(m, t, r) for m, t, _, r in classified(messages, alarms, 1)] == [
        ("安全标签", "安全标签告警", "label"),
        ("安全标签", "安全标签告警", "label"),
        ("网络变形", "模拟", "transformation"),
        ("网络伪装", "模拟", "camouflage"),
    ]


@pytest.mark.parametrize("generation, modules", [(0, 4), (1, 4), (2, 5)])
def test_dimension_is_complete_and_small(generation, modules):
    rows = classify.dimension_rows(generation)
    keys = {(r["module_key"], r["type_key"]) for r in rows}
    assert len(rows) == len(keys) == modules * 17
    assert all(r["type_label"] and r["route"] for r in rows)
    assert classify.label_count(generation) < 40


def test_alarm_table_layouts(messages):
    body = {"srcIp": "1.1.1.1", "destPort": -5, "vlan": None, "newKey": "x", "incidentdescription": "own"}
    frame = messages([(0, 7, 10, document([alarm(4, 1, **body)], messageSplit=False))])
    rows = jobs.classified_alarms(frame, 2)
    row = project.immediate_rows(rows, 2).first().asDict()
    assert row["size"] == "1" and row["disposetime"] == "1" and row["event_level"] == "0"
    assert row["messageChipVersion"] == "-1" and row["messageSplit"] == "false"
    assert row["tempVerifyCode"] == "-1"
    assert row["verifyFunctionModuleCode"] == "网络隐身" and row["verifyTypeId"] == "隐身ARP告警"
    assert row["destPort"] == "-5" and row["vlan"] == "null" and row["changeIp"] is None
    assert row["incidentdescription"] == "own"
    assert row["extras"] == {"newKey": "x"}
    gen1 = project.immediate_rows(jobs.classified_alarms(frame, 1), 1).columns
    assert gen1[:3] == ["uuid", "date", "currenttime"] and "event_level" not in gen1
    gen0 = project.immediate_rows(jobs.classified_alarms(frame, 0), 0).columns
    assert gen0[:3] == ["uuid", "date", "messageProtocolVersion"]
    report = project.report_rows(rows).first()
    assert report.reserved == "-1" and report.verifyTypeId == "1"
    assert "uuid" not in report.asDict()


def test_two_way_route(messages):
    frame = messages([(0, 7, 10, document([alarm(6, 1), alarm(5, 1), alarm("6", 1)]))])
    parsed = records.parse_alarm_messages(text_values(frame, True))
    rows = classify.route_messages(al.explode_alarms(parsed)).orderBy("pos")
    assert [r.route for r in rows.collect()] == [
        "transformation",
        "camouflage_and_label",
        "camouflage_and_label",
    ]


def test_classification_is_a_broadcast_without_shuffle(messages):
    rows = jobs.classified_alarms(messages([(0, 7, 10, document([alarm(6, 1)]))]), 2)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_each_message_is_parsed_once(messages):
    rows = jobs.classified_alarms(messages([(0, 7, 10, document([alarm(6, 1)]))]), 2)
    plan = rows.select("uuid", "type_label")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1
