"""CSV, Wi-Fi, nested tables, and the options of the connectors that need a cluster."""

import pytest
from pyspark.sql import functions as F

from alarmloom.operators import backfill, nested, project
from alarmloom.schemas import APP_USAGE_TEXT_SCHEMA, BACKFILL_COLUMNS, WIFI_COLUMNS
from alarmloom.sinks import jdbc
from alarmloom.sources.kafka import kafka_options


def test_backfill_keeps_empty_fields_and_rejects_short_lines(spark):
    full = ",".join(str(i) for i in range(58))
    trailing = "," * 57
    lines = spark.createDataFrame([(full,), (trailing,), ("1,2",), (full + ",59",)], "value string")
    rows = backfill.backfill_rows(lines)
    assert rows.columns == BACKFILL_COLUMNS and len(set(BACKFILL_COLUMNS)) == 58
    found = sorted(r.pid for r in rows.collect())
    assert found == ["", "57", "57"]
    assert [r.value for r in backfill.backfill_rejects(lines).collect()] == ["1,2"]


def test_wifi_row(messages):
    text = '{"eventType":"probe","time":1500,"ssid":"net","power":-40,"duration":7}'
    row = project.wifi_rows(messages([(0, 0, 1, text)], "wifi")).first()
    assert list(row.asDict()) == WIFI_COLUMNS
    assert (row.event_type, row.time_sta, row.time_date) == ("probe", "1500", "1970-01-01 00:00:01")
    assert (row.power, row.duration, row.mac) == ("-40", "7", None)


def test_nested_sample(messages):
    text = (
        '{"messageProtocolVersion":"","messageDeviceTypeId":0,"messageDeviceSerialId":"DEV7",'
        '"basicMessageBasicList":[{"srcMac":"02-00-00-00-00-09","srcPort":61007,"byteNumber":-4021,'
        '"verifyTypeId":13}],"tempVerifyCode":0,"messageSplit":false}'
    )
    row = nested.nested_report(messages([(0, 0, 1, text)])).first()
    assert len(row) == 16
    assert (row.messageDeviceTypeId, row.messageSplit) == ("0", "false")
    (alarm,) = row.basicMessageBasicList
    assert len(alarm) == 13
    assert (alarm.srcPort, alarm.byteNumber, alarm.destIp) == ("61007", "-4021", None)


def test_typed_sample(messages):
    text = '{"userId":"1","day":"2031-11-23","data":[{"package":"com.maps","activetime":"912"},{"activetime":"x"}]}'
    row = nested.typed_report(messages([(0, 0, 1, text)])).first()
    assert (row.userId, row.day) == (1, "2031-11-23")
    assert [tuple(e) for e in row.data] == [("com.maps", 912), (None, None)]


def test_typed_records_set_bad_text_aside(messages):
    frame = messages([(0, 0, 1, '{"day":"d"}'), (0, 1, 1, '{"day":'), (0, 2, 1, "[1]"), (0, 3, 1, None)])
    found = nested.typed_records(frame, APP_USAGE_TEXT_SCHEMA)
    reasons = {r.offset: (r.reject_reason, r.record and r.record.day) for r in found.collect()}
    assert reasons[0] == (None, "d")
    assert {reasons[i][0] for i in (1, 2, 3)} == {"malformed"}


def test_numbered_fields(spark):
    rows = spark.createDataFrame([(1, "a,b")], "x int, y string")
    found = [tuple(r) for r in nested.numbered_fields(rows).collect()]
    assert found == [(0, "1"), (1, "a"), (2, "b")]


def test_kafka_options():
    latest = kafka_options("h:1", "t")
    assert latest["subscribe"] == "t" and latest["startingOffsets"] == "latest"
    assert kafka_options("h:1", "t", "group")["startingOffsets"] == "latest"
    assert kafka_options("h:1", "t", "earliest", 500, 64)["maxOffsetsPerTrigger"] == "500"
    flush = kafka_options("h:1", "t", min_offsets_per_trigger=1000, max_trigger_delay=8, max_offsets_per_trigger=5000)
    assert (flush["minOffsetsPerTrigger"], flush["maxTriggerDelay"]) == ("1000", "8s")
    assert flush["maxOffsetsPerTrigger"] == "5000" and "minOffsetsPerTrigger" not in latest
    fixed = kafka_options("h:1", "t", {"t": {0: 5}})
    assert fixed["startingOffsets"] == '{"t": {"0": 5}}'
    with pytest.raises(ValueError):
        kafka_options("h:1", "t", "somewhere")


def test_jdbc_options_and_text_columns(spark):
    options = jdbc.jdbc_options("jdbc:x:y", "bus_warning", "d.Driver", "u", "p", connections=4)
    assert options["batchsize"] == "1000" and options["numPartitions"] == "4"
    rows = spark.range(1).select(
        "id", F.create_map(F.lit("k"), F.lit("v")).alias("extras"), F.lit("it's").alias("text")
    )
    found = jdbc.as_text_columns(rows)
    assert set(dict(found.dtypes).values()) == {"string"}
    assert list(found.first()) == ["0", '{"k":"v"}', "it's"]


def test_scratch_deletes_what_was_staged_in_it(spark):
    from pathlib import Path

    from alarmloom.session import scratch, shared_folder, stage

    folder = Path(shared_folder(spark).removeprefix("file://")) / "alarmloom"
    before = set(folder.glob("*"))
    with scratch(spark) as keep:
        rows = stage(spark.range(5), "on-the-way")
        kept = keep(rows.filter("id > 2"), "result")
    assert [r.id for r in kept.orderBy("id").collect()] == [3, 4]
    assert {p.name.split("-")[0] for p in set(folder.glob("*")) - before} == {"result"}
    with pytest.raises(ValueError), scratch(spark):
        stage(spark.range(3), "dropped")
        raise ValueError
    outside = stage(spark.range(2), "outside")
    assert outside.count() == 2


def test_a_changed_table_is_encoded_anew(spark, tmp_path):
    import pyarrow.parquet as pq

    from alarmloom.sources import samples

    events = pq.read_table("/root/testdata/sf0.001/events.parquet")
    for rows in (events, events.slice(0, 10)):
        pq.write_table(rows, tmp_path / "events.parquet")
        assert samples.wifi_lines(spark, str(tmp_path)).count() == len(rows)
