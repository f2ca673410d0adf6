"""Parsing, repair, rejects and the schema-less and fixed projections on literal payloads."""

import json

import pytest
from pyspark.sql import functions as F

from alarmloom.functions import documents, identity, text
from alarmloom.operators import project, records
from alarmloom.plans import jobs
from alarmloom.schemas import METADATA_COLUMNS, VENDOR_COLUMNS
from alarmloom.sources.kafka import byte_values, text_values


def one(spark, expression, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(expression).first()[0]


def test_column_lists_have_the_table_widths():
    assert (len(VENDOR_COLUMNS), len(set(VENDOR_COLUMNS))) == (109, 109)
    assert (len(METADATA_COLUMNS), len(set(METADATA_COLUMNS))) == (104, 104)


@pytest.mark.parametrize(
    "raw, mode, expected",
    [
        ('[{"a":1}]\n', "reference", '{"a":1}'),
        ('[{"a":1}]', "reference", '{"a":1'),  # the rule relies on the newline
        ('[{"a":1}]', "lenient", '{"a":1}'),
        (' [{"a":1}] \n', "lenient", '{"a":1}'),
        ('[{"ip":[1.2.3.4]}]\n', "reference", '{"ip":"1.2.3.4"}'),
        ('[{"f":[{123.exe}]}]\n', "reference", '{"f":"{123.exe}"}'),
    ],
)
def test_unwrap_brackets(spark, raw, mode, expected):
    assert one(spark, text.unwrap_brackets(F.col("v"), mode), v=raw) == expected


def test_double_backslashes_are_cut(spark):
    assert one(spark, text.drop_double_backslashes(F.col("v")), v=r"a\\b\c\\\d") == r"ab\c" + "\\d"


def test_absent_null_and_value_are_kept_apart(spark):
    doc = F.try_parse_json("v")
    raw = '{"a":null,"b":"x","c":[1,{"d":2}],"e":-7,"f":true,"sp ":5,"g":"null"}'
    found = spark.createDataFrame([(raw,)], "v string").select(
        *[documents.field_text(doc, k).alias(k) for k in ("a", "b", "c", "e", "f", "sp ", "zz")],
    )
    assert list(found.first()) == ["null", "x", '[1,{"d":2}]', "-7", "true", "5", None]


def test_members_agree_with_single_fields(spark):
    raw = '{"a":null,"b":"x","list":[{"k":1}],"no":{"k":1}}'
    doc = F.try_parse_json("v")
    m = documents.members(doc, ["a", "b", "zz"], ["list", "no"])
    row = (
        spark.createDataFrame([(raw,)], "v string")
        .select(m.alias("m"))
        .select(
            documents.value_text(F.col("m.a")),
            documents.value_text(F.col("m.b")),
            documents.value_text(F.col("m.zz")),
            F.size("m.list"),
            F.col("m.no").isNull(),
        )
        .first()
    )
    assert list(row) == ["null", "x", None, 1, True]


@pytest.mark.parametrize(
    "raw, ok",
    [
        ('{"a":1}', True),
        (' \n{"a":1}', True),
        ("{}", True),
        ('{"a":1', False),
        ("[1]", False),
        ("null", False),
        ('"{"', False),
        ("", False),
        (None, False),
    ],
)
def test_only_objects_are_documents(spark, raw, ok):
    found = spark.createDataFrame([(raw,)], "v string").select(
        F.explode_outer(documents.object_or_none(F.col("v"))).alias("d")
    )
    assert found.first()["d"] is not None if ok else found.first()["d"] is None


def test_repeated_key_keeps_the_last_value(spark):
    assert one(spark, documents.field_text(F.try_parse_json("v"), "a"), v='{"a":1,"a":2}') == "2"


def test_integer_codes_are_strict(spark):
    raw = '{"i":6,"s":"6","d":6.0,"n":null,"big":12345678901}'
    doc = F.try_parse_json("v")
    row = spark.createDataFrame([(raw,)], "v string").select(
        *[documents.integer_code(doc, k) for k in ("i", "s", "d", "n", "big", "none")]
    )
    assert list(row.first()) == [6, None, None, None, None, None]


def test_null_value_becomes_empty_text_and_is_dropped(messages):
    frame = messages([(0, 0, 10, None), (0, 1, 10, ""), (0, 2, 10, "{}")])
    values = text_values(frame, null_as_empty=True)
    assert [r.value for r in values.orderBy("offset").collect()] == ["", "", "{}"]
    assert records.drop_empty(values).count() == 1
    assert records.drop_empty(text_values(frame)).count() == 1
    assert dict(byte_values(frame).dtypes)["value"] == "binary"


def test_rejects_name_the_reason(messages):
    good = '{"basicMessageBasicList":[{"verifyFunctionModuleCode":6,"verifyTypeId":1},{"verifyTypeId":1}]}'
    frame = messages(
        [
            (0, 0, 10, good),
            (0, 1, 10, '{"a":'),
            (0, 2, 10, '{"a":1}'),
            (0, 3, 10, '{"basicMessageBasicList":5}'),
            (0, 4, 10, '{"basicMessageBasicList":[]}'),
            (0, 5, 10, None),
            (0, 6, 10, "[1]"),
        ]
    )
    reasons = {(r.offset, r.reject_reason) for r in jobs.alarm_rejects(frame).collect()}
    assert reasons == {
        (0, "missing_code"),
        (1, "malformed"),
        (2, "no_alarm_list"),
        (3, "no_alarm_list"),
        (6, "malformed"),
    }
    assert jobs.classified_alarms(frame, 2).count() == 1


def test_strict_mode_fails_on_the_first_bad_record(messages):
    frame = messages([(0, 0, 10, '{"a":')])
    with pytest.raises(Exception, match="bad record malformed:da_warning:0:0"):
        jobs.classified_alarms(frame, 2, strict=True).count()
    good = messages(
        [(0, 0, 10, '{"basicMessageBasicList":[{"verifyFunctionModuleCode":6,"verifyTypeId":1}]}')]
    )
    assert jobs.classified_alarms(good, 2, strict=True).count() == 1


def test_vendor_alert_stamps_and_defaults(messages):
    plain = json.dumps({"name": "scan", "direction": None, "date": "own", "srcAddress": "[x]"})
    wrapped = '[{"name":"scan","date":"own","srcAddress":[1.2.3.4]}]\n'
    frame = messages([(0, 0, 10, plain), (0, 1, 10, wrapped), (0, 2, 10, "")], "ah_warning")
    rows = {r.srcAddress: r for r in jobs.vendor_rows(frame).collect()}
    assert rows.keys() == {"[x]", "1.2.3.4"}
    first, second = rows["[x]"], rows["1.2.3.4"]
    assert list(first.asDict()) == VENDOR_COLUMNS
    assert (first.date, first.currenttime) == ("10000", "1970-01-01 00:00:10")
    assert (first.direction, first.name, first.payload) == ("null", "scan", "-1")
    assert len(first.uuid) == 32
    assert (second.uuid, second.date, second.currenttime) == ("-1", "own", "-1")


def test_metadata_skips_what_it_cannot_parse(messages):
    sample = (
        '{"device_id":"222","interface_icon":"核心交换","sport":51140,"http_res_code":200,'
        '"referer":"http://x/upload.aspx?Path=%2f\' web_xff=\'","content_length ":1375,"uri":"/a\\\\b"}'
    )
    broken = '{"device_id":"1","file_list":[{123.exe}]}'
    frame = messages([(0, 0, 10, sample), (0, 1, 10, broken)], "ah_metadata")
    (row,) = jobs.metadata_rows(frame).collect()
    assert (row.interface_icon, row.sport, row.uri) == ("核心交换", "51140", "/ab")
    assert row.referer.endswith("web_xff='")
    assert row.content_length == "-1"  # the key with a trailing space is another key
    assert row.uuid != "-1"
    parsed = records.parse_metadata_lines(text_values(frame, True))
    assert [r.offset for r in records.rejects(parsed).collect()] == [1]


def test_schemaless_row(messages):
    line = '{"name":"it\'s","ip":[1.2.3.4],"none":null,"n":5}'
    parsed = records.parse_loose_lines(text_values(messages([(0, 0, 10, line)]), True))
    rows = project.schemaless_rows(records.usable(parsed))
    assert rows.first().fields == {"name": "it|s", "ip": "1.2.3.4", "none": "null", "n": "5"}
    pivoted = project.pivot_fields(rows, ["name", "absent"]).first()
    assert (pivoted["name"], pivoted["absent"]) == ("it|s", None)
    assert pivoted["extras"] == {"ip": "1.2.3.4", "none": "null", "n": "5"}
    # Without the plain repair the same record keeps real arrays as JSON text.
    kept = records.parse_loose_lines(
        text_values(messages([(0, 0, 10, '{"a":[1]}')]), True), quote_plain_brackets=False
    )
    assert project.schemaless_rows(kept).first().fields == {"a": "[1]"}


def test_ids(spark):
    row = spark.range(1).select(
        identity.stable_id(F.lit("t"), F.lit(1), F.lit(2)).alias("a"),
        identity.stable_id(F.lit("t"), F.lit(1), F.lit(2)).alias("b"),
        identity.stable_id(F.lit("t"), F.lit(12), F.lit(2)).alias("c"),
        identity.random_id().alias("r"),
        identity.dashed(F.lit("0123456789abcdef0123456789abcdef")).alias("d"),
    )
    found = row.first()
    assert found.a == found.b != found.c
    assert len(found.r) == 32 and "-" not in found.r
    assert found.d == "01234567-89ab-cdef-0123-456789abcdef"


@pytest.mark.parametrize(
    "text, reason",
    [
        ('{"name":"a"}', None),
        (' {"name":"a"}\n', None),
        ('{"name":"a"}{"name":"b"}', "trailing_text"),
        ('{"name":"a"} trailing', "trailing_text"),
        ('{"name":"a"},{"name":"b"}', "trailing_text"),
        ('{"name":"a"},"k":1', "trailing_text"),
        ('{"name":"a"},1] rest', "trailing_text"),
        ('[{"name":"x"},{"name":"y"}]\n', "trailing_text"),
        ("[1]", "malformed"),
        ("7", "malformed"),
    ],
)
def test_text_behind_the_object_is_rejected(messages, text, reason):
    for parse in (records.parse_vendor_lines, records.parse_metadata_lines):
        row = parse(text_values(messages([(0, 0, 1, text)]))).first()
        assert row.reject_reason == reason
