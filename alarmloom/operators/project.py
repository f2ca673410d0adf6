"""Layouts of the output tables."""

from pyspark.sql import Column, DataFrame, functions as F

from alarmloom.functions import documents
from alarmloom.functions.identity import stable_id, time_text
from alarmloom.functions.text import quote_to_bar
from alarmloom.schemas import (
    BODY_KEYS,
    DESCRIPTION_KEY,
    DISPOSE_KEY,
    HEADER_KEYS,
    MODULE_KEY,
    TRAILER_KEYS,
    TYPE_KEY,
    WIFI_COLUMNS,
    WIFI_KEYS,
    WIFI_SCHEMA,
)

DEFAULT = "-1"


def fixed_projection(
    parsed: DataFrame, columns: list[str], stamped: tuple[str, ...] = ("uuid", "date", "currenttime")
) -> DataFrame:
    """The listed columns as text: `-1` for an absent key, `null` for JSON null.

    A stamped column of the row goes before the document's own key of that name; where the stamp is
    NULL (bracketed vendor alerts) the document decides.
    """

    stamps = [name for name in stamped if name in parsed.columns]
    found = parsed.select(*stamps, documents.members(F.col("doc"), columns).alias("m"))

    def value(name):
        own = documents.value_text(F.col(f"m.`{name}`"))
        parts = [F.col(name)] if name in stamps else []
        return F.coalesce(*parts, own, F.lit(DEFAULT)).alias(name)

    return found.select(*[value(name) for name in columns])


def _or_default(name: str, default: str = DEFAULT) -> Column:
    return F.coalesce(F.col(name), F.lit(default)).alias(name)


def _with_body(rows: DataFrame) -> DataFrame:
    return rows.withColumn("body", documents.members(F.col("alarm"), BODY_KEYS))


def _body(classified: bool) -> list[Column]:
    """Declared alarm keys; a key the alarm does not have stays NULL."""

    def own(key):
        return documents.value_text(F.col(f"body.{key}"))

    replaced = {}
    if classified:
        replaced = {
            MODULE_KEY: F.col("module_label"),
            TYPE_KEY: F.col("type_label"),
            DESCRIPTION_KEY: F.coalesce(F.col(DESCRIPTION_KEY), own(DESCRIPTION_KEY)),
        }
    return [replaced.get(key, own(key)).alias(key) for key in BODY_KEYS]


def _extras() -> Column:
    """Alarm keys outside the declared ones, as a map."""
    return F.map_filter(
        documents.text_map(F.col("alarm")), lambda key, _: ~key.isin(BODY_KEYS)
    ).alias("extras")


def alarm_row(rows: DataFrame, ids: list[str], links: list[str], extras: bool = True) -> DataFrame:
    """Header, link columns (`pid`, `size`, ...), body, trailer and unknown keys of classified alarms."""
    defaults = {"event_level": "0", DISPOSE_KEY: "1", "size": "1"}
    return _with_body(rows).select(
        *[_or_default(name) for name in ids],
        *[_or_default(name) for name in HEADER_KEYS],
        *[
            F.coalesce(F.col(name).cast("string"), F.lit(defaults.get(name, DEFAULT))).alias(name)
            for name in links
        ],
        *_body(classified=True),
        *[_or_default(name) for name in TRAILER_KEYS],
        *([_extras()] if extras else []),
    )


def _ids(generation: int) -> list[str]:
    return ["uuid", "date"] if generation == 0 else ["uuid", "date", "currenttime"]


def immediate_rows(rows: DataFrame, generation: int = 2, extras: bool = True) -> DataFrame:
    """Alarms that are not merged: `size` is 1, and `disposetime` is the message's."""
    links = ["size"] + ([DISPOSE_KEY, "event_level"] if generation == 2 else [])
    return alarm_row(rows.withColumn("size", F.lit("1")), _ids(generation), links, extras)


def detail_rows(rows: DataFrame, generation: int = 2, extras: bool = True) -> DataFrame:
    links = ["pid"] + (["event_level"] if generation == 2 else [])
    return alarm_row(rows, _ids(generation), links, extras)


def summary_rows(rows: DataFrame, generation: int = 2, extras: bool = True) -> DataFrame:
    links = ["pid", "size"] + (["event_level"] if generation == 2 else [])
    return alarm_row(rows, _ids(generation), links, extras)


def report_rows(alarms: DataFrame, extras: bool = True) -> DataFrame:
    """Raw alarms, not classified: no ids of their own, `reserved` always `-1`.

    The alarms of a message share its id and its time, which stays a TIMESTAMP.
    """
    message_id = stable_id(F.col("topic"), F.col("partition"), F.col("offset"))
    return _with_body(alarms).withColumn("reserved", F.lit(DEFAULT)).select(
        message_id.alias("messageUuid"),
        F.col("event_ts").alias("messageTime"),
        *[_or_default(name) for name in HEADER_KEYS],
        *_body(classified=False),
        *[_or_default(name) for name in TRAILER_KEYS],
        *([_extras()] if extras else []),
    )


def schemaless_rows(parsed: DataFrame) -> DataFrame:
    """Whatever keys the document has, as a map with quotes turned into bars, and an id."""
    fields = F.transform_values(documents.text_map(F.col("doc")), lambda _, v: quote_to_bar(v))
    return parsed.select(fields.alias("fields"), "uuid")


def pivot_fields(rows: DataFrame, keys: list[str], fields: str = "fields") -> DataFrame:
    """Declared keys of a map column as columns (NULL where absent), the others in `extras`."""
    return rows.select(
        *[c for c in rows.columns if c != fields],
        *[F.try_element_at(fields, F.lit(key)).alias(key) for key in keys],
        F.map_filter(fields, lambda key, _: ~key.isin(keys)).alias("extras"),
    )


def wifi_rows(messages: DataFrame) -> DataFrame:
    """Wi-Fi probe events under their table names, with an id and a formatted time."""
    parsed = messages.select(
        stable_id(F.col("topic"), F.col("partition"), F.col("offset")).alias("uuid"),
        F.from_json(F.col("value").cast("string"), WIFI_SCHEMA).alias("probe"),
    )
    time = F.col("probe.time").cast("bigint")
    # The table has the event's keys in order, with the id in front and the text time after `time`.
    values = [F.col("uuid")]
    for key in WIFI_KEYS:
        values.append(F.col(f"probe.{key}"))
        if key == "time":
            values.append(time_text(F.timestamp_millis(time)))
    return parsed.select(*[v.alias(name) for v, name in zip(values, WIFI_COLUMNS, strict=True)])
