"""Declared-schema tables over nested JSON documents."""

from pyspark.sql import DataFrame, functions as F

from alarmloom.functions import documents
from alarmloom.schemas import APP_USAGE_TEXT_SCHEMA, NESTED_REPORT_SCHEMA


def nested_report(messages: DataFrame) -> DataFrame:
    """The declared nested table: all text, alarms as an array of 13-field rows."""
    document = F.from_json(F.col("value").cast("string"), NESTED_REPORT_SCHEMA)
    return messages.select(document.alias("d")).select("d.*")


def typed_report(messages: DataFrame) -> DataFrame:
    """`userId BIGINT, day STRING, data ARRAY<STRUCT<package STRING, activetime BIGINT>>`.

    The numbers come as strings; a value that is no number becomes NULL.
    """
    document = F.from_json(F.col("value").cast("string"), APP_USAGE_TEXT_SCHEMA)
    return messages.select(document.alias("d")).select(
        F.col("d.userId").try_cast("bigint").alias("userId"),
        "d.day",
        F.transform(
            "d.data",
            lambda e: F.struct(
                e["package"].alias("package"),
                e["activetime"].try_cast("bigint").alias("activetime"),
            ),
        ).alias("data"),
    )


def typed_records(messages: DataFrame, schema) -> DataFrame:
    """Any declared schema: the typed columns plus `reject_reason` for text that is no object.

    Parse errors do not stop the job; the caller splits the rejects off.
    """
    text = F.coalesce(F.col("value").cast("string"), F.lit(""))
    parsed = messages.withColumn("record", F.from_json(text, schema, {"mode": "PERMISSIVE"}))
    is_object = F.size(documents.object_or_none(text)) == 1
    return parsed.withColumn("reject_reason", documents.unreadable(is_object, text))


def numbered_fields(rows: DataFrame) -> DataFrame:
    """Every row as text, split at commas into numbered pieces."""
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in rows.columns])
    return rows.select(F.posexplode(F.split(line, ",", -1)).alias("position", "field"))


def count_by(rows: DataFrame, key: str) -> DataFrame:
    """Rows per key; on a stream the counts change as rows arrive (update or complete output)."""
    return rows.groupBy(key).agg(F.count("*").alias("n"))
