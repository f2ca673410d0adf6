"""Parsing of message frames into documents, with the bad records kept apart."""

from pyspark.sql import Column, DataFrame, functions as F

from alarmloom.functions import documents, text
from alarmloom.functions.identity import epoch_millis, stable_id, time_text
from alarmloom.schemas import ALARM_LIST_KEY


def drop_empty(messages: DataFrame) -> DataFrame:
    """Drop records whose text is empty, and records without a value."""
    return messages.filter(F.col("value") != "")


def with_event_time(messages: DataFrame, clock: str = "arrival") -> DataFrame:
    """`event_ts` = the broker's time stamp (`arrival`) or the time of the batch (`processing`)."""
    if clock == "arrival":
        return messages.withColumn("event_ts", F.col("timestamp"))
    if clock == "processing":
        return messages.withColumn("event_ts", F.current_timestamp())
    raise ValueError(f"unknown clock: {clock}")


def _with_document(messages: DataFrame, text: Column, clock: str) -> DataFrame:
    """Add `event_ts` and `doc`, NULL where the text is no JSON object."""
    timed = with_event_time(messages, clock)
    return timed.select(
        *timed.columns, F.explode_outer(documents.object_or_none(text)).alias("doc")
    )


def parse_alarm_messages(messages: DataFrame, clock: str = "arrival") -> DataFrame:
    """Add `doc` (VARIANT object) and `reject_reason` (NULL for a usable message)."""
    parsed = _with_document(drop_empty(messages), F.col("value"), clock)
    return parsed.withColumn(
        "reject_reason",
        F.coalesce(
            documents.unreadable(F.col("doc").isNotNull(), F.col("value")),
            F.when(
                documents.object_list(F.col("doc"), ALARM_LIST_KEY).isNull(),
                F.lit("no_alarm_list"),
            ),
        ),
    )


def _parse_lines(lines: DataFrame, repaired: Column, clock: str) -> DataFrame:
    return _with_document(lines, repaired, clock).withColumn(
        "reject_reason",
        F.when(F.col("value").isNull() | (F.col("value") == ""), F.lit("empty")).otherwise(
            documents.unreadable(F.col("doc").isNotNull(), repaired)
        ),
    )


def _stamp(parsed: DataFrame, stamped: Column) -> DataFrame:
    """Id and times for the rows where `stamped` holds, NULL for the others."""
    row_id = stable_id(F.col("topic"), F.col("partition"), F.col("offset"))
    return parsed.withColumns(
        {
            "uuid": F.when(stamped, row_id),
            "date": F.when(stamped, epoch_millis(F.col("event_ts")).cast("string")),
            "currenttime": F.when(stamped, time_text(F.col("event_ts"))),
        }
    )


def parse_vendor_lines(
    lines: DataFrame, mode: str = "reference", clock: str = "arrival"
) -> DataFrame:
    """Vendor alerts: bracketed records are repaired, and get neither id nor times of their own."""
    value = F.col("value")
    bracketed = text.is_bracketed(value)
    repaired = F.when(bracketed, text.unwrap_brackets(value, mode)).otherwise(value)
    return _stamp(_parse_lines(lines, repaired, clock), ~bracketed)


def parse_metadata_lines(
    lines: DataFrame, mode: str = "reference", clock: str = "arrival"
) -> DataFrame:
    """Traffic metadata: bracketed records repaired, double backslashes cut from the others."""
    value = F.col("value")
    repaired = F.when(text.is_bracketed(value), text.unwrap_brackets(value, mode)).otherwise(
        text.drop_double_backslashes(value)
    )
    return _stamp(_parse_lines(lines, repaired, clock), F.lit(True))


def parse_loose_lines(
    lines: DataFrame,
    mode: str = "reference",
    clock: str = "arrival",
    quote_plain_brackets: bool = True,
) -> DataFrame:
    """Schema-less input: brackets become quotes; in plain records only if asked for."""
    value = F.col("value")
    plain = text.brackets_to_quotes(value) if quote_plain_brackets else value
    repaired = F.when(text.is_bracketed(value), text.unwrap_brackets(value, mode)).otherwise(plain)
    return _stamp(_parse_lines(lines, repaired, clock), F.lit(True))


def usable(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejects(parsed: DataFrame) -> DataFrame:
    """The rows to keep for inspection: where they came from, the raw value and the reason."""
    return parsed.filter(F.col("reject_reason").isNotNull()).select(
        "topic", "partition", "offset", "event_ts", "value", "reject_reason"
    )


def strict(parsed: DataFrame) -> DataFrame:
    """Fail the job on the first bad record instead of setting it aside."""
    where = F.concat_ws(":", "reject_reason", "topic", "partition", "offset")
    checked = F.when(F.col("reject_reason").isNull(), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("bad record "), where)).cast("boolean")
    )
    return parsed.filter(checked).drop("reject_reason")
