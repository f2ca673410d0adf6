"""One row per nested alarm, with a stable id, times and the alarm's codes."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from alarmloom.functions import documents
from alarmloom.functions.identity import epoch_millis, stable_id, time_text
from alarmloom.schemas import (
    ALARM_LIST_KEY,
    DISPOSE_KEY,
    HEADER_KEYS,
    MODULE_KEY,
    TRAILER_KEYS,
    TYPE_KEY,
)

# Arrival order of alarms. Messages of one batch may share a time stamp, so the position in the
# source breaks the tie; the whole tuple is unique.
ARRIVAL = ["event_ts", "partition", "offset", "pos", "uuid"]


@dataclass(frozen=True)
class Generation:
    """What differs between the three generations of the alarm job."""

    number: int
    window_seconds: int
    event_level: str | None
    transformation_table: str
    camouflage_table: str | None
    warning_table: str
    has_currenttime: bool = True


# Window lengths and table names.
GENERATIONS = {
    0: Generation(0, 20, None, "bus_twarning_local", None, "bus_warning_local", False),
    1: Generation(1, 20, None, "bus_twarning", "bus_cwarning", "bus_warning"),
    2: Generation(2, 120, "0", "bus_twarning", "bus_cwarning", "bus_warning"),
}


def explode_alarms(
    parsed: DataFrame, generation: int = 2, keep_rejects: bool = False
) -> DataFrame:
    """Repeat the message header for each nested alarm; an empty or missing list gives no row.

    Header fields are read before the explode, so that no alarm carries its whole message along.
    With `keep_rejects` a rejected message stays as one row with its reason and raw `value`, so that
    a job can store alarms and rejects from a single pass over its input.
    """
    keys = HEADER_KEYS + TRAILER_KEYS + [DISPOSE_KEY]
    source = ["topic", "partition", "offset", "event_ts"]
    kept = ["value", "reject_reason"] if keep_rejects else []
    found = parsed.select(
        *source, *kept, documents.members(F.col("doc"), keys, [ALARM_LIST_KEY]).alias("m")
    )
    header = found.select(
        *source,
        *[F.col(name).alias(f"message_{name}") for name in kept],
        *[documents.value_text(F.col(f"m.{key}")).alias(key) for key in keys],
        F.col(f"m.{ALARM_LIST_KEY}").alias("alarms"),
    )
    carried = [*source, *[f"message_{name}" for name in kept], *keys]
    # The outer form with a filter after it: for the plain form Spark infers a filter on the list
    # below the generator, and so walks every message twice.
    alarms = header.select(*carried, F.posexplode_outer("alarms").alias("pos", "alarm"))
    missing = F.when(
        ~(
            documents.has_value(F.col("alarm"), MODULE_KEY)
            & documents.has_value(F.col("alarm"), TYPE_KEY)
        ),
        F.lit("missing_code"),
    )
    if keep_rejects:
        bad_message = F.col("message_reject_reason").isNotNull()
        alarms = alarms.filter(bad_message | F.col("pos").isNotNull()).withColumns(
            {
                "reject_reason": F.coalesce(F.col("message_reject_reason"), missing),
                "value": F.when(bad_message, F.col("message_value")).when(
                    missing.isNotNull(), F.to_json("alarm")
                ),
            }
        ).drop("message_reject_reason", "message_value")
    else:
        alarms = alarms.filter(F.col("pos").isNotNull()).withColumn("reject_reason", missing)
    level = GENERATIONS[generation].event_level
    return alarms.withColumns(
        {
            "uuid": stable_id(F.col("topic"), F.col("partition"), F.col("offset"), F.col("pos")),
            "date": epoch_millis(F.col("event_ts")).cast("string"),
            "currenttime": time_text(F.col("event_ts")),
            "event_level": F.lit(level).cast("string"),
        }
    )


def usable_alarms(alarms: DataFrame) -> DataFrame:
    return alarms.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def with_codes(alarms: DataFrame) -> DataFrame:
    """`module_code` and `type_code`: set only where the document holds a JSON integer."""
    return alarms.withColumns(
        {
            "module_code": documents.integer_code(F.col("alarm"), MODULE_KEY),
            "type_code": documents.integer_code(F.col("alarm"), TYPE_KEY),
        }
    )
