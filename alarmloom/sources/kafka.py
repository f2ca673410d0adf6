"""Topics as streams of text or bytes.

The connector jar is not part of a plain PySpark install; a cluster adds
`org.apache.spark:spark-sql-kafka-0-10` with `--packages`.
"""

import json

from pyspark.sql import DataFrame, SparkSession, functions as F


def kafka_options(
    servers: str,
    topic: str,
    start="latest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    min_offsets_per_trigger: int | None = None,
    max_trigger_delay: int | None = None,
) -> dict[str, str]:
    """Reader options. `start` is `latest`, `earliest`, `group` or {topic: {partition: offset}}.

    `group` means "where the last run stopped". In Structured Streaming that position lives in the
    query checkpoint, which wins over `startingOffsets` on every restart, so only the very first
    run needs a value: latest.

    Flush by size or time: a batch starts once `min_offsets_per_trigger` records wait or
    `max_trigger_delay` seconds have passed, and takes at most `max_offsets_per_trigger` records.
    """
    if isinstance(start, dict):
        offsets = json.dumps(
            {t: {str(p): int(o) for p, o in parts.items()} for t, parts in start.items()}
        )
    elif start in ("latest", "group"):
        offsets = "latest"
    elif start == "earliest":
        offsets = "earliest"
    else:
        raise ValueError(f"unknown start position: {start}")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": offsets,
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if min_offsets_per_trigger is not None:
        options["minOffsetsPerTrigger"] = str(min_offsets_per_trigger)
    if max_trigger_delay is not None:
        options["maxTriggerDelay"] = f"{max_trigger_delay}s"
    return options


def topic_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def topic_batch(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The same topic as a bounded table; a batch read starts at `earliest` unless told otherwise."""
    if options.get("startingOffsets") == "latest":
        options = {**options, "startingOffsets": "earliest"}
    return spark.read.format("kafka").options(**options).load()


def text_values(messages: DataFrame, null_as_empty: bool = False) -> DataFrame:
    """`value` as UTF-8 text; with `null_as_empty` a record without a value becomes ''."""
    text = F.col("value").cast("string")
    return messages.withColumn("value", F.coalesce(text, F.lit("")) if null_as_empty else text)


def byte_values(messages: DataFrame) -> DataFrame:
    """`value` kept as BINARY."""
    return messages.withColumn("value", F.col("value").cast("binary"))
