"""The merge on a stream: windows close by the watermark, their rows come from the classified table.

Rows are stored once, classified, by Spark's file sink (`streaming.queries.classified_stream`). The
merge reads that table as a stream and keeps nothing but a count per open window and label: state of
fixed width, with partial aggregation, however many rows a window has. When windows close, their rows
are read from the table, which is partitioned by route and span of time, and merged as in a batch job.

A row that comes later than the watermark allows is stored all the same. `late_groups` finds the
closed windows that have more rows than were merged; `plans.jobs.reconcile_merged` merges them anew.
"""

from pyspark.sql import Column, DataFrame, functions as F

from alarmloom.functions.identity import window_second
from alarmloom.operators.merge import KEYS

# Seconds of event time that a folder of the classified table holds.
SPAN = 3600


def span_of(seconds: Column, span: int = SPAN) -> Column:
    return F.floor(seconds / span).cast("long")


def closed_windows(rows: DataFrame, seconds: int, delay: str = "0 seconds") -> DataFrame:
    """Route, label, window start and row count of windows as they close; a stream for append mode.

    `delay` is how far behind the newest row a row may come and still be counted.
    """
    closed = (
        rows.withWatermark("event_ts", delay)
        .groupBy(F.window("event_ts", f"{seconds} seconds"), "route", "type_label")
        .agg(F.count("*").alias("size"))
    )
    return closed.select(
        "route", "type_label", F.unix_seconds(F.col("window.start")).alias("win"), "size"
    )


def rows_of_windows(
    classified: DataFrame, seconds: int, first: int | None, last: int | None, span: int = SPAN
) -> DataFrame:
    """The classified rows with `win`, of windows that start from `first` to `last`; only the spans
    that these can touch are read."""
    if first is not None:
        classified = classified.filter(F.col("span") >= first // span)
    if last is not None:
        classified = classified.filter(F.col("span") <= (last + seconds - 1) // span)
    rows = classified.withColumn("win", window_second(F.col("event_ts"), seconds))
    if first is not None:
        rows = rows.filter(F.col("win") >= first)
    if last is not None:
        rows = rows.filter(F.col("win") <= last)
    return rows


def late_groups(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Keys of groups whose number of stored rows is not the one they were last merged with.

    `rows`: stored rows of closed windows; `heads`: route, label, window, size of what was merged.
    """
    stored = rows.groupBy(*KEYS).agg(F.count("*").alias("size"))
    return stored.join(heads.select(*KEYS, "size"), [*KEYS, "size"], "left_anti").select(*KEYS)


HEARTBEAT = "heartbeat"


def with_heartbeat(rows: DataFrame) -> DataFrame:
    """Add one row per second under the route `heartbeat`, stamped with the time of the batch.

    Processing-time windows close when their time is over, whether or not another alarm comes. A
    watermark needs rows to move on; these are the rows. Writers take the merged routes only. They
    must do so after the query, in the batch: a filter before would be pushed below the watermark.
    """
    ticks = rows.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    values = {
        "event_ts": F.current_timestamp(),
        "route": F.lit(HEARTBEAT),
        "type_label": F.lit(HEARTBEAT),
    }
    return rows.unionByName(
        ticks.select(
            *[
                values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                for f in rows.schema.fields
            ]
        )
    )
