"""Merge of repeated alarms: detail rows linked to one summary row per (route, label, window).

The merge key is a label, and there are only about 30 labels, so one key can hold a third of all
rows. Nothing here brings the rows of a key together. The first and last time and the count of a key
are a hash aggregate over fixed-width values, with map-side partials; only the rows at these two
times are looked at again, to decide ties by position. Rows meet the result in a join whose small
side is broadcast if its size is known to be bounded, or whose hot keys are spread over salts.

The rows are read two or three times: hand in a staged table where they are expensive to make.
"""

from pyspark.sql import Column, DataFrame, functions as F

from alarmloom.functions.identity import window_second
from alarmloom.operators.alarms import ARRIVAL

KEYS = ["route", "type_label", "win"]
SALTS = 32
BROADCAST_ROWS = 200_000


def arrival_order() -> Column:
    return F.struct(*ARRIVAL)


def with_window(rows: DataFrame, seconds: int) -> DataFrame:
    """`win`: start of the tumbling window, in epoch seconds."""
    return rows.withColumn("win", window_second(F.col("event_ts"), seconds))


def merge_ends(rows: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Per key: `first_ts`, `last_ts` and `size`, as a hash aggregate of fixed-width values."""
    return rows.groupBy(*keys).agg(
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
        F.count("*").alias("size"),
    )


def meet(
    rows: DataFrame,
    heads: DataFrame,
    max_heads: int | None = None,
    salts: int = SALTS,
    keys: list[str] = KEYS,
    how: str = "inner",
) -> DataFrame:
    """Rows joined with the one row of `heads` that has their key.

    `max_heads` is a number of rows of `heads` that the caller can vouch for: a count of the staged
    heads, or labels x windows. Within BROADCAST_ROWS the heads are broadcast and the rows are not
    moved at all. Otherwise, or without a number, the heads are repeated per salt and the rows of one
    key are spread over `salts` shuffle keys.
    """
    if max_heads is not None and max_heads <= BROADCAST_ROWS:
        return rows.join(F.broadcast(heads), keys, how)
    salt = F.pmod(F.xxhash64("uuid"), F.lit(salts)).cast("int")
    spread = heads.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("salt", salt).join(spread, [*keys, "salt"], how).drop("salt")


def _at_ends(rows, ends, max_heads, salts, keys):
    """The rows at the first or last time of their key: few, unless many share that time."""
    ends = merge_ends(rows, keys) if ends is None else ends
    at = F.col("event_ts")
    met = meet(rows, ends, max_heads, salts, keys)
    return met.filter((at == F.col("first_ts")) | (at == F.col("last_ts")))


def merge_heads(
    rows: DataFrame,
    keys: list[str] = KEYS,
    ends: DataFrame | None = None,
    max_heads: int | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Per key: `pid` (id of the first row), `last_date` (date of the last row) and `size`.

    `ends`: staged result of `merge_ends`, if the caller has it.
    """
    narrow = rows.select(*keys, *ARRIVAL, "date")
    return _at_ends(narrow, ends, max_heads, salts, keys).groupBy(*keys).agg(
        F.min_by("uuid", arrival_order()).alias("pid"),
        F.max_by("date", arrival_order()).alias("last_date"),
        F.max("size").alias("size"),
    )


def merge_summaries(
    rows: DataFrame,
    keys: list[str] = KEYS,
    ends: DataFrame | None = None,
    max_heads: int | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """The first row of every key with the last row's date, the row count, and its own id as pid."""
    payload = [c for c in rows.columns if c not in keys]
    merged = _at_ends(rows, ends, max_heads, salts, keys).groupBy(*keys).agg(
        F.min_by(F.struct(*payload), arrival_order()).alias("first"),
        F.max_by("date", arrival_order()).alias("last_date"),
        F.max("size").alias("size"),
    )
    columns = [
        F.col("last_date").alias("date") if name == "date" else F.col(f"first.{name}")
        for name in payload
    ]
    return merged.select(*keys, *columns, F.col("first.uuid").alias("pid"), "size")


def attach_pid(
    rows: DataFrame,
    heads: DataFrame,
    max_heads: int | None = None,
    salts: int = SALTS,
    keys: list[str] = KEYS,
) -> DataFrame:
    """Detail rows with the `pid` of their summary."""
    return meet(rows, heads.select(*keys, "pid"), max_heads, salts, keys)


def merge_details(
    rows: DataFrame,
    max_heads: int | None = None,
    salts: int = SALTS,
    ends: DataFrame | None = None,
) -> DataFrame:
    """All rows of the merged routes, each with its `pid`."""
    heads = merge_heads(rows, ends=ends, max_heads=max_heads, salts=salts)
    return attach_pid(rows, heads, max_heads, salts)


def window_sizes(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """How strongly each window length merges: groups, rows and the largest group."""
    per_size = rows.select(
        "event_ts", "route", "type_label", F.explode(F.array(*map(F.lit, sizes))).alias("seconds")
    )
    second = F.unix_seconds("event_ts")
    groups = (
        per_size.withColumn("win", second - F.pmod(second, F.col("seconds")))
        .groupBy("seconds", *KEYS)
        .count()
    )
    return groups.groupBy("seconds").agg(
        F.count("*").alias("summaries"),
        F.sum("count").alias("details"),
        F.max("count").alias("largest"),
    )
