"""Row ids and times.

An id links detail rows to their summary, so it has to survive task retries and re-reads. It is
derived from the position of the record in its source, not drawn at random.
"""

from pyspark.sql import Column, functions as F


def stable_id(*position: Column) -> Column:
    """32 hex digits from the source position, e.g. topic, partition, offset and list index."""
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in position]))


def random_id() -> Column:
    """32 random hex digits. Changes whenever the plan is run again."""
    return F.replace(F.uuid(), F.lit("-"), F.lit(""))


def dashed(hex_id: Column) -> Column:
    """The 8-4-4-4-12 form of a 32-digit id."""
    return F.regexp_replace(hex_id, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def time_text(ts: Column) -> Column:
    """Second resolution, in the session time zone."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def window_second(ts: Column, seconds: int) -> Column:
    """Start of the epoch-aligned tumbling window, in epoch seconds."""
    second = F.unix_seconds(ts)
    return second - F.pmod(second, F.lit(seconds))
