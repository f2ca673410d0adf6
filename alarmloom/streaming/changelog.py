"""Changing counts as a changelog: each batch retracts the old value of a key and adds the new one.

An update-mode query tells the new values of the keys that changed. The writer looks up what the log
said before and writes both rows, `added` false for the old and true for the new one, so that a reader
who adds and takes away has the current counts at any batch. Every few batches the same commit also
holds a snapshot, the current count of every key; look-ups and `latest_counts` start from the last one
and read only the changes after it.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from alarmloom.session import staging
from alarmloom.sinks import commits
from alarmloom.sinks.tables import read_table

SNAPSHOT_EVERY = 100


def snapshot_table(table: str) -> str:
    return f"{table}_snapshot"


def latest_counts(
    spark: SparkSession, root: str, table: str, key: str, value: str = "n"
) -> DataFrame:
    """The current value per key, of a changelog or of a table written in update mode."""
    start = commits.last_batch(spark, root, snapshot_table(table))
    if start is None:
        rows = read_table(spark, root, table)
    else:
        rows = commits.read_committed(spark, root, table, after=start)
    if "added" in rows.columns:
        rows = rows.filter("added")
    rows = rows.select(key, value, "batch_id")
    if start is not None:
        known = commits.read_committed(spark, root, snapshot_table(table), after=start - 1)
        rows = rows.unionByName(known.select(key, value, "batch_id"))
    return rows.groupBy(key).agg(F.max_by(value, "batch_id").alias(value))


def folded(spark: SparkSession, root: str, table: str, key: str, value: str = "n") -> DataFrame:
    """The whole changelog added up: the value of each key, and additions less retractions."""
    rows = read_table(spark, root, table)
    sign = F.when(F.col("added"), 1).otherwise(-1).cast("long")
    return rows.groupBy(key).agg(
        F.sum(sign * F.col(value)).alias(value), F.sum(sign).alias("balance")
    )


def change_writer(
    root: str, table: str, key: str, value: str = "n", snapshot_every: int = SNAPSHOT_EVERY
) -> Callable[[DataFrame, int], None]:
    """Writes the batches of an update-mode query as changelog; a repeated batch adds nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if commits.is_committed(spark, root, batch_id):
            return
        with staging(spark) as stage:
            new = stage(batch.select(key, value), "changed")
            added = new.withColumn("added", F.lit(True))
            if not commits.has_table(spark, root, table):
                tables, now = {table: added}, new
            else:
                before = latest_counts(spark, root, table, key, value)
                same = before[key].eqNullSafe(new[key])
                old = before.join(new.select(key), same, "left_semi")
                tables = {table: added.unionByName(old.withColumn("added", F.lit(False)))}
                now = before.join(new.select(key), same, "left_anti").unionByName(new)
            if (batch_id + 1) % snapshot_every == 0:
                tables[snapshot_table(table)] = now
            commits.write_tables(spark, root, batch_id, tables)

    return write
