"""Parquet tables written per batch, and lines of text.

`write_batch` gives a batch the folder `batch_id=<n>` of its table and overwrites it, so a batch that
is run again after a failure replaces its rows instead of adding them a second time. Jobs that write
several tables use `sinks.commits`, where all tables of a batch become visible together.
"""

from pyspark.sql import DataFrame, SparkSession

from alarmloom.sinks import commits


def write_batch(rows: DataFrame, root: str, table: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{root}/{table}/batch_id={batch_id}")


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table with its `batch_id`; under a root with commits only what is committed."""
    if commits.uses_commits(spark, root):
        return commits.read_committed(spark, root, table)
    return spark.read.option("basePath", f"{root}/{table}").parquet(f"{root}/{table}")


def write_lines(lines: DataFrame, path: str, files: int | None = None) -> None:
    """Text lines; `files` sets how many files the output has (order is not kept)."""
    spread = lines.select("value")
    if files is not None:
        spread = spread.repartition(files)
    spread.write.mode("errorifexists").option("lineSep", "\n").text(path)
