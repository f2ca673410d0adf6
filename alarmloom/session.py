"""Session settings and the shared folder for checkpoints and staged tables."""

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Settings the results depend on: UTC times, and the last of repeated JSON keys wins."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Without the setting a temporary folder is used, but only by a local session, where driver and
    executors are one process.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="alarmloom-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return os.path.join(shared_folder(spark), "alarmloom", f"{name}-{uuid.uuid4().hex}")


# Lists of the paths that `stage` writes, one per open `scratch`.
_scratches: list[list[str]] = []


def stage(rows: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write the rows once to the shared folder and read them back.

    Used where several later steps need the same expensive rows: it cuts the lineage, survives lost
    executors, and lets each step read only its own columns, and with `by` only its own folders.
    """
    path = new_folder(rows.sparkSession, name)
    if _scratches:
        _scratches[-1].append(path)
    return _written(rows, path, by)


def _deleted(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """Deletes at its end all tables that `stage` has written in it, and yields a `stage` whose tables
    stay: for a step that makes many tables on the way to its result."""
    _scratches.append([])

    def kept(rows: DataFrame, name: str, by: str | None = None) -> DataFrame:
        return _written(rows, new_folder(spark, name), by)

    try:
        yield kept
    finally:
        _deleted(spark, _scratches.pop())


def _written(rows: DataFrame, path: str, by: str | None) -> DataFrame:
    spark = rows.sparkSession
    writer = rows.write if by is None else rows.write.partitionBy(by)
    writer.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """`stage` for one job: the tables it writes are deleted when the job ends, failed or not.

    Nothing that reads them may leave the block unwritten.
    """
    paths = []

    def stage_here(rows: DataFrame, name: str, by: str | None = None) -> DataFrame:
        paths.append(new_folder(spark, name))
        return _written(rows, paths[-1], by)

    try:
        yield stage_here
    finally:
        _deleted(spark, paths)
