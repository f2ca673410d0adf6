"""Starting queries: triggers, checkpoints, the classified table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from alarmloom.sinks import commits
from alarmloom.sinks.commits import table_writer  # noqa: F401
from alarmloom.streaming.merge import SPAN, span_of

# A buffered sink flushes after this many rows or seconds.
FLUSH_ROWS = 1000
FLUSH_SECONDS = 8

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep state off the heap, with changelog checkpoints; for windows with many labels."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def _trigger(seconds: int | None) -> dict:
    return {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}


def start(
    rows: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    seconds: int | None = FLUSH_SECONDS,
) -> StreamingQuery:
    """Run `write` on every micro-batch. With `seconds=None` the input at hand is read and the
    query stops; this is also how a backlog is worked off."""
    writer = (
        rows.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return writer.trigger(**_trigger(seconds)).start()


def file_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    format: str,
    seconds: int | None,
    by: tuple[str, ...] = (),
):
    """Files through Spark's own file sink, which commits each batch exactly once: its log names the
    files of finished batches, and readers of the folder, streams too, go by that log."""
    writer = rows.writeStream.format(format).option("checkpointLocation", checkpoint)
    if by:
        writer = writer.partitionBy(*by)
    return writer.option("path", path).trigger(**_trigger(seconds)).start()


PLACED = ("route", "span")


def _placed(rows: DataFrame, span: int) -> DataFrame:
    """Columns as the table has them: its partition columns come last."""
    placed = rows.withColumn("span", span_of(F.unix_seconds("event_ts"), span))
    return placed.select(*[c for c in placed.columns if c not in PLACED], *PLACED)


def classified_stream(
    rows: DataFrame, path: str, checkpoint: str, seconds: int | None, span: int = SPAN
) -> StreamingQuery:
    """Classified alarms and rejects into one table by route and span of time: the one reader of the
    topic."""
    return file_stream(_placed(rows, span), path, checkpoint, "parquet", seconds, PLACED)


def classified_schema(rows: DataFrame) -> StructType:
    return _placed(rows, SPAN).schema


def read_classified(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def stream_classified(
    spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int | None = None
) -> DataFrame:
    commits.make_folder(spark, path)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
