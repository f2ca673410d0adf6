"""Text files and directories as lines, in batch or as a stream."""

from pyspark.sql import DataFrame, SparkSession


def text_lines(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    return (
        spark.read.option("recursiveFileLookup", recursive).option("lineSep", "\n").text(path)
    )


def text_line_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.option("lineSep", "\n")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def message_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Recorded messages (Parquet, Kafka column layout) replayed as a stream."""
    from alarmloom.schemas import MESSAGE_SCHEMA

    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
