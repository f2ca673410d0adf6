"""Historical CSV: 58 positional text columns, no quoting."""

from pyspark.sql import DataFrame, functions as F

from alarmloom.schemas import BACKFILL_COLUMNS


def split_backfill(lines: DataFrame) -> DataFrame:
    """`fields` plus `reject_reason` for lines with too few of them. Empty fields are kept."""
    return lines.withColumn("fields", F.split("value", ",", -1)).withColumn(
        "reject_reason",
        F.when(F.size("fields") < len(BACKFILL_COLUMNS), F.lit("too_few_fields")),
    )


def backfill_rows(lines: DataFrame) -> DataFrame:
    kept = split_backfill(lines).filter(F.col("reject_reason").isNull())
    return kept.select(
        *[F.col("fields").getItem(i).alias(name) for i, name in enumerate(BACKFILL_COLUMNS)]
    )


def backfill_rejects(lines: DataFrame) -> DataFrame:
    return (
        split_backfill(lines)
        .filter(F.col("reject_reason").isNotNull())
        .select("value", "reject_reason")
    )
