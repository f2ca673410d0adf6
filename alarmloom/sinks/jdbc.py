"""JDBC tables. All columns are text, as in the target store; values are bound, never concatenated."""

from pyspark.sql import DataFrame, functions as F, types as T

BATCH_COLUMN = "batch_id"


def jdbc_options(
    url: str,
    table: str,
    driver: str,
    user: str | None = None,
    password: str | None = None,
    batch_rows: int = 1000,
    connections: int = 16,
) -> dict[str, str]:
    """Writer options: rows per statement batch, and how many tasks may hold a connection."""
    options = {
        "url": url,
        "dbtable": table,
        "driver": driver,
        "batchsize": str(batch_rows),
        "numPartitions": str(connections),
        "isolationLevel": "READ_COMMITTED",
    }
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    return options


def as_text_columns(rows: DataFrame) -> DataFrame:
    """Every column as text; maps and other nested values as JSON."""

    def text(field):
        nested = isinstance(field.dataType, (T.MapType, T.ArrayType, T.StructType, T.VariantType))
        column = F.col(f"`{field.name}`")
        return (F.to_json(column) if nested else column.cast("string")).alias(field.name)

    return rows.select(*[text(f) for f in rows.schema.fields])


def append(rows: DataFrame, options: dict[str, str]) -> None:
    as_text_columns(rows).write.format("jdbc").options(**options).mode("append").save()


def append_batch(rows: DataFrame, options: dict[str, str], batch_id: int, key: str) -> None:
    """Append the rows of a batch that the table does not have yet.

    Tasks commit on their own, so a failed batch may have left some of its rows behind. A repeated
    batch reads back the keys stored under its number and writes only the missing rows.
    """
    query = f"SELECT {key} FROM {options['dbtable']} WHERE {BATCH_COLUMN} = '{int(batch_id)}'"
    source = {k: v for k, v in options.items() if k not in ("dbtable", "numPartitions")}
    stored = rows.sparkSession.read.format("jdbc").options(**source).option("query", query).load()
    stored = stored.toDF(key)
    missing = rows.join(stored, key, "left_anti")
    append(missing.withColumn(BATCH_COLUMN, F.lit(str(int(batch_id)))), options)
