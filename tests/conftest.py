import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from alarmloom.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture()
def messages(spark):
    """Builds a frame with the Kafka layout from (partition, offset, seconds, text) rows."""
    from datetime import datetime, timezone

    from alarmloom.schemas import MESSAGE_SCHEMA

    def build(rows, topic="da_warning"):
        data = [
            (
                None,
                bytearray(text if isinstance(text, bytes) else text.encode())
                if text is not None
                else None,
                topic,
                partition,
                offset,
                datetime.fromtimestamp(second, timezone.utc),
            )
            for partition, offset, second, text in rows
        ]
        return spark.createDataFrame(data, MESSAGE_SCHEMA)

    return build
