from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


@pytest.fixture
def messages(spark):
    """Message values (str, bytes or None) as a frame with Kafka columns, in offset order."""

    def build(*values, first_offset=0, partition=0):
        rows = [
            (v.encode() if isinstance(v, str) else v, "users", partition, first_offset + i)
            for i, v in enumerate(values)
        ]
        return spark.createDataFrame(
            rows, "value BINARY, topic STRING, partition INT, offset BIGINT"
        )

    return build
