from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from eventlake.plans import dead_letter_table, events_table  # noqa: E402
from eventlake.schema import RAW_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("eventlake-tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Build raw records from values, or from (value, partition, offset) triples."""

    def build(values):
        rows = []
        for i, value in enumerate(values):
            value, partition, offset = value if isinstance(value, tuple) else (value, 0, i)
            rows.append((None if value is None else bytearray(value, "utf-8"), partition, offset))
        return spark.createDataFrame(rows, RAW_SCHEMA)

    return build


@pytest.fixture
def events(spark, tmp_path):
    return events_table(spark, str(tmp_path / "events"))


@pytest.fixture
def dead(spark, tmp_path):
    return dead_letter_table(spark, str(tmp_path / "dead"))
