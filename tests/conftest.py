"""Session of all tests."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from helpers import BRONZE_SCHEMA  # noqa: E402


def pytest_collection_modifyitems(items):
    """Spark keeps the plans of its last 1000 queries, so what counts the plans of a run goes first."""
    items.sort(key=lambda item: "done" not in getattr(item, "fixturenames", ()))


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    """A session far from UTC, so anything that reads its zone shows."""
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.sql.warehouse.dir", str(warehouse))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def bronze_of(spark):
    def build(*rows) -> DataFrame:
        return spark.createDataFrame(list(rows), BRONZE_SCHEMA)

    return build
