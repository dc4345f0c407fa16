"""Rows, specs and plans that several test modules use."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame

from stratalake.spec import TRIPS

BRONZE_SCHEMA = (
    "VendorID bigint, passenger_count double, total_amount double, "
    "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "source_file string, ingestion_timestamp timestamp"
)
LOADED = datetime(2024, 1, 1, 12)
# Files written by tests are single Parquet files or folders, as each test says.
FOLDERS = replace(TRIPS, lineage_level="folder")


def at(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


def trip(
    vendor=1,
    riders=1.0,
    amount=10.0,
    pickup="2023-03-01 10:00:00",
    dropoff="2023-03-01 10:10:00",
    source="a.parquet",
    loaded=LOADED,
):
    return (vendor, riders, amount, at(pickup), at(dropoff), source, loaded)


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
