from __future__ import annotations

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stratalake.functions.times import hour_bucket, moment, month_bucket
from stratalake.plans.sizing import SETTING, reducers_for, shuffle_sized_for
from stratalake.spec import TRIPS

GIB = 1 << 30


@pytest.mark.parametrize(
    ("text", "month", "hour"),
    [
        ("2023-05-01 00:00:00", "2023-05", 0),
        ("2023-05-31 23:59:59.999999", "2023-05", 23),
        ("2023-03-12 02:30:00", "2023-03", 2),  # this hour does not exist in New York
        ("0987-12-01 05:00:00", "0987-12", 5),
    ],
)
def test_buckets_ignore_the_session_zone(spark, text, month, hour):
    when = moment(text)
    row = spark.range(1).select(month_bucket(when).alias("m"), hour_bucket(when).alias("h")).first()
    assert (row.m, row.h) == (month, hour)


def test_literals_ignore_the_session_zone(spark):
    (row,) = spark.range(1).select(moment("2024-01-05").alias("t")).collect()
    assert row.t == datetime(2024, 1, 5)


def test_rounding_is_half_up(spark):
    row = spark.range(1).select(F.round(F.lit(0.125), 2).alias("x")).first()
    assert row.x == 0.13


@pytest.mark.parametrize(
    ("size", "current", "expected"),
    [(0, 8, 8), (GIB, 8, 8), (18 * GIB + 1, 8, 10), (100 << 40, 200, 51_200)],
)
def test_reducers_follow_the_input(size, current, expected):
    assert reducers_for(size, current) == expected


def test_shuffle_setting_is_restored(spark):
    with shuffle_sized_for(spark, 40 * GIB) as wanted:
        assert (wanted, spark.conf.get(SETTING)) == (20, "20")
    assert spark.conf.get(SETTING) == "8"
    with pytest.raises(RuntimeError), shuffle_sized_for(spark, 40 * GIB):
        raise RuntimeError
    assert spark.conf.get(SETTING) == "8"


def test_spec_refuses_unknown_columns():
    with pytest.raises(ValueError, match="not among the required columns: fare"):
        replace(TRIPS, amount="fare")
    with pytest.raises(ValueError, match="lineage_level"):
        replace(TRIPS, lineage_level="row")


def test_trips_spec():
    assert [TRIPS.landing_name(period) for period in TRIPS.periods][0] == (
        "yellow_tripdata_2023-01.parquet"
    )
    assert TRIPS.tie_break == ("source_file", "passenger_count", "ingestion_timestamp")
    assert set(TRIPS.key) == {
        "VendorID",
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "total_amount",
    }


def test_months_keep_long_years(spark):
    frame = spark.sql("SELECT TIMESTAMP_NTZ '2024-05-03' AS t UNION ALL SELECT make_timestamp_ntz(12023, 5, 1, 0, 0, 0) UNION ALL SELECT make_timestamp_ntz(33, 1, 1, 0, 0, 0)")
    found = {row[0] for row in frame.select(month_bucket(F.col("t"))).collect()}
    assert found == {"2024-05", "12023-05", "0033-01"}
