"""Trips-shaped table derived from ``events``, and the spec that describes it.

The remainders only vary the values. Every event becomes a trip, and some become
two.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.typed import wall_clock
from stratalake.spec import TRIPS

TRIPS_2024 = replace(
    TRIPS,
    landing_file="trips_{period}.parquet",
    periods=("int", "extra", "whole"),
    lower="2024-01-01",
    upper="2024-06-01",
    mart_month="2024-05",
    lineage_level="folder",
)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _every(step: int) -> Column:
    return F.col("event_id") % step == 0


def _days(count: Column) -> Column:
    return F.make_dt_interval(count.cast("int"))


def _minutes(count: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), count.cast("int"))


def events_as_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with the columns of their event beside them, in one scan."""
    events = load(spark, sf_dir, "events")
    number = F.col("event_id")
    riders = F.when(~_every(37), F.when(_every(53), 0).otherwise(1 + F.col("user_id") % 5))
    value = F.col("value")
    amount = F.when(_every(113), -value).when(~_every(211), value)
    pickup = wall_clock(events, "ts") + _days(31 * (number % 6))
    ride = F.when(_every(97), F.lit(0)).otherwise(1 + number % 45)
    second = F.col("copy") == 1
    part = F.concat(F.lit("trips_"), (number % 6).cast("string"), F.lit(".parquet"))
    # Copies 0 and, for some events, 1.
    copies = F.explode(F.sequence(F.lit(0), F.when(_every(101), 1).otherwise(0)))
    return (
        events.select("*", copies.alias("copy"))
        .withColumns(
            {
                "VendorID": 1 + F.col("user_id") % 2,
                "passenger_count": (riders + F.col("copy")).cast("double"),
                "total_amount": amount,
                "tpep_pickup_datetime": pickup,
                "tpep_dropoff_datetime": pickup + _minutes(ride),
                "source_file": F.when(second, "trips_dup.parquet").otherwise(part),
                "ingestion_timestamp": F.current_timestamp(),
            }
        )
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze table of the fixture."""
    return events_as_trips(spark, sf_dir).select(
        *TRIPS_2024.required, "source_file", "ingestion_timestamp"
    )


# The same table for the SQL oracle; all its queries start from here.
TRIPS_SQL = """
WITH base AS (
    SELECT event_id,
           1 + user_id % 2 AS VendorID,
           CASE WHEN event_id % 37 = 0 THEN NULL
                WHEN event_id % 53 = 0 THEN CAST(0 AS DOUBLE)
                ELSE CAST(1 + user_id % 5 AS DOUBLE) END AS passenger_count,
           CASE WHEN event_id % 113 = 0 THEN -value
                WHEN event_id % 211 = 0 THEN NULL
                ELSE value END AS total_amount,
           ts + to_days(CAST(31 * (event_id % 6) AS INTEGER)) AS tpep_pickup_datetime,
           ts + to_days(CAST(31 * (event_id % 6) AS INTEGER))
              + to_minutes(CAST(CASE WHEN event_id % 97 = 0 THEN 0
                                     ELSE 1 + event_id % 45 END AS BIGINT))
              AS tpep_dropoff_datetime,
           'trips_' || CAST(event_id % 6 AS VARCHAR) || '.parquet' AS source_file,
           event_type
    FROM events
),
bronze AS (
    SELECT * FROM base
    UNION ALL
    SELECT event_id, VendorID, passenger_count + 1, total_amount, tpep_pickup_datetime,
           tpep_dropoff_datetime, 'trips_dup.parquet', event_type
    FROM base WHERE event_id % 101 = 0
)"""

CLEAN_SQL = (
    TRIPS_SQL
    + """,
clean AS (
    SELECT * FROM bronze
    WHERE total_amount >= 0
      AND tpep_pickup_datetime < tpep_dropoff_datetime
      AND tpep_pickup_datetime >= TIMESTAMP '2024-01-01'
      AND tpep_pickup_datetime < TIMESTAMP '2024-06-01'
)"""
)

SILVER_SQL = (
    CLEAN_SQL
    + """,
conformed AS (
    SELECT CAST(VendorID AS INTEGER) AS VendorID,
           CAST(trunc(passenger_count) AS INTEGER) AS passenger_count,
           CAST(total_amount AS DOUBLE) AS total_amount,
           tpep_pickup_datetime, tpep_dropoff_datetime, source_file
    FROM clean
),
ranked AS (
    SELECT *, row_number() OVER (
               PARTITION BY VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, total_amount
               ORDER BY source_file NULLS LAST, passenger_count NULLS LAST) AS rn
    FROM conformed
),
silver AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1),
fact AS (
    SELECT * EXCLUDE (source_file),
           strftime(tpep_pickup_datetime, '%Y-%m') AS pickup_month,
           CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour
    FROM silver
)"""
)
