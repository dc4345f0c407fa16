"""SQL over the layers: free queries and the two standing questions on trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratalake.sources.lake import FACT_VIEW
from stratalake.spec import TRIPS

DISPLAY_ROWS = 50


def run_query(spark: SparkSession, sql: str, limit: int | None = None) -> DataFrame:
    """Any statement Spark accepts, over whatever views are registered.

    ``limit`` is for display (``DISPLAY_ROWS`` is customary); None returns all rows.
    """
    result = spark.sql(sql)
    return result if limit is None else result.limit(limit)


def month_answer(spark: SparkSession, view: str = FACT_VIEW) -> DataFrame:
    """What did an average trip cost in each month?"""
    return spark.sql(
        """
        SELECT pickup_month,
               round(avg(total_amount), 2) AS avg_total_amount_per_trip,
               count(*) AS trips,
               round(sum(total_amount), 2) AS total_revenue
        FROM identifier(:view)
        GROUP BY pickup_month
        ORDER BY pickup_month
        """,
        args={"view": view},
    )


def hour_answer(
    spark: SparkSession, view: str = FACT_VIEW, month: str = TRIPS.mart_month
) -> DataFrame:
    """How many passengers rode together in each hour of the day, in one month?"""
    return spark.sql(
        """
        SELECT pickup_hour,
               round(avg(passenger_count), 3) AS avg_passenger_count,
               count(*) AS trips
        FROM identifier(:view)
        WHERE passenger_count > 0 AND pickup_month = :month
        GROUP BY pickup_hour
        ORDER BY pickup_hour
        """,
        args={"view": view, "month": month},
    )
