"""Silver to gold: the fact table and its two aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.times import hour_bucket, month_bucket
from stratalake.spec import DatasetSpec


def fact_columns(spec: DatasetSpec) -> tuple[str, ...]:
    return (*spec.required, spec.month_column, spec.hour_column)


def fact(silver: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Required columns plus month and hour of the start; lineage stays behind."""
    begin = F.col(spec.starts)
    return silver.select(
        *spec.required,
        month_bucket(begin).alias(spec.month_column),
        hour_bucket(begin).alias(spec.hour_column),
    )


def average_by(
    df: DataFrame, group: str | Column, value: str, digits: int, average: str, count: str
) -> DataFrame:
    """Rounded mean and row count per group, sorted by group."""
    return (
        df.groupBy(group)
        .agg(
            F.round(F.avg(value), digits).alias(average),
            F.count(F.lit(1)).alias(count),
        )
        .orderBy(group)
    )


def month_mart(fact: DataFrame, spec: DatasetSpec) -> DataFrame:
    return average_by(fact, spec.month_column, spec.amount, 2, f"avg_{spec.amount}", "trips")


def hour_mart(fact: DataFrame, spec: DatasetSpec, month: str | None = None) -> DataFrame:
    """Mean of the recorded counts per hour in one month.

    On the stored fact the month is a partition column, so one month is read.
    """
    in_month = F.col(spec.month_column) == (month or spec.mart_month)
    recorded = F.col(spec.counted) > 0
    return average_by(
        fact.filter(in_month & recorded),
        spec.hour_column,
        spec.counted,
        3,
        f"avg_{spec.counted}",
        "trips",
    )
