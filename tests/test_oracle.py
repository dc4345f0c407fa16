"""Every query against its SQL on the same tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as contract
from checks.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("events", "lineitem")
# DuckDB type per Spark type.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return str(value)


def rows_by_column(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(comparable(row[at]) for at in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    answer = duck.execute(contract.oracle_sql()[name])
    names = [column[0] for column in answer.description]
    kinds = {column[0]: str(column[1]) for column in answer.description}
    assert {column: TYPES[kind] for column, kind in df.dtypes} == kinds
    assert rows_by_column(df.columns, df.collect()) == rows_by_column(names, answer.fetchall())


SETTINGS = {
    "spark.sql.ansi.enabled": "false",
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.session.timeZone": "Asia/Tokyo",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


@pytest.mark.parametrize(
    "name",
    [
        "landing_ingest",
        "silver_dedup",
        "q2_sql",
        "medallion_month_answer",
        "medallion_subset_rerun",
        "hourly_value_events",
        "drift_text_conformed",
    ],
)
def test_answers_do_not_depend_on_session_settings(spark, duck, name):
    before = {key: spark.conf.get(key) for key in SETTINGS}
    try:
        for key, value in SETTINGS.items():
            spark.conf.set(key, value)
        test_query_equals_oracle(spark, duck, name)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_entry_is_the_month_answer(spark):
    assert [row.pickup_month for row in contract.entry(spark).collect()] == [
        "2024-01",
        "2024-02",
        "2024-03",
        "2024-04",
        "2024-05",
    ]
