"""Figures of the derived trips table that were worked out before the library existed."""

from __future__ import annotations

import pytest

from checks.registry import QUERIES
from checks.trips_fixture import TRIPS_2024, trips
from stratalake.operators import reports

ROOT = "/root/testdata/"
REASONS = {
    "sf0.001": (10, 10, 174, 4, 7, 805),
    "sf0.01": (90, 104, 1761, 38, 81, 8026),
    "sf0.1": (894, 1031, 17616, 385, 796, 80269),
}
DISCARDS = {
    "sf0.001": (1010, 10, 12, 178, 7, 805),
    "sf0.01": (10100, 90, 106, 1796, 81, 8026),
    "sf0.1": (100991, 894, 1042, 17958, 796, 80269),
}
MONTHS = {
    "sf0.01": [
        ("2024-01", 49.96, 1628, 81338.15),
        ("2024-02", 52.27, 1573, 82213.16),
        ("2024-03", 48.87, 1627, 79516.24),
        ("2024-04", 50.99, 1571, 80103.60),
        ("2024-05", 47.80, 1627, 77763.97),
    ],
    "sf0.1": [
        ("2024-01", 49.95, 16271, 812679.08),
        ("2024-02", 49.94, 15723, 785131.68),
        ("2024-03", 49.92, 16273, 812378.16),
        ("2024-04", 49.75, 15728, 782528.99),
        ("2024-05", 49.96, 16274, 812968.97),
    ],
}


@pytest.mark.parametrize("scale", REASONS)
def test_reject_reasons(spark, scale):
    rows = QUERIES["reject_reasons"](spark, ROOT + scale).collect()
    assert {row.reason: row["rows"] for row in rows} == dict(zip(reports.REASONS, REASONS[scale]))


@pytest.mark.parametrize("scale", DISCARDS)
def test_discards(spark, scale):
    (row,) = QUERIES["discard_report"](spark, ROOT + scale).collect()
    assert tuple(row)[:6] == DISCARDS[scale]
    assert row.kept_pct == round(100 * row.kept / row.total, 2)


@pytest.mark.parametrize("scale", MONTHS)
def test_month_answer(spark, scale):
    assert [tuple(row) for row in QUERIES["q1_sql"](spark, ROOT + scale).collect()] == MONTHS[scale]


def test_hour_answer(spark):
    rows = QUERIES["q2_sql"](spark, ROOT + "sf0.01").collect()
    assert len(rows) == 24
    first = [(row.avg_passenger_count, row.trips) for row in rows[:4]]
    assert first == [(2.917, 60), (2.746, 59), (3.065, 62), (3.258, 62)]


@pytest.mark.parametrize(
    ("mart", "answer", "renamed"),
    [
        ("mart_amount_by_month", "q1_sql", {"avg_total_amount": "avg_total_amount_per_trip"}),
        ("mart_passengers_by_hour", "q2_sql", {}),
    ],
)
def test_marts_say_what_the_sql_says(spark, mart, answer, renamed):
    stored = QUERIES[mart](spark, ROOT + "sf0.01").withColumnsRenamed(renamed)
    asked = QUERIES[answer](spark, ROOT + "sf0.01").select(stored.columns)
    assert stored.collect() == asked.collect()


def test_every_event_becomes_a_trip(spark):
    events = spark.read.parquet(ROOT + "sf0.01/events.parquet").count()
    table = trips(spark, ROOT + "sf0.01")
    assert table.count() == events + table.filter("source_file = 'trips_dup.parquet'").count()
    assert reports.diagnostics(table, TRIPS_2024).first().total == 10100
