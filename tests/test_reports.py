from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from helpers import trip
from stratalake.operators import reports
from stratalake.operators.conform import silver
from stratalake.plans.stages import discards
from stratalake.spec import TRIPS


def test_overlapping_counts(bronze_of):
    bronze = bronze_of(
        trip(),
        trip(),
        trip(amount=-1.0, dropoff="2023-03-01 10:00:00"),
        trip(pickup="2024-01-01 00:00:00", dropoff="2023-01-01 00:00:00"),
        trip(amount=None),
    )
    counts = reports.diagnostics(bronze, TRIPS).first()
    assert counts.asDict() == {
        "total": 5,
        "negative_amount": 1,
        "bad_interval": 2,
        "out_of_range": 1,
        "accepted": 2,
        "nulled_by_cast": 0,
    }
    report = reports.discard_report(bronze, TRIPS).first()
    assert (report.duplicates, report.kept, report.kept_pct) == (1, 1, 20.0)


def test_stage_report_equals_operator_report(spark, bronze_of):
    bronze = bronze_of(trip(), trip(), trip(amount=-1.0), trip(vendor=2))
    counts = reports.diagnostics(bronze, TRIPS).first()
    from_counts = discards(spark, counts, kept=2)
    from_rows = reports.discard_report(bronze, TRIPS)
    assert from_counts.dtypes == from_rows.dtypes
    assert from_counts.collect() == from_rows.collect()


def test_reports_on_nothing(spark, bronze_of):
    empty = bronze_of()
    report = reports.discard_report(empty, TRIPS).first()
    assert (report.total, report.kept, report.kept_pct) == (0, 0, None)
    assert {row["rows"] for row in reports.reject_reasons(empty, TRIPS).collect()} == {0}
    profile = reports.profile(empty, TRIPS).first()
    assert (profile.total, profile.duplicate_keys, profile.zero_amount_pct) == (0, 0, None)
    assert discards(spark, reports.diagnostics(empty, TRIPS).first(), 0).first().kept_pct is None


def test_profile(bronze_of):
    bronze = bronze_of(
        trip(amount=0.0, pickup="2001-01-01 00:00:00"),
        trip(riders=None),
        trip(riders=0.0),
        trip(amount=-2.0, pickup="2023-09-01 00:00:00"),
    )
    found = reports.profile(bronze, TRIPS).first()
    assert (found.total, found.negative_amount, found.zero_amount) == (4, 1, 1)
    assert (found.null_count, found.zero_count, found.bad_interval) == (1, 1, 1)
    assert (found.out_of_range, found.duplicate_keys, found.duplicate_keys_pct) == (2, 1, 25.0)
    assert found.first_start == datetime(2001, 1, 1)
    assert found.last_start == datetime(2023, 9, 1)


def test_rows_by_file_is_sorted(bronze_of):
    bronze = bronze_of(trip(source="b"), trip(source="a"), trip(source="b"))
    rows = [tuple(row) for row in reports.rows_by_file(bronze).collect()]
    assert rows == [("a", 1), ("b", 2)]


def test_a_key_without_the_judged_columns(bronze_of):
    """Reports then count rows where they otherwise count keys, with equal results."""
    narrow = replace(TRIPS, key=("VendorID",))
    bronze = bronze_of(
        trip(amount=-1.0),
        trip(vendor=2, pickup="2001-01-01 00:00:00"),
        trip(vendor=2, riders=None, source="b"),
        trip(vendor=2, riders=5.0, source="a"),
        trip(vendor=None, amount=0.0),
        trip(vendor=None, amount=None),
    )
    wide, found = (reports.profile(bronze, spec).first().asDict() for spec in (TRIPS, narrow))
    assert (wide.pop("duplicate_keys"), found.pop("duplicate_keys")) == (1, 3)
    del wide["duplicate_keys_pct"], found["duplicate_keys_pct"]
    assert found == wide

    reasons = {row.reason: row["rows"] for row in reports.reject_reasons(bronze, narrow).collect()}
    assert reasons == {
        "negative_amount": 1,
        "bad_interval": 0,
        "out_of_range": 1,
        "null_predicate": 1,
        "duplicate_key": 1,
        "kept": 2,
    }
    kept = sorted((row.VendorID or 0, row.source_file) for row in silver(bronze, narrow).collect())
    assert kept == [(0, "a.parquet"), (2, "a")]
