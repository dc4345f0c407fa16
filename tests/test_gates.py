from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, trip
from stratalake.operators import gates
from stratalake.operators.conform import conform
from stratalake.operators.gates import DataQualityError, gate_bronze, gate_silver
from stratalake.spec import LINEAGE, TRIPS


def silver_rows(bronze_of, *rows):
    return conform(bronze_of(*rows), TRIPS)


def failure(gate, df, spec=TRIPS) -> tuple[str, int]:
    with pytest.raises(DataQualityError) as caught:
        gate(df, spec)
    return caught.value.rule, caught.value.count


def test_good_layers_pass(bronze_of):
    rows = [trip(vendor=n, riders=riders) for n, riders in enumerate((None, 0.0, 9.0))]
    assert gate_bronze(bronze_of(*rows), TRIPS) == {"rows": 3}
    assert gate_silver(silver_rows(bronze_of, *rows), TRIPS) == {"rows": 3}


@pytest.mark.parametrize("name", [*TRIPS.required, *LINEAGE])
def test_bronze_needs_each_column(bronze_of, name):
    rule, count = failure(gate_bronze, bronze_of(trip()).drop(name))
    assert rule == f"required_columns: missing {name}"
    assert count == 1


def test_missing_columns_are_listed_sorted(bronze_of):
    rule, count = failure(gate_bronze, bronze_of(trip()).drop("total_amount", "VendorID"))
    assert rule == "required_columns: missing VendorID, total_amount"
    assert count == 2


def test_silver_does_not_need_lineage(bronze_of):
    assert gate_silver(bronze_of(trip()).drop(*LINEAGE), TRIPS) == {"rows": 1}


@pytest.mark.parametrize("name", TRIPS.required)
def test_silver_needs_each_required_column(bronze_of, name):
    rule, _ = failure(gate_silver, silver_rows(bronze_of, trip()).drop(name))
    assert rule == f"required_columns: missing {name}"


def test_columns_match_in_any_case(bronze_of):
    renamed = bronze_of(trip()).withColumnRenamed("VendorID", "vendorid")
    assert gate_bronze(renamed, TRIPS) == {"rows": 1}


def test_empty_layers_fail(bronze_of):
    assert failure(gate_bronze, bronze_of()) == ("not_empty", 0)
    assert failure(gate_silver, silver_rows(bronze_of)) == ("not_empty", 0)


@pytest.mark.parametrize("row", [trip(source=None), trip(loaded=None)])
def test_lineage_must_be_present(bronze_of, row):
    assert failure(gate_bronze, bronze_of(row, trip())) == ("lineage_present", 1)


@pytest.mark.parametrize("name", TRIPS.required)
def test_no_required_column_may_be_all_null(bronze_of, name):
    silver = silver_rows(bronze_of, trip(), trip(vendor=2))
    emptied = silver.withColumn(name, F.lit(None).cast(TRIPS.types[name]))
    assert failure(gate_silver, emptied) == (f"not_all_null:{name}", 2)


@pytest.mark.parametrize(
    ("row", "rule"),
    [
        (trip(amount=-1.0), "negative_amount"),
        (trip(dropoff="2023-03-01 10:00:00"), "bad_interval"),
        (trip(pickup="2022-12-31 23:59:59"), "out_of_range"),
        (trip(pickup="2023-06-01 00:00:00", dropoff="2023-06-01 01:00:00"), "out_of_range"),
        (trip(riders=10.0), "passenger_count_range"),
        (trip(riders=-1.0), "passenger_count_range"),
        (trip(vendor=2), "unique_key"),
    ],
)
def test_each_silver_rule(bronze_of, row, rule):
    assert failure(gate_silver, silver_rows(bronze_of, row, trip(vendor=2))) == (rule, 1)


def test_nulls_break_no_row_rule(bronze_of):
    rows = [trip(), trip(amount=None), trip(pickup=None), trip(dropoff=None), trip(riders=None, vendor=2)]
    report = gates.silver_report(silver_rows(bronze_of, *rows), TRIPS).collect()
    assert all(row.passed for row in report)


def test_first_failing_rule_is_named(bronze_of):
    bad = trip(amount=-1.0, riders=99.0, dropoff="2023-03-01 09:00:00")
    silver = silver_rows(bronze_of, bad, bad, trip())
    assert failure(gate_silver, silver) == ("negative_amount", 2)
    failed = [row.rule for row in gates.silver_report(silver, TRIPS).collect() if not row.passed]
    assert failed == ["negative_amount", "bad_interval", "passenger_count_range", "unique_key"]


def test_error_tells_layer_rule_and_count(bronze_of):
    with pytest.raises(DataQualityError, match="silver failed: negative_amount .1 violations"):
        gate_silver(silver_rows(bronze_of, trip(amount=-1.0)), TRIPS)


def test_same_verdict_when_rules_need_columns_outside_the_key(bronze_of):
    """With a smaller key the same rules are counted per row instead of per key."""
    rows = [trip(amount=-1.0), trip(amount=-2.0), trip(vendor=2, dropoff=None), trip(vendor=3)]
    narrow = replace(TRIPS, key=("VendorID",))
    silver = silver_rows(bronze_of, *rows)
    wide_report = {row.rule: row.violations for row in gates.silver_report(silver, TRIPS).collect()}
    narrow_report = {row.rule: row.violations for row in gates.silver_report(silver, narrow).collect()}
    assert narrow_report.pop("unique_key") == 1
    assert wide_report.pop("unique_key") == 0
    assert narrow_report == wide_report


def test_a_gate_is_one_scan_and_one_shuffle_of_keys(spark, bronze_of, tmp_path):
    silver_rows(bronze_of, trip()).write.parquet(str(tmp_path / "silver"))
    plan = plan_of(gates.silver_report(spark.read.parquet(str(tmp_path / "silver")), TRIPS))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1
    assert "source_file" not in plan
