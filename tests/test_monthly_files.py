"""The trips spec as it is, on single monthly files with the drift the real ones have."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from helpers import plan_of
from stratalake import Lake, TRIPS, hour_answer, month_answer, register_fact, run_all, run_bronze, run_silver
from stratalake.operators.reports import rows_by_file
from stratalake.sources.lake import read_layer
from stratalake.sources.landing import read_landing

PER_MONTH = 400


def month_rows(period: str) -> list[dict]:
    """Trips of one month, with refunds, inverted intervals, strays and repeats."""
    pick = random.Random(period)
    begin = dt.datetime.fromisoformat(f"{period}-01")
    rows = []
    for number in range(PER_MONTH):
        pickup = begin + dt.timedelta(minutes=pick.randrange(27 * 24 * 60))
        if number % 50 == 0:
            pickup = pick.choice([dt.datetime(2001, 1, 1, 5), dt.datetime(2023, 6, 1), dt.datetime(2022, 12, 31, 23)])
        minutes = -3 if number % 40 == 1 else pick.randrange(1, 60)
        rows.append(
            {
                "VendorID": 1 + number % 2,
                "tpep_pickup_datetime": pickup,
                "tpep_dropoff_datetime": pickup + dt.timedelta(minutes=minutes),
                "passenger_count": pick.choice([None, 0, 1, 1, 2, 6]),
                "total_amount": -5.0 if number % 30 == 2 else pick.randrange(0, 8000) / 4,
                "fee": 2.5,
            }
        )
    rows += [dict(row, passenger_count=9) for row in rows[3:13]]
    return rows


def write_month(path: str, rows: list[dict], first: bool) -> None:
    """The first month has wide vendors and fractional counts; later ones the reverse."""
    whole, count, fee = (
        (pa.int64(), pa.float64(), "airport_fee") if first else (pa.int32(), pa.int64(), "Airport_fee")
    )
    schema = pa.schema(
        [
            ("VendorID", whole),
            ("tpep_pickup_datetime", pa.timestamp("us")),
            ("tpep_dropoff_datetime", pa.timestamp("us")),
            ("passenger_count", count),
            ("total_amount", pa.float64()),
            (fee, pa.float64()),
        ]
    )
    columns = [name if name != fee else "fee" for name in schema.names]
    arrays = [pa.array([row[name] for row in rows]).cast(kind) for name, kind in zip(columns, schema.types)]
    pq.write_table(pa.Table.from_arrays(arrays, schema=schema), path)


@pytest.fixture(scope="module")
def months() -> dict[str, list[dict]]:
    return {period: month_rows(period) for period in TRIPS.periods}


@pytest.fixture(scope="module")
def lake(spark, months, tmp_path_factory) -> Lake:
    folder = tmp_path_factory.mktemp("monthly")
    (folder / "landing").mkdir()
    lake = Lake(str(folder), TRIPS)
    for at, (period, rows) in enumerate(months.items()):
        write_month(lake.landing(period), rows, first=at == 0)
    run_all(spark, lake)
    return lake


@pytest.fixture(scope="module")
def kept(months) -> list[dict]:
    """What a plain loop keeps: the first of each key by file, then by passengers."""
    best: dict[tuple, tuple] = {}
    for period, rows in months.items():
        for row in rows:
            pickup, dropoff = row["tpep_pickup_datetime"], row["tpep_dropoff_datetime"]
            in_range = dt.datetime(2023, 1, 1) <= pickup < dt.datetime(2023, 6, 1)
            if row["total_amount"] < 0 or pickup >= dropoff or not in_range:
                continue
            key = (row["VendorID"], pickup, dropoff, row["total_amount"])
            riders = row["passenger_count"]
            rank = (period, riders is None, riders or 0)
            if key not in best or rank < best[key][0]:
                best[key] = (rank, row)
    return [row for _, row in best.values()]


def as_tuples(rows):
    return sorted(
        (
            row["tpep_pickup_datetime"],
            row["tpep_dropoff_datetime"],
            row["VendorID"],
            row["total_amount"],
            -1 if row["passenger_count"] is None else row["passenger_count"],
        )
        for row in rows
    )


def test_bronze_holds_every_row_of_every_file(spark, lake, months):
    bronze = read_layer(spark, lake, "bronze")
    assert dict(bronze.dtypes)["VendorID"] == "bigint"
    assert dict(bronze.dtypes)["passenger_count"] == "double"
    assert bronze.filter("airport_fee = 2.5").count() == sum(map(len, months.values()))
    assert {row.source_file: row["count"] for row in rows_by_file(bronze).collect()} == {
        TRIPS.landing_name(period): len(rows) for period, rows in months.items()
    }


def test_five_files_of_two_schemas_are_two_scans(spark, lake):
    paths = [lake.landing(period) for period in TRIPS.periods]
    assert plan_of(read_landing(spark, paths)).count("FileScan") == 2


def test_silver_is_what_a_plain_loop_keeps(spark, lake, kept):
    assert as_tuples(row.asDict() for row in read_layer(spark, lake, "silver").collect()) == as_tuples(kept)


def test_answers(spark, lake, kept):
    amounts, riders = defaultdict(list), defaultdict(list)
    for row in kept:
        pickup = row["tpep_pickup_datetime"]
        amounts[f"{pickup:%Y-%m}"].append(row["total_amount"])
        if f"{pickup:%Y-%m}" == "2023-05" and row["passenger_count"]:
            riders[pickup.hour].append(row["passenger_count"])
    view = register_fact(spark, lake)
    months = month_answer(spark, view).collect()
    assert [row.pickup_month for row in months] == sorted(amounts)
    for row in months:
        values = amounts[row.pickup_month]
        assert row.trips == len(values)
        assert row.total_revenue == pytest.approx(sum(values), abs=0.005)
        assert row.avg_total_amount_per_trip == pytest.approx(sum(values) / len(values), abs=0.0051)
    hours = hour_answer(spark, view).collect()
    assert [row.pickup_hour for row in hours] == sorted(riders)
    for row in hours:
        values = riders[row.pickup_hour]
        assert row.trips == len(values)
        assert row.avg_passenger_count == pytest.approx(sum(values) / len(values), abs=0.00051)


def test_order_of_delivery_does_not_matter(spark, lake, kept):
    bronze = run_bronze(spark, lake, list(reversed(TRIPS.periods)))
    silver = run_silver(spark, lake, bronze).table
    assert as_tuples(row.asDict() for row in silver.collect()) == as_tuples(kept)
