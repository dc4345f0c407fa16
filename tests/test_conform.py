from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import LOADED, plan_of, trip
from stratalake.functions.typed import coerce
from stratalake.operators import reports
from stratalake.operators.conform import clean, conform, keep_first, silver
from stratalake.operators.keys import duplicate_rows
from stratalake.spec import TRIPS


def amounts(df):
    return [row.total_amount for row in df.collect()]


@pytest.mark.parametrize(
    ("amount", "kept"),
    [(-0.01, False), (0.0, True), (-0.0, True), (math.nan, True), (None, False), (5.0, True)],
)
def test_amount(bronze_of, amount, kept):
    assert clean(bronze_of(trip(amount=amount)), TRIPS).count() == int(kept)


@pytest.mark.parametrize(
    ("pickup", "kept"),
    [
        ("2022-12-31 23:59:59.999999", False),
        ("2023-01-01 00:00:00", True),
        ("2023-05-31 23:59:59.999999", True),
        ("2023-06-01 00:00:00", False),
        (None, False),
    ],
)
def test_event_time_range_is_half_open(bronze_of, pickup, kept):
    row = trip(pickup=pickup, dropoff="2023-08-01 00:00:00")
    assert clean(bronze_of(row), TRIPS).count() == int(kept)


@pytest.mark.parametrize(
    ("dropoff", "kept"),
    [
        ("2023-03-01 10:00:00", False),
        ("2023-03-01 09:59:59", False),
        ("2023-03-01 10:00:01", True),
        ("2024-03-01 10:00:01", True),
        (None, False),
    ],
)
def test_interval(bronze_of, dropoff, kept):
    assert clean(bronze_of(trip(dropoff=dropoff)), TRIPS).count() == int(kept)


def test_counts_are_never_cleaned(bronze_of):
    rows = [trip(riders=riders, vendor=n) for n, riders in enumerate((None, 0.0, 9.0, 10.0, -1.0))]
    assert clean(bronze_of(*rows), TRIPS).count() == 5


@pytest.mark.parametrize(
    ("riders", "expected"),
    [(1.9, 1), (-1.9, -1), (3e10, None), (math.nan, None), (None, None), (4.0, 4)],
)
def test_count_cast(bronze_of, riders, expected):
    assert conform(bronze_of(trip(riders=riders)), TRIPS).first().passenger_count == expected


def test_conformed_schema(bronze_of):
    assert conform(bronze_of(trip()), TRIPS).dtypes == [
        ("VendorID", "int"),
        ("passenger_count", "int"),
        ("total_amount", "double"),
        ("tpep_pickup_datetime", "timestamp_ntz"),
        ("tpep_dropoff_datetime", "timestamp_ntz"),
        ("source_file", "string"),
        ("ingestion_timestamp", "timestamp"),
    ]


def test_vendor_too_large_is_counted_as_nulled(bronze_of):
    bronze = bronze_of(trip(vendor=2**40), trip(vendor=None), trip(riders=math.nan))
    assert reports.diagnostics(bronze, TRIPS).first().nulled_by_cast == 2
    assert sorted(row.VendorID or 0 for row in conform(bronze, TRIPS).collect()) == [0, 0, 1]


def test_text_columns_are_typed_before_they_are_judged(spark, bronze_of):
    bronze = bronze_of(trip()).withColumn(
        "total_amount", F.explode(F.array(*map(F.lit, ("-0.5", "1.5", "n/a"))))
    )
    assert amounts(silver(bronze, TRIPS)) == [1.5]
    counts = reports.diagnostics(bronze, TRIPS).first()
    assert (counts.negative_amount, counts.nulled_by_cast) == (1, 1)


def test_zone_aware_times_become_utc(spark, bronze_of):
    """05:30Z and 06:30Z read 01:30 twice in New York on that night."""
    bronze = bronze_of(trip()).select(
        "VendorID",
        "passenger_count",
        "total_amount",
        F.timestamp_micros(F.lit(1667712600000000)).alias("tpep_pickup_datetime"),
        F.timestamp_micros(F.lit(1667716200000000)).alias("tpep_dropoff_datetime"),
        "source_file",
        "ingestion_timestamp",
    )
    row = conform(bronze, TRIPS).first()
    assert row.tpep_pickup_datetime == datetime(2022, 11, 6, 5, 30)
    assert row.tpep_dropoff_datetime == datetime(2022, 11, 6, 6, 30)


@pytest.mark.parametrize(
    ("left", "right"),
    [
        (trip(vendor=None), trip(vendor=None)),
        (trip(amount=0.0), trip(amount=-0.0)),
        (trip(amount=math.nan), trip(amount=math.nan)),
    ],
)
def test_keys_compare_as_in_distinct(bronze_of, left, right):
    bronze = bronze_of(left, right)
    assert silver(bronze, TRIPS).count() == 1
    assert silver(bronze, TRIPS).count() == bronze.dropDuplicates(list(TRIPS.key)).count()
    assert duplicate_rows(bronze, TRIPS.key).first().duplicate_keys == 1


def test_first_by_tie_break_wins_in_any_order(bronze_of):
    rows = [
        trip(riders=None, source="a.parquet"),
        trip(riders=3.0, source="a.parquet"),
        trip(riders=2.0, source="b.parquet"),
        trip(riders=1.0, source=None),
    ]
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        (kept,) = silver(bronze_of(*rows).repartition(3), TRIPS).collect()
        assert (kept.source_file, kept.passenger_count) == ("a.parquet", 3)


def test_copies_are_dropped_before_the_shuffle(bronze_of):
    plan = plan_of(silver(bronze_of(trip()), TRIPS))
    assert plan.count("WindowGroupLimit") == 2
    assert "Partial" in plan and plan.count("Exchange") == 1


def test_key_held_by_a_third_of_the_rows(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )
    kept = keep_first(rows, ["k"], ["v"])
    assert kept.count() == 20_001
    assert kept.filter("k = 0").first().v == 0


def random_trips(count: int, seed: int):
    pick = random.Random(seed)
    start = datetime(2022, 12, 31, 23, 0)
    for _ in range(count):
        pickup = pick.choice([None, *[start + timedelta(days=40 * n, hours=n) for n in range(5)]])
        gap = timedelta(minutes=pick.choice([-5, 0, 5, 10]))
        dropoff = pick.choice([None, pickup + gap, pickup + gap]) if pickup else None
        amount = pick.choice([None, -3.0, 0.0, -0.0, 7.5, 7.5, math.nan])
        riders = pick.choice([None, 0.0, 1.0, 2.7])
        source = pick.choice([None, "a", "b"])
        yield (pick.choice([None, 1, 2]), riders, amount, pickup, dropoff, source, LOADED)


def judge(row) -> str:
    _, _, amount, pickup, dropoff, _, _ = row
    low, high = datetime.fromisoformat(TRIPS.lower), datetime.fromisoformat(TRIPS.upper)
    if amount is not None and amount < 0:
        return "negative_amount"
    if pickup and dropoff and pickup >= dropoff:
        return "bad_interval"
    if pickup and not low <= pickup < high:
        return "out_of_range"
    if amount is None or pickup is None or dropoff is None:
        return "null_predicate"
    return "kept"


def key_of(row):
    vendor, _, amount, pickup, dropoff, _, _ = row
    return (vendor, "nan" if math.isnan(amount) else amount + 0.0, pickup, dropoff)


def rank_of(row):
    _, riders, _, _, _, source, _ = row
    whole = None if riders is None else int(riders)
    return (source is None, source or "", whole is None, whole or 0)


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(bronze_of, seed):
    rows = list(random_trips(600, seed))
    reasons = dict.fromkeys(reports.REASONS, 0)
    best: dict = {}
    for row in rows:
        reason = judge(row)
        if reason != "kept":
            reasons[reason] += 1
            continue
        key = key_of(row)
        if key in best:
            reasons["duplicate_key"] += 1
        if key not in best or rank_of(row) < rank_of(best[key]):
            best[key] = row
    reasons["kept"] = len(best)

    bronze = bronze_of(*rows)
    found = {row.reason: row["rows"] for row in reports.reject_reasons(bronze, TRIPS).collect()}
    assert found == reasons
    assert sum(found.values()) == len(rows)

    expected = {(key, rank_of(row)) for key, row in best.items()}
    actual = {(key_of(row), rank_of(row)) for row in silver(bronze, TRIPS).collect()}
    assert actual == expected


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_text_becomes_the_number_it_is(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        texts = [("1.0",), ("1.9",), ("-1.9",), ("1e2",), ("x",), ("3e10",), ("true",), (None,), (" 7 ",)]
        frame = spark.createDataFrame(texts, "t string")
        cast = coerce(F.col("t"), frame.schema["t"].dataType, "int")
        assert [row[0] for row in frame.select(cast).collect()] == [1, 1, -1, 100, None, None, 1, None, 7]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
