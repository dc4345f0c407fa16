"""Whole runs on stored tables."""

from __future__ import annotations

import os
from dataclasses import dataclass, replace

import pytest
from pyspark.sql import functions as F

from helpers import BRONZE_SCHEMA, FOLDERS, plan_of, trip
from stratalake import (
    DataQualityError,
    Lake,
    hour_answer,
    month_answer,
    register_fact,
    register_layers,
    run_all,
    run_bronze,
    run_gold,
    run_query,
    run_silver,
    save_fact_table,
)
from stratalake.operators.conform import silver
from stratalake.operators.reports import rows_by_file
from stratalake.plans.sizing import table_bytes
from stratalake.plans.stages import GoldResult
from stratalake.sources.lake import layer_exists, read_layer
from stratalake.spec import TRIPS

JANUARY = [
    trip(pickup="2023-01-05 08:00:00", dropoff="2023-01-05 08:20:00", amount=10.0, riders=None),
    trip(pickup="2023-01-06 09:00:00", dropoff="2023-01-06 09:20:00", amount=20.005),
    trip(pickup="2023-01-06 09:00:00", dropoff="2023-01-06 09:20:00", amount=20.005, riders=3.0),
    trip(pickup="2023-01-07 09:00:00", dropoff="2023-01-07 09:00:00"),
]
MAY = [
    trip(pickup="2023-05-05 23:59:59", dropoff="2023-05-06 00:20:00", amount=30.0, riders=2.0),
    trip(pickup="2023-05-07 23:10:00", dropoff="2023-05-07 23:20:00", amount=50.0, riders=1.0),
    trip(pickup="2023-05-07 07:10:00", dropoff="2023-05-07 07:20:00", amount=50.0, riders=0.0),
    trip(pickup="2023-05-08 07:10:00", dropoff="2023-05-08 07:20:00", amount=-4.0, riders=1.0),
    trip(pickup="2023-07-08 07:10:00", dropoff="2023-07-08 07:20:00", amount=4.0, riders=1.0),
    trip(pickup="2023-05-09 07:10:00", dropoff=None, amount=4.0, riders=1.0),
]


def land(spark, lake, period, rows, vendor_type="bigint"):
    (
        spark.createDataFrame(rows, BRONZE_SCHEMA)
        .drop("source_file", "ingestion_timestamp")
        .withColumn("VendorID", F.col("VendorID").cast(vendor_type))
        .withColumn("tip", F.lit(1.5))
        .write.mode("overwrite")
        .parquet(lake.landing(period))
    )


def landed(spark, folder) -> Lake:
    spec = replace(FOLDERS, periods=("2023-01", "2023-05"))
    lake = Lake(str(folder / "lake"), spec)
    land(spark, lake, "2023-01", JANUARY, "int")
    land(spark, lake, "2023-05", MAY)
    return lake


@pytest.fixture
def lake(spark, tmp_path) -> Lake:
    return landed(spark, tmp_path)


@dataclass
class Run:
    lake: Lake
    gold: GoldResult
    plans: list[str]
    """What Spark recorded of every query it executed."""


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory) -> Run:
    """One whole run, for tests that only look at it."""
    lake = landed(spark, tmp_path_factory.mktemp("done"))
    store = spark._jsparkSession.sharedState().statusStore()
    known = store.executionsList().size()
    gold = run_all(spark, lake)
    executions = store.executionsList()
    plans = [
        executions.apply(number).physicalPlanDescription()
        for number in range(known, executions.size())
    ]
    return Run(lake, gold, plans)


def rows_of(df):
    return [tuple(row) for row in df.collect()]


def contents(df):
    return sorted(map(repr, rows_of(df.drop("ingestion_timestamp"))))


def test_landing_to_gold(spark, done):
    lake, gold = done.lake, done.gold
    assert rows_of(gold.month_mart) == [("2023-01", 15.0, 2), ("2023-05", 43.33, 3)]
    assert rows_of(gold.hour_mart) == [(23, 1.5, 2)]
    assert gold.fact.dtypes == [
        *[(name, kind) for name, kind in TRIPS.columns],
        ("pickup_month", "string"),
        ("pickup_hour", "int"),
    ]
    view = register_fact(spark, lake)
    assert rows_of(month_answer(spark, view)) == [
        ("2023-01", 15.0, 2, 30.01),
        ("2023-05", 43.33, 3, 130.0),
    ]
    assert rows_of(hour_answer(spark, view)) == [(23, 1.5, 2)]
    assert rows_of(hour_answer(spark, view, "2023-01")) == [(9, 1.0, 1)]


def test_bronze_keeps_everything_and_its_origin(spark, done):
    bronze = read_layer(spark, done.lake, "bronze")
    assert bronze.filter("tip = 1.5").count() == 10
    assert dict(bronze.dtypes)["VendorID"] == "bigint"
    assert rows_of(rows_by_file(bronze)) == [
        ("yellow_tripdata_2023-01.parquet", 4),
        ("yellow_tripdata_2023-05.parquet", 6),
    ]


def test_silver_report(spark, lake):
    silver = run_silver(spark, lake, run_bronze(spark, lake))
    assert silver.rows == 5
    assert silver.discards.first().asDict() == {
        "total": 10,
        "negative_amount": 1,
        "bad_interval": 1,
        "out_of_range": 1,
        "duplicates": 1,
        "kept": 5,
        "kept_pct": 50.0,
        "nulled_by_cast": 0,
    }


def test_stages_alone_equal_the_whole_run(spark, lake, tmp_path):
    run_all(spark, lake)
    whole = contents(read_layer(spark, lake, "fact"))
    run_silver(spark, lake)
    run_gold(spark, lake)
    assert contents(read_layer(spark, lake, "fact")) == whole


def test_running_again_changes_nothing(spark, lake):
    run_all(spark, lake)
    layers = ("bronze", "silver", "fact", "month_mart", "hour_mart")
    first = {layer: contents(read_layer(spark, lake, layer)) for layer in layers}
    run_all(spark, lake)
    assert {layer: contents(read_layer(spark, lake, layer)) for layer in layers} == first
    assert not os.path.exists(lake.staging("silver"))
    assert not os.path.exists(lake.retired("silver"))


def test_a_subset_of_periods_replaces_bronze(spark, lake):
    run_bronze(spark, lake)
    assert run_bronze(spark, lake, ["2023-05"]).rows == 6
    assert read_layer(spark, lake, "bronze").count() == 6


def test_failed_gate_leaves_silver_as_it_was(spark, lake):
    run_all(spark, lake)
    before = contents(read_layer(spark, lake, "silver"))
    land(spark, lake, "2023-05", [*MAY, trip(riders=10.0)])
    bronze = run_bronze(spark, lake)
    with pytest.raises(DataQualityError) as caught:
        run_silver(spark, lake, bronze)
    assert (caught.value.rule, caught.value.count) == ("passenger_count_range", 1)
    assert contents(read_layer(spark, lake, "silver")) == before
    assert os.path.exists(lake.staging("silver"))


def test_a_run_that_died_while_publishing_is_undone(spark, lake):
    run_all(spark, lake)
    before = contents(read_layer(spark, lake, "silver"))
    os.makedirs(os.path.dirname(lake.retired("silver")), exist_ok=True)
    os.rename(lake.path("silver"), lake.retired("silver"))
    land(spark, lake, "2023-05", [*MAY, trip(riders=10.0)])
    with pytest.raises(DataQualityError):
        run_silver(spark, lake, run_bronze(spark, lake))
    assert contents(read_layer(spark, lake, "silver")) == before


def test_nothing_survives_cleaning(spark, lake):
    land(spark, lake, "2023-05", [trip(amount=-1.0)])
    bronze = run_bronze(spark, lake, ["2023-05"])
    with pytest.raises(DataQualityError, match="not_empty"):
        run_silver(spark, lake, bronze)
    assert not layer_exists(spark, lake, "silver")


def test_silver_alone_checks_its_input(spark, lake):
    run_bronze(spark, lake)
    (
        read_layer(spark, lake, "bronze")
        .drop("total_amount")
        .write.parquet(lake.path("bronze") + "_narrow")
    )
    narrow = Lake(lake.root, replace(lake.spec, table=lake.spec.table + "_narrow"))
    with pytest.raises(DataQualityError, match="missing total_amount"):
        run_silver(spark, narrow)


def test_empty_landing_is_refused_after_bronze_is_written(spark, lake):
    land(spark, lake, "2023-05", [])
    with pytest.raises(DataQualityError, match="bronze failed: not_empty"):
        run_bronze(spark, lake, ["2023-05"])
    assert layer_exists(spark, lake, "bronze")


def test_other_file_formats(spark, lake):
    orc = replace(lake, fmt="orc")
    gold = run_all(spark, orc)
    assert rows_of(gold.month_mart) == [("2023-01", 15.0, 2), ("2023-05", 43.33, 3)]
    assert gold.fact.dtypes[3] == ("tpep_pickup_datetime", "timestamp_ntz")
    assert register_layers(spark, orc) == ["bronze", "silver", "gold_fact"]


@pytest.mark.parametrize(
    ("setting", "value"),
    [
        ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k"),
        ("spark.sql.adaptive.enabled", "false"),
    ],
)
def test_a_large_month_is_split_into_files(spark, lake, setting, value):
    """A month holding most rows must not end in one task."""
    busy = spark.range(0, 200_000, 1, 8).selectExpr(
        "CAST(id % 2 AS INT) AS VendorID",
        "1.0D AS passenger_count",
        "CAST(id AS DOUBLE) AS total_amount",
        "TIMESTAMP_NTZ'2023-05-01' + make_dt_interval(0, 0, 0, id) AS tpep_pickup_datetime",
        "TIMESTAMP_NTZ'2023-05-01' + make_dt_interval(0, 0, 5, id) AS tpep_dropoff_datetime",
    )
    busy.write.mode("overwrite").parquet(lake.landing("2023-05"))
    run_silver(spark, lake, run_bronze(spark, lake))
    spark.conf.set(setting, value)
    try:
        fact = run_gold(spark, lake, part_bytes=1 << 16).fact
    finally:
        spark.conf.unset(setting)
    assert fact.filter("pickup_month = '2023-05'").count() == 200_000
    files = [name for name in os.listdir(lake.path("fact") + "/pickup_month=2023-05") if name[0] == "p"]
    assert len(files) > 1


def test_views_appear_as_layers_do(spark, lake):
    assert register_layers(spark, lake) == []
    run_bronze(spark, lake)
    assert register_layers(spark, lake) == ["bronze"]
    run_silver(spark, lake)
    run_gold(spark, lake)
    assert register_layers(spark, lake) == ["bronze", "silver", "gold_fact"]
    assert rows_of(run_query(spark, "SELECT COUNT(*) FROM bronze")) == [(10,)]
    joined = "SELECT count(*) FROM gold_fact f JOIN silver s USING (tpep_pickup_datetime, VendorID)"
    assert rows_of(run_query(spark, joined)) == [(5,)]
    assert run_query(spark, "SELECT * FROM bronze", limit=3).count() == 3


def test_fact_as_catalog_table(spark, done):
    lake = done.lake
    table = save_fact_table(spark, lake, "trips_catalogued")
    assert contents(table.select(read_layer(spark, lake, "fact").columns)) == contents(
        read_layer(spark, lake, "fact")
    )
    assert save_fact_table(spark, lake, "trips_catalogued").count() == 5
    assert rows_of(month_answer(spark, "trips_catalogued"))[0][:2] == ("2023-01", 15.0)
    spark.sql("DROP TABLE trips_catalogued")


def test_a_month_is_a_folder_and_the_hour_mart_reads_only_that(spark, done):
    lake, fact = done.lake, done.gold.fact
    assert sorted(name for name in os.listdir(lake.path("fact")) if "=" in name) == [
        "pickup_month=2023-01",
        "pickup_month=2023-05",
    ]
    register_fact(spark, lake)
    plan = plan_of(hour_answer(spark, month="2023-05"))
    assert "PartitionFilters: [isnotnull(pickup_month" in plan
    assert "ReadSchema: struct<passenger_count:int,pickup_hour:int>" in plan
    assert fact.count() == 5


def test_cleaning_reaches_the_bronze_scan(spark, done):
    plan = plan_of(silver(read_layer(spark, done.lake, "bronze"), done.lake.spec))
    assert "GreaterThanOrEqual(total_amount,0.0)" in plan
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2023-01-01T00:00)" in plan
    assert "tip" not in plan


def test_a_run_reads_bronze_twice_and_silver_once(done):
    """Bronze: once for gate and diagnostics together, once to write silver."""
    lake = done.lake

    def scans(path: str) -> int:
        return sum(f"[file:{path}]" in plan and "Scan" in plan for plan in done.plans)

    assert scans(lake.path("bronze")) == 2
    assert scans(lake.staging("silver")) == 1
    assert scans(lake.path("silver")) == 1


def test_no_python_in_any_plan(done):
    assert done.plans
    for plan in done.plans:
        assert "EvalPython" not in plan and "InPandas" not in plan


def test_the_fact_is_rebalanced_by_month(done):
    assert sum("REBALANCE_PARTITIONS_BY_COL" in plan for plan in done.plans) == 1


def test_mart_of_a_month_without_trips_is_empty(spark, lake):
    gold = run_all(spark, lake, ["2023-01"])
    assert rows_of(gold.hour_mart) == []
    assert gold.hour_mart.columns == ["pickup_hour", "avg_passenger_count", "trips"]
    assert rows_of(gold.month_mart) == [("2023-01", 15.0, 2)]


def test_paths(monkeypatch):
    lake = Lake("s3a://bucket/lake/", TRIPS)
    assert lake.landing("2023-01") == "s3a://bucket/lake/landing/yellow_tripdata_2023-01.parquet"
    assert lake.path("bronze") == "s3a://bucket/lake/bronze/yellow_tripdata"
    assert lake.path("silver") == "s3a://bucket/lake/silver/yellow_tripdata"
    assert lake.path("fact") == "s3a://bucket/lake/gold/fact_trips"
    assert lake.path("month_mart") == "s3a://bucket/lake/gold/agg_avg_total_amount_by_month"
    assert lake.path("hour_mart") == "s3a://bucket/lake/gold/agg_avg_passengers_by_hour_may"
    monkeypatch.setenv("DATA_ROOT", "/data/elsewhere")
    assert Lake.from_env(TRIPS).root == "/data/elsewhere"
    monkeypatch.delenv("DATA_ROOT")
    assert Lake.from_env(TRIPS, default="here").root == "here"
    assert not lake.renames and Lake("s3a://b", TRIPS, publish="rename").renames
    assert Lake("/lake", TRIPS).renames and Lake("hdfs://n/lake", TRIPS).renames
    assert not Lake("/lake", TRIPS, fmt="delta").renames
    with pytest.raises(ValueError, match="publish"):
        Lake("x", TRIPS, publish="copy")


def test_size_is_that_of_the_files(spark, done):
    lake = done.lake
    total = sum(
        os.path.getsize(os.path.join(lake.path("bronze"), name))
        for name in os.listdir(lake.path("bronze"))
        if name.endswith(".parquet")
    )
    assert table_bytes(read_layer(spark, lake, "bronze")) == pytest.approx(total, rel=0.01)
    assert table_bytes(spark.range(0)) >= 0
