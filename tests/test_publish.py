"""Publishing and reruns: what readers find when a run dies, with and without a JVM at hand."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import stratalake.plans.stages as stages
import stratalake.sources.lake as lakes
from helpers import BRONZE_SCHEMA, FOLDERS, trip
from stratalake import DataQualityError, Lake, register_layers, run_all, run_bronze, run_silver
from stratalake.plans.journal import finished
from stratalake.sources.lake import current_version, layer_exists, locate, read_layer

ROWS = {
    "2023-01": [trip(pickup="2023-01-05 08:00:00", dropoff="2023-01-05 08:20:00", amount=10.0)],
    "2023-05": [
        trip(pickup="2023-05-05 23:59:59", dropoff="2023-05-06 00:20:00", amount=30.0, riders=2.0),
        trip(pickup="2023-05-07 23:10:00", dropoff="2023-05-07 23:20:00", amount=50.0),
    ],
}


class Died(Exception):
    pass


def land(spark, lake, rows=ROWS):
    for period, trips in rows.items():
        landed = spark.createDataFrame(trips, BRONZE_SCHEMA).drop("source_file", "ingestion_timestamp")
        landed.write.mode("overwrite").parquet(lake.landing(period))


@pytest.fixture(params=["rename", "pointer"])
def lake(spark, tmp_path, request) -> Lake:
    lake = Lake(str(tmp_path / "lake"), replace(FOLDERS, periods=tuple(ROWS)), publish=request.param)
    land(spark, lake)
    return lake


def amounts(spark, lake, layer="silver"):
    return sorted(row.total_amount for row in read_layer(spark, lake, layer).collect())


def dying_before(monkeypatch, step):
    """Lets the run die before the ``step``-th change that a publication makes; returns whether it got there."""
    seen = []

    def counted(change):
        def act(*args, **kwargs):
            seen.append(change)
            if len(seen) == step:
                raise Died
            return change(*args, **kwargs)

        return act

    class Files:
        """The file system, with the calls that change something counted."""

        def __init__(self, files):
            self.files = files

        def __getattr__(self, name):
            call = getattr(self.files, name)
            return counted(call) if name in ("rename", "delete", "mkdirs") else call

    whole = lakes._file_system
    monkeypatch.setattr(lakes, "_file_system", lambda spark, path: Files(whole(spark, path)))
    for name in ("_write", "append_row", "_empty"):
        monkeypatch.setattr(lakes, name, counted(getattr(lakes, name)))
    return seen


def test_a_run_that_dies_leaves_the_old_table_or_the_new_one(spark, lake, monkeypatch):
    bronze = run_bronze(spark, lake)
    for _ in range(2 if lake.publish == "pointer" else 1):
        run_silver(spark, lake, bronze)
    old = amounts(spark, lake)
    dearer = replace(bronze, table=bronze.table.withColumn("total_amount", F.col("total_amount") + 1))
    new = [x + 1 for x in old]
    found, step = [], 0
    while True:
        step += 1
        with monkeypatch.context() as patch:
            dying_before(patch, step)
            try:
                run_silver(spark, lake, dearer)
            except Died:
                died = True
            else:
                died = False
        found.append(amounts(spark, lake))
        assert found[-1] in (old, new)
        assert register_layers(spark, lake) == ["bronze", "silver"]
        if not died:
            break
        run_silver(spark, lake, bronze)  # a rerun mends what was left
        assert amounts(spark, lake) == old
    assert found[0] == old and found[-1] == new and step > 3


def test_both_ways_publish_the_same_tables(spark, lake, tmp_path):
    gold = run_all(spark, lake)
    assert [tuple(r) for r in gold.month_mart.collect()] == [("2023-01", 10.0, 1), ("2023-05", 40.0, 2)]
    assert [tuple(r) for r in gold.hour_mart.collect()] == [(23, 1.5, 2)]
    assert register_layers(spark, lake) == ["bronze", "silver", "gold_fact"]
    assert gold.fact.dtypes[-2:] == [("pickup_month", "string"), ("pickup_hour", "int")]


def test_versions_are_numbered_and_old_ones_freed(spark, tmp_path):
    lake = Lake(str(tmp_path), replace(FOLDERS, periods=tuple(ROWS)), publish="pointer")
    land(spark, lake)
    assert not layer_exists(spark, lake, "bronze") and current_version(spark, lake, "bronze") == 0
    for number in (1, 2, 3):
        run_bronze(spark, lake)
        assert current_version(spark, lake, "bronze") == number
        assert locate(spark, lake, "bronze") == lake.version("bronze", number)
    rows = [spark.read.parquet(lake.version("bronze", n)).count() for n in (1, 2, 3)]
    assert rows == [0, 3, 3]
    # a lake that has pointers keeps them, however it is opened later
    assert run_bronze(spark, replace(lake, publish="rename")).rows == 3
    assert current_version(spark, lake, "bronze") == 4


def test_failed_gate_publishes_nothing(spark, lake):
    run_all(spark, lake)
    before = amounts(spark, lake)
    land(spark, lake, ROWS | {"2023-05": [trip(riders=10.0)]})
    with pytest.raises(DataQualityError, match="passenger_count_range"):
        run_all(spark, lake)
    assert amounts(spark, lake) == before


def test_stages_run_without_a_jvm_handle(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path), replace(FOLDERS, periods=tuple(ROWS)))
    land(spark, lake)

    def out_of_reach(*args):
        raise AssertionError("the JVM was used")

    monkeypatch.setattr(lakes, "_has_jvm", lambda spark: False)
    monkeypatch.setattr(lakes, "_hadoop_path", out_of_reach)
    monkeypatch.setattr(lakes, "_file_system", out_of_reach)
    assert run_all(spark, lake).fact.count() == 3
    assert register_layers(spark, lake) == ["bronze", "silver", "gold_fact"]


def counted_stages(monkeypatch, dies=None):
    done = []

    def wrap(name):
        whole = getattr(stages, f"run_{name}")

        def act(*args, **kwargs):
            if name == dies:
                raise Died
            done.append(name)
            return whole(*args, **kwargs)

        return act

    for name in ("bronze", "silver", "gold"):
        monkeypatch.setattr(stages, f"run_{name}", wrap(name))
    return done


def test_a_named_run_goes_on_where_it_died(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path), replace(FOLDERS, periods=tuple(ROWS)))
    land(spark, lake)
    for dies, did in [("bronze", []), ("silver", ["bronze"]), ("gold", ["silver"]), (None, ["gold"]), (None, [])]:
        with monkeypatch.context() as patch:
            done = counted_stages(patch, dies)
            if dies:
                with pytest.raises(Died):
                    run_all(spark, lake, run="monday")
            else:
                assert run_all(spark, lake, run="monday").fact.count() == 3
            assert done == did
    assert finished(spark, lake, "monday", lake.spec.periods) == ["bronze", "silver", "gold"]
    assert finished(spark, lake, "monday", ["2023-05"]) == []  # other periods are other work
    assert finished(spark, lake, "tuesday", lake.spec.periods) == []
    run_silver(spark, lake)
    assert finished(spark, lake, "monday", lake.spec.periods) == ["bronze"]  # silver is not the one it wrote
