from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from helpers import plan_of
from stratalake.operators.unify import common_type, unify
from stratalake.sources.landing import read_landing, schema_groups


def put(path, **columns) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), path)
    return str(path)


@pytest.fixture
def drifted(tmp_path) -> list[str]:
    """INT then BIGINT vendor, an extra column, whole-number counts, another spelling."""
    stamp = pa.array([dt.datetime(2023, 1, 1)], pa.timestamp("us"))
    return [
        put(
            tmp_path / "m1.parquet",
            VendorID=pa.array([1], pa.int32()),
            passenger_count=[1.0],
            at=stamp,
        ),
        put(
            tmp_path / "m2.parquet",
            VendorID=pa.array([2**40], pa.int64()),
            passenger_count=[2.0],
            at=stamp,
            airport_fee=["x"],
        ),
        put(
            tmp_path / "m3.parquet",
            vendorid=pa.array([3], pa.int64()),
            passenger_count=pa.array([3], pa.int64()),
            at=stamp,
        ),
        put(
            tmp_path / "m4.parquet",
            VendorID=pa.array([4], pa.int32()),
            passenger_count=[4.0],
            at=stamp,
            tip=[0.5],
        ),
    ]


def test_drifting_files_become_one_frame(spark, drifted):
    frame = read_landing(spark, drifted)
    assert dict(frame.dtypes) == {
        "VendorID": "bigint",
        "passenger_count": "double",
        "at": "timestamp_ntz",
        "airport_fee": "string",
        "tip": "double",
        "source_file": "string",
        "ingestion_timestamp": "timestamp",
    }
    rows = sorted(
        (row.source_file, row.VendorID, row.passenger_count, row.airport_fee, row.tip)
        for row in frame.collect()
    )
    assert rows == [
        ("m1.parquet", 1, 1.0, None, None),
        ("m2.parquet", 2**40, 2.0, "x", None),
        ("m3.parquet", 3, 3.0, None, None),
        ("m4.parquet", 4, 4.0, None, 0.5),
    ]


def test_one_load_has_one_time(spark, drifted):
    assert read_landing(spark, drifted).select("ingestion_timestamp").distinct().count() == 1


def test_files_share_a_scan_unless_a_type_differs(spark, drifted):
    groups = [[path.rsplit("/", 1)[-1] for path in files] for _, files in schema_groups(spark, drifted)]
    assert sorted(map(sorted, groups)) == [
        ["m1.parquet", "m4.parquet"],
        ["m2.parquet"],
        ["m3.parquet"],
    ]
    assert plan_of(read_landing(spark, drifted)).count("FileScan") == 3


def test_many_equal_files_are_one_scan(spark, tmp_path):
    paths = [put(tmp_path / f"{n:02}.parquet", x=[n]) for n in range(20)]
    assert plan_of(read_landing(spark, paths)).count("FileScan") == 1
    assert read_landing(spark, paths).count() == 20


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_number_meeting_text_becomes_text(spark, tmp_path, ansi):
    paths = [put(tmp_path / "n.parquet", x=[1]), put(tmp_path / "t.parquet", x=["one"])]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert sorted(row.x for row in read_landing(spark, paths).collect()) == ["1", "one"]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_unusual_names_are_reported_as_they_are(spark, tmp_path):
    name = "a b+c%20é.parquet"
    path = put(tmp_path / name, x=[1])
    assert read_landing(spark, [path]).first().source_file == name
    inside = put(tmp_path / "in b+c%" / "part-0.parquet", x=[1])
    folder = inside.rsplit("/", 1)[0]
    assert read_landing(spark, [folder], "folder").first().source_file == "in b+c%"


def test_folders_of_files(spark, tmp_path):
    for part in range(3):
        put(tmp_path / "jan.parquet" / f"part-{part}.parquet", x=pa.array([part], pa.int32()))
    put(tmp_path / "feb.parquet" / "part-0.parquet", x=pa.array([9], pa.int64()))
    paths = [str(tmp_path / name) for name in ("jan.parquet", "feb.parquet")]
    frame = read_landing(spark, paths, "folder")
    counts = {row.source_file: row["count"] for row in frame.groupBy("source_file").count().collect()}
    assert counts == {"jan.parquet": 3, "feb.parquet": 1}
    assert dict(frame.dtypes)["x"] == "bigint"


def test_folder_that_drifts_inside(spark, tmp_path):
    put(tmp_path / "jan.parquet" / "part-0.parquet", x=pa.array([1], pa.int32()))
    put(tmp_path / "jan.parquet" / "part-1.parquet", x=pa.array([2], pa.int64()))
    frame = read_landing(spark, [str(tmp_path / "jan.parquet")], "folder")
    assert sorted((row.x, row.source_file) for row in frame.collect()) == [
        (1, "jan.parquet"),
        (2, "jan.parquet"),
    ]


def test_zone_aware_file_among_zone_free_ones(spark, tmp_path):
    moment = dt.datetime(2023, 11, 5, 6, 30)
    paths = [
        put(tmp_path / "free.parquet", at=pa.array([moment], pa.timestamp("us"))),
        put(tmp_path / "utc.parquet", at=pa.array([moment], pa.timestamp("us", "UTC"))),
    ]
    frame = read_landing(spark, paths)
    assert dict(frame.dtypes)["at"] == "timestamp_ntz"
    assert {row.at for row in frame.collect()} == {moment}


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_landing(spark, [str(tmp_path / "none.parquet")])
    with pytest.raises(ValueError, match="no landing paths"):
        read_landing(spark, [])


@pytest.mark.parametrize(
    ("kinds", "expected"),
    [
        ((T.IntegerType(), T.LongType()), T.LongType()),
        ((T.ByteType(), T.ShortType(), T.IntegerType()), T.IntegerType()),
        ((T.LongType(), T.DoubleType()), T.DoubleType()),
        ((T.FloatType(), T.FloatType()), T.FloatType()),
        ((T.FloatType(), T.IntegerType()), T.DoubleType()),
        ((T.DecimalType(10, 2), T.DecimalType(12, 4)), T.DecimalType(12, 4)),
        ((T.DecimalType(10, 2), T.LongType()), T.DecimalType(22, 2)),
        ((T.DecimalType(38, 0), T.DecimalType(38, 10)), T.StringType()),
        ((T.DecimalType(10, 2), T.DoubleType()), T.DoubleType()),
        ((T.DateType(), T.TimestampNTZType()), T.TimestampNTZType()),
        ((T.TimestampType(), T.TimestampType()), T.TimestampType()),
        ((T.NullType(), T.LongType()), T.LongType()),
        ((T.BooleanType(), T.LongType()), T.StringType()),
        ((T.StringType(), T.TimestampNTZType()), T.StringType()),
    ],
)
def test_common_type(kinds, expected):
    assert common_type(kinds) == expected


def test_widening_keeps_every_value(spark):
    frames = [
        spark.sql("SELECT 1 AS a, CAST(1.25 AS DECIMAL(5, 2)) AS d"),
        spark.sql("SELECT 9007199254740993 AS a, CAST(7 AS BIGINT) AS d"),
    ]
    rows = {(row.a, row.d) for row in unify(frames).collect()}
    assert rows == {(1, Decimal("1.25")), (9007199254740993, Decimal("7"))}


def test_differing_structs_keep_their_fields(spark):
    frames = [
        spark.sql("SELECT named_struct('x', 1) AS s"),
        spark.sql("SELECT named_struct('x', 2, 'y', 'b') AS s"),
    ]
    assert {(row.s.x, row.s.y) for row in unify(frames).collect()} == {(1, None), (2, "b")}
