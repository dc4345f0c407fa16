"""Drift inside structs, arrays and maps; footers of many files; whole numbers as text."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import stratalake.sources.landing as landing
from helpers import plan_of
from stratalake.functions.typed import coerce
from stratalake.operators.unify import common_type, unify
from stratalake.sources.landing import read_landing, schema_groups
from test_landing import put


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def kind(ddl):
    return T.StructType.fromDDL(f"x {ddl}").fields[0].dataType


@pytest.mark.parametrize(
    ("kinds", "expected"),
    [
        (("array<int>", "array<bigint>"), "array<bigint>"),
        (("array<int>", "array<string>"), "array<string>"),
        (("struct<a:int>", "struct<A:bigint,b:string>"), "struct<a:bigint,b:string>"),
        (("struct<a:struct<b:int>>", "struct<a:struct<b:string>>"), "struct<a:struct<b:string>>"),
        (("map<int,int>", "map<bigint,double>"), "map<bigint,double>"),
        (("map<int,int>", "map<double,int>"), "map<string,int>"),
        (("map<double,int>", "map<double,bigint>"), "map<double,bigint>"),
        (("array<struct<a:int>>", "array<struct<b:date>>"), "array<struct<a:int,b:date>>"),
        (("struct<a:int>", "int"), "string"),
        (("array<int>", "map<int,int>"), "string"),
    ],
)
def test_common_nested_type(spark, kinds, expected):
    assert common_type([kind(k) for k in kinds]).simpleString() == expected


def test_values_keep_their_shape(spark, ansi):
    frames = [
        spark.sql("SELECT 1 n, named_struct('x', 1, 'Y', 'a') s, array(1, 2) a, map(1, 1.5D) m, named_struct('z', null) w"),
        spark.sql("SELECT 2 n, named_struct('x', 'one', 'd', named_struct('e', 2)) s, array(3000000000) a, map(2.5D, 2) m, 'text' w"),
        spark.sql("SELECT 3 n, CAST(null AS struct<x:int>) s, CAST(null AS array<int>) a, CAST(null AS map<int,int>) m, array(1) w"),
    ]
    rows = sorted(unify(frames).collect())
    assert [r.s and (r.s.x, r.s.Y, r.s.d and r.s.d.e) for r in rows] == [("1", "a", None), ("one", None, 2), None]
    assert [r.a for r in rows] == [[1, 2], [3_000_000_000], None]
    assert [r.m for r in rows] == [{"1": 1.5}, {"2.5": 2.0}, None]
    assert [r.w for r in rows] == ['{"z":null}', "text", "[1]"]


def test_struct_fields_that_are_absent_share_a_scan(spark, tmp_path):
    paths = [
        put(tmp_path / "1.parquet", s=pa.array([{"a": 1}]), n=pa.array([1], pa.int32())),
        put(tmp_path / "2.parquet", s=pa.array([{"b": "x"}]), n=pa.array([2], pa.int64())),
        put(tmp_path / "3.parquet", s=pa.array([{"a": 3, "b": "y"}]), n=pa.array([3], pa.int32())),
    ]
    assert len(schema_groups(spark, paths)) == 2
    rows = sorted(read_landing(spark, paths).collect(), key=lambda r: r.n)
    assert [(r.s.a, r.s.b) for r in rows] == [(1, None), (None, "x"), (3, "y")]


def jobs(spark, label, act):
    sc = spark.sparkContext
    sc.setJobGroup(label, label)
    try:
        act()
    finally:
        sc._jsc.clearJobGroup()
    return len(sc.statusTracker().getJobIdsForGroup(label))


def test_alternating_types_take_a_constant_number_of_jobs(spark, tmp_path):
    def files(n):
        shapes = (lambda i: pa.array([i], pa.int32()), lambda i: pa.array([i], pa.int64()), lambda i: [str(i)])
        return [put(tmp_path / f"{n}" / f"{i:03}.parquet", x=shapes[i % 3](i)) for i in range(n)]

    few, many = files(6), files(60)
    counts = [jobs(spark, f"census {len(paths)}", lambda p=paths: schema_groups(spark, p)) for paths in (few, many)]
    assert max(counts) <= 8  # two of them list files, where there are many paths
    groups = schema_groups(spark, many)
    assert sorted(len(members) for _, members in groups) == [20, 20, 20]
    frame = read_landing(spark, many)
    assert plan_of(frame).count("FileScan") == 3
    assert sorted(int(r.x) for r in frame.collect()) == list(range(60))


def test_folders_that_drift_inside_and_agree_elsewhere(spark, tmp_path):
    whole = [put(tmp_path / "a.parquet" / f"{i}.parquet", x=pa.array([i], pa.int64())) for i in range(3)]
    for i in range(4):
        put(tmp_path / "b%20 c.parquet" / f"{i}.parquet", x=pa.array([10 + i], pa.int32() if i % 2 else pa.int64()))
    paths = [str(tmp_path / name) for name in ("a.parquet", "b%20 c.parquet")]
    members = sorted(len(files) for _, files in schema_groups(spark, paths))
    assert members == [2, 3]  # the first folder as one path, with two files of the second
    rows = read_landing(spark, paths, "folder").collect()
    assert sorted(r.x for r in rows) == [0, 1, 2, 10, 11, 12, 13] and len(whole) == 3
    assert {r.source_file for r in rows} == {"a.parquet", "b%20 c.parquet"}


def test_stores_out_of_reach_are_read_by_halves(spark, tmp_path, monkeypatch):
    paths = [put(tmp_path / f"{i}.parquet", x=pa.array([i], pa.int64() if i % 2 else pa.int32())) for i in range(4)]
    monkeypatch.setattr(landing, "census", lambda *args: None)
    assert sorted(r.x for r in read_landing(spark, paths).collect()) == [0, 1, 2, 3]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("9007199254740993.0", 9007199254740993),
        ("-9223372036854775808.0", -(2**63)),
        ("9223372036854775808", None),
        ("92233720368547758070e-1", 2**63 - 1),
        ("0.9999999999999999999", 0),
        ("1e3", 1000),
        ("1.5E+2", 150),
        ("-12.99", -12),
        ("1" * 40, None),
        ("0" * 40 + "12.5", 12),
        ("1e400", None),
        ("0e999999999999", 0),
        ("7e-99999999999999", 0),
        ("\t12.0\n", 12),
        (".5", 0),
        ("5.", 5),
        ("+7.0", 7),
        (".", None),
        ("", None),
        ("1.2e1.5", None),
        ("true", 1),
        (None, None),
    ],
)
def test_whole_numbers_as_text(spark, ansi, text, expected):
    frame = spark.createDataFrame([(text,)], "x string")
    assert frame.select(coerce(F.col("x"), T.StringType(), "bigint").alias("n")).first().n == expected
