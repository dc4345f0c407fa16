"""Reads landing files whose schemas drift, with lineage."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.unify import unify
from stratalake.sources.footers import census
from stratalake.spec import LOADED_AT, SOURCE_FILE

SchemaGroup = tuple[T.StructType, list[str]]


def _reader(spark: SparkSession) -> DataFrameReader:
    """Reads every file below a landing entry, whatever folders lie in between.

    The same for all entries, so rows and columns do not depend on whether types drift. Folders
    named ``key=value`` are folders like others; their names add no column.
    """
    return spark.read.option("recursiveFileLookup", "true")


def _merged_schema(spark: SparkSession, paths: Sequence[str]) -> T.StructType | None:
    """Union of the paths' columns, or None if a column's type differs between them.

    Spark reads the footers in parallel on the executors.
    """
    try:
        return _reader(spark).option("mergeSchema", "true").parquet(*paths).schema
    except Exception as error:  # its class and condition depend on the kind of session
        if "CANNOT_MERGE_SCHEMAS" in str(error):
            return None
        raise


def _files_below(spark: SparkSession, path: str) -> list[str]:
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path")
    )
    return sorted(row.path for row in listing.toLocalIterator())


def _runs(spark: SparkSession, paths: list[str]) -> list[SchemaGroup]:
    """Cuts ``paths`` into stretches of mergeable schemas by halving.

    For stores that only Spark reads. Types usually change once and stay, so this
    takes a few footer jobs per change instead of one per file.
    """
    schema = _merged_schema(spark, paths)
    if schema is not None:
        return [(schema, paths)]
    if len(paths) == 1:
        files = _files_below(spark, paths[0])
        if len(files) < 2:
            raise ValueError(f"cannot read a consistent schema from {paths[0]}")
        paths = files
    middle = len(paths) // 2
    return _runs(spark, paths[:middle]) + _runs(spark, paths[middle:])


def _joined(left: T.DataType, right: T.DataType) -> T.DataType | None:
    """A type in which one scan reads both, or None: fields may be absent, but not differ."""
    if isinstance(left, T.StructType) and isinstance(right, T.StructType):
        return _joined_fields(left, right)
    if isinstance(left, T.ArrayType) and isinstance(right, T.ArrayType):
        element = _joined(left.elementType, right.elementType)
        return element and T.ArrayType(element)
    if isinstance(left, T.MapType) and isinstance(right, T.MapType):
        key, value = _joined(left.keyType, right.keyType), _joined(left.valueType, right.valueType)
        return key and value and T.MapType(key, value)
    return left if left.simpleString() == right.simpleString() else None


def _joined_fields(left: T.StructType, right: T.StructType) -> T.StructType | None:
    fields = {field.name.lower(): field for field in left}
    for field in right:
        known = fields.get(field.name.lower())
        kind = _joined(known.dataType, field.dataType) if known else field.dataType
        if kind is None:
            return None
        fields[field.name.lower()] = T.StructField(known.name if known else field.name, kind)
    return T.StructType(list(fields.values()))


def _schemas(spark: SparkSession, paths: Sequence[str]) -> list[SchemaGroup]:
    """Files that have one schema, and that schema."""
    whole = _merged_schema(spark, paths)
    if whole is not None:
        return [(whole, list(paths))]
    found = census(spark, paths)
    if found is None:
        return _runs(spark, list(paths))
    return [(_reader(spark).parquet(example).schema, files) for example, files in found]


def schema_groups(spark: SparkSession, paths: Sequence[str]) -> list[SchemaGroup]:
    """Files that one scan can read together: no column or field has two types in a group."""
    groups: list[SchemaGroup] = []
    for schema, members in _schemas(spark, paths):
        for at, (known, earlier) in enumerate(groups):
            both = _joined(known, schema)
            if both is not None:
                groups[at] = (both, earlier + members)
                break
        else:
            groups.append((schema, members))
    return groups


def _decoded(name: Column) -> Column:
    """Spark reports names URL-encoded, except that a plus sign stays as it is."""
    decoded = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(name, F.lit("%")), decoded).otherwise(name)


def _entry_below(path: Column, root: str) -> Column:
    """The part of ``path`` that follows ``root``, up to the next slash; NULL elsewhere."""
    mark = F.lit(f"/{root.strip('/')}/")
    at = F.locate(f"/{root.strip('/')}/", path)
    return F.when(at > 0, F.substring_index(F.substr(path, at + F.length(mark)), "/", 1))


def _origin(level: str, roots: Sequence[str]) -> Column:
    """Landing entry of a row: its file's name, or the name of the folder below a landing root."""
    if level == "file":
        return _decoded(F.col("_metadata.file_name"))
    path = _decoded(F.col("_metadata.file_path"))
    around = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.coalesce(*[_entry_below(path, root) for root in roots], around)


def landing_roots(paths: Sequence[str]) -> list[str]:
    """The folders that hold the landing entries, without scheme and host, longest first."""
    places = {urlsplit(path).path if "://" in path else path.removeprefix("file:") for path in paths}
    roots = {place.rstrip("/").rpartition("/")[0] for place in places}
    return sorted((root for root in roots if root.strip("/")), key=len, reverse=True)


def with_lineage(scan: DataFrame, level: str = "file", roots: Sequence[str] = ()) -> DataFrame:
    """Adds the landing entry a row came from and the time of the load."""
    return scan.withColumns(
        {SOURCE_FILE: _origin(level, roots), LOADED_AT: F.current_timestamp()}
    )


def read_landing(spark: SparkSession, paths: Sequence[str], level: str = "file") -> DataFrame:
    """All landing entries as one frame.

    The plan has one scan per schema group, however many files there are.
    """
    if not paths:
        raise ValueError("no landing paths given")
    scans = [
        with_lineage(_reader(spark).schema(schema).parquet(*members), level, landing_roots(paths))
        for schema, members in schema_groups(spark, paths)
    ]
    return unify(scans)
