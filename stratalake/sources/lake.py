"""Layer tables, addressed by path below one root."""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import urlsplit

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.marts import fact_columns
from stratalake.spec import LOADED_AT, SOURCE_FILE, DatasetSpec

# The view names under which layers can be queried.
VIEWS = {"bronze": "bronze", "silver": "silver", "gold_fact": "fact"}
FACT_VIEW = "fact_trips"
# URI schemes whose stores rename a folder without copying it.
RENAMING_SCHEMES = ("", "file", "hdfs", "viewfs", "abfss")

# What a pointer object says, and how many versions keep their files.
POINTER = "version bigint"
KEPT_VERSIONS = 2

# Error conditions that mean "no table here", for files and for Delta.
_ABSENT = {
    "PATH_NOT_FOUND",
    "UNABLE_TO_INFER_SCHEMA",
    "DELTA_MISSING_DELTA_TABLE",
    "DELTA_PATH_DOES_NOT_EXIST",
    "DELTA_SCHEMA_NOT_SET",
    "DELTA_TABLE_NOT_FOUND",
}


@dataclass(frozen=True)
class Lake:
    """Where the layers of one dataset live.

    ``root`` may be any URI Spark can reach. ``publish`` says how an audited
    table replaces the old one when the format has no transactions: ``rename``
    moves folders; ``pointer`` writes each version into a folder of its own and
    then adds one small object that names it, for object stores, where a rename
    copies file by file, and for sessions without a JVM at hand (Spark Connect).
    The default goes by the scheme of ``root``, or where it has none by that of
    the file system Spark resolves it to. A layer that has a pointer keeps it.
    With ``delta`` the write itself is atomic.

    Readers find the old table or the new one at any moment, also where a run
    died. Two runs may not publish one layer at the same time.
    """

    root: str
    spec: DatasetSpec
    fmt: str = "parquet"
    publish: str | None = None

    def __post_init__(self) -> None:
        if self.publish not in (None, "rename", "pointer"):
            raise ValueError(f"publish must be rename or pointer: {self.publish}")

    @property
    def renames(self) -> bool:
        if self.fmt == "delta":
            return False
        by_scheme = urlsplit(self.root).scheme in RENAMING_SCHEMES
        return by_scheme if self.publish is None else self.publish == "rename"

    @classmethod
    def from_env(cls, spec: DatasetSpec, default: str = "data", **options) -> Lake:
        return cls(os.environ.get("DATA_ROOT", default), spec, **options)

    def _at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def landing(self, period: str) -> str:
        return self._at("landing", self.spec.landing_name(period))

    def path(self, layer: str) -> str:
        spec = self.spec
        places = {
            "bronze": ("bronze", spec.table),
            "silver": ("silver", spec.table),
            "fact": ("gold", spec.fact_table),
            "month_mart": ("gold", spec.month_mart),
            "hour_mart": ("gold", spec.hour_mart),
        }
        return self._at(*places[layer])

    def staging(self, layer: str) -> str:
        return self._at("_staging", layer, self.path(layer).rsplit("/", 1)[-1])

    def retired(self, layer: str) -> str:
        return self._at("_retired", layer, self.path(layer).rsplit("/", 1)[-1])

    def pointer(self, layer: str) -> str:
        """Folder of the objects that name the layer's versions; the highest number counts."""
        return f"{self.path(layer)}/_pointer"

    def version(self, layer: str, number: int) -> str:
        return f"{self.path(layer)}/_versions/{number:08}"

    @property
    def journal(self) -> str:
        return self._at("_journal")


def _declared_schema(spec: DatasetSpec, layer: str) -> T.StructType | None:
    """Schema of the layers whose columns the spec fixes; saves reading footers.

    It also keeps a month from being read as something other than text when it
    comes from a folder name.
    """
    columns = dict(spec.columns)
    if layer == "silver":
        columns |= {SOURCE_FILE: "string", LOADED_AT: "timestamp_ltz"}
    elif layer == "fact":
        columns |= {spec.month_column: "string", spec.hour_column: "int"}
    else:
        return None
    return T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in columns.items()))


def _load(spark: SparkSession, lake: Lake, layer: str, path: str) -> DataFrame:
    schema = None if lake.fmt == "delta" else _declared_schema(lake.spec, layer)
    reader = spark.read.format(lake.fmt)
    table = (reader.schema(schema) if schema else reader).load(path)
    return table.select(*fact_columns(lake.spec)) if layer == "fact" else table


def _absent(error: AnalysisException) -> bool:
    return error.getCondition() in _ABSENT


def appended_rows(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """Rows of a folder of small JSON objects, or None if there is no such folder."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if _absent(error):
            return None
        raise


def append_row(spark: SparkSession, path: str, schema: str, row: tuple) -> None:
    """Adds one object. It appears whole or not at all, and changes no other."""
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").json(path)


def current_version(spark: SparkSession, lake: Lake, layer: str) -> int:
    """Number of the version the layer's pointer names; 0 without a pointer."""
    if lake.fmt == "delta":
        return 0
    named = appended_rows(spark, lake.pointer(layer), POINTER)
    return (named.agg(F.max("version")).first()[0] or 0) if named else 0


def _present(spark: SparkSession, lake: Lake, path: str) -> bool:
    """Asks the reader itself, so it holds for every file system and format."""
    try:
        spark.read.format(lake.fmt).load(path)
    except AnalysisException as error:
        if _absent(error):
            return False
        raise
    return True


def locate(spark: SparkSession, lake: Lake, layer: str) -> str:
    """The folder that holds the layer's table now.

    Without a pointer it is the layer's own path, or between the two moves of a
    rename the place where the old table waits.
    """
    version = current_version(spark, lake, layer)
    if version:
        return lake.version(layer, version)
    path = lake.path(layer)
    if lake.fmt != "delta" and not _present(spark, lake, path) and _present(spark, lake, lake.retired(layer)):
        return lake.retired(layer)
    return path


def read_layer(spark: SparkSession, lake: Lake, layer: str) -> DataFrame:
    return _load(spark, lake, layer, locate(spark, lake, layer))


def layer_exists(spark: SparkSession, lake: Lake, layer: str) -> bool:
    return _present(spark, lake, locate(spark, lake, layer))


def _write(df: DataFrame, fmt: str, path: str, partition_by: Sequence[str]) -> None:
    # A session may be set to replace only the months that are written; here a write is whole.
    writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def stage_layer(
    df: DataFrame, lake: Lake, layer: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Writes next to the layer, not over it, and returns what was written."""
    spark = df.sparkSession
    place = staged_at(spark, lake, layer)
    if publish_mode(spark, lake, layer) == "rename":
        _restore(spark, lake, layer)
    _write(df, lake.fmt, place, partition_by)
    return _load(spark, lake, layer, place)


def staged_at(spark: SparkSession, lake: Lake, layer: str) -> str:
    """Where the layer's next table is written before it is published."""
    if publish_mode(spark, lake, layer) == "pointer":
        return lake.version(layer, current_version(spark, lake, layer) + 1)
    return lake.staging(layer)


def publish_layer(
    spark: SparkSession, lake: Lake, layer: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Replaces the layer by its staged version and returns the table read back."""
    mode = publish_mode(spark, lake, layer)
    if mode == "rename":
        _swap(spark, lake, layer)
    elif mode == "pointer":
        _point(spark, lake, layer)
    else:
        _write(_load(spark, lake, layer, lake.staging(layer)), lake.fmt, lake.path(layer), partition_by)
        _empty(spark, lake, lake.staging(layer))
    spark.catalog.refreshByPath(lake.path(layer))
    return read_layer(spark, lake, layer)


def publish_mode(spark: SparkSession, lake: Lake, layer: str) -> str:
    """``rename``, ``pointer``, or ``write`` where the format has transactions."""
    if lake.fmt == "delta":
        return "write"
    if current_version(spark, lake, layer):
        return "pointer"
    if lake.publish:
        return lake.publish
    if not _has_jvm(spark):
        return "pointer"
    if urlsplit(lake.root).scheme:
        return "rename" if lake.renames else "pointer"
    scheme = _file_system(spark, _hadoop_path(spark, lake.root)).getScheme()
    return "rename" if scheme in RENAMING_SCHEMES else "pointer"


def _point(spark: SparkSession, lake: Lake, layer: str) -> None:
    """Names the staged version as the current one, in one object, then frees the last but one.

    The version before stays for readers that have already planned. Spark has no call to
    delete a folder, so an old version is overwritten by an empty table.
    """
    version = current_version(spark, lake, layer) + 1
    append_row(spark, lake.pointer(layer), POINTER, (version,))
    if version > KEPT_VERSIONS:
        _empty(spark, lake, lake.version(layer, version - KEPT_VERSIONS))


def _empty(spark: SparkSession, lake: Lake, path: str) -> None:
    _write(spark.range(0), lake.fmt, path, ())


def _has_jvm(spark: SparkSession) -> bool:
    """Whether Python can reach the session's JVM; with Spark Connect it cannot."""
    try:
        return spark._jvm is not None and spark._jsc is not None
    except (PySparkException, AttributeError):
        return False


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _restore(spark: SparkSession, lake: Lake, layer: str) -> None:
    """Puts the old table back if an earlier run died while publishing."""
    final, retired = (_hadoop_path(spark, where(layer)) for where in (lake.path, lake.retired))
    files = _file_system(spark, final)
    if files.exists(retired) and not files.exists(final):
        files.rename(retired, final)


def _swap(spark: SparkSession, lake: Lake, layer: str) -> None:
    """Moves the old table aside and the staged one into place.

    If the run dies between the moves, the old table is still in ``_retired``
    and the checked one in ``_staging``; the next run starts by restoring it.
    """
    staged, final, retired = (
        _hadoop_path(spark, where(layer)) for where in (lake.staging, lake.path, lake.retired)
    )
    files = _file_system(spark, final)
    for place in (final, retired):
        files.mkdirs(place.getParent())
    files.delete(retired, True)
    if files.exists(final) and not files.rename(final, retired):
        raise OSError(f"cannot move {final.toString()} aside")
    if not files.rename(staged, final):
        raise OSError(f"cannot move {staged.toString()} into place")
    files.delete(retired, True)


def replace_layer(
    df: DataFrame, lake: Lake, layer: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Full overwrite of a layer that needs no audit before it is published.

    Readers see the old table until the new one is complete, and it is written once.
    """
    if lake.fmt != "delta":
        stage_layer(df, lake, layer, partition_by)
        return publish_layer(df.sparkSession, lake, layer, partition_by)
    _write(df, lake.fmt, lake.path(layer), partition_by)
    return read_layer(df.sparkSession, lake, layer)


def register_layers(spark: SparkSession, lake: Lake) -> list[str]:
    """Makes every layer that exists a temporary view; returns the view names."""
    found = [view for view, layer in VIEWS.items() if layer_exists(spark, lake, layer)]
    for view in found:
        read_layer(spark, lake, VIEWS[view]).createOrReplaceTempView(view)
    return found


def register_fact(spark: SparkSession, lake: Lake, view: str = FACT_VIEW) -> str:
    read_layer(spark, lake, "fact").createOrReplaceTempView(view)
    return view


def save_fact_table(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """Publishes the fact as a catalog table, split by month like its files."""
    (
        read_layer(spark, lake, "fact")
        .write.format(lake.fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(lake.spec.month_column)
        .saveAsTable(name)
    )
    return spark.table(name)
