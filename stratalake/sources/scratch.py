"""Shared scratch tables: what a job writes to cut its lineage."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application below the one the cluster shares.

    That is ``spark.checkpoint.dir``, or the warehouse where it is unset: both are read by
    every executor. What lies below goes when the Python process ends.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _ROOTS:
        shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
        if not shared:
            shared = spark.conf.get("spark.sql.warehouse.dir")
        root = f"{shared.rstrip('/')}/scratch-{sc.applicationId}-{uuid.uuid4().hex[:8]}"
        _ROOTS[sc.applicationId] = root
        atexit.register(_remove, spark, root)
    return _ROOTS[sc.applicationId]


def scratch_folder(spark: SparkSession, label: str = "table") -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str = "table") -> DataFrame:
    """The frame written once as Parquet and read back."""
    folder = scratch_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def drop_stored(*frames: DataFrame) -> None:
    """Removes what ``stored`` wrote for these frames; nothing may read them afterwards."""
    for df in frames:
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            _remove(df.sparkSession, folder)


def _remove(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
