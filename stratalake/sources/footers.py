"""Schemas of many Parquet files in one job: tasks read the footers, equal ones are counted together."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: where Spark keeps a file's schema in its own words.
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
FORM = "entry int, path string, form string"


def _place(path: str) -> str:
    """The path without scheme and host."""
    place = urlsplit(path).path if "://" in path else path.removeprefix("file:")
    return place.rstrip("/")


def _open(path: str):
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file" or path.startswith("/"):
        return fs.LocalFileSystem().open_input_file(_place(path))
    system, name = fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@')}")
    return system.open_input_file(name)


def _form(path: str) -> str | None:
    """A digest of the schema in a file's footer; None where Arrow cannot open the store."""
    from pyarrow import parquet

    try:
        file = _open(path)
    except (OSError, pa.ArrowInvalid, pa.ArrowNotImplementedError):
        return None
    with file:
        footer = parquet.ParquetFile(file).metadata
    columns = repr(footer.schema).partition("\n")[2]  # the first line names an object in memory
    own = (footer.metadata or {}).get(_SPARK_SCHEMA, b"")
    return hashlib.md5(columns.encode() + own).hexdigest()


def footer_forms(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``entry, path, form`` of every file: the number of its landing entry (-1: none), and its schema's digest."""
    entries = sorted(((_place(path), at) for at, path in enumerate(paths)), key=lambda x: -len(x[0]))
    schema = pa.schema([("entry", pa.int32()), ("path", pa.string()), ("form", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = batch.column("path").to_pylist()
            owner = []
            for place in map(_place, files):
                owner.append(next((at for root, at in entries if place == root or place.startswith(root + "/")), -1))
            yield pa.record_batch([pa.array(owner, pa.int32()), pa.array(files), pa.array(map(_form, files), pa.string())], schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return files.select("path").mapInArrow(read, FORM)


def census(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, list[str]]] | None:
    """A file of each schema, and the entries or files that have it; None if a footer is out of Arrow's reach.

    Two jobs at most, however many files there are and however their schemas take turns. What
    comes to the driver is a row per entry and schema in it; paths of single files come only from
    entries whose files differ.
    """
    forms = footer_forms(spark, paths)
    found = forms.groupBy("entry", "form").agg(F.min("path").alias("one")).collect()
    if any(row.form is None for row in found):
        return None
    of_entry = defaultdict(list)
    for row in found:
        of_entry[row.entry].append(row)
    members: dict[str, list[str]] = defaultdict(list)
    example = {row.form: row.one for row in sorted(found, key=lambda row: row.one, reverse=True)}
    mixed = [entry for entry, rows in of_entry.items() if entry < 0 or len(rows) > 1]
    for entry, rows in sorted(of_entry.items()):
        if entry not in mixed:
            members[rows[0].form].append(paths[entry])
    if mixed:
        for row in sorted(forms.filter(F.col("entry").isin(mixed)).collect(), key=lambda row: row.path):
            members[row.form].append(row.path)
    return [(example[form], files) for form, files in members.items()]
