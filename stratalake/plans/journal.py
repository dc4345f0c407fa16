"""Which stages of a named run are finished, so that a rerun starts at the first that is not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from stratalake.sources.lake import Lake, append_row, appended_rows, layer_exists, read_layer

ENTRY = "run string, stage string, periods string, source string, result string"
# The table a stage reads, and the ones it writes, in the order of the stages.
STAGES = {
    "bronze": (None, ("bronze",)),
    "silver": ("bronze", ("silver",)),
    "gold": ("silver", ("fact", "month_mart", "hour_mart")),
}
# The part of a data file's name that all files of one write share.
_WRITE = r"([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})"


def written_by(spark: SparkSession, lake: Lake, layer: str) -> str:
    """The write that made the layer's table: the same on every read, another after each write."""
    if not layer_exists(spark, lake, layer):
        return ""
    one = read_layer(spark, lake, layer).select(F.regexp_extract("_metadata.file_name", _WRITE, 1)).first()
    return one[0] if one else "empty"


def _tables(spark: SparkSession, lake: Lake, stage: str) -> tuple[str, str]:
    source, results = STAGES[stage]
    read = written_by(spark, lake, source) if source else ""
    return read, " ".join(written_by(spark, lake, layer) for layer in results)


def note(spark: SparkSession, lake: Lake, run: str | None, stage: str, periods: Sequence[str]) -> None:
    """Adds a finished stage, with the tables it read and wrote; runs without a name leave no trace."""
    if run is not None:
        append_row(spark, lake.journal, ENTRY, (run, stage, " ".join(periods), *_tables(spark, lake, stage)))


def finished(spark: SparkSession, lake: Lake, run: str | None, periods: Sequence[str]) -> list[str]:
    """The first stages of the run that need not be done again, in order."""
    entries = appended_rows(spark, lake.journal, ENTRY) if run is not None else None
    if entries is None:
        return []
    known = {tuple(row) for row in entries.filter(F.col("run") == run).collect()}  # a few rows a run
    done = []
    for stage in STAGES:
        if (run, stage, " ".join(periods), *_tables(spark, lake, stage)) not in known:
            break
        done.append(stage)
    return done
