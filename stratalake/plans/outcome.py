"""What came of a stage, as a row: its error, the rule that stopped it, counts and the views there are."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratalake.operators.gates import DataQualityError
from stratalake.sources.lake import Lake, register_layers

OUTCOME = "stage string, passed boolean, layer string, rule string, violations bigint, rows bigint, views string"


def outcome(spark: SparkSession, lake: Lake, stage: str, act: Callable[[], int | None]) -> DataFrame:
    """Runs ``act``, which returns a row count or none, and reports it in one row.

    A gate's refusal is a result here; any other error is raised. ``views`` names the layers that
    can be queried afterwards, none if there are none.
    """
    stopped, rows = None, None
    try:
        rows = act()
    except DataQualityError as error:
        stopped = error
    views = ",".join(register_layers(spark, lake))
    verdict = (stopped.layer, stopped.rule, stopped.count) if stopped else (None, None, None)
    return spark.createDataFrame([(stage, stopped is None, *verdict, rows, views)], OUTCOME)
