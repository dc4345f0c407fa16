"""Layered batch tables on Spark: ingest, conform, audit, aggregate, query."""

from stratalake.operators.gates import (
    DataQualityError,
    bronze_report,
    gate_bronze,
    gate_silver,
    silver_report,
)
from stratalake.operators.reports import (
    diagnostics,
    discard_report,
    profile,
    reject_reasons,
    rows_by_file,
)
from stratalake.plans.answers import hour_answer, month_answer, run_query
from stratalake.plans.sizing import shuffle_sized_for
from stratalake.plans.stages import run_all, run_bronze, run_gold, run_silver
from stratalake.sources.lake import (
    Lake,
    read_layer,
    register_fact,
    register_layers,
    save_fact_table,
)
from stratalake.sources.landing import read_landing
from stratalake.spec import TRIPS, DatasetSpec

__all__ = [
    "TRIPS",
    "DataQualityError",
    "DatasetSpec",
    "Lake",
    "bronze_report",
    "diagnostics",
    "discard_report",
    "gate_bronze",
    "gate_silver",
    "hour_answer",
    "month_answer",
    "profile",
    "read_landing",
    "read_layer",
    "register_fact",
    "register_layers",
    "reject_reasons",
    "rows_by_file",
    "run_all",
    "run_bronze",
    "run_gold",
    "run_query",
    "run_silver",
    "save_fact_table",
    "shuffle_sized_for",
    "silver_report",
]
