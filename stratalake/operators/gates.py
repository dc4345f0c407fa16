"""Data quality gates: a list of rules, measured together, enforced in order.

A gate measures and never repairs. ``*_metrics`` is one row of counts,
``*_report`` turns it into one row per rule, ``enforce`` raises on the first
rule that failed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.rules import Rule, broken_rules, is_null, outside
from stratalake.functions.typed import typed_columns
from stratalake.operators.keys import tally
from stratalake.spec import LINEAGE, DatasetSpec

REPORT_SCHEMA = "rule_no int, rule string, violations bigint, rows bigint, passed boolean"


class DataQualityError(Exception):
    """A gate stopped the run."""

    def __init__(self, layer: str, rule: str, count: int) -> None:
        super().__init__(f"data quality gate of {layer} failed: {rule} ({count} violations)")
        self.layer = layer
        self.rule = rule
        self.count = count


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    """Expected names the schema lacks. Reads no data."""
    present = {name.lower() for name in df.columns}
    return sorted(name for name in expected if name.lower() not in present)


def bronze_columns(spec: DatasetSpec) -> tuple[str, ...]:
    return (*spec.required, *LINEAGE)


def bronze_counts(df: DataFrame) -> list[Column]:
    no_lineage = F.lit(False)
    for name in LINEAGE:
        no_lineage = no_lineage | F.col(name).isNull()
    return [F.count(F.lit(1)).alias("rows"), F.count_if(no_lineage).alias("null_lineage")]


def bronze_metrics(df: DataFrame) -> DataFrame:
    return df.agg(*bronze_counts(df))


def _row_rules(spec: DatasetSpec) -> tuple[Rule, ...]:
    return (*broken_rules(spec), *[outside(*limits) for limits in spec.ranges])


def silver_metrics(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """All silver rules and uniqueness in one scan and one shuffle of distinct keys."""
    nulls = [is_null(name) for name in spec.required]
    return tally(df, typed_columns(df, spec), spec.key, [*nulls, *_row_rules(spec)])


def _report(metrics: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """One row per rule. ``not_empty`` has no violating rows to count, only a verdict."""
    rows = F.col("rows")
    entries = []
    for number, (name, violations) in enumerate(rules, start=1):
        passed = rows > 0 if name == "not_empty" else violations == 0
        entries.append(
            F.struct(
                F.lit(number).alias("rule_no"),
                F.lit(name).alias("rule"),
                violations.cast("bigint").alias("violations"),
                rows.alias("rows"),
                passed.alias("passed"),
            )
        )
    return metrics.select(F.inline(F.array(*entries)))


def bronze_rules() -> list[tuple[str, Column]]:
    return [
        ("required_columns", F.lit(0)),
        ("not_empty", F.lit(0)),
        ("lineage_present", F.col("null_lineage")),
    ]


def silver_rules(spec: DatasetSpec) -> list[tuple[str, Column]]:
    def wholly_null(name: str) -> Column:
        return F.when(F.col(f"{name}_nulls") == F.col("rows"), F.col("rows")).otherwise(0)

    return [
        ("required_columns", F.lit(0)),
        ("not_empty", F.lit(0)),
        *[(f"not_all_null:{name}", wholly_null(name)) for name in spec.required],
        *[(rule.name, F.col(rule.name)) for rule in _row_rules(spec)],
        ("unique_key", F.col("duplicate_keys")),
    ]


def bronze_verdicts(metrics: DataFrame) -> DataFrame:
    return _report(metrics, bronze_rules())


def silver_verdicts(metrics: DataFrame, spec: DatasetSpec) -> DataFrame:
    return _report(metrics, silver_rules(spec))


def missing_report(df: DataFrame, missing: Sequence[str]) -> DataFrame:
    """Report of a frame that cannot be measured because columns are missing."""
    rule = f"required_columns: missing {', '.join(missing)}"
    return df.sparkSession.createDataFrame(
        [(1, rule, len(missing), None, False)], REPORT_SCHEMA
    )


def bronze_report(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    missing = missing_columns(df, bronze_columns(spec))
    if missing:
        return missing_report(df, missing)
    return bronze_verdicts(bronze_metrics(df))


def silver_report(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    missing = missing_columns(df, spec.required)
    if missing:
        return missing_report(df, missing)
    return silver_verdicts(silver_metrics(df, spec), spec)


def enforce(report: DataFrame, layer: str) -> dict[str, int]:
    """Raises for the first failed rule, else returns the row count.

    The report has one row per rule, so collecting it is bounded by the spec.
    """
    verdicts = sorted(report.collect(), key=lambda verdict: verdict.rule_no)
    for verdict in verdicts:
        if not verdict.passed:
            raise DataQualityError(layer, verdict.rule, verdict.violations)
    return {"rows": verdicts[0].rows}


def gate_bronze(df: DataFrame, spec: DatasetSpec) -> dict[str, int]:
    return enforce(bronze_report(df, spec), "bronze")


def gate_silver(df: DataFrame, spec: DatasetSpec) -> dict[str, int]:
    return enforce(silver_report(df, spec), "silver")
